"""Language ID by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability is the sum over
all its segmentations into pieces, by the forward algorithm; a text's is the product over its words. Probabilities
start from one segmentation of each word and are re-estimated by expected counts over all segmentations.

A word is a run of letters, lower-cased; runs above ``LONGEST`` letters are cut. Expected counts are summed by Spark
over the distinct words of at most ``sample`` texts for each language, those with the smallest hashes of their ids.
The tables that come to the driver and go out with the tasks have the vocabulary's size for each language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from trendcast.llm.shared import small_batches, text_or_empty, tidy, written
from trendcast.llm.vocabulary import tokenizer_path

SAMPLE = 600
LONGEST = 48
CACHE = 300_000
FLOOR = 1e-7  # probability of a letter that is no piece
LETTERS = re.compile(r"[^\W\d_]+")
BORDER = "▁"


def words_of(text: str) -> list[str]:
    found = LETTERS.findall(text.lower())
    if max(map(len, found), default=0) <= LONGEST:
        return found
    return [w[k:k + LONGEST] for w in found for k in range(0, len(w), LONGEST)]


def vocabulary(path: str) -> list[str]:
    """The pieces with letters and single letters, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.vocab_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


class Forward:
    """Log-probabilities of words in each language, over all their segmentations, many words at a time."""

    def __init__(self, table: dict[str, np.ndarray], languages: int):
        self.number = {piece: k for k, piece in enumerate(table, 2)}
        # Row 0 is for strings that are no piece, row 1 for letters that are none.
        self.rows = np.array([np.zeros(languages), np.full(languages, FLOOR), *table.values()])
        self.longest = max(map(len, table), default=1)

    def _together(self, words: list[str]) -> np.ndarray:
        get, longest = self.number.get, self.longest
        spelled = [BORDER + w for w in words]
        sizes = np.array([len(w) for w in spelled])
        n, shape = int(sizes.max()), (len(words), self.rows.shape[1])
        sums = np.zeros((n + 1, *shape))
        sums[0] = 1
        scale, out = np.zeros((len(words), 1)), np.zeros(shape)
        for end in range(1, n + 1):
            for begin in range(max(0, end - longest), end):
                other = 1 if end - begin == 1 else 0
                at = np.array([get(w[begin:end], other) for w in spelled])
                if at.any():
                    sums[end] += sums[begin] * self.rows[at]
            done = sizes == end
            if done.any():
                out[done] = np.log(sums[end][done]) + scale[done]
            if end % 12 == 0:  # keep long words from underflow
                top = sums[end].max(axis=1, keepdims=True)
                top[top == 0] = 1
                sums[max(0, end + 1 - longest):end + 1] /= top
                scale += np.log(top)
        return out

    def __call__(self, words: list[str], block: int = 2048) -> np.ndarray:
        order = sorted(range(len(words)), key=lambda k: len(words[k]))  # words of like lengths go together
        out = np.zeros((len(words), self.rows.shape[1]))
        for k in range(0, len(order), block):
            part = order[k:k + block]
            out[part] = self._together([words[i] for i in part])
        return out


def expected_counts(word: str, table: dict[str, float], longest: int) -> dict[str, float]:
    """Expected number of each piece over all segmentations of a word, in one language."""
    word = BORDER + word
    n = len(word)
    ahead, behind = [1.0] + [0.0] * n, [0.0] * n + [1.0]
    arcs = []
    for end in range(1, n + 1):
        for begin in range(max(0, end - longest), end):
            piece = word[begin:end]
            p = table.get(piece) or (FLOOR if end - begin == 1 else 0.0)
            if p and ahead[begin]:
                arcs.append((begin, end, piece, p))
                ahead[end] += ahead[begin] * p
    for begin, end, _, p in reversed(arcs):
        behind[begin] += p * behind[end]
    out: dict[str, float] = {}
    if ahead[n]:
        for begin, end, piece, p in arcs:
            out[piece] = out.get(piece, 0.0) + ahead[begin] * p * behind[end] / ahead[n]
    return out


def fold(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(doc_id.cast("string")) % folds


class Model:
    """Languages in order, and for each piece its probabilities."""

    def __init__(self, languages: list[str], table: dict[str, np.ndarray]):
        self.languages, self.table = languages, table


def fit(docs: DataFrame, path: str | None = None, held_out: int = 0, folds: int = 5, sample: int = SAMPLE,
        rounds: int = 2, smoothing: float = 0.02) -> Model:
    """Learn from text and lang of documents whose fold is not ``held_out``."""
    path = path or tokenizer_path("piece_bpe_32k.model")
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = usable.select("doc_id", "lang").withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample).select(
        "doc_id", "lang").distinct()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, word = [], []
            for a, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = words_of(t)
                word += w
                lang += [a] * len(w)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(word, pa.string())], ["lang", "word"])

    texts = usable.join(F.broadcast(ids), ["doc_id", "lang"]).select("lang", "text")
    counted = written(texts.mapInArrow(tidy(split), "lang string, word string").groupBy("lang", "word").count(), "words")
    known = set(vocabulary(path))

    def summed(per_word):
        def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            expect = per_word()
            sums: dict[tuple[str, str], float] = {}
            for part in parts:
                for lang, word, n in part.itertuples(index=False):
                    for piece, c in expect(lang, word).items():
                        sums[lang, piece] = sums.get((lang, piece), 0.0) + n * c
            yield pd.DataFrame([(a, b, c) for (a, b), c in sums.items()], columns=["lang", "piece", "n"]).astype({"n": float})

        return counted.mapInPandas(work, "lang string, piece string, n double").groupBy("lang", "piece").agg(
            F.sum("n").alias("n")).collect()

    def segmented():
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)

        def one(lang, word):
            out: dict[str, float] = {}
            for piece in model.encode(word, out_type=str):
                out[piece] = out.get(piece, 0.0) + 1
            return out

        return one

    def tables(rows):
        out: dict[str, dict[str, float]] = {}
        for r in rows:
            if r["piece"] in known:
                out.setdefault(r["lang"], {})[r["piece"]] = r["n"]
        pieces = {p for t in out.values() for p in t}
        return {lang: {p: (t.get(p, 0.0) + smoothing) / (sum(t.values()) + smoothing * len(pieces)) for p in pieces}
                for lang, t in out.items()}

    now = tables(summed(segmented))
    for _ in range(rounds):
        longest = max((len(p) for t in now.values() for p in t), default=1)

        def marginal(now=now, longest=longest):
            return lambda lang, word: expected_counts(word, now.get(lang, {}), longest)

        now = tables(summed(marginal))
    languages = sorted(now)
    pieces = {p for t in now.values() for p in t}
    return Model(languages, {p: np.array([now[a][p] for a in languages]) for p in pieces})


def predictions(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text: the likeliest language with its share among all. A text that is
    null or has no letter, and every text without a learned language, is ``und`` with score 0."""
    kept = docs.select("doc_id", text_or_empty(docs).alias("text"))
    small_batches(docs.sparkSession)
    id_type = kept.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = model.languages
        forward = Forward(model.table, len(names))
        rows: dict[str, int] = {}
        values = np.zeros((CACHE, len(names)))

        def totals(texts: list[list[str]]) -> list[np.ndarray]:
            """Sums over the words of each text; words not known yet are worked out together."""
            fresh = list({w for words in texts for w in words}.difference(rows))
            if len(rows) + len(fresh) > CACHE and rows:
                rows.clear()
                return totals(texts)
            if len(fresh) > CACHE:  # more words than the cache holds
                if len(texts) > 1:
                    return [t for words in texts for t in totals([words])]
                words = texts[0]
                return [sum(totals([words[k:k + CACHE]])[0] for k in range(0, len(words), CACHE))]
            if fresh:
                begin = len(rows)
                values[begin:begin + len(fresh)] = forward(fresh)
                rows.update(zip(fresh, range(begin, begin + len(fresh))))
            return [values[[rows[w] for w in words]].sum(axis=0) for words in texts]

        for batch in batches:
            language, score = [], []
            for k in range(0, batch.num_rows, 128):
                texts = [words_of(value.as_py()) for value in batch.column(1)[k:k + 128]]
                for words, logs in zip(texts, totals(texts) if names else texts):
                    if not words or not names:
                        language.append("und")
                        score.append(0.0)
                        continue
                    p = np.exp(logs - logs.max())
                    language.append(names[int(np.argmax(p))])
                    score.append(float(p.max() / p.sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(language, pa.string()), pa.array(
                score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return kept.mapInArrow(tidy(work), f"doc_id {id_type}, lang_pred string, score double")
