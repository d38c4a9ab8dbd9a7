"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic passages and one on ordinary text. A window of a text (a word
with its borders; a run without white space above 512 characters is cut into overlapping windows, all of which count)
is compressed with each; the difference of the lengths is its evidence. Each letter is first
spelled as a code of four bytes, so that a letter costs more than a match and the lengths count the phrases that a
dictionary lacks. A text's score is a logistic function of how many windows pass each of several thresholds, with
weights calibrated on labelled texts that the dictionaries of that step have not seen.

The toxic passages of a toxic text are not marked; they are taken to be the windows whose beginnings are far more
frequent in toxic texts than in ordinary ones, near copies counted once.

The model is fitted on at most ``sample`` labelled rows of each class, those with the smallest hashes of their ids:
a bounded sample, whose ids only are broadcast. It has a few kilobytes and travels with the tasks. Scoring reads
each text once, in place, and keeps a bounded cache of windows.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from trendcast.llm.shared import small_batches, tidy

SAMPLE = 2500
PLAIN_WINDOWS = 30_000
LONGEST, OVERLAP = 512, 64  # characters of a window, and those that it shares with the next one of its run
CACHE, ENTRY = 32 << 20, 200  # bytes of the cache of windows, and of an entry beside its window
LEVEL, TOXIC_BYTES, ORDINARY_BYTES = 12, 4096, 16384
THRESHOLDS = (2, 4, 5, 6, 7, 8, 10)  # bytes
MARKS = ".,!?*%$&|\"'()[]{}:;-_#@<>/\\0123456789"
CODES = [hashlib.blake2b(bytes([b]), digest_size=4).digest() for b in range(256)]


def windows(text: str) -> list[str]:
    """Words without their marks, in order; one above ``LONGEST`` characters as overlapping parts that cover it."""
    words = [w for w in (w.strip(MARKS) for w in text.lower().split()) if len(w) > 2]
    if not any(len(w) > LONGEST for w in words):
        return words
    step = LONGEST - OVERLAP
    return [w[k:k + LONGEST] for w in words for k in range(0, max(1, len(w) - OVERLAP), step)]


def spelled(window: str) -> bytes:
    return b"".join([CODES[b] for b in f" {window} ".encode()])


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]
    centre: tuple[float, ...]
    scale: tuple[float, ...]


class Scorer:
    def __init__(self, model: Model):
        import zstandard

        def compressor(content):
            known = zstandard.ZstdCompressionDict(content)
            known.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False,
                                            write_checksum=False, write_dict_id=False)

        self.model, self.toxic, self.ordinary = model, compressor(model.toxic), compressor(model.ordinary)
        self.known: dict[str, int] = {}
        self.held = 0

    def _fresh(self, window: str) -> int:
        code = spelled(window)
        if self.held > CACHE:
            self.known.clear()
            self.held = 0
        self.held += len(window) + ENTRY
        gain = self.known[window] = len(self.ordinary.compress(code)) - len(self.toxic.compress(code))
        return gain

    def features(self, text: str) -> np.ndarray:
        known = self.known.get
        gains = [g if (g := known(w)) is not None else self._fresh(w) for w in windows(text)]
        if not gains:
            return np.zeros(2 * len(THRESHOLDS) + 1)
        d = np.array(gains)
        counts = (d[:, None] >= THRESHOLDS).sum(axis=0)
        return np.concatenate([np.log1p(counts), np.sqrt(counts / len(d)), [max(0, d.max()) / 10]])

    def score(self, text: str) -> float:
        m = self.model
        z = m.weights[0] + float(((self.features(text) - m.centre) / m.scale) @ m.weights[1:])
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def _distinct(texts: list[str]) -> list[str]:
    """One of the texts that share their smallest hash of five words in a row: near copies mostly do."""
    found = {}
    for text in texts:
        w = windows(text)
        key = min((zlib.crc32(" ".join(w[k:k + 5]).encode()) for k in range(max(1, len(w) - 4))), default=0)
        found.setdefault(key, text)
    return list(found.values())


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression, intercept first, by Newton steps."""
    x, w = np.column_stack([np.ones(len(x)), x]), np.zeros(x.shape[1] + 1)
    penalty = np.diag([1e-6] + [ridge] * (len(w) - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (weight * (y - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _dictionaries(toxic: list[str], ordinary: list[str], plain_windows: int = PLAIN_WINDOWS) -> Model:
    """A model without weights. The ordinary dictionary is trained on every n-th ordinary window, with the smallest n
    that leaves fewer than twice ``plain_windows``."""
    import zstandard

    seen, known = _distinct(toxic), _distinct(ordinary)

    def begins(texts):
        return Counter(b for t in texts for b in {w[:5] for w in windows(t)})

    ours, theirs = begins(seen), begins(known)
    least = max(2, 0.01 * len(seen))
    marked = {b for b, n in ours.items() if n >= least
              and (n + 0.5) / len(seen) >= 8 * (theirs[b] + 0.5) / len(known)}
    passages = [w for t in seen for w in windows(t) if w[:5] in marked]
    if len(passages) < 20:
        passages = [w for t in seen for w in windows(t)]
    plain = [w for t in known for w in windows(t)]
    plain = plain[:: max(1, len(plain) // plain_windows)]

    def trained(samples, size):
        codes = [spelled(w) for w in samples]
        try:
            return zstandard.train_dictionary(size, codes).as_bytes()
        except zstandard.ZstdError:  # too little text to train on: the text itself
            return b"".join(codes)[-size:] or b"\0" * 8

    return Model(trained(passages, TOXIC_BYTES), trained(plain, ORDINARY_BYTES), (), (), ())


def fit_texts(toxic: list[str], ordinary: list[str], rate: float, plain_windows: int = PLAIN_WINDOWS) -> Model | None:
    """A model from labelled texts; ``rate`` is the share of toxic texts among all. None without both classes.

    Each half of the texts is measured with dictionaries trained on the other half; the weights are fitted on those
    measures, and the dictionaries of the model are trained on all texts.
    """
    if min(len(toxic), len(ordinary)) < 4:
        return None
    x, y = [], []
    for part in (0, 1):
        scorer = Scorer(_dictionaries(toxic[part::2], ordinary[part::2], plain_windows))
        for texts, value in ((toxic, 1.0), (ordinary, 0.0)):
            x += [scorer.features(t) for t in texts[1 - part::2]]
            y += [value] * len(texts[1 - part::2])
    x, y = np.array(x), np.array(y)
    weight = np.where(y == 1, rate / y.mean(), (1 - rate) / (1 - y.mean()))
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    w = _logistic((x - centre) / scale, y, weight)
    model = _dictionaries(toxic, ordinary, plain_windows)
    return Model(model.toxic, model.ordinary, tuple(w), tuple(centre), tuple(scale))


def fold(doc_id: Column, folds: int = 3) -> Column:
    return F.crc32(doc_id.cast("string")) % folds


def fit(docs: DataFrame, labels: DataFrame, held_out: int = 1, folds: int = 3, sample: int = SAMPLE,
        plain_windows: int = PLAIN_WINDOWS) -> Model | None:
    """Fit on labelled rows whose fold is not ``held_out``, at most ``sample`` of each class. The dictionary of ordinary
    text is trained on ``plain_windows`` evenly spread windows of theirs, or up to twice as many."""
    usable = labels.where(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id"), folds) != held_out)).select("doc_id", "toxic")
    counts = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    order = F.xxhash64("doc_id"), F.col("doc_id")
    ids = usable.where("toxic = 1").orderBy(*order).limit(sample).unionByName(
        usable.where("toxic = 0").orderBy(*order).limit(sample))
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(ids), "doc_id").collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["text"]))
    by_class = {c: [r["text"] for r in rows if r["toxic"] == c] for c in (0, 1)}
    return fit_texts(by_class[1], by_class[0], counts[1] / (counts[0] + counts[1]), plain_windows)


def scores(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with a column ``score`` from 0 to 1 (replacing one of that name); a null text counts as empty, and
    without a model every score is 0."""
    columns = [c for c in docs.columns if c != "score"]
    rows, at = docs.select(*columns), columns.index("text")
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model else None
        for batch in batches:
            found = [scorer.score(t.as_py() or "") if scorer else 0.0 for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*columns, "score"])

    kinds = docs.select(*columns).schema.fields
    return rows.mapInArrow(tidy(work), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds) + ", score double")
