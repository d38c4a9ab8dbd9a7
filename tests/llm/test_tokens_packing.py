import math
import random
import zlib
from array import array

import pytest
from tokenizers import Tokenizer

from trendcast.llm import packing, tokens
from trendcast.llm.queries import QUERIES
from trendcast.llm.vocabulary import PrefixCounter, WordEncoder, tokenizer_path

ODD = [
    "", "a  b\n\n c", "don't we'll I'LL we're'", "<|endoftext|>x <|endoftext", "  ", "\n\n x", "   x", "a\x1cb!\x1c!",
    "ﬁ ｱ é́ İ ß ẞ Å ½ ²", "\U0001F44D\U0001F3FD a", "x<|startoftext|>y", "a　b", "'s 's's", "1234 5 6", "\t\tx  ",
    "ª µ º × ÷", "<|endoftext|><|endoftext|>  a", "日本語 テキスト", "a" * 300, " " * 50 + "x", "éa ́", "x" * 20000,
    "wor ld\r\nwörld ÀÉ", "  \xa0  b", "a b  c   d    e\n  f", "it'll 'Re 'll'",
]


@pytest.fixture(scope="module")
def byte_bpe():
    return Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))


def test_ids_equal_the_library():
    encoder, library = WordEncoder(tokenizer_path("word_bpe_49k.json")), Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    for text in ODD:
        ids = array("I")
        ids.frombytes(encoder.encode(text))
        assert list(ids) == library.encode(text, add_special_tokens=False).ids, text[:40]


def test_every_prefix_equals_encoding_it(byte_bpe):
    counter = PrefixCounter(tokenizer_path("byte_bpe_50k.json"))
    rng = random.Random(1)
    mixed = ["".join(rng.choice([" ", "\n", "a", "the", "'ll", "é", "12", "!?", "ing", "  ", "<|endoftext|>"])
                     for _ in range(40)) for _ in range(40)]
    for text in [t[:400] for t in ODD] + mixed:
        count = 0
        for k, change in enumerate(array("h", counter.changes(text)), 1):
            count += change
            assert count == len(byte_bpe.encode(text[:k], add_special_tokens=False).ids), repr(text[:k][-30:])


def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as ids", "2 as n_tokens")


def test_count_query_and_budgets(spark, tmp_path, byte_bpe):
    texts = [*ODD, None, "word " * 1024, "word " * 1025]
    docs = documents(spark, texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op5_token_counts"](spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        n = len(byte_bpe.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((text or "").encode()), n > 1024)
    counts = tokens.prefix_counts(docs.where("doc_id in (1, 2)"))
    from pyspark.sql import functions as F
    r = counts.select("doc_id", tokens.tokens_of_prefix(F.col("prefix_changes"), F.lit(4)).alias("n"),
                      tokens.longest_prefix(F.col("prefix_changes"), F.lit(3)).alias("k")).collect()
    for row in r:
        text = texts[row.doc_id]
        assert row.n == len(byte_bpe.encode(text[:4]).ids)
        assert row.k == max(i for i in range(len(text) + 1) if len(byte_bpe.encode(text[:i]).ids) <= 3)


def test_best_fit_takes_the_tightest_bin():
    assert sorted(map(sorted, packing.best_fit([6, 5, 4, 3, 2], 10))) == [[0, 2], [1, 3, 4]]


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_packing_is_whole_and_tight(spark, parts):
    rng = random.Random(parts)
    sizes = [rng.choice([rng.randint(1, 4096), rng.randint(1, 900), 4096, 1]) for _ in range(3000)]
    items = spark.createDataFrame(list(enumerate(sizes)), "item long, length long").repartition(parts)
    got = packing.pack(items, task_items=500).collect()
    assert sorted(r.item for r in got) == list(range(3000))
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, sizes[r.item]))
    for members in bins.values():
        at = 0
        for offset, size in sorted(members):
            assert offset == at
            at += size
        assert at <= 4096
    assert len(bins) <= math.ceil(sum(sizes) / 4096) * 1.02 + 1


def test_items_that_fit_with_nothing(spark):
    items = spark.createDataFrame([(i, 3000) for i in range(900)], "item long, length long").repartition(20)
    assert packing.pack(items, task_items=50).select("sequence_id").distinct().count() == 900


def test_packing_query(spark, tmp_path):
    texts = [*ODD, None, "word " * 9000, "word " * 4095, "word " * 4096]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = {}
    for i, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for p in range(0, len(ids), 4096):
            cut = ids[p:p + 4096]
            want[i, p // 4096] = (p, len(cut), zlib.crc32(array("I", cut).tobytes()))
    rows = QUERIES["op1_best_fit_packing"](spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op1_best_fit_packing"](spark, str(tmp_path)).count() == 0
    assert QUERIES["op5_token_counts"](spark, str(tmp_path)).count() == 0
