import os
import random
import re
import string
from collections import Counter

import pytest

from tests.compare import connect, difference
from trendcast.llm import collocations

SCHEMA = "lang string, text string, w1 int, word string, n int, code int"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(docs, least, top=2000):
    f, n = Counter(), Counter()
    for lang, text in docs:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            ws = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(ws)
            f.update((lang or "und", tuple(ws[i:i + m])) for m in range(1, 5) for i in range(len(ws) - m + 1))
    longer = {}
    for (lang, ph), c in f.items():
        if c >= least:
            for i in range(len(ph)):
                for j in range(i + 1, len(ph) + 1):
                    if j - i < len(ph):
                        longer[lang, ph[i:j]] = max(longer.get((lang, ph[i:j]), 0), c)
    out = {}
    for (lang, ph), a in f.items():
        if len(ph) > 1 and a >= least and 100 * longer.get((lang, ph), 0) < 80 * a:
            score, k = min((2000000 * a // (f[lang, ph[:k]] + f[lang, ph[k:]]), k) for k in range(1, len(ph)))
            out.setdefault(lang, []).append((-score, -a, " ".join(ph).encode(), f[lang, ph[:k]], f[lang, ph[k:]]))
    return sorted((lang, i, ph.decode(), -a, x, y, n[lang], -s) for lang, rows in out.items()
                  for i, (s, a, ph, x, y) in enumerate(sorted(rows)[:top], 1))


def some_docs():
    rng = random.Random(2)
    vocabulary = ["New", "york", "new", "É", "é", "a", "the", "\x00", "x\x1cy", "b-c", " ", "\U0001F600z", "ﬀ"]
    docs = []
    for i in range(300):
        ws = rng.choices(vocabulary, k=rng.randrange(0, 60))
        docs.append((rng.choice([None, "und", "en", "de"]), "".join(w + rng.choice([" ", " ", " ", " \t", ". ", "\x0b", "\n"]) for w in ws)))
    return docs + [("en", None), ("en", ""), (None, " \t"), ("fr", "only here"), ("en", "new york city hall " * 50), ("en", "z" * 5000 + " q")] + docs[:20]


@pytest.mark.parametrize("dictionary, span", [(400_000, 1 << 20), (0, 1 << 20), (400_000, 64), (0, 7)])
def test_equals_brute_force(spark, monkeypatch, dictionary, span):
    monkeypatch.setattr(collocations, "SPAN", span)
    docs = some_docs()
    df = spark.createDataFrame([(lang, text, 1, "w", 2, 3) for lang, text in docs], SCHEMA).repartition(5)
    got = collocations.collocations(df, least=5, dictionary=dictionary)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(docs, 5)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 50


@pytest.mark.parametrize("dictionary", [400_000, 0])
def test_prefixes_are_summed_where_the_windows_meet(spark, monkeypatch, dictionary):
    docs = some_docs()
    df = spark.createDataFrame([(lang, text, 1, "w", 2, 3) for lang, text in docs], SCHEMA).repartition(5)
    for common, shares in ((1.0, 64), (1 / 40, 3)):  # no word is common, some are
        monkeypatch.setattr(collocations, "COMMON", common)
        monkeypatch.setattr(collocations, "SHARES", shares)
        got = collocations.collocations(df, least=5, dictionary=dictionary)
        assert sorted(map(tuple, got.collect())) == brute(docs, 5)
    _, numbers = collocations._numbered(
        collocations.word_counts(df).where("word is null or n >= 5"), lambda: collocations.word_counts(df), dictionary, 5)
    met = collocations.windows(df, numbers)
    assert 0 < len(numbers.common) < 40 and met.where("share = 0").count() and met.where("share > 0").count()
    assert met.where("share > 0").selectExpr("max(share)").first()[0] <= 3


def test_top_and_empty_tables(spark):
    df = spark.createDataFrame([(lang, text, 1, "w", 2, 3) for lang, text in some_docs()], SCHEMA)
    assert sorted(map(tuple, collocations.collocations(df, least=5, top=3).collect())) == brute(some_docs(), 5, 3)
    assert collocations.collocations(df.limit(0)).count() == 0
    assert collocations.collocations(df.limit(5), least=10_000).count() == 0


def test_a_hash_collision_is_avoided(spark, monkeypatch):
    real = collocations.hashed

    def weak(salt):  # with the first salt, all words collide
        from pyspark.sql import functions as F

        return F.lit(1) if salt == "0" else real(salt)

    monkeypatch.setattr(collocations, "hashed", weak)
    docs = some_docs()
    df = spark.createDataFrame([(lang, text, 1, "w", 2, 3) for lang, text in docs], SCHEMA)
    assert sorted(map(tuple, collocations.collocations(df, least=5, dictionary=0).collect())) == brute(docs, 5)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="test tables are not here")
def test_query_equals_sql(spark):
    assert not difference(spark, connect("/root/testdata/sf0.01"), "op12_collocations", "/root/testdata/sf0.01")
