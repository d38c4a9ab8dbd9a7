import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trendcast.llm import lines
from trendcast.llm.shared import small


def words(line):
    return {w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", line)}


def brute(rows, threshold=0.8):
    """rows: (doc_id, text), distinct ids. Returns {doc_id: text} after the removal."""
    all_lines = [(i, k, line, words(line)) for i, t in sorted(rows) for k, line in enumerate((t or "").split("\n"))]
    out = {}
    for n, (i, k, line, s) in enumerate(all_lines):
        gone = bool(s) and any(len(s & p) / len(s | p) >= threshold for _, _, _, p in all_lines[:n] if p)
        out.setdefault(i, [])
        if not gone:
            out[i].append(line)
    return {i: "\n".join(v) for i, v in out.items()}


def corpus(seed, n, family=0):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + [f"Rare{k}é" for k in range(800)]
    line = lambda m: [rng.choice(vocabulary[:40] if rng.random() < 0.4 else vocabulary) for _ in range(m)]
    pool = [line(rng.randint(1, 25)) for _ in range(n)]
    base = line(40)
    rows = []
    for i in range(n):
        out = []
        for _ in range(rng.randint(1, 5)):
            l = list(rng.choice(pool)) if rng.random() < 0.5 else line(rng.randint(0, 12))
            if l and rng.random() < 0.5:
                l[rng.randrange(len(l))] = rng.choice(vocabulary)
            out.append(" ".join(l))
        if i < family:
            l = list(base)
            for _ in range(rng.randint(0, 4)):
                l[rng.randrange(40)] = f"x{rng.randint(0, 9999)}"
            out.append(" ".join(l))
        rows.append((i, "\n".join(out)))
    return rows


@pytest.mark.parametrize("seed, n, family", [(1, 150, 0), (2, 250, 160)])
def test_equals_brute_force(spark, seed, n, family):
    rows = corpus(seed, n, family) + [(100000, None), (100001, ""), (100002, "\n\n"), (100003, "Of\nof\nOF the\nthe  of")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 as n_lines", "'x' as tokens", "1 as place")
    got = lines.dedup_lines(docs.repartition(5)).collect()
    want = brute(rows)
    assert {r.doc_id: r.text or "" for r in got} == want
    assert [r.text for r in got if r.doc_id == 100000] == [None]
    assert all(r.n_lines - r.n_removed == len((r.text or "").split("\n")) or r.text in (None, "") for r in got)
    assert set(docs.columns) <= set(got[0].asDict())


def test_long_lines_on_both_sides_of_the_levels(spark):
    rng = random.Random(9)
    rows = []
    for n in (11, 12, 14, 15, 16, 58, 62, 75, 200, 238, 250, 300, 950, 970, 1200):
        base = [f"v{rng.randrange(5000)}" for _ in range(n)]
        for share in (0.0, 0.05, 0.09, 0.11, 0.2):
            line = [w if rng.random() >= share else f"y{rng.randrange(10**6)}" for w in base]
            rows.append((len(rows), " ".join(line[: max(1, int(len(line) * rng.choice([1, 0.85])))])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in lines.dedup_lines(docs).collect()} == brute(rows)


def test_repeated_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c\nd e f"), (1, "a b c\nd e f"), (1, "x y z\na b c"), (None, "a b c"), (2, "d e f g h\nD E F")],
                                 "doc_id long, text string")
    got = sorted((str(r.doc_id), r.text) for r in lines.dedup_lines(docs).collect())
    assert ("None", "a b c") in got and ("1", "d e f") in got and ("2", "d e f g h") in got
    assert lines.dedup_lines(docs.where("false")).count() == 0


def test_extra_columns_may_have_any_name(spark):
    names = ["r_id", "r_text", "r_places", "row", "line", "key", "a.b"]
    docs = spark.createDataFrame([(1, "a b c\nd e f"), (2, "x y z\na b c"), (3, None)], "doc_id long, text string").select(
        "*", *[F.lit(c).alias(c) for c in names])
    got = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    assert {k: (r.text, r.n_lines, r.n_removed) for k, r in got.items()} == {
        1: ("a b c\nd e f", 2, 0), 2: ("x y z", 2, 1), 3: (None, 0, 0)}
    assert all(list(r)[2:-2] == names for r in got.values())


def test_only_small_tables_are_broadcast(spark):
    def hinted(df):
        return "broadcast" in small(df)._jdf.queryExecution().logical().toString().lower()

    assert hinted(spark.range(10)) and hinted(spark.range(0))
    assert not hinted(spark.range(4).select(F.repeat(F.lit("x"), 4 << 20).alias("text")))


def test_white_space_between_words(spark):
    rows = [(1, "a b c d e"), (2, "\ta  b\x0bc \x0c d\re "), (3, "a b\u00a0c d e"), (4, " \t \r"), (5, "A B C D E F\n a\tb c d e")]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == brute(rows)


def family(spark, n):
    rng = random.Random(n)
    base = [f"b{k}" for k in range(40)]
    rows = [(i, " ".join(f"x{rng.randrange(10**9)}" if rng.random() < 0.05 else w for w in base)) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_pairs_follow_the_lines_of_a_family(spark, monkeypatch):
    counts = []

    def counted(df, name, write=lines.written):
        table = write(df, name)
        if name in ("line-pairs", "line-candidates"):
            counts.append(table.count())
        return table

    monkeypatch.setattr(lines, "written", counted)
    for n in (300, 1200):
        counts.clear()
        lines.dedup_lines(family(spark, n)).count()
        assert sum(counts) <= 16 * n


def test_what_nothing_reads_any_more_takes_no_disk(spark, monkeypatch):
    tables = {}
    write = lines.written
    monkeypatch.setattr(lines, "written", lambda df, name: tables.setdefault((name, len(tables)), write(df, name)))
    out = lines.dedup_lines(family(spark, 200))
    assert {name for (name, _), table in tables.items() if spark.read.parquet(table.written_to).count()} == {"repeated-lines"}
    assert out.count() == 200


def test_each_word_is_worked_out_once_for_many_lines(monkeypatch):
    hashed, hashes = [], lines._hashes
    monkeypatch.setattr(lines, "_hashes", lambda words: hashed.extend(words.to_pylist()) or hashes(words))
    texts = ["a b c\n\nb a  a\tc", "", "c b a d\nd"] * 50
    ids = list(range(len(texts)))
    piece = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids), pa.array(texts)], ["doc_id", "digest", "low"])
    classes = np.zeros(lines.BUCKETS, dtype=np.int8)
    rows = lines._line_rows(piece, classes, 0.8, 1).to_pylist()
    assert sorted(w for w in hashed if w) == ["a", "b", "c", "d"]
    assert [(r["doc_id"], r["place"] >> 31, r["size"]) for r in rows[:4]] == [(0, 0, 3), (0, 2, 3), (2, 0, 4), (2, 1, 1)]
    same, four, one = rows[0], rows[2], rows[3]
    assert {k: same[k] for k in ("set_id", "x", "y", "prefix", "hashes")} == {k: rows[1][k] for k in ("set_id", "x", "y", "prefix", "hashes")}
    assert len({r["set_id"] for r in rows}) == 3
    assert (four["x"] ^ same["x"] ^ one["x"], four["y"] ^ same["y"] ^ one["y"]) == (0, 0)
    assert [len(r["prefix"]) for r in (same, four, one)] == [1, 1, 1] and sorted(same["hashes"] + one["hashes"]) == four["hashes"]
