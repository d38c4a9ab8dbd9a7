import hashlib
import heapq
import random
import zlib

import pytest

from trendcast.llm import queries, repair

STATES = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
INTO = {0: 2, 1: 2, 2: 3, 3: 2}
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def cheapest(rows):
    """Dijkstra over (row, state) with the letters as second key: (cost, letters, repaired rows)."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, letters, i, q, made = heapq.heappop(heap)
        if i == len(rows) and q in (0, 3):
            return cost, letters, made
        if (i, q) in done:
            continue
        done.add((i, q))
        name = {2: "user", 3: "assistant"}[INTO[q]]
        heapq.heappush(heap, (cost + 5, letters + "I", i, INTO[q], (*made, f"{name}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 2, letters + "D", i + 1, q, made))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if role[:1] in STATES[q]:
                    heapq.heappush(heap, (cost + more, letters + "K", i + 1, STATES[q][role[:1]], (*made, f"{role}:{text}")))
                heapq.heappush(heap, (cost + more + 1, letters + "R", i + 1, INTO[q], (*made, f"{name}:{text}")))


def report(rows):
    """The query's row for one conversation's (conv_id, turn, role, text), in plain Python."""
    out = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        out += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.md5(r[2].encode()).hexdigest()))
    marked, seen = [], set()
    for _, role, text in out:
        bare = text.rstrip(WHITE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        marked.append((role, text, fault))
    cost, letters, made = cheapest(marked)
    known = [t for t, _, _ in out if t is not None]
    count = [sum(f == k for _, _, f in marked) for k in ("blank", "duplicate", "truncated")]
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    return (gaps, *count, illegal, cost, letters, hashlib.sha256("\n".join(made).encode()).hexdigest())


def test_auction_equals_dijkstra():
    rng = random.Random(5)
    for _ in range(3000):
        rows = [(rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), str(i),
                 rng.choice(["", "", "", "truncated", "blank", "duplicate"])) for i in range(rng.randrange(0, 30))]
        letters, cost = repair.solved(tuple(repair.symbol(r[0], r[2]) for r in rows))
        assert (cost, letters) == cheapest(rows)[:2]


def test_clean_conversation_is_one_path():
    auction = repair.Auction([r + "-" for r in "suaua"])
    assert auction.trace() == ("KKKKK", 3) and auction.prices[0] == 0


def conversations(rng, n, rows):
    texts = ["One.", "Two!", "No end", "", " \t", "Three?\n", "é", "x" * 300 + ".", "x" * 300 + "!"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    out = []
    for conv_id in [None, *range(n)]:
        for i in range(rng.randrange(1, rows)):
            turn = rng.choice([None, i, i, i, i * 2])
            out.append((conv_id, turn, rng.choice(roles), rng.choice([*texts, *[f"{i} is new."] * 9, None])))
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("bounds", [{}, {"most_rows": 3}])
def test_repair_equals_plain_python(spark, bounds):
    rows = conversations(random.Random(3), 120, 25)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as at", "2 as gone_", "3 as edits", "4 as n_rows", "5 as key")
    got = repair.audits(repair.repair(repair.damaged(df), **bounds)).collect()
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    assert len(got) == len(by)
    for r in got:
        assert tuple(r)[1:] == report(by[r.conv_id]), r.conv_id


def test_one_conversation_of_many_rows_and_many_equal_rows(spark):
    rng = random.Random(8)
    rows = [(7, i, rng.choice(["user", "assistant"]), f"{i}.") for i in range(3000)] + [(7, None, "user", "Same.")] * 1500
    rows += [(i, 0, "user", "Hi.") for i in range(100, 200)]
    got = {r.conv_id: r for r in repair.audits(repair.repair(
        repair.damaged(spark.createDataFrame(rows, SCHEMA).repartition(8)), most_rows=500)).collect()}
    assert tuple(got[7])[1:] == report([r for r in rows if r[0] == 7])
    assert len(got) == 101


def test_query_and_empty_table(spark, tmp_path):
    rows = conversations(random.Random(4), 30, 8)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.QUERIES["op11_conversation_repair"](spark, str(tmp_path))
    assert got.columns == ["conv_id", *[f.split()[0] for f in repair.AUDIT.split(", ")]]
    assert {r.conv_id for r in got.collect()} == {r[0] for r in rows}
    assert repair.audits(repair.repair(spark.createDataFrame([], SCHEMA))).count() == 0


def test_edits_are_the_operators_output(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "user", "Again."), (1, 2, "assistant", "")]
    found = repair.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("at").collect()
    assert [(e.edit, e.role, e.text) for part in found for e in part.edits] == [
        ("K", "user", "Hello."), ("R", "assistant", "Again."), ("D", None, "")]
    assert sum(part.cost for part in found) == 3 and sum(part.blank for part in found) == 1
