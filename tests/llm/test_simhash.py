import random
import re

import numpy as np
import xxhash

from trendcast.llm import simhash
from trendcast.llm.queries import QUERIES
from trendcast.llm.shared import components


def slow_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    cut = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in cut]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps, distance=4):
    """fps: list of (id, fp). Smallest id reachable."""
    parent = {i: i for i, _ in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, f) in enumerate(fps):
        for j, g in fps[:n]:
            if (f ^ g).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in parent}


def test_fingerprints():
    for text in ["", " \n", "one", "Two Words", "É a b c d E", "x " * 200_000, "a b c d e f g h i j"]:
        assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_golay_lists():
    golay = simhash.Golay()
    rng = np.random.default_rng(1)
    v = rng.integers(0, 1 << 23, 3000)
    lists = golay.near(v)
    for flips, other in ((1, v ^ (1 << rng.integers(0, 23, 3000))),):
        far = golay.near(other)
        assert all(a[0] in b and b[0] in a for a, b in zip(lists, far)), flips
    two = v ^ (1 << rng.integers(0, 12, 3000)) ^ (1 << rng.integers(12, 23, 3000))
    assert all(set(a) & set(b) for a, b in zip(lists, golay.near(two)))


def test_keys_meet_for_all_patterns_of_four_errors():
    golay, rng = simhash.Golay(), random.Random(2)
    for _ in range(3000):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), 4):
            y ^= 1 << b
        keys = [set(simhash.keys_of(np.array([z], np.uint64).view(np.int64), golay)[0].tolist()) for z in (x, y)]
        assert keys[0] & keys[1] and len(keys[0]) <= 51


def test_components_equal_brute_force(spark):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(30)]
    fps = {0}
    for c in centres:
        for _ in range(rng.choice([1, 3, 40])):
            x = c
            for b in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << b
            fps.add(x)
    rows = sorted(fps)
    signed = [(int(np.uint64(f).view(np.int64)),) for f in rows]
    df = spark.createDataFrame(signed, "fp long")

    found = components(simhash.links(df), "test").collect()
    by_root = {r.node & (2**64 - 1): r.root & (2**64 - 1) for r in found}
    want = slow_components([(f, f) for f in rows])
    groups = {}
    for f in rows:
        groups.setdefault(want[f], set()).add(f)
    got = {}
    for f in rows:
        got.setdefault(by_root.get(f, f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_crowded_groups_are_handed_on(spark):
    import pyarrow as pa
    fps = np.arange(simhash.GROUP + 5, dtype=np.int64)
    keys = np.concatenate([np.full(len(fps), 7), [8, 8]])
    all_fps = np.concatenate([fps, [1, 2]])
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[k:k + 3000]), pa.array(all_fps[k:k + 3000])], ["key", "fp"])
               for k in range(0, len(keys), 3000)]
    out = [(a, b) for t in simhash._linked(iter(batches), 4) for a, b in zip(t.column(0).to_pylist(), t.column(1).to_pylist())]
    assert sorted(a for a, b in out if b is None) == fps.tolist()
    assert [(a, b) for a, b in out if b is not None] == [(1, 2)]
    near = next(simhash._neighbourhoods(iter([pa.RecordBatch.from_arrays([pa.array([5])], ["fp"])])))
    assert near.num_rows == 1 + 64 + 64 * 63 // 2


def test_crowded_members_are_linked_at_every_distance(spark):
    rng = random.Random(6)
    centre = rng.getrandbits(63)
    fps = sorted({centre ^ sum(1 << b for b in rng.sample(range(63), rng.randint(0, 3))) for _ in range(60)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long").coalesce(1)
    for distance in range(5):
        links = [(r.a, r.b) for r in simhash.crowded_links(df, distance).collect()]
        assert all((a ^ b).bit_count() <= distance for a, b in links)
        parent = {f: f for f in fps}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in links:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
        assert {f: find(f) for f in fps} == slow_components([(f, f) for f in fps], distance)


def test_query(spark, tmp_path):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefghij") * 3 for _ in range(300)) for _ in range(20)]
    texts += [t + " extra" for t in texts[:8]] + texts[:3] + [None, "", "  \n", "Only", "only"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as fp", "2 as key").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op4_simhash_golay"](spark, str(tmp_path)).collect()}
    fps = [(i, slow_fingerprint(t)) for i, t in enumerate(texts)]
    want = slow_components(fps)
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps}
    assert {i: r.component_id for i, r in got.items()} == want


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
