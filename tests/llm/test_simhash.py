import random

import numpy as np
import pytest
import xxhash

from vectide.llm import simhash
from vectide.llm.components import components


def plain_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, ids, radius=3):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    lowest = {}
    for i in range(len(fps)):
        if ids[i] is not None:
            r = find(i)
            lowest[r] = min(lowest.get(r, ids[i]), ids[i])
    return [lowest.get(find(i)) for i in range(len(fps))]


def test_fingerprint():
    rng = random.Random(1)
    texts = [None, "", " \n", "one", "one two", "One TWO three", "a\x0bb\x0cc\td\re", "É é É é"]
    texts += [" ".join(rng.choice(["a", "B", "the", "é", "xyz"]) for _ in range(rng.randrange(1, 300))) for _ in range(40)]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    assert simhash.fingerprint("a b c") != simhash.fingerprint("A b\x85c")
    long = "w " * 200_000
    assert simhash.fingerprint(long) == xxhash.xxh64_intdigest(b"w w w", 42)


@pytest.mark.parametrize("radius", [0, 1, 3, 4])
def test_near_pairs_are_those_of_brute_force(radius, monkeypatch):
    monkeypatch.setattr(simhash, "STEP_BLOCKS", 16)
    rng = random.Random(radius)
    fps, group = [], []
    for g, n in enumerate([1, 2, 64, 65, 3, 200, 1]):
        base = rng.getrandbits(64)
        for _ in range(n):
            flips = rng.randrange(0, 8)
            fps.append(base ^ sum(1 << b for b in rng.sample(range(64), flips)))
            group.append(g)
    side = np.array([rng.random() < 0.5 for _ in fps])
    for s in (None, side):
        found = [x for step in simhash.near_pairs(np.array(fps, np.uint64), np.array(group), radius, s) for x in zip(*map(list, step))]
        want = {
            (i, j)
            for j in range(len(fps))
            for i in range(j)
            if group[i] == group[j] and (s is None or s[i] != s[j]) and bin(fps[i] ^ fps[j]).count("1") <= radius
        }
        assert len(found) == len(want) and set(found) == want


def test_every_near_pair_shares_a_mask():
    rng = random.Random(3)
    for n in (10, 10**6, 10**9, 10**12):
        masks = simhash.part_masks(n, 3)
        for _ in range(200):
            flips = sum(1 << b for b in rng.sample(range(64), 3))
            assert any(flips & m == 0 for m in masks)


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000 + i, 1000) for i in range(1, 200)] + [(7000, 7000), (5000, 5001)] * 2
    edges = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in edges]
    rng.shuffle(edges)
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(1, 301)} | {1000 + i: 1000 for i in range(1, 200)} | {5001: 5000}
    assert found == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("slice_rows", [4096, 5])
def test_groups_equal_brute_force(spark, slice_rows):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(20):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(30, 200))]
        for _ in range(rng.randrange(1, 12)):
            copy = list(words)
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [None, "", "  \n", texts[0], texts[0], "short", "short"]
    ids = [*range(100, 100 + len(texts))]
    ids[-1], ids[-3], ids[3] = None, 100, None
    rows = spark.createDataFrame(list(zip(ids, texts, texts)), "doc_id long, text string, _kept string")
    found = simhash.groups(rows, slice_rows=slice_rows).collect()
    fps = [plain_fingerprint(t) for t in texts]
    want = plain_components(fps, ids)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(tuple, found), key=key) == sorted(zip(ids, signed, want), key=key)
    kept = simhash.keep_one(rows)
    assert kept.columns == rows.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(
        i for i, w in zip(ids, want) if i is not None and i == w
    )


def test_empty_table(spark):
    assert simhash.groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_equals_brute_force(spark):
    from vectide.llm.queries import REGISTRY

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    ids = [r.doc_id for r in rows]
    want = {(i, f"{f:016x}", c) for i, f, c in zip(ids, fps, plain_components(fps, ids))}
    found = [tuple(r) for r in REGISTRY.plans["op1_simhash"](spark, sf).collect()]
    assert len(found) == len(rows) and set(found) == want
