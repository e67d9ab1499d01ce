import random

import numpy as np
import pytest

from vectide.llm import decontaminate as d

SF = "/root/testdata/sf0.001"


def plain_tiles(a, b, seed):
    """Greedy string tiling by comparing all places."""
    a_free, b_free, found = [True] * len(a), [True] * len(b), []
    while True:
        best, at = 0, []
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and a_free[i + k] and b_free[j + k]:
                    k += 1
                if k > best:
                    best, at = k, []
                if k == best and k:
                    at.append((i, j))
        if best < seed:
            return found
        for i, j in at:
            if all(a_free[i : i + best]) and all(b_free[j : j + best]):
                a_free[i : i + best] = [False] * best
                b_free[j : j + best] = [False] * best
                found.append((i, j, best))


def numbered(words):
    return d.token_numbers(words)


def test_rolling_hashes():
    rng = np.random.default_rng(1)
    numbers = rng.integers(0, 2**63, 50).astype(np.uint64)
    for length in (1, 2, 5, 7, 16, 50, 51):
        want = []
        for i in range(50 - length + 1):
            h = 0
            for x in numbers[i : i + length].tolist():
                h = (h * int(d._BASE) + x) % 2**64
            want.append(h)
        assert d.rolling(numbers, length).tolist() == want


@pytest.mark.parametrize("seed", [1, 3, 5])
def test_tiles_equal_brute_force(seed):
    rng = random.Random(seed)
    for n in range(60):
        letters = [b"a", b"b", b"c"] if n % 2 else [str(i).encode() for i in range(12)]
        a = [rng.choice(letters) for _ in range(rng.randrange(0, 25))]
        b = [rng.choice(letters) for _ in range(rng.randrange(0, 40))]
        if n % 3 == 0 and len(a) > 12:
            b[3:3] = a[8:]
            b += a[:8]
        assert d.tiles(a, b, numbered(a), numbered(b), seed) == plain_tiles(a, b, seed)


def test_one_word_many_times():
    a, b = [b"x"] * 300, [b"x"] * 30_000
    assert d.tiles(a, b, numbered(a), numbered(b), 5) == [(0, 0, 300)]


def test_tokens():
    assert d.tokens("Ab-c, É é!\n9") == [b"ab", b"c", "é".encode(), "é".encode(), b"9"]
    assert d.tokens(None) == []
    split = [t.decode() for t in d.tokens("Das 日本語テスト, é第x kö สวัส 한국어")]
    assert split == ["das", *"日本語テスト", "é", "第", "x", "kö", *"สวัส", "한국어"]
    # Whatever a text mixes, ideographs stand alone and everything else is cut as before.
    rng = random.Random(9)
    for _ in range(300):
        text = "".join(rng.choice("aZ9 -é\u4e00\u30c6\u0e01\uac00\U00020001\U0001f600\n\u3000\u2014ß") for _ in range(rng.randrange(30)))
        want = [x for run in d._TOKEN.findall(text.lower().encode()) for x in d._MIXED.findall(run)]
        assert d.tokens(text) == want and all(d._SPACELESS.search(t.decode()) is None or len(t.decode()) == 1 for t in d.tokens(text))


def test_short_items(spark):
    items = [(1, "what is two"), (2, "世界で一番高い山は富士山ですか違います"), (3, "yes"), (4, "two two"), (5, "")]
    docs = [(1, "I ask: What is TWO, then?"), (2, "前に世界で一番高い山は富士山ですか違います後"), (3, "yes"), (4, "yes indeed"), (5, "what is one and two"), (6, "two, two"), (7, ""), (8, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = d.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.id, r.item_id, r.coverage) for r in found) == [(1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0), (6, 4, 1.0)]


@pytest.mark.parametrize("block_chars", [1 << 23, 300])
def test_pairs(spark, block_chars):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    items = [(k, " ".join(rng.sample(words, 30))) for k in range(20)] + [(90, "too short here"), (91, None), (3, "w1 w2 w3 w4 w5"), (None, "z1 z2 z3 z4 z5 z6")]
    docs = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(80)]
        part = items[i % 20][1].split()
        if i % 4 == 0:
            text[10:10] = part[20:] + ["x"] + part[10:20] + ["y"] + part[:10]  # all of it, in another order
        elif i % 4 == 1:
            text[10:10] = part[:26]
        elif i % 4 == 2:
            text[10:10] = part[:22]
        docs.append((i, " ".join(text), "clash"))
    docs += [(None, "Z1, z2; z3 Z4 z5 (z6)", "n"), (7, None, ""), (7, "", ""), (8, items[0][1] + " " + "w0 " * 3000, ""), (8, items[0][1] + " " + "w0 " * 3000, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string, _hit string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = d.contaminated(df, bench, block_chars=block_chars).collect()
    want = []
    for i, t, _ in docs:
        for k, s in items:
            a, b = d.tokens(s), d.tokens(t)
            if a and len(b) < 1000 or (a and i == 8 and k == 0):
                covered = sum(x[2] for x in plain_tiles(a, b if len(b) < 1000 else b[:40], min(5, len(a))))
                if covered >= 0.8 * len(a) and covered:
                    want.append((i, k, len(a), covered))
    assert sorted(map(repr, ((r.id, r.item_id, r.item_tokens, r.covered) for r in found))) == sorted(map(repr, want))
    for r in found:
        assert r.coverage == r.covered / r.item_tokens and sum(t.length for t in r.tiles) == r.covered
    hit = {r.id for r in found}
    assert {i for i in range(0, 60, 4)} <= hit and not {i for i in range(2, 60, 4)} & hit
    clean = d.filter_clean(df, bench)
    assert clean.columns == df.columns
    assert sorted(map(repr, (r.doc_id for r in clean.collect()))) == sorted(repr(i) for i, _, _ in docs if i not in hit)


def test_empty_tables(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    assert d.contaminated(docs.limit(0), bench).count() == 0
    assert d.contaminated(docs, bench.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    from vectide.llm.queries import REGISTRY

    docs, bench = spark.read.parquet(f"{SF}/documents.parquet").collect(), spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    items = [(r.item_id, d.tokens(r.text)) for r in bench]
    runs = {k: {tuple(a[i : i + 5]) for i in range(len(a) - 4)} for k, a in items}
    want = []
    for r in docs:
        b = d.tokens(r.text)
        own = {tuple(b[i : i + 5]) for i in range(len(b) - 4)}
        for k, a in items:
            if runs[k] & own:
                covered = sum(x[2] for x in plain_tiles(a, b, 5))
                if covered >= 0.8 * len(a):
                    want.append((r.doc_id, k, covered))
    found = REGISTRY.plans["op7_decontaminate"](spark, SF).collect()
    assert sorted((r.doc_id, r.item_id, r.covered) for r in found) == sorted(want) and want
