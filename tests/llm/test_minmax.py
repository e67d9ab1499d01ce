import random

import numpy as np
import pytest

from vectide.llm import minmax

SF = "/root/testdata/sf0.001"


def plain_set(text, shingle=5):
    words = (text or "").encode().lower().split()
    if len(words) < shingle:
        return frozenset([b" ".join(words)] if words else [])
    return frozenset(b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1))


def plain_groups(rows, threshold=85):
    """Lowest id reachable from each row, by comparing all pairs."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[find(i)] = min(low.get(find(i), k), k)
    out = []
    for i, (k, _) in enumerate(rows):
        c = low.get(find(i)) if sets[i] else k
        out.append((k, len(sets[i]), c, k == c))
    return out


def found(df, **more):
    return sorted(map(repr, ((r.id, r.n, r.component, r.kept) for r in minmax.groups(df, **more).collect())))


def varied(rng, base, n):
    words = list(base)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return words


def family(rng, n_words, n, edits):
    base = [f"b{rng.randrange(10**6)}" for _ in range(n_words)]
    return [" ".join(varied(rng, base, rng.randrange(edits + 1))) for _ in range(n)]


ODD = [None, "", " \n", "one", "ONE", "one two", "One  two", "a b c d", "a b c d e", "a b c d e f", "A b c d e F", "é b c d e", "É b c d e", "w " * 50, "w " * 60, "a\x0bb\x0cc\td\re", "a\xa0b c d e f"]


def test_sets():
    assert [len(minmax.shingle_set(t)) for t in ODD] == [len(plain_set(t)) for t in ODD]
    by_plain = {}
    for t in ODD:
        by_plain.setdefault(plain_set(t), set()).add(minmax.shingle_set(t).tobytes())
    assert all(len(v) == 1 for v in by_plain.values()) and len({b for v in by_plain.values() for b in v}) == len(by_plain)


def test_long_texts_are_cut_between_words(monkeypatch):
    rng = random.Random(1)
    text = " ".join(rng.choice(["ab", "CDE", "fghijk", "é"]) + rng.choice(["", " ", "\n"]) for _ in range(3000))
    whole = minmax.word_hashes(text)
    monkeypatch.setattr(minmax, "STEP_BYTES", 64)
    assert (minmax.word_hashes(text) == whole).all() and len(whole) == len(text.split())


def test_agreement_estimates_similarity_with_less_variance():
    rng = np.random.default_rng(2)
    estimates = []
    for _ in range(300):
        pool = rng.integers(0, 1 << 63, 240, np.uint64)
        a, b = minmax.signature(np.unique(pool[:200])), minmax.signature(np.unique(pool[40:]))
        estimates.append((a == b).mean())
    # 160 of 240 shared; 160 independent values would have this deviation.
    alone = np.sqrt(2 / 3 * 1 / 3 / (2 * minmax.PERMUTATIONS))
    assert abs(np.mean(estimates) - 2 / 3) < 4 * alone / np.sqrt(300)
    assert np.std(estimates) < 1.1 * alone


def test_links_of_equals_all_pairs():
    rng = random.Random(3)
    texts = family(rng, 60, 80, 4) + family(rng, 90, 50, 2) + family(rng, 30, 30, 1)
    members = [minmax.shingle_set(t) for t in texts]
    sketches = np.array([np.frombuffer(minmax.sketch(minmax.signature(m)), np.uint8) for m in members])
    rows = list(enumerate(texts))
    links = minmax.links_of(members, sketches, np.arange(len(rows)))
    root = list(range(len(rows)))
    for i, j in links:
        a, b = root[i], root[j]
        assert a != b
        root = [min(a, b) if r in (a, b) else r for r in root]
    assert root == [c for _, _, c, _ in plain_groups(rows)]


@pytest.mark.parametrize("slices", [{}, {"slice_classes": 4}, {"slice_shingles": 300}])
def test_groups_equal_brute_force(spark, slices):
    rng = random.Random(5)
    texts = ODD + family(rng, 70, 60, 3) + family(rng, 60, 40, 5) + family(rng, 200, 12, 12) + family(rng, 9, 12, 1)
    texts += [" ".join(f"s{rng.randrange(40)}" for _ in range(30)) for _ in range(30)] + ["long " * 1 + " ".join(str(k) for k in range(30_000))] * 2
    texts += [texts[30]] * 20
    rng.shuffle(texts)
    rows = [(k * 3, t) for k, t in enumerate(texts)] + [(None, texts[5]), (3, texts[1]), (3, texts[1]), (6, texts[40]), (None, "only null ids here now"), (None, "")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, component string, n int")
    assert found(df, **slices) == sorted(map(repr, plain_groups(rows)))


def test_chain_over_slices(spark):
    # Neighbours are similar, the ends are not: one group only if no link between slices is lost.
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(words[4 * k : 4 * k + 100])) for k in range(70)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component for r in minmax.groups(df, slice_classes=2).collect()} == {0}


def test_nothing_to_compare(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (2, None), (3, "g h i j k l")], "doc_id long, text string")
    assert found(df) == sorted(map(repr, [(1, 2, 1, True), (2, 0, 2, True), (3, 2, 3, True)]))
    assert found(df.limit(0)) == []


def test_query_equals_brute_force(spark):
    from vectide.llm.queries import REGISTRY

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = REGISTRY.plans["op11_minhash"](spark, SF).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == sorted(plain_groups(rows))
