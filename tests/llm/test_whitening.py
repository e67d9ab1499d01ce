import numpy as np
import pytest

from vectide.llm import whitening

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("case", ["random", "zeros", "equal", "tiny", "parallel", "one", "graded"])
def test_rank_one_update(case):
    rng = np.random.default_rng(3)
    for k in (1, 2, 5, 33):
        d, q, v = np.sort(rng.random(k)) * 10, np.linalg.qr(rng.normal(size=(k, k)))[0], rng.normal(size=k)
        if case == "zeros":
            d[:] = 0
        elif case == "equal":
            d[: k // 2 + 1] = d[0]
        elif case == "tiny":
            v *= 1e-9
        elif case == "parallel":
            v = q[:, -1] * 3
        elif case == "one":
            v = q @ np.where(np.arange(k) % 2, 1.0, 0.0)
        elif case == "graded":
            d = np.sort(10.0 ** rng.integers(-12, 6, k))
        want = (q * d) @ q.T + np.outer(v, v)
        values, basis = whitening.rank_one(d, q, v)
        size = max(np.abs(want).max(), 1e-300)
        assert (np.diff(values) >= 0).all()
        assert np.abs(basis.T @ basis - np.eye(k)).max() < 1e-13
        assert np.abs((basis * values) @ basis.T - want).max() < 1e-13 * size * k
        assert np.abs(values - np.linalg.eigvalsh(want)).max() < 1e-13 * size * k


def test_many_updates_and_merges():
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(400, 12)) @ rng.normal(size=(12, 12)) * 20).astype(np.int64) + whitening.SHIFT
    x[:, 3] = whitening.SHIFT + 7
    parts = []
    for block in np.array_split(x, 7):
        held = whitening.Spectrum(12)
        for v, n in zip(*np.unique(block, axis=0, return_counts=True)):
            held.add(v, int(n))
        parts.append(held)
    whole = whitening.Spectrum(12)
    for p in [whitening.Spectrum(12), *parts]:
        whole.merge(p)
    away = x - x.mean(axis=0)
    assert whole.n == 400 and (whole.sums == x.sum(axis=0)).all()
    assert np.abs((whole.q * whole.d) @ whole.q.T - away.T @ away).max() < 1e-10 * np.abs(away.T @ away).max()


def plain(rows, limit=32):
    """By numpy on whole arrays: id, component, n, deviation, |whitened|, explained."""
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    ids, x = [i for i, _ in good], np.floor(64 * np.array([v for _, v in good], np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    away = (n * x - sums) / n
    values, basis = np.linalg.eigh(away.T @ away / n)
    order = [k for k in np.argsort(-values) if values[k] > 1e-12 * values.max()][:limit]
    y = away @ basis[:, order] / np.sqrt(values[order])
    dev = [sum(int(c) ** 2 for c in n * r - sums) for r in x]
    return [(i, k + 1, n, dev[a], abs(y[a, k]), values[j] / values.sum()) for a, i in enumerate(ids) for k, j in enumerate(order)]


def same(found, want):
    key = lambda r: (str(r[0]), r[1], r[3])
    found, want = sorted(found, key=key), sorted(want, key=key)
    assert [r[:4] for r in found] == [r[:4] for r in want]
    assert all(abs(a[4]) == pytest.approx(b[4], abs=1e-8) and a[5] == pytest.approx(b[5], rel=1e-9) for a, b in zip(found, want))


@pytest.mark.parametrize("fan", [2, 16])
def test_whitening_equals_numpy(spark, fan):
    rng = np.random.default_rng(7)
    mix = rng.normal(size=(9, 9))
    rows = [(k, [float(np.float32(c)) for c in rng.normal(size=9) @ mix]) for k in range(300)]
    rows += [(k, rows[0][1]) for k in range(300, 500)] + [(None, rows[1][1]), (7, rows[7][1]), (7, rows[8][1])]
    bad = [(900, None), (901, []), (902, [None] * 9), (903, [float("nan")] * 9), (904, [float("inf")] + [0.0] * 8), (905, [1.0] * 4), (906, [1e30] + [0.0] * 8)]
    df = spark.createDataFrame([(i, v, 0.5) for i, v in rows + bad], "id long, vector array<float>, whitened double").repartition(5)
    found = [tuple(r) for r in whitening.whiten(df, fan=fan).collect()]
    assert len({r[6] for r in found}) == 1 and found[0][6] < 1e-10
    same(found, plain(rows))
    assert whitening.whiten(df, components=2).select("component").distinct().count() == 2


def test_whitened_columns_have_unit_covariance(spark):
    from vectide.llm.queries import REGISTRY

    found = REGISTRY.plans["op13_whitening"](spark, SF).collect()
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    same([tuple(r) for r in found], plain(rows))
    by_id = {}
    for r in found:
        by_id.setdefault(r.vec_id, [0.0] * 32)[r.component - 1] = r.whitened
    y = np.array(list(by_id.values()))
    assert np.abs(np.cov(y.T, bias=True) - np.eye(32)).max() < 1e-9 and found[0].identity_error < 1e-9


def test_few_vectors(spark):
    make = lambda rows: spark.createDataFrame(rows, "id long, vector array<double>")
    assert whitening.whiten(make([(1, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(make([(1, None)])).count() == 0
    found = whitening.whiten(make([(1, [1.0, 2.0, 5.0]), (2, [3.0, 2.0, 5.0]), (3, [3.0, 2.0, 5.0])])).collect()
    assert [(r.id, r.component, r.n) for r in sorted(found)] == [(1, 1, 3), (2, 1, 3), (3, 1, 3)] and found[0].explained == 1.0
    # An even split of lengths goes to the longer vectors.
    mixed = [(1, [1.0]), (2, [2.0]), (3, [1.0, 0.0]), (4, [0.0, 3.0])]
    assert {r.id for r in whitening.whiten(make(mixed)).collect()} == {3, 4}


def test_large_sums_stay_exact():
    x = np.array([[1_000_000 + 5], [1_000_000 - 7]])
    n = 1 << 45
    away = whitening.centred(x, n, np.array([n * 1_000_000 - 3]))
    assert away.dtype == object and [int(a) for a in away[:, 0]] == [5 * n + 3, -7 * n + 3]
    assert whitening.deviations(away) == [None, None]
    assert whitening.deviations(whitening.centred(x, 10, np.array([9_999_999]))) == [51 * 51, 69 * 69]
