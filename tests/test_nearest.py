import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from hypothesis.extra import numpy as hnp
from pyspark.sql import functions as F

from vectide.functions import kernels
from vectide.functions import vectors as V
from vectide.operators import nearest


def brute(corpus, queries, metric, k):
    """Best k by plain arithmetic, one pair at a time."""
    out = {}
    for qid, q in queries:
        scored = []
        for i, v in corpus:
            q64, v64 = np.float32(q).astype(float), np.float32(v).astype(float)
            if metric == "L2":
                s = math.sqrt(sum((a - b) ** 2 for a, b in zip(q64, v64)))
            else:
                s = sum(a * b for a, b in zip(q64, v64))
                if metric == "COSINE":
                    n = math.sqrt(sum(a * a for a in q64)) * math.sqrt(sum(b * b for b in v64))
                    s = s / n if n else None
            s = None if s is None else round(s, 9)
            scored.append((s is None, s if metric == "L2" else -(s or 0), i, s))
        scored.sort()
        out[qid] = [(i, s) for _, _, i, s in scored[:k]]
    return out


def found(hits):
    out = {}
    for r in sorted(hits.collect(), key=lambda r: (r.qid, r["rank"])):
        out.setdefault(r.qid, []).append((r.id, r.score))
    return out


def same(a, b):
    assert a.keys() == b.keys()
    for q in a:
        assert [i for i, _ in a[q]] == [i for i, _ in b[q]], q
        for (_, x), (_, y) in zip(a[q], b[q]):
            assert x == y or abs(x - y) < 2e-9


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    corpus = [(i, rng.normal(size=6).round(2).tolist()) for i in range(300)]
    corpus += [(300 + i, corpus[i][1]) for i in range(40)]  # equal vectors
    corpus.append((400, [0.0] * 6))
    return corpus, [(i, rng.normal(size=6).round(2).tolist()) for i in range(25)] + [(99, [0.0] * 6)]


@pytest.mark.parametrize("metric", V.METRICS)
@pytest.mark.parametrize("bounds", [{}, {"broadcast_bytes": 0, "block_bytes": 512}])
def test_equals_brute_force(vectors, asked, data, metric, bounds):
    corpus, queries = data
    hits = nearest.top_k(vectors(corpus).repartition(5), asked(queries), 12, metric, **bounds)
    same(found(hits), brute(corpus, queries, metric, 12))


@pytest.mark.parametrize("metric", V.METRICS)
def test_expressions_agree_with_kernel(vectors, asked, data, metric):
    corpus, queries = data
    pairs = vectors(corpus[:40]).join(asked(queries))
    got = pairs.select("qid", "id", V.score(metric, F.col("qv"), F.col("vector")).alias("s")).collect()
    expected = brute(corpus[:40], queries, metric, 40)
    for r in got:
        want = dict(expected[r.qid])[r.id]
        assert (r.s is None) == (want is None) and (want is None or abs(r.s - want) < 2e-9)


def test_tie_goes_to_the_lower_id(vectors, asked):
    hits = nearest.top_k(vectors([(7, [1.0, 2.0]), (3, [1.0, 2.0])]), asked([(1, [1.0, 2.0])]), 1)
    assert [r.id for r in hits.collect()] == [3]


def test_zero_vector_ranks_last_without_score(vectors, asked):
    hits = nearest.top_k(vectors([(1, [0.0, 0.0]), (2, [0.0, -1.0])]), asked([(1, [0.0, 1.0])]), 5)
    assert [(r.id, r.score) for r in hits.orderBy("rank").collect()] == [(2, -1.0), (1, None)]


def test_string_keys_and_null_vectors(vectors, asked):
    rows = vectors([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", None)], key="string")
    hits = nearest.top_k(rows, asked([(1, [1.0, 0.0])]), 5)
    assert [r.id for r in hits.orderBy("rank").collect()] == ["a", "b"]


@pytest.mark.parametrize("bounds", [{}, {"broadcast_bytes": 0, "block_bytes": 16}])
def test_vectors_of_another_length_are_left_out_and_counted(vectors, asked, bounds):
    rows = vectors([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0, 0.0]), (4, [1.0]), (5, []), (6, None)])
    questions = asked([(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [1.0, 1.0, 1.0]), (4, None)])
    hits = nearest.top_k(rows, questions, 5, **bounds).collect()
    assert sorted((r.qid, r["rank"], r.id) for r in hits) == [(1, 1, 1), (1, 2, 2), (2, 1, 2), (2, 2, 1)]
    near = nearest.range_search(rows, questions, 0.5, **bounds).collect()
    assert sorted((r.qid, r.id) for r in near) == [(1, 1), (2, 2)]
    counted = {(r.side, r.length): (r.n, r.searched) for r in nearest.lengths(rows, questions).collect()}
    assert counted == {
        ("corpus", 2): (2, True), ("corpus", 3): (1, False), ("corpus", 1): (1, False), ("corpus", 0): (1, False), ("corpus", None): (1, False),
        ("queries", 2): (2, True), ("queries", 3): (1, False), ("queries", None): (1, False),
    }
    # Of equally frequent lengths the higher one is searched.
    even = asked([(1, [1.0]), (2, [1.0, 0.0])])
    assert {r.qid for r in nearest.top_k(rows, even, 5, **bounds).collect()} == {2}


def test_one_block_of_queries_at_a_time(spark, vectors, asked, monkeypatch):
    from pyspark.core.context import SparkContext

    live, most = set(), []
    send = SparkContext.broadcast

    def counted(self, value):
        shared = send(self, value)
        live.add(id(shared))
        most.append(len(live))
        end = shared.destroy
        monkeypatch.setattr(shared, "destroy", lambda *a: (live.discard(id(shared)), end(*a)), raising=False)
        return shared

    monkeypatch.setattr(SparkContext, "broadcast", counted)
    rows, questions = [(i, [float(i), 1.0]) for i in range(50)], [(q, [float(q), 2.0]) for q in range(40)]
    hits = nearest.search(vectors(rows), asked(questions), limit=3, broadcast_bytes=100, block_bytes=200)
    assert hits.count() == 120 and len(most) >= 4 and max(most) == 1


def test_limit_comes_before_the_similarity_cut(vectors, asked):
    rows = vectors([(1, [0.9, 0.0]), (2, [0.8, 0.0]), (3, [0.5, 0.0])])
    query = asked([(1, [1.0, 0.0])])

    def ids(limit, least):
        hits = nearest.search(rows, query, limit, "IP", min_similarity=least)
        return [r.id for r in hits.orderBy("rank").collect()]

    assert ids(2, 0.79) == [1, 2]
    assert ids(1, 0.79) == [1]
    assert ids(3, 0.79) == [1, 2]


def test_distance_becomes_similarity(vectors, asked):
    rows = vectors([(1, [0.0]), (2, [1.0]), (3, [3.0])])
    hits = nearest.search(rows, asked([(1, [0.0])]), 3, "L2")
    assert [(r.score, r.similarity) for r in hits.orderBy("rank").collect()] == [(0.0, 1.0), (1.0, 0.5), (3.0, 0.25)]


@pytest.mark.parametrize("bounds", [{}, {"broadcast_bytes": 0, "block_bytes": 512}])
@pytest.mark.parametrize("metric, low, high", [("COSINE", 0.2, 0.8), ("L2", 0.25, 0.5), ("IP", -0.5, 0.5)])
def test_range_equals_brute_force(vectors, asked, data, metric, low, high, bounds):
    corpus, queries = data
    hits = nearest.range_search(vectors(corpus), asked(queries), low, high, metric, **bounds)
    expected = set()
    for q, pairs in brute(corpus, queries, metric, len(corpus)).items():
        for i, s in pairs:
            if s is not None and low <= (1 / (1 + s) if metric == "L2" else s) <= high:
                expected.add((q, i))
    assert {(r.qid, r.id) for r in hits.collect()} == expected


@pytest.mark.parametrize("metric, low, high", [("COSINE", None, 0.5), ("L2", 0.25, 0.5), ("IP", -0.5, 0.5), ("L2", None, 0.4)])
def test_best_within_a_range_equals_brute_force(vectors, asked, data, metric, low, high):
    corpus, queries = data
    hits = nearest.search(vectors(corpus), asked(queries), 7, metric, radius=low, range_filter=high)
    expected = {}
    for q, pairs in brute(corpus, queries, metric, len(corpus)).items():
        inside = []
        for i, s in pairs:
            alike = None if s is None else 1 / (1 + s) if metric == "L2" else s
            if alike is not None and (low is None or alike >= low) and alike <= high:
                inside.append((i, s))
        if inside:
            expected[q] = inside[:7]
    same(found(hits), expected)


def test_range_bounds_are_included(vectors, asked):
    rows = vectors([(1, [1.0]), (2, [0.5]), (3, [0.25])])
    hits = nearest.range_search(rows, asked([(1, [1.0])]), 0.25, 0.5, "IP")
    assert {r.id for r in hits.collect()} == {2, 3}


def test_filter_partition_and_fields(spark, asked):
    rows = spark.createDataFrame(
        [(1, [1.0, 0.0], "x", "red"), (2, [1.0, 0.1], "y", "blue"), (3, [1.0, 0.2], "x", "blue")],
        "id long, vector array<float>, partition_name string, colour string",
    )
    query = asked([(1, [1.0, 0.0])])
    hits = nearest.search(rows, query, 2, filter="colour == 'blue'", output_fields="colour")
    assert [(r.id, r.colour) for r in hits.orderBy("rank").collect()] == [(2, "blue"), (3, "blue")]
    hits = nearest.search(rows, query, 2, partition_names="x, z")
    assert [r.id for r in hits.orderBy("rank").collect()] == [1, 3]
    assert "vector" not in hits.columns


def test_normalize(vectors):
    rows = vectors([(1, [3.0, 4.0]), (2, [0.0, 0.0])])
    unit = {r.id: r.u for r in rows.select("id", V.normalize(F.col("vector")).alias("u")).collect()}
    assert unit[1] == pytest.approx([0.6, 0.8]) and unit[2] == [0.0, 0.0]


def test_merge_in_slices_gives_the_same_hits(vectors, asked, data, monkeypatch):
    corpus, queries = data
    plain = nearest.top_k(vectors(corpus), asked(queries), 12)
    monkeypatch.setattr(nearest, "_slices", lambda rows, k: 5)
    sliced = nearest.top_k(vectors(corpus), asked(queries), 12)
    assert sorted(map(str, plain.collect())) == sorted(map(str, sliced.collect()))
    monkeypatch.undo()
    monkeypatch.setattr(nearest, "SCAN_BYTES", 1)
    monkeypatch.setattr(nearest, "MERGE_ROWS", 1)
    assert nearest._slices(vectors(corpus), 12) > 1


def test_fields_of_very_many_hits(spark, vectors, asked, data, monkeypatch):
    corpus, queries = data
    rows = vectors(corpus).withColumn("name", F.concat(F.lit("n"), "id"))
    few = nearest.search(rows, asked(queries), output_fields="name")
    monkeypatch.setattr(nearest, "BROADCAST_BYTES", 0)
    many = nearest.search(rows, asked(queries), output_fields="name")
    assert few.columns == many.columns and sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
    assert all(r.name == f"n{r.id}" for r in many.collect())


def test_refusals(vectors, asked):
    with pytest.raises(ValueError):
        nearest.top_k(vectors([]), asked([]), 0)
    with pytest.raises(ValueError):
        nearest.top_k(vectors([]), asked([]), 1, "HAMMING")
    with pytest.raises(ValueError):
        nearest.range_search(vectors([]), asked([]), 0.9, 0.1)


def test_no_rows_no_hits(vectors, asked):
    assert nearest.top_k(vectors([]), asked([(1, [1.0])]), 3).count() == 0
    assert nearest.top_k(vectors([(1, [1.0])]), asked([]), 3).count() == 0


FLOATS = st.floats(-1e3, 1e3, width=32, allow_subnormal=False)


@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=hnp.arrays(np.float32, st.tuples(st.integers(1, 40), st.just(4)), elements=FLOATS),
    queries=hnp.arrays(np.float32, st.tuples(st.integers(1, 4), st.just(4)), elements=FLOATS),
    k=st.integers(1, 8),
    metric=st.sampled_from(V.METRICS),
    batch=st.integers(1, 15),
    merge_at=st.sampled_from([1, 20_000]),
    bounds=st.sampled_from([(-np.inf, np.inf), (-np.inf, 0.2), (0.01, 0.9)]),
)
def test_kernel_is_exact_for_any_batching(rows, queries, k, metric, batch, merge_at, bounds):
    best = kernels.TopK(kernels.Queries(metric, pa.array(range(len(queries))), queries), k, 9, *bounds)
    kernels.MERGE_AT = merge_at
    for i in range(0, len(rows), batch):
        best.add(np.arange(i, min(i + batch, len(rows))), rows[i : i + batch])
    table = best.table(pa.int64())
    table = table.to_pydict() if table is not None else {"qid": [], "id": [], "score": []}
    kernels.MERGE_AT = 20_000
    got = {}
    for q, i, s in zip(table["qid"], table["id"], table["score"]):
        got.setdefault(q, []).append((i, s))
    for q in range(len(queries)):
        pair = np.repeat(queries[q : q + 1], len(rows), axis=0)
        score = kernels.exact(metric, pair, rows, 9)
        gain = np.where(np.isnan(score), -np.inf, -score if metric == "L2" else score)
        order = np.lexsort((np.arange(len(rows)), -gain))
        alike = 1 / (1 + score) if metric == "L2" else score
        if np.isfinite(bounds[1]):
            order = [i for i in order if bounds[0] <= alike[i] <= bounds[1]]
        assert [i for i, _ in got.get(q, [])] == list(order[:k])


@pytest.mark.parametrize("metric", ["COSINE", "L2", "IP"])
def test_rows_without_a_score_displace_nothing(vectors, asked, metric):
    bad = float("nan"), float("inf"), -float("inf")
    good = [(i, [float(i % 7 + 1), float(i % 5 + 1)]) for i in range(50)]
    wanted = nearest.search(vectors(good), asked([(1, [1.0, 2.0])]), limit=10, metric=metric).collect()
    rows = good + [(100 + i, [bad[i % 3], 1.0]) for i in range(30)]
    found = nearest.search(vectors(rows), asked([(1, [1.0, 2.0])]), limit=10, metric=metric).collect()
    assert found == wanted and len(found) == 10
    in_range = nearest.range_search(vectors(rows), asked([(1, [1.0, 2.0])]), radius=-1e9, metric=metric)
    assert in_range.where("id >= 100").count() == 0


def test_equal_vectors_and_queries_without_length(vectors, asked, monkeypatch):
    monkeypatch.setattr(kernels, "EXACT_BYTES", 100)
    rows = [(i, [3.0, 4.0]) for i in range(300, 0, -1)] + [(900, [0.0, 0.0])]
    found = nearest.search(vectors(rows), asked([(1, [1.0, 1.0]), (2, [0.0, 0.0])]), limit=3).collect()
    assert [(r.qid, r.id, r.score is None) for r in found] == [(1, 1, False), (1, 2, False), (1, 3, False), (2, 1, True), (2, 2, True), (2, 3, True)]


def test_queries_above_the_bound_leave_the_collection_in_place(vectors, asked):
    rows, questions = [(i, [float(i), 1.0]) for i in range(200)], [(q, [float(q), 2.0]) for q in range(40)]
    plain = nearest.search(vectors(rows), asked(questions), limit=3)
    cut = nearest.search(vectors(rows), asked(questions), limit=3, broadcast_bytes=100, block_bytes=200)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, plain.collect()))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and "cogroup" not in plan.lower()


@pytest.mark.parametrize("bounds", [{}, {"broadcast_bytes": 0, "block_bytes": 512}])
@pytest.mark.parametrize("metric", ["IP", "L2"])
@pytest.mark.parametrize("scale", [1e-6, 1e-12])
def test_short_vectors_keep_their_order(vectors, asked, metric, scale, bounds):
    """Ranked by the unrounded score; scaling by powers of two changes no order."""
    scale = 2.0 ** round(math.log2(scale))
    rng = np.random.default_rng(8)
    rows, queries = rng.normal(size=(200, 4)).astype(np.float32), rng.normal(size=(5, 4)).astype(np.float32)
    corpus = vectors([(i, (v * np.float32(scale)).tolist()) for i, v in enumerate(rows)])
    short = asked([(i, (v * np.float32(scale)).tolist()) for i, v in enumerate(queries)])
    hits = nearest.search(corpus, short, limit=7, metric=metric, decimals=None, **bounds)
    got = found(hits)
    for q, v in enumerate(queries.astype(float)):
        score = np.sqrt(((rows - v) ** 2).sum(axis=1)) if metric == "L2" else -(rows.astype(float) @ v)
        best = np.argsort(score, kind="stable")[:7]
        assert [i for i, _ in got[q]] == best.tolist()
        size = scale if metric == "L2" else -scale * scale
        assert np.allclose([s / size for _, s in got[q]], score[best], rtol=1e-9, atol=0)
    rounded = nearest.search(corpus, short, limit=7, metric=metric, **bounds)
    assert [(q, i) for q in range(5) for i, _ in found(rounded)[q]] == [(q, i) for q in range(5) for i, _ in got[q]]


def test_short_vectors_are_cut_by_unrounded_scores(vectors, asked):
    corpus = vectors([(i, [i * 1e-6, 0.0]) for i in range(20)])
    one = asked([(1, [1e-6, 0.0])])
    wanted = {5, 6, 7, 8}
    inside = nearest.range_search(corpus, one, 4.5e-12, 8.5e-12, "IP")
    assert {r.id for r in inside.collect()} == wanted
    top = nearest.search(corpus, one, limit=4, metric="IP", radius=4.5e-12, range_filter=8.5e-12)
    assert {r.id for r in top.collect()} == wanted
    least = nearest.search(corpus, one, limit=20, metric="IP", min_similarity=4.5e-12)
    assert {r.id for r in least.collect()} == set(range(5, 20))
    near = nearest.range_search(corpus, one, 1 / (1 + 2.5e-6), 1 / (1 + 0.5e-6), "L2")
    assert {r.id for r in near.collect()} == {0, 2, 3}
    itself = nearest.range_search(vectors([(i, [0.1 * i, 0.3, 0.7]) for i in range(30)]), asked([(9, [0.9, 0.3, 0.7])]), 1.0)
    assert {r.id for r in itself.collect()} == {9}


@pytest.mark.parametrize("metric", ["COSINE", "L2", "IP"])
def test_queries_in_groups_find_the_same(vectors, asked, monkeypatch, metric):
    rng = np.random.default_rng(3)
    rows = vectors([(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 4)))])
    # Some ids ask several times, with different vectors.
    questions = asked([(q % 50, [float(x) for x in v]) for q, v in enumerate(rng.normal(size=(60, 4)))])
    plain = nearest.search(rows, questions, 5, metric).collect()
    ranged = nearest.range_search(rows, questions, 0.2, None, metric).collect()
    assert nearest.group_count(60 * 32, 60, 5, nearest.BROADCAST_BYTES, nearest.BLOCK_BYTES) == 1
    monkeypatch.setattr(nearest, "GROUP_BYTES", 2000)
    assert nearest.group_count(60 * 32, 60, 5, nearest.BROADCAST_BYTES, nearest.BLOCK_BYTES) == 6
    key = lambda found: sorted(map(tuple, found))
    assert key(nearest.search(rows, questions, 5, metric).collect()) == key(plain)
    assert key(nearest.range_search(rows, questions, 0.2, None, metric).collect()) == key(ranged)


def test_small_blocks_share_a_scan():
    """Scans grow with the bytes of the queries, not with how finely they are cut."""
    size = 100_000 * 64 * 8
    finely, coarsely = (nearest.group_count(size, 100_000, 7, 0, block) for block in (64 * 1024, 1 << 30))
    assert coarsely <= finely <= max(nearest.FEW_BLOCKS, coarsely)


def test_groups_of_queries_are_ranked_once(spark, vectors, asked):
    """Queries with ids of their own are ranked when their group is written; those that share an id again."""
    rng = np.random.default_rng(11)
    rows = [(i, rng.integers(0, 3, 4).astype(float).tolist()) for i in range(300)]
    corpus = vectors(rows).repartition(20)
    bounds = {"broadcast_bytes": 0, "block_bytes": 800}
    own = asked([(i, v) for i, v in rows[:90]])
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    key = lambda hits: sorted((r.qid, r["rank"], r.id, r.score) for r in hits.collect())
    grouped = nearest.search(corpus, own, 7, **bounds)
    assert "Window" not in text(grouped) and "Exchange" not in text(grouped)
    assert key(grouped) == key(nearest.search(corpus, own, 7))
    shared = asked([(i % 30, v) for i, v in rows[:90]])
    again = nearest.search(corpus, shared, 7, **bounds)
    assert "Window" in text(again) and key(again) == key(nearest.search(corpus, shared, 7))


def test_scans_for_groups_take_no_more_tasks_than_cores(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 1000, 1, 5 * cores)
    assert nearest.few_tasks(rows).rdd.getNumPartitions() == cores
    assert nearest.few_tasks(spark.range(0, 1000, 1, 2)).rdd.getNumPartitions() == 2
    # Large ones keep tasks of a bounded size.
    monkeypatch.setattr(nearest, "SCAN_BYTES", 1000 * 8 // (3 * cores))
    assert nearest.few_tasks(rows).rdd.getNumPartitions() == 3 * cores


@pytest.mark.parametrize("metric", ["COSINE", "L2", "IP"])
@pytest.mark.parametrize("text", [False, True])
def test_crowds_of_equal_rows_are_not_merged(metric, text):
    """Rows that tie with the k-th best and have higher ids are dropped before the best are merged."""
    rng = np.random.default_rng(3)
    rows = rng.integers(-1, 2, (4000, 6)).astype(np.float32)
    rows[rng.random(4000) < 0.5] = rows[0]
    ids = rng.permutation(4000)
    ids = np.char.zfill(ids.astype(str), 1 + 3 * text) if text else ids
    best = kernels.TopK(kernels.Queries(metric, pa.array(range(20)), rows[:20]), 3)
    for start in range(0, 4000, 500):
        best.add(ids[start : start + 500], rows[start : start + 500])
        best._merge()
    # Rows like the crowd, behind all others by their ids.
    best.add(np.array(["~" if text else 9999] * 500), np.repeat(rows[:1], 500, axis=0))
    assert best.n_new == 0
    got = best.table(pa.string() if text else pa.int64()).to_pydict()
    for q in range(20):
        score = kernels.exact(metric, np.repeat(rows[q : q + 1], 4000, axis=0), rows)
        gain = np.where(np.isnan(score), -np.inf, -score if metric == "L2" else score)
        want = np.lexsort((ids, -gain))[:3]
        at = [k for k, x in enumerate(got["qid"]) if x == q]
        assert [got["id"][k] for k in at] == [ids[k] for k in want]


@pytest.mark.parametrize("metric", ["COSINE", "L2", "IP"])
def test_many_rows_against_brute_force(metric):
    """A block wide enough that its bar comes from groups of rows; vectors of very different length."""
    rng = np.random.default_rng(8)
    rows = (rng.normal(size=(5000, 5)) * rng.choice([0.0, 0.1, 1.0, 30.0], (5000, 1))).astype(np.float32)
    asked, ids = rows[:40], rng.permutation(5000)
    best = kernels.TopK(kernels.Queries(metric, pa.array(range(40)), asked), 4)
    for start in range(0, 5000, 2500):
        best.add(ids[start : start + 2500], rows[start : start + 2500])
    got = best.table(pa.int64()).to_pydict()
    found = {}
    for q, i, s in zip(got["qid"], got["id"], got["score"]):
        found.setdefault(q, []).append((i, s))
    for q in range(40):
        score = kernels.exact(metric, np.repeat(asked[q : q + 1], 5000, axis=0), rows)
        gain = np.where(np.isnan(score), -np.inf, -score if metric == "L2" else score)
        order = np.lexsort((ids, -gain))[:4]
        assert found[q] == [(ids[k], None if np.isnan(score[k]) else score[k]) for k in order]
