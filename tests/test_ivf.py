import re
import uuid

import numpy as np
import pytest

from vectide.operators import evaluation, ivf, nearest
from vectide.session import work_dir


@pytest.fixture(scope="module")
def sides(spark):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(8, 8))
    # A third of all rows crowd around one centre.
    crowd = np.where(rng.random(600) < 0.33, 0, rng.integers(0, 8, 600))
    points = centers[crowd] + rng.normal(scale=0.3, size=(600, 8))
    corpus = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, vector array<float>")
    queries = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points[:60])], "qid long, qv array<float>")
    return corpus, queries


def rows(hits):
    return sorted((r.qid, r["rank"], r.id, r.score) for r in hits.collect())


@pytest.mark.parametrize("metric", ["COSINE", "L2", "IP"])
def test_level_5_is_exact(sides, metric):
    corpus, queries = sides
    index = ivf.build(corpus, 8, metric)
    assert rows(ivf.search(index, queries, level=5)) == rows(nearest.search(corpus, queries, metric=metric))


def test_blocked_plan_gives_the_same_hits(sides):
    corpus, queries = sides
    index = ivf.build(corpus, 8)
    for level in (1, 3):
        scan = ivf.search(index, queries, level=level)
        blocked = ivf.search(index, queries, level=level, broadcast_bytes=0, block_bytes=1024)
        assert rows(scan) == rows(blocked)


def test_recall_grows_with_the_level_and_the_stored_index_answers_alike(spark, sides):
    corpus, queries = sides
    index = ivf.build(corpus, 8)
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    ivf.store(index, path)
    stored = ivf.load(spark, path)
    assert stored.rows.count() == 600 and stored.metric == "COSINE"
    truth = nearest.search(corpus, queries).selectExpr("qid", "id as relevant_id")
    recall = []
    for level in range(1, 6):
        hits = ivf.search(stored, queries, level=level)
        recall.append(evaluation.summarize(evaluation.evaluate(hits, truth)).first()["average_recall"])
    assert recall == sorted(recall) and recall[0] > 0.3 and recall[-1] == 1.0
    assert rows(ivf.search(stored, queries, level=2)) == rows(ivf.search(index, queries, level=2))


def test_only_probed_cells_are_read(spark, sides):
    corpus, queries = sides
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    ivf.store(ivf.build(corpus, 8), path)
    hits = ivf.search(ivf.load(spark, path), queries.where("qid = 3"), level=1)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[(isnotnull\(cell|\(cell|cell#\d+ IN)", plan)


def test_parameters():
    assert ivf.parse_params('{"nprobe": 10, "ef": 64}') == {"nprobe": 10, "ef": 64}
    for text in (None, "", "not json", "[1]"):
        assert ivf.parse_params(text) == {}
    assert ivf.probes(32, 1) == 4 and ivf.probes(32, 5) == 32 and ivf.probes(3, 1) == 1
    assert ivf.probes(32, 1, '{"nprobe": 7}') == 7 and ivf.probes(32, 2, "bad") == 8
    with pytest.raises(ValueError):
        ivf.probes(32, 6)


METRICS = ["COSINE", "L2", "IP"]


@pytest.fixture(scope="module")
def stretched(spark):
    """Vectors of log-normal length."""
    rng = np.random.default_rng(6)
    points = rng.normal(size=(4000, 16)) * rng.lognormal(sigma=1.0, size=(4000, 1))
    corpus = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, vector array<float>").repartition(6)
    asked = [(i, p.tolist()) for i, p in enumerate(rng.normal(size=(50, 16)))]
    return corpus, spark.createDataFrame(asked, "qid long, qv array<float>")


@pytest.mark.parametrize("metric", METRICS)
def test_levels_reach_their_recall(spark, stretched, metric):
    corpus, queries = stretched
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    ivf.store(ivf.build(corpus, 32, metric), path)
    index = ivf.load(spark, path)
    # Queries like the rows, which the levels were measured with.
    like = corpus.where("id % 20 = 7").selectExpr("id as qid", "vector as qv")
    truth = nearest.search(corpus, like, metric=metric).selectExpr("qid", "id as relevant_id")
    before = (0, 0)
    for level, aim in ivf.LEVEL_RECALL.items():
        beam, count = ivf.effort(index, level)
        assert (beam, count) >= before and count <= 32
        before = (beam, count)
        if level in (2, 5):
            continue
        hits = ivf.search(index, like, level=level)
        recall = evaluation.summarize(evaluation.evaluate(hits, truth)).first()["average_recall"]
        assert recall >= aim - 0.02, (metric, level, recall)
        assert recall >= count / 32 or recall == 1.0


@pytest.mark.parametrize("metric", METRICS)
def test_exact_search_reads_few_cells(spark, stretched, metric):
    corpus, queries = stretched
    index = ivf.build(corpus, 64, metric)
    want = nearest.search(corpus, queries, metric=metric)
    hits, read = ivf.exact_with_report(index, queries)
    assert rows(hits) == rows(want)
    assert rows(ivf.exact_search(index, queries, broadcast_bytes=0, block_bytes=4096)) == rows(want)
    assert rows(ivf.exact_search(index, queries, limit=5000)) == rows(nearest.search(corpus, queries, 5000, metric=metric))
    got = read.collect()
    assert len(got) == 50 and all(0 < r.first_cells + r.more_cells <= 64 for r in got)


def test_cells_out_of_reach_are_not_read(spark, sides):
    corpus, queries = sides
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    ivf.store(ivf.build(corpus, 8, "L2"), path)
    stored = ivf.load(spark, path)
    hits, read = ivf.exact_with_report(stored, queries)
    assert rows(hits) == rows(nearest.search(corpus, queries, metric="L2"))
    looked = [r.first_cells + r.more_cells for r in read.collect()]
    # The centres are far apart: hardly a query needs more than a few of them.
    assert sum(looked) < 0.5 * 8 * len(looked)


@pytest.mark.parametrize("metric", METRICS)
def test_range_on_cells(spark, stretched, metric):
    corpus, queries = stretched
    index = ivf.build(corpus, 32, metric, calibrate=False)
    scale = 20 if metric == "IP" else 1
    for low, high in ((0.3 * scale, 0.6 * scale), (None, 0.05)):
        asked = queries.where("qid < 10")
        want = nearest.range_search(corpus, asked, low, high, metric)
        got = ivf.range_search(index, asked, low, high)
        key = lambda hits: sorted((r.qid, r.id, r.score) for r in hits.collect())
        assert key(got) == key(want)
        assert key(ivf.range_search(index, asked, low, high, broadcast_bytes=0, block_bytes=8192)) == key(want)


def test_a_range_is_not_written(stretched, monkeypatch):
    """Hits of a range may be far more than the input: only the queries and their cells are kept."""
    corpus, queries = stretched
    index = ivf.build(corpus, 32, calibrate=False)
    asked = queries.where("qid < 50")
    written = []
    for name in ("materialize", "grouped", "materialize_parts"):
        for module in (ivf, nearest):
            if hasattr(module, name):
                keep = getattr(module, name)
                monkeypatch.setattr(module, name, lambda df, *a, _keep=keep, **b: written.append(getattr(df, "columns", ["parts"])) or _keep(df, *a, **b))
    key = lambda hits: sorted((r.qid, r.id, r.score) for r in hits.collect())
    got = key(ivf.range_search(index, asked, 0.2, 0.9, broadcast_bytes=0, block_bytes=2048))
    assert not [c for c in written if "score" in c or "parts" in c] and ["qid", "qv", "cells"] in [c[:3] for c in written]
    assert got == key(nearest.range_search(corpus, asked, 0.2, 0.9)) and len(got) > 1000


@pytest.mark.parametrize("metric", METRICS)
def test_tree_of_centroids(spark, stretched, metric, monkeypatch):
    corpus, queries = stretched
    monkeypatch.setattr(ivf, "FLAT_CELLS", 16)
    whole = ivf.build(corpus, 100, metric)
    assert len(whole.tree.branches) == 10 and whole.n_cells > 60
    placed = {r.id: (r.branch, r.cell) for r in whole.rows.collect()}
    assert len(placed) == 4000
    branch_of = {r.cell: r.branch for r in whole.table.collect()}
    assert all(branch_of[c] == b for b, c in placed.values())
    want = nearest.search(corpus, queries, metric=metric)
    assert rows(ivf.search(whole, queries, level=5)) == rows(want)
    assert rows(ivf.exact_search(whole, queries)) == rows(want)
    # Centroids beyond the bound meet rows and queries branch by branch, with the same outcome.
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    ivf.store(whole, path)
    apart = ivf.load(spark, path, broadcast_bytes=0)
    assert apart.tree.centers is None
    for level in (1, 5):
        assert rows(ivf.search(apart, queries, level=level)) == rows(ivf.search(whole, queries, level=level))
    assert rows(ivf.exact_search(apart, queries, block_bytes=4096)) == rows(want)
    again = ivf.build(corpus, 100, metric, broadcast_bytes=0, block_bytes=4096, calibrate=False)
    assert {r.id: (r.branch, r.cell) for r in again.rows.collect()} == placed


def test_hundred_thousand_cells(spark):
    from pyspark.sql import functions as F

    coordinates = F.array(*[F.randn(k).cast("float") for k in range(4)])
    corpus = spark.range(200_000).select("id", coordinates.alias("vector"))
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    corpus.repartition(8).write.parquet(path)
    corpus = spark.read.parquet(path)
    index = ivf.build(corpus, 100_000, "L2", broadcast_bytes=64 * 1024, max_iter=3)
    assert index.tree.centers is None and index.n_cells > 80_000
    queries = corpus.where("id % 4000 = 3").selectExpr("id as qid", "vector as qv")
    truth = nearest.search(corpus, queries, metric="L2").selectExpr("qid", "id as relevant_id")
    beam, count = ivf.effort(index, 1)
    assert count < 200 and beam < 100
    hits = ivf.search(index, queries, level=1)
    assert evaluation.summarize(evaluation.evaluate(hits, truth)).first()["average_recall"] >= ivf.LEVEL_RECALL[1] - 0.03


def test_share_read_falls_as_the_collection_grows(spark):
    rng = np.random.default_rng(8)
    points = rng.normal(size=(16_000, 6))
    table = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, vector array<float>").repartition(8)
    shares = []
    for n in (1000, 4000, 16_000):
        index = ivf.build(table.where(f"id < {n}"), metric="L2")
        shares.append(ivf.effort(index, 2)[1] / index.n_cells)
    # Four times the rows take less than four times the cells' rows at the same recall.
    assert shares[0] > shares[1] > shares[2]


def test_odd_vectors(spark):
    rng = np.random.default_rng(9)
    held = [(i, p.tolist()) for i, p in enumerate(rng.normal(size=(200, 5)))]
    held += [(300, None), (301, [1.0]), (302, [0.0] * 5), (303, [float("nan")] * 5), (304, [float("inf")] + [1.0] * 4), (305, held[0][1]), (305, held[0][1])]
    corpus = spark.createDataFrame(held, "id long, vector array<double>")
    queries = spark.createDataFrame([(0, held[0][1]), (1, [0.0] * 5), (2, [1.0]), (3, None), (4, held[9][1])], "qid long, qv array<double>")
    for metric in METRICS:
        index = ivf.build(corpus, 6, metric)
        # A query without a direction has no nearest cells: it looks into all of them.
        want = nearest.search(corpus, queries.where("qid <> 1"), metric=metric)
        assert rows(ivf.exact_search(index, queries.where("qid <> 1"))) == rows(want)
        assert rows(ivf.search(index, queries, level=5)) == rows(nearest.search(corpus, queries, metric=metric))
        exact = ivf.exact_search(index, queries.where("qid = 1")).collect()
        assert sorted((r["rank"], r.id) for r in exact) == sorted((r["rank"], r.id) for r in nearest.search(corpus, queries.where("qid = 1"), metric=metric).collect())


@pytest.mark.parametrize("metric", ["COSINE", "L2", "IP"])
def test_queries_in_groups_find_the_same_in_cells(vectors, asked, monkeypatch, metric):
    rng = np.random.default_rng(5)
    corpus = vectors([(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(400, 4)))])
    queries = asked([(q, [float(x) for x in v]) for q, v in enumerate(rng.normal(size=(40, 4)))])
    index = ivf.build(corpus, 9, metric)
    key = lambda df: sorted(map(tuple, df.collect()))
    runs = [lambda: ivf.search(index, queries, 5, 2), lambda: ivf.exact_search(index, queries, 5), lambda: ivf.range_search(index, queries, 0.3)]
    plain = [key(run()) for run in runs]
    monkeypatch.setattr(nearest, "GROUP_BYTES", 3000)
    assert [key(run()) for run in runs] == plain
    plan = ivf.search(index, queries, 5, 2)._jdf.queryExecution().executedPlan().toString()
    assert "cogroup" not in plan.lower()
