"""Search by cells: rows are grouped around centroids and a query looks into few groups.

The groups ("cells") are a column of the collection and a partition of its files, so
cells that a search does not look into are not read. Cells belong to branches, the upper
level of a two-level tree of centroids: a query descends into the nearest branches (the
beam) and there into the nearest cells, so it never meets all centroids. Two small
tables are stored with the rows, one row for each cell and one for each branch; each
keeps the radius, the distance of its farthest row.

* Approximate search looks into as many cells as its level asks for. For fitted
  centroids a level is a recall: how many branches and cells reach it is measured when
  the index is built, on a bounded sample against exact search. For given centroids a
  level is a share of the cells.
* Exact search (``exact_search``, ``range_search``) needs no level: no row of a cell is
  nearer than its centroid less the radius, so cells that cannot reach the best k found so
  far, or the range asked for, are never read.

Distances are Euclidean in a space where they order rows like the metric does: unit
vectors for cosine; for inner products one more coordinate brings all rows to the length
of the longest, and queries are scaled to that length with a zero there.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectide.functions import kernels
from vectide.functions.predicates import predicate
from vectide.functions.vectors import SCORE_DECIMALS, check_metric, similarity
from vectide.operators import nearest
from vectide.session import materialize, materialize_parts
from vectide.sizing import BLOCK_BYTES, BROADCAST_BYTES, Size
from vectide.sources.collections import in_partitions

# Share of the cells that each precision level looks into, where centroids are given.
LEVEL_SHARE = {1: 1 / 8, 2: 1 / 4, 3: 1 / 2, 4: 3 / 4, 5: 1.0}
# Recall of the best ten that each precision level is measured to reach, where centroids are fitted.
LEVEL_RECALL = {1: 0.9, 2: 0.95, 3: 0.98, 4: 0.99, 5: 1.0}
# Rows that serve as queries when levels are measured, and the hits that are looked for.
SAMPLE_QUERIES, SAMPLE_HITS = 256, 10

# Up to this many cells one level of centroids is enough.
FLAT_CELLS = 256
# Rows of a branch that its cells are fitted to, for each cell, and the bytes of such a sample.
SAMPLE_PER_CELL = 64
SAMPLE_BYTES = 256 * 1024 * 1024

# Rows whose distances to all centroids one step holds.
STEP_CELLS = 4_000_000
# Bytes of rows that a task gathers before it deals them to their cells.
GATHER_BYTES = 16 * 1024 * 1024
# Cells that a filter names; more are sent as a table.
NAMED_CELLS = 200
# Distances are compared with this much slack, relative to the lengths involved.
SLACK = 1e-9


@dataclass(frozen=True)
class Tree:
    """Centroids of branches, and of cells where they fit into the driver's bound.

    ``centers`` are ordered by branch; those of branch ``b`` are ``first[b]`` to
    ``first[b + 1]``, and ``cells`` gives their numbers. Without ``centers`` they are
    met branch by branch in tasks.
    """

    branches: np.ndarray
    cells: np.ndarray | None = None
    centers: np.ndarray | None = None
    first: np.ndarray | None = None

    def arrays(self) -> tuple:
        """What is sent to tasks: broadcasts are read where this package need not be installed."""
        return self.branches, self.cells, self.centers, self.first


@dataclass(frozen=True)
class CellIndex:
    """``rows(id, vector, branch, cell, cell_far, branch_far)`` and the centroids.

    ``table`` holds one row for each cell: ``cell, branch, center``. ``longest`` is the length
    of the longest vector (inner products only). ``levels`` gives branches and cells to look
    into at each level, where that was measured.
    """

    rows: DataFrame
    table: DataFrame
    tree: Tree
    metric: str
    longest: float
    n_cells: int
    radii: DataFrame | None = None
    levels: dict[int, tuple[int, int]] = field(default_factory=dict)

    @property
    def centroids(self) -> np.ndarray:
        """Centroids in the order of their cells; only where they fit."""
        return self.tree.centers[np.argsort(self.tree.cells)]


def parse_params(text: str | None) -> dict:
    """Search parameters as JSON; text that is no JSON object gives none."""
    try:
        value = json.loads(text) if text else {}
    except (TypeError, ValueError):
        return {}
    return value if isinstance(value, dict) else {}


def probes(n_cells: int, level: int = 1, search_params: str | None = None) -> int:
    """Number of cells a query looks into: ``nprobe`` if given, otherwise the level's share."""
    asked = parse_params(search_params).get("nprobe")
    if asked is not None:
        return min(n_cells, max(1, int(asked)))
    if int(level) not in LEVEL_SHARE:
        raise ValueError("level must be between 1 and 5")
    return max(1, math.ceil(n_cells * LEVEL_SHARE[int(level)]))


def effort(index: CellIndex, level: int = 1, search_params: str | None = None) -> tuple[int, int]:
    """Branches and cells a query looks into: all branches where cells are asked for by number."""
    count = probes(index.n_cells, level, search_params)
    if "nprobe" not in parse_params(search_params) and int(level) in index.levels:
        return index.levels[int(level)]
    return len(index.tree.branches), count


def default_cells(n: int) -> int:
    return max(1, round(math.sqrt(n)))


# The space in which distances are Euclidean.


def _dim(dim: int, metric: str) -> int:
    return dim + 1 if metric == "IP" else dim


def rows_in_space(vectors: np.ndarray, metric: str, longest: float) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    squares = kernels.squared_norms(vectors)
    if metric == "COSINE":
        return vectors / np.where(squares > 0, np.sqrt(squares), 1.0)[:, None]
    if metric == "IP":
        with np.errstate(invalid="ignore"):
            rest = np.sqrt(np.maximum(longest * longest - squares, 0.0))
        return np.concatenate([vectors, rest[:, None]], axis=1)
    return vectors


def queries_in_space(vectors: np.ndarray, metric: str, longest: float) -> np.ndarray:
    if metric != "IP":
        return rows_in_space(vectors, metric, longest)
    vectors = vectors.astype(np.float64)
    length = np.sqrt(kernels.squared_norms(vectors))
    scaled = vectors * np.where(length > 0, longest / np.where(length > 0, length, 1.0), 0.0)[:, None]
    return np.concatenate([scaled, np.zeros((len(vectors), 1))], axis=1)


def reach(scores: np.ndarray, vectors: np.ndarray, metric: str, longest: float) -> np.ndarray:
    """Distance in the space at which a query has a score; infinite where the score is missing or the query has none."""
    scores = scores.astype(np.float64)
    if metric == "L2":
        return np.where(np.isfinite(scores), scores, np.inf)
    length = np.sqrt(kernels.squared_norms(vectors))
    if metric == "COSINE":
        square = 2.0 - 2.0 * scores
    else:
        with np.errstate(divide="ignore", invalid="ignore"):
            square = 2.0 * longest * longest - 2.0 * longest * scores / length
    return np.where(np.isfinite(square) & (length > 0), np.sqrt(np.maximum(square, 0.0)), np.inf)


def longest_vector(rows: DataFrame, metric: str) -> float:
    """Length of the longest finite ``vector`` (inner products only)."""
    if metric != "IP":
        return 0.0
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    finite = F.when(~F.isnan(square) & (square < float("inf")), square)
    return math.sqrt(rows.agg(F.max(finite)).first()[0] or 0.0)


def _features(rows: DataFrame, dim: int, metric: str, longest: float) -> DataFrame:
    """Finite rows in the space, as ``v``."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                points = rows_in_space(kernels.matrix(batch["vector"], dim), metric, longest)
                points = points[np.isfinite(points).all(axis=1)]
                yield pa.RecordBatch.from_arrays([_lists(points)], ["v"])

    return rows.select("vector").mapInArrow(run, "v array<double>")


def _lists(points: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(0, points.size + 1, max(1, points.shape[1]), dtype=np.int32)[: len(points) + 1])
    return pa.ListArray.from_arrays(offsets, pa.array(points.ravel()))


def fit_centroids(points: DataFrame, n_cells: int, seed: int = 7, max_iter: int = 10) -> np.ndarray:
    """Centroids of all points ``v``, by distributed k-means."""
    features = points.select(array_to_vector("v").alias("features"))
    return np.array(KMeans(k=n_cells, seed=seed, initMode="random", maxIter=max_iter).fit(features).clusterCenters())


def _nearest_cells(points: np.ndarray, centroids: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` nearest centroids of each point, in ascending order of the places."""
    squares = np.einsum("ij,ij->i", centroids, centroids)[None, :]
    step = max(1, STEP_CELLS // len(centroids))
    found = [np.empty((0, count), np.int64)]
    for start in range(0, len(points), step):
        with np.errstate(invalid="ignore", over="ignore"):
            far = squares - 2.0 * (points[start : start + step] @ centroids.T)
        far = np.where(np.isnan(far), np.inf, far)
        if count == 1:
            found.append(far.argmin(axis=1)[:, None])
        elif count == len(centroids):
            found.append(np.tile(np.arange(count), (len(far), 1)))
        else:
            # Of equally far cells at the edge the lower ones, as in a full sort.
            edge = np.partition(far, count - 1, axis=1)[:, count - 1 : count]
            nearer, at_edge = far < edge, far == edge
            room = count - nearer.sum(axis=1, keepdims=True)
            chosen = nearer | (at_edge & (np.cumsum(at_edge, axis=1) <= room))
            found.append(np.nonzero(chosen)[1].reshape(len(far), count))
    return np.concatenate(found)


def _distances(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    away = points - center
    return np.sqrt(np.einsum("ij,ij->i", away, away))


# Building.


def _lloyd(points: np.ndarray, k: int, seed: int, max_iter: int) -> np.ndarray:
    """k-means of a bounded sample; centroids that lose all points stay where they are."""
    distinct = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    centers = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(max_iter):
        own = _nearest_cells(points, centers, 1)[:, 0]
        order = np.argsort(own, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(own[order]) > 0])
        moved = centers.copy()
        moved[own[order][starts]] = np.add.reduceat(points[order], starts, axis=0) / np.diff(np.r_[starts, len(own)])[:, None]
        if np.allclose(moved, centers, rtol=0, atol=1e-12):
            break
        centers = moved
    return centers


_TABLE = "cell int, branch int, center array<double>"


def _fit_cells(rows: DataFrame, branches: np.ndarray, n_cells: int, dim: int, metric: str, longest: float, seed: int, max_iter: int) -> DataFrame:
    """The cells of each branch, fitted to a bounded sample of its rows in a task of its own.

    A branch gets cells in proportion to its rows; ``SAMPLE_BYTES`` bounds its sample.
    """
    spark = rows.sparkSession
    width = _dim(dim, metric)
    most = max(1, SAMPLE_BYTES // (SAMPLE_PER_CELL * width * 8))
    held = materialize(_in_branches(rows, branches, dim, metric, longest).select("id", "vector", "branch"))
    counts = {r["branch"]: r["count"] for r in held.groupBy("branch").count().collect()}
    n = sum(counts.values())
    plan, cell = [], 0
    for b in sorted(counts):
        cells = min(most, max(1, round(n_cells * counts[b] / n)))
        plan.append((b, cells, cell, min(1.0, SAMPLE_PER_CELL * cells / counts[b])))
        cell += cells
    # As many rows as branches.
    planned = F.broadcast(spark.createDataFrame(plan, "branch int, cells int, first int, part double"))
    chosen = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < F.col("part") * float(1 << 30)
    sample = held.join(planned, "branch").where(chosen).select("branch", "cells", "first", "vector")

    def fit(table: pa.Table) -> pa.Table:
        points = rows_in_space(kernels.matrix(table["vector"], dim), metric, longest)
        points = points[np.isfinite(points).all(axis=1)]
        branch, cells, first = (table[c][0].as_py() for c in ("branch", "cells", "first"))
        centers = _lloyd(points, cells, seed, max_iter) if len(points) else branches[branch][None, :]
        numbers = pa.array(np.arange(first, first + len(centers), dtype=np.int32))
        return pa.table([numbers, pa.array(np.full(len(centers), branch, np.int32)), _lists(centers)], names=["cell", "branch", "center"])

    fitted = materialize(sample.groupBy("branch").applyInArrow(fit, _TABLE))
    # A branch whose sample came out empty is one cell.
    there = {r["branch"] for r in fitted.select("branch").distinct().collect()}
    alone = [(first, b, branches[b].tolist()) for b, _, first, _ in plan if b not in there]
    return fitted.unionByName(spark.createDataFrame(alone, _TABLE)) if alone else fitted


def _in_branches(rows: DataFrame, branches: np.ndarray, dim: int, metric: str, longest: float) -> DataFrame:
    """Rows with ``branch``, the nearest one."""
    shared = rows.sparkSession.sparkContext.broadcast(branches)
    schema = T.StructType([*rows.schema.fields, T.StructField("branch", T.IntegerType())])

    def run(batches):
        for batch in batches:
            points = rows_in_space(kernels.matrix(batch["vector"], dim), metric, longest)
            near = _nearest_cells(points, shared.value, 1)[:, 0].astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near)], [*batch.schema.names, "branch"])

    return rows.mapInArrow(run, schema)


def _tree(table: DataFrame, branches: np.ndarray, n_cells: int, broadcast_bytes: int) -> Tree:
    """The centroids, those of cells only if they fit into the bound."""
    if n_cells * branches.shape[1] * 8 > broadcast_bytes:
        return Tree(branches)
    held = table.orderBy("branch", "cell").toArrow()
    branch = held["branch"].to_numpy()
    centers = kernels.matrix(held["center"], branches.shape[1])
    return Tree(branches, held["cell"].to_numpy(), centers, np.searchsorted(branch, np.arange(len(branches) + 1)))


_PLACED = [T.StructField("branch", T.IntegerType()), T.StructField("cell", T.IntegerType()), T.StructField("cell_far", T.DoubleType()), T.StructField("branch_far", T.DoubleType())]


def _placed(points: np.ndarray, cells: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest cell of each point, and the distance to its centre."""
    near = _nearest_cells(points, centers, 1)[:, 0]
    with np.errstate(invalid="ignore", over="ignore"):
        return cells[near].astype(np.int32), _distances(points, centers[near])


def _place(rows: DataFrame, table: DataFrame, tree: Tree, dim: int, metric: str, longest: float, block_bytes: int) -> DataFrame:
    """Rows ``id, vector`` with their branch and cell and the distances to both centroids."""
    schema = T.StructType([rows.schema["id"], rows.schema["vector"], *_PLACED])
    shared = rows.sparkSession.sparkContext.broadcast(tree.arrays())

    def batch_of(ids, vectors, points, branch, cell, far) -> pa.RecordBatch:
        with np.errstate(invalid="ignore", over="ignore"):
            away = _distances(points, shared.value[0][branch])
        columns = [ids, vectors, pa.array(branch.astype(np.int32)), pa.array(cell), pa.array(far), pa.array(away)]
        return pa.RecordBatch.from_arrays(columns, schema.names)

    if tree.centers is not None:

        def run(batches):
            tree = Tree(*shared.value)
            for batch in batches:
                if not batch.num_rows:
                    continue
                points = rows_in_space(kernels.matrix(batch["vector"], dim), metric, longest)
                branch = _nearest_cells(points, tree.branches, 1)[:, 0]
                cell, far = np.zeros(len(branch), np.int32), np.zeros(len(branch))
                for b in np.unique(branch):
                    at, own = branch == b, slice(tree.first[b], tree.first[b + 1])
                    cell[at], far[at] = _placed(points[at], tree.cells[own], tree.centers[own])
                yield batch_of(batch["id"], batch["vector"], points, branch, cell, far)

        return rows.select("id", "vector").mapInArrow(run, schema)

    # Centroids that exceed the bound meet the rows branch by branch, crowded branches in slices.
    held = materialize(_in_branches(rows.select("id", "vector"), tree.branches, dim, metric, longest))
    per_slice = max(1, block_bytes // (dim * 8))
    # One row for each branch.
    shape = F.broadcast(held.groupBy("branch").agg(F.ceil(F.count(F.lit(1)) / F.lit(per_slice)).cast("int").alias("slices")))
    left = held.join(shape, "branch").withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int")).drop("slices")
    right = table.join(shape, "branch").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a):
            return pa.Table.from_batches([], to_schema)
        points = rows_in_space(kernels.matrix(a["vector"], dim), metric, longest)
        cell, far = _placed(points, b["cell"].to_numpy(), kernels.matrix(b["center"], points.shape[1]))
        branch = a["branch"].to_numpy()
        return pa.Table.from_batches([batch_of(a["id"].combine_chunks(), a["vector"].combine_chunks(), points, branch, cell, far)])

    to_schema = nearest.to_arrow_schema(schema)
    keys = ("branch", "slice")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, schema)


def build(
    corpus: DataFrame,
    n_cells: int | None = None,
    metric: str = "COSINE",
    id_col: str = "id",
    vector_col: str = "vector",
    seed: int = 7,
    max_iter: int = 10,
    centroids: np.ndarray | None = None,
    calibrate: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> CellIndex:
    """Assign every row to a near centroid; centroids are fitted unless they are given.

    Given centroids are those of the space (for inner products one coordinate longer).
    Vectors whose length is not the most frequent one are left out (``nearest.lengths``
    counts them). ``calibrate`` measures what the levels need.
    """
    metric = check_metric(metric)
    rows = corpus.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).where("vector is not null")
    dim = nearest.usual_length(rows.select("vector"), "vector")
    rows = rows.where(F.size("vector") == dim)
    longest = longest_vector(rows, metric)
    spark = corpus.sparkSession
    if centroids is None:
        wanted = n_cells or default_cells(rows.count())
        points = _features(rows, dim, metric, longest)
        if wanted <= FLAT_CELLS:
            centroids = fit_centroids(points, wanted, seed, max_iter)
        else:
            per_branch = max(1, SAMPLE_BYTES // (SAMPLE_PER_CELL * _dim(dim, metric) * 8))
            branches = fit_centroids(points, math.ceil(max(math.sqrt(wanted), wanted / per_branch)), seed, max_iter)
            table = _fit_cells(rows, branches, wanted, dim, metric, longest, seed, max_iter)
    else:
        calibrate = False
    if centroids is not None:
        branches = centroids.mean(axis=0, keepdims=True)
        table = spark.createDataFrame([(i, 0, c.tolist()) for i, c in enumerate(centroids)], _TABLE)
    n = table.count()
    tree = _tree(table, branches, n, broadcast_bytes)
    placed = _place(rows, table, tree, dim, metric, longest, block_bytes)
    if not calibrate:
        return CellIndex(placed, table, tree, metric, longest, n)
    # Read several times to measure the levels: placed once.
    index = CellIndex(materialize(placed), table, tree, metric, longest, n)
    return replace(index, levels=measure_levels(index))


def _radii(rows: DataFrame) -> DataFrame:
    """``cell, branch, n, radius, branch_radius``: rows without a finite place (NaN) reach any distance."""
    far = lambda c: F.max(F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0)))
    return rows.groupBy("cell").agg(
        F.first("branch").alias("branch"), F.count(F.lit(1)).alias("n"), far(F.col("cell_far")).alias("radius"), far(F.col("branch_far")).alias("branch_radius")
    )


def store(index: CellIndex, path: str) -> None:
    """Write the rows partitioned by cell, the cells and their radii, the branches and the levels.

    The rebalance lets the adaptive planner split a crowded cell over several tasks
    and put small cells together, in one pass over the rows.
    """
    spark = index.rows.sparkSession
    index.rows.hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{path}/rows")
    index.table.write.parquet(f"{path}/cells")
    _radii(load_rows(spark, path)).write.parquet(f"{path}/radii")
    branches = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(index.tree.branches)], "branch int, center array<double>")
    branches.coalesce(1).write.parquet(f"{path}/branches")
    about = [(index.metric, index.longest, index.n_cells, {k: list(v) for k, v in index.levels.items()})]
    spark.createDataFrame(about, "metric string, longest double, n_cells long, levels map<int, array<int>>").coalesce(1).write.parquet(f"{path}/about")


def load_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows")


def load(spark: SparkSession, path: str, broadcast_bytes: int = BROADCAST_BYTES) -> CellIndex:
    about = spark.read.parquet(f"{path}/about").first()
    table = spark.read.parquet(f"{path}/cells")
    # The upper level: the square root of the cells.
    branches = np.array([r["center"] for r in spark.read.parquet(f"{path}/branches").orderBy("branch").collect()])
    tree = _tree(table, branches, about["n_cells"], broadcast_bytes)
    levels = {k: tuple(v) for k, v in about["levels"].items()}
    radii = spark.read.parquet(f"{path}/radii")
    return CellIndex(load_rows(spark, path), table, tree, about["metric"], about["longest"], about["n_cells"], radii, levels)


# Levels.


def measure_levels(index: CellIndex, hits: int = SAMPLE_HITS, queries: int = SAMPLE_QUERIES) -> dict[int, tuple[int, int]]:
    """Branches and cells that the recall of each level takes.

    A sample of at most ``queries`` rows (by the hash of their ids) is searched exactly; of
    each hit it is counted how many branches, and how many cells, are nearer to the
    query than the hit's own.
    """
    every = (len(index.tree.branches), index.n_cells)
    rows = index.rows
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(queries)
    asked = materialize(chosen.select(F.col("id").alias("qid"), F.col("vector").alias("qv")))
    found = nearest.top_k(rows.select("id", "vector"), asked, hits + 1, index.metric, decimals=None)
    # A row that finds itself says nothing. At most ``queries`` times ``hits`` rows.
    truth = F.broadcast(found.where("id <> qid and score is not null").select("qid", "id"))
    placed = rows.select("id", "cell", "branch").join(truth, "id").select("qid", "cell", "branch").collect()
    if not placed:
        return {level: every for level in LEVEL_RECALL}
    sample = asked.dropDuplicates(["qid"]).collect()
    number = {r["qid"]: k for k, r in enumerate(sample)}
    points = queries_in_space(np.array([r["qv"] for r in sample]), index.metric, index.longest)
    query = np.array([number[r["qid"]] for r in placed])
    cell, branch = (np.array([r[c] for r in placed]) for c in ("cell", "branch"))
    far = np.stack([_distances(index.tree.branches, p) for p in points])
    branch_rank = (far[query] < far[query, branch][:, None]).sum(axis=1)
    cell_rank = _cell_ranks(index, points, query, cell)

    def least(rank: np.ndarray, share: float) -> int | None:
        """The smallest number of places that holds the share."""
        ordered = np.sort(rank)
        at = math.ceil(share * len(rank)) - 1
        return int(ordered[at]) + 1 if ordered[at] < np.iinfo(np.int64).max else None

    levels, low = {}, (1, 1)
    for level, recall in LEVEL_RECALL.items():
        # Two standard errors above, for the sample is one of many; the hits of a query stand or fall together.
        aim = min(1.0, recall + 2 * math.sqrt(recall * (1 - recall) / len(sample)))
        beam = every[0] if recall >= 1 else least(branch_rank, (1 + aim) / 2)
        outside = np.iinfo(np.int64).max
        count = every[1] if recall >= 1 else least(np.where(branch_rank < beam, cell_rank, outside), aim)
        low = max(low[0], beam), max(low[1], count or every[1])
        levels[level] = low
    return levels


def _cell_ranks(index: CellIndex, points: np.ndarray, query: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """How many cells are nearer to each query than a cell of its hits, from one pass over the table of cells."""
    spark = index.table.sparkSession
    width = points.shape[1]
    # The cells that hold hits: a bounded sample has few.
    wanted = spark.createDataFrame([(int(c),) for c in np.unique(cell)], "cell int")
    own = index.table.join(F.broadcast(wanted), "cell").collect()
    center = {r["cell"]: np.array(r["center"]) for r in own}
    far = np.array([float(_distances(center[c][None, :], points[q])[0]) for q, c in zip(query, cell)])
    shared = spark.sparkContext.broadcast((points, query, cell, far))

    def run(batches):
        points, query, cell, far = shared.value
        nearer = np.zeros(len(query), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            centers, numbers = kernels.matrix(batch["center"], width), batch["cell"].to_numpy()
            for q in np.unique(query):
                at = np.flatnonzero(query == q)
                away = _distances(centers, points[q])
                before = (away[None, :] < far[at, None]) | ((away[None, :] == far[at, None]) & (numbers[None, :] < cell[at, None]))
                nearer[at] += before.sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(query))), pa.array(nearer)], ["item", "nearer"])

    counted = index.table.mapInArrow(run, "item long, nearer long").groupBy("item").agg(F.sum("nearer").alias("nearer"))
    out = np.zeros(len(query), np.int64)
    for r in counted.collect():
        out[r["item"]] = r["nearer"]
    return out


# Searching.


class _Nearest:
    """Chooses the nearest cells among those of the nearest branches."""

    def __init__(self, beam: int, count: int):
        self.beam, self.count = beam, count

    def branches(self, points: np.ndarray, bars: np.ndarray, centers: np.ndarray, radii) -> list[np.ndarray]:
        return list(_nearest_cells(points, centers, min(self.beam, len(centers))))

    def cells(self, point: np.ndarray, bar: float, centers: np.ndarray, radii) -> np.ndarray:
        return _nearest_cells(point[None, :], centers, min(self.count, len(centers)))[0]


def _chosen(tree: Tree, points: np.ndarray, bars: np.ndarray, choose, branch_far, cell_far) -> list[np.ndarray]:
    """The cells that each point looks into, in ascending order."""
    if isinstance(choose, _Nearest) and choose.beam >= len(tree.branches):
        near = _nearest_cells(points, tree.centers, min(choose.count, len(tree.centers)))
        return list(np.sort(tree.cells[near], axis=1))
    chosen = []
    for p, bar, own in zip(points, bars, choose.branches(points, bars, tree.branches, branch_far)):
        at = np.concatenate([np.arange(tree.first[b], tree.first[b + 1]) for b in own] or [np.zeros(0, np.int64)])
        near = choose.cells(p, bar, tree.centers[at], None if cell_far is None else cell_far[at]) if len(at) else at
        chosen.append(np.sort(tree.cells[at[near]]))
    return chosen


class _Within:
    """Chooses the cells, and the branches, that may hold a row no farther than the bar."""

    def branches(self, points, bars, centers, radii):
        return [self.cells(p, b, centers, radii) for p, b in zip(points, bars)]

    def cells(self, point, bar, centers, radii):
        far = _distances(centers, point)
        # Comparisons with NaN are false: what cannot be bounded is read.
        return np.flatnonzero(~(far - radii > bar + SLACK * (far + radii)))


def _bars(batch: pa.RecordBatch, vectors: np.ndarray, metric: str, longest: float) -> np.ndarray:
    score = batch["bar"].to_numpy(zero_copy_only=False).astype(np.float64)
    bars = reach(score, vectors, metric, longest)
    # The score of a near row is known to a few digits less as a distance.
    scale = {"COSINE": 2.0, "IP": 2.0 * longest * longest}.get(metric, 0.0)
    return np.sqrt(bars * bars + 1e-12 * scale)


def _probe(index: CellIndex, asked: DataFrame, choose, radii: DataFrame | None, block_bytes: int) -> DataFrame:
    """``no, qid, qv, cells``: the cells that each query ``no, qid, qv, bar`` looks into."""
    metric, longest, tree = index.metric, index.longest, index.tree
    dim = tree.branches.shape[1] - (metric == "IP")
    spark = asked.sparkSession
    shared_tree = spark.sparkContext.broadcast(tree.arrays())
    branch_far, cell_far = _radius_arrays(index, radii)
    shared_radii = spark.sparkContext.broadcast((branch_far, cell_far))
    kept = [asked.schema[c] for c in ("no", "qid", "qv")]
    listed = T.ArrayType(T.IntegerType())

    def lists(values: list[np.ndarray]) -> pa.Array:
        offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
        flat = np.concatenate(values) if values else np.zeros(0)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))

    def space(batch):
        vectors = kernels.matrix(batch["qv"], dim)
        return queries_in_space(vectors, metric, longest), _bars(batch, vectors, metric, longest)

    if tree.centers is not None:

        def run(batches):
            tree, (branch_far, cell_far) = Tree(*shared_tree.value), shared_radii.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                points, bars = space(batch)
                chosen = _chosen(tree, points, bars, choose, branch_far, cell_far)
                yield pa.RecordBatch.from_arrays([batch[c] for c in ("no", "qid", "qv")] + [lists(chosen)], ["no", "qid", "qv", "cells"])

        return asked.mapInArrow(run, T.StructType([*kept, T.StructField("cells", listed)]))

    # Centroids that exceed the bound meet the queries branch by branch, crowded branches in slices.
    def descend(batches):
        for batch in batches:
            if batch.num_rows:
                points, bars = space(batch)
                own = choose.branches(points, bars, shared_tree.value[0], shared_radii.value[0])
                yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("no", "qv", "bar")), lists(own)], ["no", "qv", "bar", "own"])

    fields = [asked.schema[c] for c in ("no", "qv", "bar")]
    met = asked.mapInArrow(descend, T.StructType([*fields, T.StructField("own", listed)]))
    met = materialize(met.select("no", "qv", "bar", F.explode("own").alias("branch")))
    per_slice = max(1, block_bytes // (dim * 8))
    # One row for each branch.
    shape = F.broadcast(met.groupBy("branch").agg(F.ceil(F.count(F.lit(1)) / F.lit(per_slice)).cast("int").alias("slices")))
    left = met.join(shape, "branch").withColumn("slice", F.pmod(F.xxhash64("no"), F.col("slices")).cast("int")).drop("slices")
    table = index.table.join(radii.select("cell", "radius"), "cell") if radii is not None else index.table.withColumn("radius", F.lit(0.0))
    right = table.join(shape, "branch").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")
    names = ["no", "cell", "far"]

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        no, cell, away = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0)]
        if len(a) and len(b):
            vectors = kernels.matrix(a["qv"], dim)
            points, bars = queries_in_space(vectors, metric, longest), _bars(a, vectors, metric, longest)
            order = np.argsort(b["cell"].to_numpy())
            cells, radius = b["cell"].to_numpy()[order], b["radius"].to_numpy()[order]
            centers = kernels.matrix(b["center"], points.shape[1])[order]
            for n, p, bar in zip(a["no"].to_numpy(), points, bars):
                at = choose.cells(p, bar, centers, radius)
                no.append(np.full(len(at), n))
                cell.append(cells[at])
                away.append(_distances(centers[at], p))
        return pa.table([pa.array(np.concatenate(x)) for x in (no, cell, away)], names=names)

    keys = ("branch", "slice")
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "no long, cell int, far double")
    if isinstance(choose, _Nearest):
        place = F.row_number().over(nearest.Window.partitionBy("no").orderBy("far", "cell"))
        near = near.withColumn("_n", place).where(F.col("_n") <= choose.count)
    cells = near.groupBy("no").agg(F.sort_array(F.collect_list("cell")).alias("cells"))
    return asked.join(cells, "no", "left").select("no", "qid", "qv", F.coalesce("cells", F.array().cast(listed)).alias("cells"))


def _radius_arrays(index: CellIndex, radii: DataFrame | None) -> tuple[np.ndarray | None, np.ndarray | None]:
    """Radii in the order of the tree's branches and, where its centroids fit, cells; a cell without rows cannot be reached."""
    if radii is None:
        return None, None
    branch_far = np.full(len(index.tree.branches), -np.inf)
    for r in radii.groupBy("branch").agg(F.max("branch_radius").alias("r")).collect():
        branch_far[r["branch"]] = r["r"]
    if index.tree.centers is None:
        return branch_far, None
    held = {r["cell"]: r["radius"] for r in radii.select("cell", "radius").collect()}
    return branch_far, np.array([held.get(int(c), -np.inf) for c in index.tree.cells])


def _numbered(asked: DataFrame) -> DataFrame:
    """Queries ``no, qid, qv, bar`` with a number each; the bar is the score that a hit must reach."""
    return asked.select(F.monotonically_increasing_id().alias("no"), "qid", "qv", F.lit(None).cast("double").alias("bar"))


def _queries(index: CellIndex, queries: DataFrame, qid_col: str, query_col: str) -> DataFrame:
    dim = index.tree.branches.shape[1] - (index.metric == "IP")
    asked = queries.select(F.col(qid_col).alias("qid"), F.col(query_col).alias("qv"))
    return asked.where(F.size("qv") == dim)


def _met(
    rows: DataFrame, probed: DataFrame, size: Size, dim: int, schema, make, n_cells: int, n_groups: int, finish=None
) -> DataFrame:
    """Meet the rows of the probed cells with the queries that look into them; ``finish`` is applied to the hits.

    ``size`` bounds the queries and their cells. ``make(ids, vectors)`` prepares queries for a
    task: it gives ``add(ids, vectors, pick)``, which may return tables, and ``end()``. Many
    queries go out in groups, one scan of the cells for each, so no row moves. The few hits that
    ``finish`` leaves are written. Without it hits may be far more than all input: they are handed
    out as they are found, and what was sent stays until they are read.
    """
    if not size.rows:
        empty = rows.sparkSession.createDataFrame([], schema)
        return finish(empty) if finish else empty
    if n_groups == 1:
        hits = _scan_cells(rows, probed, dim, schema, make, n_cells)[0]
        return finish(hits) if finish else hits
    kept = nearest.grouped(probed.select("qid", "qv", "cells"), n_groups)

    few = finish is not None
    scans = (_scan_cells(rows, kept.where(F.col("_block") == g), dim, schema, make, n_cells, few) for g in range(n_groups))
    if finish is None:
        return reduce(DataFrame.unionByName, (hits for hits, _ in scans))

    def parts():
        for hits, shared in scans:
            yield finish(hits)
            if shared is not None:
                shared.destroy()

    return materialize_parts(parts())


def _askers(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells in ascending order, where the queries of each begin, and these queries."""
    cells = np.concatenate(lists) if lists else np.zeros(0, np.int32)
    query = np.repeat(np.arange(len(lists), dtype=np.int32), [len(x) for x in lists])
    order = np.argsort(cells, kind="stable")
    wanted, first = np.unique(cells[order], return_index=True)
    return wanted, np.append(first, len(cells)), query[order]


def _by_cell(batches, dim: int):
    """Rows of the batches, some at a time, as ``cell, ids, vectors`` for each cell among them."""

    def split(held):
        cells, ids, vectors = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(cells, kind="stable")
        ends = np.flatnonzero(np.diff(cells[order])) + 1
        for at in np.split(order, ends):
            yield int(cells[at[0]]), ids[at], vectors[at]

    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append((batch["cell"].to_numpy(zero_copy_only=False), kernels.id_values(batch["id"]), kernels.matrix(batch["vector"], dim)))
            n += batch.num_rows
        if n * dim * 8 >= GATHER_BYTES:
            yield from split(held)
            held, n = [], 0
    if held:
        yield from split(held)


def _meet_cells(batches, found, askers, dim: int):
    wanted, first, query = askers
    for cell, ids, vectors in _by_cell(batches, dim):
        at = int(np.searchsorted(wanted, cell))
        if at < len(wanted) and wanted[at] == cell:
            for table in found.add(ids, vectors, query[first[at] : first[at + 1]]):
                yield table
    yield from found.end()


def _scan_cells(
    rows: DataFrame, probed: DataFrame, dim: int, schema, make, n_cells: int, few: bool = False
) -> tuple[DataFrame, Broadcast | None]:
    """Read the probed cells in place; each row meets only the queries that look into its cell. Also what was sent."""
    table = probed.select("qid", "qv", "cells").toArrow()
    lists = table["cells"].combine_chunks()
    offsets = lists.offsets.to_numpy()
    flat = lists.flatten().to_numpy()
    if not len(flat):
        return rows.sparkSession.createDataFrame([], schema), None
    askers = _askers(np.split(flat, offsets[1:-1] - offsets[0]))
    shared = rows.sparkSession.sparkContext.broadcast((table["qid"].combine_chunks(), kernels.matrix(table["qv"], dim), askers))

    def run(batches):
        ids, vectors, askers = shared.value
        yield from _meet_cells(batches, make(ids, vectors), askers, dim)

    wanted = askers[0]
    if len(wanted) <= NAMED_CELLS:
        rows = rows.where(F.col("cell").isin(wanted.tolist()))
    elif len(wanted) < n_cells:
        # Read by partition as well: the planner prunes by the table it has sent.
        named = rows.sparkSession.createDataFrame([(c,) for c in wanted.tolist()], "cell int")
        rows = rows.join(F.broadcast(named), "cell", "left_semi")
    rows = nearest.few_tasks(rows) if few else rows
    return rows.select("cell", "id", "vector").mapInArrow(run, schema), shared


def _search_groups(index: CellIndex, rows: DataFrame, groups: list[Broadcast], choose, dim: int, schema, make, finish) -> DataFrame:
    """As ``_met`` for groups of queries that were sent without their cells: a task chooses them."""
    metric, longest = index.metric, index.longest
    shared_tree = rows.sparkSession.sparkContext.broadcast(index.tree.arrays())
    rows = nearest.few_tasks(rows)

    def scan(shared: Broadcast) -> DataFrame:
        def run(batches):
            ids, vectors = shared.value
            points = queries_in_space(vectors, metric, longest)
            askers = _askers(_chosen(Tree(*shared_tree.value), points, np.full(len(points), np.inf), choose, None, None))
            yield from _meet_cells(batches, make(ids, vectors), askers, dim)

        return finish(rows.select("cell", "id", "vector").mapInArrow(run, schema))

    return materialize_parts(scan(shared) for shared in groups)


class _Best:
    """Best k of a task."""

    def __init__(self, metric, ids, vectors, k, low, high, arrow_id, per_step=None):
        self.best, self.arrow_id = kernels.TopK(kernels.Queries(metric, ids, vectors), k, None, low, high, per_step), arrow_id

    def add(self, ids, vectors, pick):
        self.best.add(ids, vectors, pick)
        return ()

    def end(self):
        found = self.best.table(self.arrow_id)
        return [] if found is None else found.to_batches()


class _Range:
    """All hits of a range."""

    def __init__(self, metric, ids, vectors, low, high, arrow_id, per_step=None):
        self.asked, self.low, self.high = kernels.Queries(metric, ids, vectors), low, high
        self.arrow_id, self.per_step = arrow_id, per_step

    def add(self, ids, vectors, pick):
        for found in kernels.in_range(self.asked, ids, vectors, self.low, self.high, None, self.arrow_id, pick, self.per_step):
            yield from found.to_batches()

    def end(self):
        return ()


def _chosen_rows(index: CellIndex, corpus: DataFrame | None, filter, partition_names, id_col: str) -> DataFrame:
    rows = index.rows.select("cell", "id", "vector")
    if not (filter or partition_names):
        return rows
    chosen = in_partitions(corpus, partition_names)
    chosen = chosen.where(predicate(filter)) if filter else chosen
    return rows.join(chosen.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi").select(*rows.columns)


def _need_corpus(corpus, *of) -> None:
    if corpus is None and any(of):
        raise ValueError("a filter, partitions and output fields need the corpus they refer to")


def _query_bytes(asked: DataFrame, dim: int, cells: int) -> Size:
    n, _, id_bytes = nearest.query_size(asked)
    return Size(n, n * (dim * 8 + cells * 12) + id_bytes)


def _per_step(block_bytes: int, dim: int) -> int:
    """Queries that meet rows in one product."""
    return max(1, block_bytes // max(1, dim * 8))


def _placed_once(index: CellIndex, rows: DataFrame) -> DataFrame:
    """Rows that are read several times: those of an index that was not stored would be placed each time."""
    stored = index.radii is not None or index.levels
    return rows if stored else materialize(rows)


def _ranked(hits: DataFrame, metric: str, limit: int) -> DataFrame:
    ranked = nearest.rank_hits(hits, metric, limit)
    return ranked.select("qid", "rank", "id", "score", similarity(metric, F.col("score")).alias("similarity"))


def search(
    index: CellIndex,
    queries: DataFrame,
    limit: int = 10,
    level: int = 1,
    search_params: str | None = None,
    qid_col: str = "qid",
    query_col: str = "qv",
    corpus: DataFrame | None = None,
    filter: str | None = None,
    partition_names: str | Sequence[str] | None = None,
    output_fields: Sequence[str] | str | None = None,
    min_similarity: float | None = None,
    radius: float | None = None,
    range_filter: float | None = None,
    id_col: str = "id",
    broadcast_bytes: int = BROADCAST_BYTES,
    block_bytes: int = BLOCK_BYTES,
    decimals: int | None = SCORE_DECIMALS,
) -> DataFrame:
    """Best rows among the cells nearest to each query, scored exactly.

    ``filter``, ``partition_names`` and ``output_fields`` refer to ``corpus``, the table the
    index was built from. The range and the similarity cut are those of exact search.
    Queries of another length than the index's vectors have no hits.
    """
    _need_corpus(corpus, filter, partition_names, output_fields)
    metric = index.metric
    low, high = nearest.limits(radius, range_filter)
    beam, count = effort(index, level, search_params)
    rows = _chosen_rows(index, corpus, filter, partition_names, id_col)
    asked = _queries(index, queries, qid_col, query_col)
    dim = index.tree.branches.shape[1] - (metric == "IP")
    size = _query_bytes(asked, dim, count)
    schema = nearest.hit_schema(rows, asked)
    arrow_id = nearest.to_arrow_type(schema["id"].dataType)
    per_step = _per_step(block_bytes, dim)

    def make(ids, vectors):
        return _Best(metric, ids, vectors, limit, low, high, arrow_id, per_step)

    def best(hits):
        return nearest.rank_hits(hits, metric, limit)

    n_groups = nearest.group_count(size.bytes, size.rows, limit, broadcast_bytes, block_bytes)
    if index.tree.centers is None or n_groups == 1:
        probed = _probe(index, _numbered(asked), _Nearest(beam, count), None, block_bytes)
        hits = _met(rows, probed, size, dim, schema, make, index.n_cells, n_groups, best)
    else:
        # The same groups serve searches of any level and metric.
        n, _, id_bytes = nearest.query_size(asked)
        n_groups = nearest.group_count(n * dim * 8 + id_bytes, n, limit, broadcast_bytes, block_bytes)
        groups = nearest.sent_groups((queries, qid_col, query_col), asked, dim, n_groups)
        hits = _search_groups(index, _placed_once(index, rows), groups, _Nearest(beam, count), dim, schema, make, best)
    kept = nearest.given_out(nearest.cut_similarity(_ranked(hits.drop("rank"), metric, limit), min_similarity), metric, decimals)
    return kept if corpus is None else nearest.attach_fields(kept, corpus, output_fields, id_col, size.rows * limit)


def exact_search(
    index: CellIndex,
    queries: DataFrame,
    limit: int = 10,
    qid_col: str = "qid",
    query_col: str = "qv",
    broadcast_bytes: int = BROADCAST_BYTES,
    block_bytes: int = BLOCK_BYTES,
    decimals: int | None = SCORE_DECIMALS,
) -> DataFrame:
    """The exact best rows, as ``nearest.search`` finds them, from the cells that can hold one."""
    return exact_with_report(index, queries, limit, qid_col, query_col, broadcast_bytes, block_bytes, decimals)[0]


def exact_with_report(
    index: CellIndex,
    queries: DataFrame,
    limit: int = 10,
    qid_col: str = "qid",
    query_col: str = "qv",
    broadcast_bytes: int = BROADCAST_BYTES,
    block_bytes: int = BLOCK_BYTES,
    decimals: int | None = SCORE_DECIMALS,
) -> tuple[DataFrame, DataFrame]:
    """Hits, and ``qid, first_cells, more_cells, n_cells``: the cells that each query had to look into.

    The cells of level 1 give a query its k-th best score. Cells farther than that,
    radius included, are not read. A query with fewer than ``limit`` scored rows so far
    looks into all cells.
    """
    metric = index.metric
    dim = index.tree.branches.shape[1] - (metric == "IP")
    rows = _placed_once(index, index.rows.select("cell", "id", "vector"))
    asked = materialize(_numbered(_queries(index, queries, qid_col, query_col)))
    radii = index.radii if index.radii is not None else materialize(_radii(index.rows))
    schema = nearest.hit_schema(rows, asked)
    arrow_id = nearest.to_arrow_type(schema["id"].dataType)

    per_step = _per_step(block_bytes, dim)

    def make(ids, vectors):
        return _Best(metric, ids, vectors, limit, -math.inf, math.inf, arrow_id, per_step)

    def first_best(hits):
        return nearest.rank_hits(hits, metric, limit)

    beam, count = effort(index, 1)
    first = materialize(_probe(index, asked, _Nearest(beam, count), None, block_bytes))
    size = _cells_size(first, dim)
    n_groups = nearest.group_count(size.bytes, size.rows, limit, broadcast_bytes, block_bytes)
    hits = _met(rows, first, size, dim, schema, make, index.n_cells, n_groups, first_best)
    hits = materialize(first_best(hits.drop("rank")).select("qid", "id", "score", "rank"))
    last = hits.where(F.col("rank") == limit).select("qid", F.col("score").alias("bar"))
    barred = asked.drop("bar").join(last, "qid", "left").select("no", "qid", "qv", "bar")
    within = _probe(index, materialize(barred), _Within(), radii, block_bytes)
    looked = first.select("no", F.col("cells").alias("before"))
    more = within.join(looked, "no").select("no", "qid", "qv", F.array_except("cells", "before").alias("cells"), F.size("before").alias("n_before"))
    more = materialize(more)
    rest = more.where(F.size("cells") > 0)
    size = _cells_size(rest, dim)
    n_groups = nearest.group_count(size.bytes, size.rows, limit, broadcast_bytes, block_bytes)
    found = _met(rows, rest, size, dim, schema, make, index.n_cells, n_groups, first_best)
    best = _ranked(hits.unionByName(found).drop("rank"), metric, limit)
    report = more.select("qid", F.col("n_before").alias("first_cells"), F.size("cells").alias("more_cells"), F.lit(index.n_cells).alias("n_cells"))
    return nearest.given_out(best, metric, decimals), report


def range_search(
    index: CellIndex,
    queries: DataFrame,
    radius: float | None = None,
    range_filter: float | None = None,
    qid_col: str = "qid",
    query_col: str = "qv",
    broadcast_bytes: int = BROADCAST_BYTES,
    block_bytes: int = BLOCK_BYTES,
    decimals: int | None = SCORE_DECIMALS,
) -> DataFrame:
    """All rows whose similarity lies within both bounds, from the cells that can hold one."""
    metric = index.metric
    low, high = nearest.limits(radius, range_filter)
    dim = index.tree.branches.shape[1] - (metric == "IP")
    rows = index.rows.select("cell", "id", "vector")
    # The score at the lower bound; without one all cells are read.
    bar = low
    if metric == "L2":
        bar = 1.0 / low - 1.0 if low > 0 else math.inf
    bar = bar if math.isfinite(bar) else None
    asked = _numbered(_queries(index, queries, qid_col, query_col)).withColumn("bar", F.lit(bar).cast("double"))
    radii = index.radii if index.radii is not None else materialize(_radii(index.rows))
    schema = nearest.hit_schema(rows, asked)
    arrow_id = nearest.to_arrow_type(schema["id"].dataType)

    per_step = _per_step(block_bytes, dim)

    def make(ids, vectors):
        return _Range(metric, ids, vectors, low, high, arrow_id, per_step)

    # Queries that meet the centroids branch by branch are numbered once.
    asked = asked if index.tree.centers is not None else materialize(asked)
    probed = materialize(_probe(index, asked, _Within(), radii, block_bytes))
    size = _cells_size(probed, dim)
    n_groups = nearest.group_count(size.bytes, size.rows, 0, broadcast_bytes, block_bytes)
    hits = _met(rows, probed, size, dim, schema, make, index.n_cells, n_groups)
    hits = hits.select("qid", "id", "score", similarity(metric, F.col("score")).alias("similarity"))
    return nearest.given_out(hits, metric, decimals)


def _cells_size(probed: DataFrame, dim: int) -> Size:
    """Queries and bytes of a table ``qid, qv, cells`` that is written."""
    n, _, id_bytes = nearest.query_size(probed)
    cells = probed.agg(F.sum(F.size("cells"))).first()[0] or 0
    return Size(n, n * dim * 8 + cells * 12 + id_bytes)
