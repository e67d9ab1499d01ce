"""Nearest-neighbour search of a table of query vectors in a table of vectors.

The query table is measured first. A small one is sent to every task and the
collection is scanned once, without moving a row: each task keeps its own best k
per query and only those are shuffled. A large one is cut into groups, each of which
is sent to a scan of its own. No pair of rows is ever emitted, only the best of each task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from vectide.functions import kernels
from vectide.functions.predicates import fields_list, predicate
from vectide.functions.vectors import SCORE_DECIMALS, best_first, check_metric, similarity
from vectide.session import materialize, materialize_parts
from vectide.sizing import BLOCK_BYTES, BROADCAST_BYTES, HIT_BYTES, broadcast_if_small, estimated_bytes, spread_join

# Bytes of queries, with the best rows found for them, that are sent to tasks at a time, and
# bytes that one row among the best takes while it is held and merged.
GROUP_BYTES = 32 * 1024 * 1024
BEST_BYTES = 32
# Blocks of queries that get a scan each however small they are.
FEW_BLOCKS = 8
# Bytes that one task scans, and the number of rows that one task may merge for a query.
SCAN_BYTES = 128 * 1024 * 1024
MERGE_ROWS = 1_000_000


def sides(corpus: DataFrame, queries: DataFrame, id_col, vector_col, qid_col, query_col):
    rows = corpus.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    asked = queries.select(F.col(qid_col).alias("qid"), F.col(query_col).alias("qv"))
    return rows.where("vector is not null"), asked.where("qv is not null")


def hit_schema(corpus: DataFrame, queries: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("qid", queries.schema["qid"].dataType),
            T.StructField("id", corpus.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def usual_length(rows: DataFrame, vector_col: str) -> int:
    """The most frequent length of the vectors, the higher of equally frequent ones; 0 without vectors."""
    size = F.size(vector_col)
    ends = rows.where(F.col(vector_col).isNotNull()).agg(F.min(size).alias("low"), F.max(size).alias("high")).first()
    if ends["low"] == ends["high"]:
        return int(ends["low"] or 0)
    most = lengths_of(rows, vector_col).orderBy(F.desc("n"), F.desc("length")).first()
    return int(most["length"])


def lengths_of(rows: DataFrame, vector_col: str) -> DataFrame:
    """``length, n``: how many vectors have each length."""
    held = rows.where(F.col(vector_col).isNotNull()).select(F.size(vector_col).alias("length"))
    return held.groupBy("length").agg(F.count(F.lit(1)).alias("n"))


def lengths(corpus: DataFrame, queries: DataFrame, vector_col: str = "vector", query_col: str = "qv") -> DataFrame:
    """``side, length, n, searched``: which rows and queries take part in a search, by the length of their vectors.

    Searches compare vectors of the queries' usual length; other rows and queries are left
    out and counted here. Missing vectors have no length (null).
    """
    dim = usual_length(queries, query_col)

    def counted(side: str, rows: DataFrame, column: str) -> DataFrame:
        length = F.when(F.col(column).isNotNull(), F.size(column)).alias("length")
        return rows.select(F.lit(side).alias("side"), length).groupBy("side", "length").agg(F.count(F.lit(1)).alias("n"))

    both = counted("corpus", corpus, vector_col).unionByName(counted("queries", queries, query_col))
    return both.withColumn("searched", F.coalesce(F.col("length") == dim, F.lit(False)))


def query_size(queries: DataFrame) -> tuple[int, int, int]:
    """Number of query vectors of the usual length, that length, and the bytes of their ids."""
    kind = queries.schema["qid"].dataType
    width = F.octet_length("qid") if isinstance(kind, (T.StringType, T.BinaryType)) else F.lit(8)
    size = F.size("qv")
    sums = [F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")]
    row = queries.agg(*sums, F.min(size).alias("d"), F.max(size).alias("high")).first()
    if row["d"] != row["high"]:
        row = queries.groupBy(size.alias("d")).agg(*sums).orderBy(F.desc("n"), F.desc("d")).first()
    return int(row["n"]), int(row["d"] or 0), int(row["b"] or 0)


def collect_queries(queries: DataFrame) -> tuple[pa.Array, pa.Array]:
    table = queries.select("qid", "qv").toArrow().combine_chunks()
    return table.column("qid").combine_chunks(), table.column("qv").combine_chunks()


def _met(rows: DataFrame, shared: Broadcast, schema, run) -> DataFrame:
    """Let ``run`` consume each task's batches together with the queries that were sent."""
    return rows.mapInArrow(lambda batches: run(shared.value, batches), schema)


def meet_blocks(
    rows: DataFrame, asked: DataFrame, dim: int, schema, run, block_bytes: int = BLOCK_BYTES, counts=None
) -> DataFrame:
    """Meet rows ``(id, vector)`` and queries ``(qid, qv)`` block by block.

    Both sides are cut into blocks of bounded size. With a ``cell`` on both sides,
    only blocks of the same cell meet, and a cell that holds a third of all rows, or
    is asked by all queries, becomes many groups. Without one, ``counts`` gives the
    number of rows and of queries.
    """
    per_block = max(1, block_bytes // (dim * 8))
    if counts is None:

        def blocks(df: DataFrame, name: str) -> DataFrame:
            return df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(per_block)).cast("long").alias(name))

        # One row per cell that has both rows and queries.
        shape = broadcast_if_small(blocks(rows, "row_blocks").join(blocks(asked, "query_blocks"), "cell"))
        rows, asked = rows.join(shape, "cell"), asked.join(shape, "cell")
        cell, row_blocks, query_blocks = F.col("cell"), F.col("row_blocks"), F.col("query_blocks")
    else:
        cell = F.lit(0)
        row_blocks, query_blocks = (F.lit(max(1, math.ceil(c / per_block))).cast("long") for c in counts)
    first = F.lit(0).cast("long")
    left = rows.select(
        cell.alias("cell"),
        F.pmod(F.xxhash64("id"), row_blocks).alias("rb"),
        F.explode(F.sequence(first, query_blocks - 1)).alias("qb"),
        "id",
        "vector",
    )
    right = asked.select(
        cell.alias("cell"),
        F.explode(F.sequence(first, row_blocks - 1)).alias("rb"),
        F.pmod(F.xxhash64("qid"), query_blocks).alias("qb"),
        "qid",
        "qv",
    )
    empty = to_arrow_schema(schema).empty_table()

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a) or not len(b):
            return empty
        found = list(run((b["qid"].combine_chunks(), kernels.matrix(b["qv"], dim)), a.to_batches()))
        return pa.Table.from_batches(found) if found else empty

    keys = ("cell", "rb", "qb")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, schema)


def group_count(size: int, n: int, k: int, broadcast_bytes: int, block_bytes: int) -> int:
    """Groups in which ``n`` queries of ``size`` bytes are sent, one after another.

    A group and the best ``k`` rows of its queries stay within ``GROUP_BYTES``. Queries above the
    broadcast bound go out in blocks; of very many blocks several make a group, so scans
    grow with what is sent and not with how finely it is cut.
    """
    needed = -(-(size + n * k * BEST_BYTES) // GROUP_BYTES)
    blocks = -(-size // max(1, block_bytes)) if size > broadcast_bytes else 1
    return max(1, min(n, max(needed, min(blocks, FEW_BLOCKS))))


def grouped(asked: DataFrame, n_groups: int) -> DataFrame:
    """Queries written once, in folders of groups ``_block``."""
    return materialize(asked.withColumn("_block", F.pmod(F.xxhash64("qid", "qv"), F.lit(n_groups)).cast("int")), by="_block")


# What was sent of a table of queries, for as long as the frame lives.
_SENT: WeakKeyDictionary[DataFrame, dict[tuple, list[Broadcast]]] = WeakKeyDictionary()


def send(asked: DataFrame, dim: int) -> Broadcast:
    """Queries ``qid, qv`` as ``(ids, vectors)``, sent to all tasks."""
    ids, vectors = collect_queries(asked)
    return asked.sparkSession.sparkContext.broadcast((ids, kernels.matrix(vectors, dim)))


def sent_groups(source: tuple, asked: DataFrame, dim: int, n_groups: int) -> list[Broadcast]:
    """All groups of the queries ``asked``, kept for further searches of the same ``source``, the caller's frame and columns."""
    held, key = _SENT.setdefault(source[0], {}), (*source[1:], dim, n_groups)
    if key not in held:
        kept = grouped(asked.select("qid", "qv"), n_groups)
        held[key] = [send(kept.where(F.col("_block") == g), dim) for g in range(n_groups)]
    return held[key]


def _hits(rows, asked, n: int, dim: int, schema, run, n_groups: int, finish, source: tuple, again=None) -> DataFrame:
    """Hits that ``finish`` was applied to, group by group if there are several; ``again`` to all, if queries of one id may lie in several."""
    if not n:
        return finish(rows.sparkSession.createDataFrame([], schema))
    if n_groups == 1:
        return finish(_met(rows, send(asked, dim), schema, run))
    rows = few_tasks(rows)
    held = _SENT.get(source[0], {}).get((*source[1:], dim, n_groups))
    if held is not None:
        hits = materialize_parts(finish(_met(rows, shared, schema, run)) for shared in held)
        return hits if again is None or _ids_once(asked) else again(hits)
    # One scan for each group of queries, one after another, so the collection never moves, the
    # driver never holds more than a group and a task no more than the best of a group.
    kept = grouped(asked, n_groups)

    def parts():
        for g in range(n_groups):
            shared = send(kept.where(F.col("_block") == g), dim)
            yield finish(_met(rows, shared, schema, run))
            shared.destroy()

    hits = materialize_parts(parts())
    return hits if again is None or _ids_once(kept) else again(hits)


def few_tasks(rows: DataFrame) -> DataFrame:
    """Rows that are scanned again and again, in no more tasks than cores unless they are large: each hands in a list for every query."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, estimated_bytes(rows) // SCAN_BYTES)
    # Far more tell that the size is not known.
    return rows.coalesce(tasks) if tasks < MERGE_ROWS else rows


def _ids_once(asked: DataFrame) -> bool:
    """Whether no two queries have one id."""
    row = asked.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("qid").alias("ids")).first()
    return row["n"] == row["ids"]


def top_k_run(metric: str, k: int, dim: int, id_type: T.DataType, low=-math.inf, high=math.inf, block_bytes: int = BLOCK_BYTES):
    arrow_id = to_arrow_type(id_type)
    per_step = max(1, block_bytes // max(1, dim * 8))

    def run(queries, batches) -> Iterator[pa.RecordBatch]:
        best = kernels.TopK(kernels.Queries(metric, *queries), k, None, low, high, per_step)
        for batch in batches:
            if batch.num_rows:
                best.add(kernels.id_values(batch["id"]), kernels.matrix(batch["vector"], dim))
        table = best.table(arrow_id)
        if table is not None:
            yield from table.to_batches()

    return run


def rank_hits(hits: DataFrame, metric: str, k: int, slices: int = 1) -> DataFrame:
    """The best k of each query, ties to the lower id.

    ``slices`` above 1 takes the best of each slice of a query's hits first, for
    searches in which very many tasks hand in a list for the same query.
    """
    best = [best_first(metric, F.col("score")), F.col("id").asc()]
    if slices > 1:
        cut = hits.withColumn("_slice", F.pmod(F.xxhash64("id"), F.lit(slices)))
        place = F.row_number().over(Window.partitionBy("qid", "_slice").orderBy(*best))
        hits = cut.withColumn("_n", place).where(F.col("_n") <= k).drop("_n", "_slice")
    return (
        hits.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(*best)))
        .where(F.col("rank") <= k)
        .withColumn("rank", F.col("rank").cast("long"))
    )


def _slices(rows: DataFrame, k: int) -> int:
    """Slices for the merge, from the number of tasks that a scan of the rows takes."""
    tasks = estimated_bytes(rows) // SCAN_BYTES
    return 1 if tasks * k < MERGE_ROWS else math.ceil(math.sqrt(tasks))


def limits(radius: float | None, range_filter: float | None) -> tuple[float, float]:
    low = -math.inf if radius is None else float(radius)
    high = math.inf if range_filter is None else float(range_filter)
    if low > high:
        raise ValueError("radius must not exceed range_filter")
    return low, high


def _top_k(rows, asked, k, metric, broadcast_bytes, block_bytes, source, low=-math.inf, high=math.inf) -> tuple[DataFrame, int]:
    """Ranked hits and the number of queries."""
    if k < 1:
        raise ValueError("k must be at least 1")
    n, dim, id_bytes = query_size(asked)
    rows, asked = rows.where(F.size("vector") == dim), asked.where(F.size("qv") == dim)
    schema = hit_schema(rows, asked)
    run = top_k_run(metric, k, dim, schema["id"].dataType, low, high, block_bytes)
    slices = _slices(rows, k)
    best = lambda hits: rank_hits(hits, metric, k, slices)
    n_groups = group_count(n * dim * 8 + id_bytes, n, k, broadcast_bytes, block_bytes)
    again = lambda hits: rank_hits(hits.drop("rank"), metric, k)
    ranked = _hits(rows, asked, n, dim, schema, run, n_groups, best, source, again)
    return ranked.select("qid", "rank", "id", "score", similarity(metric, F.col("score")).alias("similarity")), n


def top_k(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 10,
    metric: str = "COSINE",
    id_col: str = "id",
    vector_col: str = "vector",
    qid_col: str = "qid",
    query_col: str = "qv",
    broadcast_bytes: int = BROADCAST_BYTES,
    block_bytes: int = BLOCK_BYTES,
    decimals: int | None = SCORE_DECIMALS,
) -> DataFrame:
    """Exact best k rows per query as ``(qid, rank, id, score, similarity)``."""
    rows, asked = sides(corpus, queries, id_col, vector_col, qid_col, query_col)
    hits = _top_k(rows, asked, k, check_metric(metric), broadcast_bytes, block_bytes, (queries, qid_col, query_col))[0]
    return given_out(hits, metric, decimals)


def range_search(
    corpus: DataFrame,
    queries: DataFrame,
    radius: float | None = None,
    range_filter: float | None = None,
    metric: str = "COSINE",
    id_col: str = "id",
    vector_col: str = "vector",
    qid_col: str = "qid",
    query_col: str = "qv",
    broadcast_bytes: int = BROADCAST_BYTES,
    block_bytes: int = BLOCK_BYTES,
    decimals: int | None = SCORE_DECIMALS,
) -> DataFrame:
    """All rows whose similarity lies between ``radius`` and ``range_filter``, both included."""
    metric = check_metric(metric)
    low, high = limits(radius, range_filter)
    rows, asked = sides(corpus, queries, id_col, vector_col, qid_col, query_col)
    n, dim, id_bytes = query_size(asked)
    rows, asked = rows.where(F.size("vector") == dim), asked.where(F.size("qv") == dim)
    schema = hit_schema(rows, asked)

    arrow_id = to_arrow_type(schema["id"].dataType)
    per_step = max(1, block_bytes // max(1, dim * 8))

    def run(data, batches):
        prepared = kernels.Queries(metric, *data)
        for batch in batches:
            if batch.num_rows:
                ids = kernels.id_values(batch["id"])
                block = kernels.matrix(batch["vector"], dim)
                for found in kernels.in_range(prepared, ids, block, low, high, None, arrow_id, per_step=per_step):
                    yield from found.to_batches()

    source = (queries, qid_col, query_col)
    n_groups = group_count(n * dim * 8 + id_bytes, n, 0, broadcast_bytes, block_bytes)
    hits = _hits(rows, asked, n, dim, schema, run, n_groups, lambda hits: hits, source)
    hits = hits.select("qid", "id", "score", similarity(metric, F.col("score")).alias("similarity"))
    return given_out(hits, metric, decimals)


def cut_similarity(hits: DataFrame, min_similarity: float | None) -> DataFrame:
    """Drop hits below a similarity; applied after the top k, so fewer than k may remain."""
    if min_similarity is None:
        return hits
    least = float(min_similarity)
    return hits.where(F.col("similarity") >= least - kernels.SLACK * abs(least))


def given_out(hits: DataFrame, metric: str, decimals: int | None) -> DataFrame:
    """Ranked and cut hits with their scores rounded, and similarities of the rounded scores."""
    if decimals is None:
        return hits
    hits = hits.withColumn("score", F.round("score", decimals))
    return hits.withColumn("similarity", similarity(metric, F.col("score")))


def attach_fields(
    hits: DataFrame,
    corpus: DataFrame,
    fields: Sequence[str] | str | None,
    id_col: str = "id",
    max_hits: int | None = None,
) -> DataFrame:
    """Join entity fields to hits; vectors and payload stay out of the search itself.

    With a known, small number of hits they are broadcast and the collection is
    scanned in place. Otherwise the fields of the rows that were hit are fetched
    once each, and a row that most queries hit is spread over many tasks.
    """
    names = fields_list(fields, [c for c in corpus.columns if c != id_col])
    if not names:
        return hits
    entity = corpus.select(F.col(id_col).alias("id"), *[F.col(n) for n in names])
    payload = entity.columns[1:]
    # Only keys of fixed width tell the size of the hits before they are found.
    fixed = not any(isinstance(hits.schema[c].dataType, (T.StringType, T.BinaryType)) for c in ("qid", "id"))
    if max_hits is not None and fixed and max_hits * HIT_BYTES <= BROADCAST_BYTES:
        joined = entity.join(F.broadcast(hits), "id")
    else:
        fetched = entity.join(hits.select("id").distinct(), "id", "left_semi")
        joined = spread_join(hits, fetched, ["id"], "qid", small=False)
    return joined.select(*hits.columns, *payload)


def search(
    corpus: DataFrame,
    queries: DataFrame,
    limit: int = 10,
    metric: str = "COSINE",
    filter: str | None = None,
    partition_names: str | Sequence[str] | None = None,
    output_fields: Sequence[str] | str | None = None,
    min_similarity: float | None = None,
    radius: float | None = None,
    range_filter: float | None = None,
    id_col: str = "id",
    anns_field: str = "vector",
    qid_col: str = "qid",
    query_col: str = "qv",
    broadcast_bytes: int = BROADCAST_BYTES,
    block_bytes: int = BLOCK_BYTES,
    decimals: int | None = SCORE_DECIMALS,
) -> DataFrame:
    """Vector search: filter, then best k (within a range if one is given), then the similarity cut.

    Scores are rounded to ``decimals`` only when they are given out; None leaves them unrounded.
    """
    from vectide.sources.collections import in_partitions

    rows = in_partitions(corpus, partition_names)
    if filter:
        rows = rows.where(predicate(filter))
    low, high = limits(radius, range_filter)
    searched, asked = sides(rows, queries, id_col, anns_field, qid_col, query_col)
    source = (queries, qid_col, query_col)
    hits, n = _top_k(searched, asked, limit, check_metric(metric), broadcast_bytes, block_bytes, source, low, high)
    kept = given_out(cut_similarity(hits, min_similarity), metric, decimals)
    return attach_fields(kept, rows, output_fields, id_col, n * limit)
