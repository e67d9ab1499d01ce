"""A collection kept in order, with counts: a page is a seek.

The rows lie in slices of ``SLICE_ROWS`` rows or so that follow each other in the
order of the key (and of further fields, so that rows of one key have an order too). Each
row knows its place in its slice, and a small table says how many rows stand before each
slice. Slices lie in folders, small ones many together, so folders grow with the rows and not
with how finely they are sliced. A page reads the one or two slices that hold it, and nothing is written. With a
filter one pass counts the matching rows of each slice, reading only the fields that the
filter names; these counts serve every further page of the same filter.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectide.functions.predicates import fields_list, predicate

SLICE_ROWS = 100_000
# Folders of a collection that has as many slices, and rows of a folder of a larger one.
FEW_PARTS, PART_ROWS = 64, 100_000
_SLICE, _PLACE, _PART = "_slice", "_place", "_part"


@dataclass(frozen=True)
class Ordered:
    """``rows`` with their slice and place, ``slices(_slice, n, before)`` and the fields that order them.

    Slices ``p * stride`` to ``(p + 1) * stride - 1`` lie in folder ``p``.
    """

    rows: DataFrame
    slices: DataFrame
    order: list[str]
    stride: int = 1

    @property
    def fields(self) -> list[str]:
        return [c for c in self.rows.columns if c not in (_SLICE, _PLACE, _PART)]

    def of_slices(self, numbers: Sequence[int]) -> DataFrame:
        """The rows of some slices; only their folders are looked into."""
        parts = sorted({n // self.stride for n in numbers})
        return self.rows.where(F.col(_PART).isin(parts) & F.col(_SLICE).isin(list(numbers)))


def store(df: DataFrame, path: str, order_by: str | Sequence[str], slice_rows: int = SLICE_ROWS) -> None:
    """Write ``df`` in the order of ``order_by``. Rows that agree in all these fields follow in any order.

    One range shuffle; a key that holds a large share of the rows is spread over many
    slices as far as the further fields tell its rows apart.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    clash = {_SLICE, _PLACE, _PART} & set(df.columns)
    if clash:
        raise ValueError(f"reserved field names: {', '.join(sorted(clash))}")
    n_rows = df.count()
    n_slices = max(1, math.ceil(n_rows / slice_rows))
    n_parts = min(n_slices, max(FEW_PARTS, math.ceil(n_rows / PART_ROWS)))
    # Folders are cut by a sample of the keys: room for twice the slices, and the last one takes what is over.
    stride = 1 if n_parts == n_slices else 2 * math.ceil(n_slices / n_parts)
    keys = [F.col(f"`{c}`") for c in order]
    at = F.monotonically_increasing_id()
    # The upper bits number the folder, the lower 33 the row in it.
    placed = df.repartitionByRange(n_parts, *keys).sortWithinPartitions(*keys).withColumn("_at", at)
    row = F.col("_at").bitwiseAND((1 << 33) - 1)
    inner = F.least(F.floor(row / slice_rows), F.lit(stride - 1)).cast("long")
    placed = placed.withColumns({
        _PART: F.shiftrightunsigned("_at", 33).cast("long"),
        _SLICE: F.shiftrightunsigned("_at", 33) * stride + inner,
        _PLACE: row - inner * slice_rows,
    })
    placed.drop("_at").write.partitionBy(_PART).parquet(f"{path}/rows")
    spark, schema = df.sparkSession, placed.drop("_at").schema
    counts = spark.read.schema(schema).parquet(f"{path}/rows").groupBy(_SLICE).agg(F.count(F.lit(1)).alias("n"))
    _cumulated(counts).coalesce(1).write.parquet(f"{path}/slices")
    spark.createDataFrame([(order, schema.json(), stride)], "order array<string>, schema string, stride int").coalesce(1).write.parquet(f"{path}/about")


def _cumulated(counts: DataFrame) -> DataFrame:
    """Counts of slices with the rows before each; one row for each slice."""
    before = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(_SLICE, "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def load(spark: SparkSession, path: str) -> Ordered:
    about = spark.read.parquet(f"{path}/about").first()
    rows = spark.read.schema(T.StructType.fromJson(json.loads(about["schema"]))).parquet(f"{path}/rows")
    return Ordered(rows, spark.read.parquet(f"{path}/slices"), list(about["order"]), about["stride"])


def matching(collection: Ordered, filter: str | Column) -> DataFrame:
    """Counts of the rows that match, slice by slice, for any number of pages."""
    hit = collection.rows.where(predicate(filter))
    return _cumulated(hit.groupBy(_SLICE).agg(F.count(F.lit(1)).alias("n")))


def page(
    collection: Ordered,
    limit: int = 100,
    offset: int = 0,
    filter: str | Column | None = None,
    output_fields="*",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Rows ``offset + 1`` to ``offset + limit`` in the collection's order; fewer where it ends.

    ``counts`` are those of ``matching`` for the same filter, if they are at hand.
    """
    if limit < 1 or offset < 0:
        raise ValueError("limit must be positive and offset must not be negative")
    chosen = not (filter is None or (isinstance(filter, str) and not filter.strip()))
    if counts is None:
        counts = matching(collection, filter) if chosen else collection.slices
    # As many rows as the page spans slices.
    near = counts.where((F.col("before") < offset + limit) & (F.col("before") + F.col("n") > offset)).orderBy(_SLICE).collect()
    names = fields_list(output_fields, collection.fields)
    names = [c for c in collection.order if c not in names] + names
    wanted = [F.col(f"`{c}`") for c in names]
    if not near:
        return collection.rows.where(F.lit(False)).select(*wanted)
    rows = collection.of_slices([r[_SLICE] for r in near])
    order = [F.col(_SLICE), F.col(_PLACE)]
    if chosen:
        start = offset - near[0]["before"]
        return rows.where(predicate(filter)).orderBy(*order).offset(start).limit(limit).select(*wanted)

    def inside(r) -> Column:
        low, high = max(0, offset - r["before"]), offset + limit - r["before"]
        return (F.col(_SLICE) == r[_SLICE]) & (F.col(_PLACE) >= low) & (F.col(_PLACE) < high)

    return rows.where(reduce(Column.__or__, map(inside, near))).orderBy(*order).limit(limit).select(*wanted)


def place_of(collection: Ordered, keys: DataFrame) -> DataFrame:
    """``place``, counted from 0, of the rows that agree with ``keys`` in the fields it holds: the offset of their page."""
    on = keys.columns
    found = collection.rows.join(keys.distinct(), on, "left_semi")
    # One row for each slice.
    before = F.broadcast(collection.slices.select(_SLICE, F.col("before").alias("_before")))
    return found.join(before, _SLICE).select(*on, (F.col("_before") + F.col(_PLACE)).alias("place"))
