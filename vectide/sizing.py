"""Size checks that decide between broadcasting a side and shuffling it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
BLOCK_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 32
HIT_BYTES = 96


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int


def row_bytes(df: DataFrame) -> Column:
    """Estimated width of a row: exact for strings and arrays of fixed-width values."""
    width = F.lit(ROW_OVERHEAD)
    for field in df.schema.fields:
        name = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            part = F.octet_length(name)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
            part = F.size(name) * 8
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            part = F.octet_length(F.to_json(F.struct(name)))
        else:
            part = F.lit(8)
        width = width + F.coalesce(part.cast("long"), F.lit(8).cast("long"))
    return width


def measure(df: DataFrame) -> Size:
    """Rows and estimated bytes of a frame, from one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("b")).first()
    return Size(int(row["n"]), int(row["b"] or 0))


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return measure(df).bytes <= max_bytes


def broadcast_if_small(df: DataFrame, measured: DataFrame | None = None, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only where the measured size allows it.

    ``measured`` is a frame that is at least as large and cheaper to count, such as
    the input of a ``distinct``.
    """
    return F.broadcast(df) if fits(df if measured is None else measured, max_bytes) else df


# A table of at least this many bytes per core is read in enough splits to use all cores.
SPLIT_BYTES = 16 * 1024 * 1024


def deal_out(df: DataFrame) -> DataFrame:
    """Spread the rows of a small input over all cores before costly work on each row.

    A small file is one split and would keep one core busy. The size is the
    optimizer's estimate; an input large enough to be read in many splits is left
    where it is, so nothing large is ever shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if estimated_bytes(df) < cores * SPLIT_BYTES else df


SALTS = 64


def numbers(n: int) -> Column:
    """One row per number from 0 to n-1."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread: str,
    small: bool | None = None,
    salts: int = SALTS,
    how: str = "inner",
) -> DataFrame:
    """Inner or left join that survives a key held by a large share of ``left``.

    A small right side is broadcast: ``small`` if the caller knows, otherwise it is
    measured. Beyond the bound the rows of each key are cut into slices by
    ``spread``, and the right side is repeated per slice.
    """
    if fits(right) if small is None else small:
        return left.join(F.broadcast(right), on, how)
    sliced = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    repeated = right.select("*", numbers(salts).alias("_salt"))
    return sliced.join(repeated, [*on, "_salt"], how).drop("_salt")
