"""Files that answer filters on several fields: rows along a Z curve, with Bloom filters for equality.

Each field's values are ranked into ``2 ** BITS`` steps of equal frequency; the bits of the
ranks are interleaved and rows are written in the order of the result. Rows that are near
each other in all fields lie together, so the smallest and largest values that Parquet keeps
for each row group exclude most row groups for a range in any of the fields, not only in the
first one as with a plain sort. Bloom filters exclude row groups for an equality, where
ranges say nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 8
#: Error of the ranks' boundaries, as a share of the rows.
ACCURACY = 10_000
ROW_GROUP_BYTES = 32 * 1024 * 1024


def boundaries(df: DataFrame, fields: Sequence[str], bits: int = BITS) -> dict[str, list[float]]:
    """The values that cut each numeric or date field into steps of about equal frequency; nulls and NaN are left aside."""
    shares = [i / 2**bits for i in range(1, 2**bits)]
    number = {f: _number(df, f) for f in fields}
    cut = [F.percentile_approx(F.when(~F.isnan(c), c), shares, ACCURACY).alias(f"_{i}") for i, c in enumerate(number.values())]
    row = df.agg(*cut).first()
    return {f: sorted(set(row[i] or [])) for i, f in enumerate(fields)}


def _number(df: DataFrame, field: str) -> Column:
    """The field as a number that keeps its order."""
    kind, value = df.schema[field].dataType, F.col(f"`{field}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return value.cast("timestamp").cast("double")
    if not isinstance(kind, T.NumericType):
        raise ValueError(f"{field} is neither a number nor a time")
    return value.cast("double")


def ranked(df: DataFrame, field: str, cuts: Sequence[float], name: str) -> DataFrame:
    """``df`` with the step a value lies in; nulls and NaN lie in the first one."""
    if not cuts:
        return df.withColumn(name, F.lit(0))
    splits = [-float("inf"), *cuts, float("inf")]
    put = Bucketizer(splits=splits, inputCol=f"{name}v", outputCol=f"{name}b", handleInvalid="keep")
    value = _number(df, field)
    held = put.transform(df.withColumn(f"{name}v", F.when(~F.isnan(value), value)))
    step = F.when(F.col(f"{name}v").isNull(), F.lit(0)).otherwise(F.col(f"{name}b").cast("int"))
    return held.withColumn(name, step).drop(f"{name}v", f"{name}b")


def z_value(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of all ranks, the highest of each first."""
    parts = []
    for b in range(bits):
        for k, r in enumerate(ranks):
            at = b * len(ranks) + (len(ranks) - 1 - k)
            parts.append(F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1)).cast("long"), at))
    return reduce(Column.bitwiseOR, parts)


def write(
    df: DataFrame,
    path: str,
    fields: Sequence[str],
    equality: Sequence[str] = (),
    bits: int = BITS,
    row_group_bytes: int = ROW_GROUP_BYTES,
    n_files: int | None = None,
) -> None:
    """Write ``df`` along the Z curve of ``fields``, with Bloom filters on the fields ``equality``.

    Values that a third of all rows share fill steps of their own; their rows are told
    apart by the other fields and, last, by a hash, so no task gets them all.
    """
    if not 1 <= len(fields) <= 63 // bits:
        raise ValueError(f"1 to {63 // bits} fields are expected")
    keyed = df
    for k, (f, cuts) in enumerate(boundaries(df, fields, bits).items()):
        keyed = ranked(keyed, f, cuts, f"_z{k}")
    names = [f"_z{k}" for k in range(len(fields))]
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    keyed = keyed.withColumn("_z", z_value([F.col(n) for n in names], bits)).withColumn("_tie", F.xxhash64(*hashed)).drop(*names)
    args = ([n_files] if n_files else []) + [F.col("_z"), F.col("_tie")]
    ordered = keyed.repartitionByRange(*args).sortWithinPartitions("_z").drop("_z", "_tie")
    writer = ordered.write.option("parquet.block.size", str(row_group_bytes))
    for f in equality:
        writer = writer.option(f"parquet.bloom.filter.enabled#{f}", "true")
    writer.parquet(path)
