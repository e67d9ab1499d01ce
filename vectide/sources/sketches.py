"""Profiles that are updated instead of recomputed: sketches of each batch, merged on demand.

A batch leaves one row behind: exact counts, for each field a sketch of its distinct
values (HLL) and for numbers a sketch of their quantiles (KLL). Rows of any number of
batches merge into one, with the same error as a sketch of all rows at once:

* distinct values: a relative standard error of ``DISTINCT_ERROR``;
* quantiles: ranks within ``RANK_ERROR`` of the number of values.

A batch that is written again replaces its own row, so a replay changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The HLL sketches have 2 ** HLL_BITS registers, the KLL sketches the accuracy KLL_K.
HLL_BITS, KLL_K = 12, 200
DISTINCT_ERROR = 1.04 / 2 ** (HLL_BITS / 2)
RANK_ERROR = 0.0133
_SHAPE = "field string, position int, rows long, nulls long, distinct binary, numbers binary"


def _hashable(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)):
        return value
    return value.cast("string") if isinstance(field.dataType, T.AtomicType) else F.to_json(F.struct(value))


def sketch(df: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """``field, position, rows, nulls, distinct, numbers`` of a batch, in one pass.

    NaN and infinite numbers count as values but not in the quantiles. A field without a
    value has no sketch (null).
    """
    chosen = [f for f in df.schema.fields if fields is None or f.name in fields]
    measures = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(chosen):
        value = F.col(f"`{f.name}`")
        measures += [F.count_if(value.isNull()).alias(f"n{i}"), F.hll_sketch_agg(_hashable(f), F.lit(HLL_BITS)).alias(f"d{i}")]
        if isinstance(f.dataType, T.NumericType):
            number = value.cast("double")
            finite = F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
            measures.append(F.kll_sketch_agg_double(finite, F.lit(KLL_K)).alias(f"q{i}"))
        else:
            measures.append(F.lit(None).cast("binary").alias(f"q{i}"))
    wide = df.agg(*measures)
    lines = [
        F.struct(
            F.lit(f.name).alias("field"),
            F.lit(i).alias("position"),
            F.col("rows").alias("rows"),
            F.col(f"n{i}").alias("nulls"),
            F.when(F.col(f"n{i}") < F.col("rows"), F.col(f"d{i}")).alias("distinct"),
            F.when(F.col(f"n{i}") < F.col("rows"), F.col(f"q{i}")).alias("numbers"),
        )
        for i, f in enumerate(chosen)
    ]
    return wide.select(F.inline(F.array(*lines)))


def merge(sketches: DataFrame) -> DataFrame:
    """One row for each field from those of many batches, in the same form."""
    return sketches.groupBy("field").agg(
        F.min("position").alias("position"),
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("numbers", F.lit(KLL_K)).alias("numbers"),
    )


def report(merged: DataFrame, quantiles: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """``field, rows, nulls, distinct_values, quantiles``: what sketches say; quantiles of fields that are no numbers are null."""
    ranks = F.array(*[F.lit(float(q)) for q in quantiles])
    some = F.kll_sketch_get_n_double("numbers") > 0
    return merged.select(
        "field",
        "position",
        "rows",
        "nulls",
        F.when(F.col("nulls") < F.col("rows"), F.hll_sketch_estimate("distinct")).otherwise(F.lit(0)).alias("distinct_values"),
        F.when(F.col("numbers").isNotNull() & some, F.kll_sketch_get_quantile_double("numbers", ranks)).alias("quantiles"),
    )


def keep(df: DataFrame, path: str, batch: str, fields: Sequence[str] | None = None) -> None:
    """Write the sketches of a batch to its own folder."""
    sketch(df, fields).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def profile(spark: SparkSession, path: str, quantiles: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """The profile of all batches kept so far; reads sketches only."""
    held = spark.read.schema(_SHAPE).option("recursiveFileLookup", "true").parquet(path)
    return report(merge(held), quantiles)
