"""Collections: typed tables with a key, a fixed-length vector and scalar fields."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectide.functions.vectors import check_metric, norm
from vectide.session import materialize

MAX_DIMENSION = 32768
MAX_TEXT = 65535
PARTITION_COLUMN = "partition_name"
DYNAMIC_COLUMN = "_dynamic"

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]{0,254}\Z")


def check_name(name: str) -> str:
    if not name or not _NAME.match(name):
        raise ValueError(f"invalid collection name: {name!r}")
    return name


def check_dimension(dimension) -> int:
    if dimension is None or dimension == "":
        raise ValueError("dimension is required")
    try:
        value = int(dimension)
    except (TypeError, ValueError):
        raise ValueError("dimension must be a valid integer") from None
    if not 1 <= value <= MAX_DIMENSION:
        raise ValueError(f"dimension must be between 1 and {MAX_DIMENSION}")
    return value


@dataclass(frozen=True)
class CollectionSpec:
    """Declared shape of a collection.

    ``fields`` are extra scalar fields; ``max_length`` bounds string fields, in characters.
    """

    name: str
    dimension: int
    metric: str = "COSINE"
    key: str = "id"
    key_type: T.DataType = field(default_factory=T.LongType)
    vector: str = "vector"
    auto_id: bool = True
    enable_bm25: bool = False
    text: str = "text"
    fields: tuple[tuple[str, T.DataType], ...] = ()
    max_length: Mapping[str, int] = field(default_factory=dict)
    dynamic: bool = False
    description: str = ""

    def __post_init__(self):
        check_name(self.name)
        object.__setattr__(self, "dimension", check_dimension(self.dimension))
        object.__setattr__(self, "metric", check_metric(self.metric))
        if not isinstance(self.key_type, (T.LongType, T.StringType)):
            raise ValueError("the key must be a long or a string")

    @property
    def schema(self) -> T.StructType:
        out = [T.StructField(self.key, self.key_type, False)]
        out.append(T.StructField(self.vector, T.ArrayType(T.FloatType(), False), False))
        if self.enable_bm25:
            out.append(T.StructField(self.text, T.StringType()))
        out += [T.StructField(n, t) for n, t in self.fields]
        if self.dynamic:
            out.append(T.StructField(DYNAMIC_COLUMN, T.MapType(T.StringType(), T.StringType())))
        return T.StructType(out)

    def limits(self) -> dict[str, int]:
        limits = dict(self.max_length)
        if self.enable_bm25:
            limits.setdefault(self.text, MAX_TEXT)
        return limits


def empty(spark: SparkSession, spec: CollectionSpec) -> DataFrame:
    return spark.createDataFrame([], spec.schema)


def _cast(name: str, kind: T.DataType) -> Column:
    value = F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        return value.cast("string")
    return value.try_cast(kind)


def conform(df: DataFrame, spec: CollectionSpec) -> DataFrame:
    """Rows cast to the collection's schema, each with a ``reject_reason`` (NULL when accepted).

    NaN and infinite elements have no place in a ranking, so vectors holding one are refused here.
    """
    given = set(df.columns)
    missing = [f.name for f in spec.schema if f.name not in given and f.name != DYNAMIC_COLUMN]
    missing = [m for m in missing if m in (spec.key, spec.vector)]
    if missing:
        raise ValueError(f"missing fields: {', '.join(missing)}")
    typed = []
    for f in spec.schema:
        if f.name == spec.vector:
            continue
        if f.name == DYNAMIC_COLUMN:
            extra = sorted(given - {x.name for x in spec.schema})
            pairs = [x for n in extra for x in (F.lit(n), F.col(f"`{n}`").cast("string"))]
            value = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
            typed.append(F.map_filter(value, lambda _, v: v.isNotNull()).alias(f.name))
        elif f.name in given:
            typed.append(_cast(f.name, f.dataType).alias(f.name))
        else:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
    vector = F.col(f"`{spec.vector}`").cast("array<float>")
    rows = df.select(*typed, vector.alias(spec.vector))

    v, key = F.col(f"`{spec.vector}`"), F.col(f"`{spec.key}`")
    reason = F.when(key.isNull(), "missing key").when(v.isNull(), "missing vector")
    reason = reason.when(F.size(v) != spec.dimension, "wrong dimension")
    flawed = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    reason = reason.when(flawed, "invalid vector element")
    for name, most in spec.limits().items():
        reason = reason.when(F.char_length(F.col(f"`{name}`")) > most, f"{name} too long")
    return rows.select(*[F.col(f"`{f.name}`") for f in spec.schema], reason.alias("reject_reason"))


def accepted(conformed: DataFrame) -> DataFrame:
    return conformed.where("reject_reason is null").drop("reject_reason")


def rejected(conformed: DataFrame) -> DataFrame:
    return conformed.where("reject_reason is not null")


def rows_from_json(df: DataFrame, json_col: str, spec: CollectionSpec) -> DataFrame:
    """Rows of JSON arrays of objects, one array per input row. Text that is no array gives no rows."""
    item = T.StructType([T.StructField(f.name, f.dataType) for f in spec.schema])
    parsed = F.when(_is_array(json_col), F.from_json(F.col(json_col), T.ArrayType(item)))
    return df.select(F.explode_outer(parsed).alias("r")).where("r is not null").select("r.*")


def _is_array(json_col: str) -> Column:
    return F.json_array_length(F.col(json_col)).isNotNull()


def conform_json(df: DataFrame, json_col: str, spec: CollectionSpec) -> DataFrame:
    """Like ``conform``, for JSON arrays of objects; text that is no array is one row with its reason."""
    good = conform(rows_from_json(df, json_col, spec), spec)
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in good.schema if f.name != "reject_reason"]
    bad = df.where(~_is_array(json_col)).select(*nothing, F.lit("not a JSON array").alias("reject_reason"))
    return good.unionByName(bad)


def insert_json(spark: SparkSession, data: str, spec: CollectionSpec) -> DataFrame:
    """One JSON array given as a parameter; an empty or invalid one is an error."""
    import json

    try:
        rows = json.loads(data) if isinstance(data, str) else data
    except json.JSONDecodeError:
        raise ValueError("data must be a valid JSON array") from None
    if not isinstance(rows, list) or not rows:
        raise ValueError("data is required and must not be empty")
    text = spark.createDataFrame([(json.dumps(r),) for r in rows], "r string")
    item = T.StructType([T.StructField(f.name, f.dataType) for f in spec.schema])
    return text.select(F.from_json("r", item).alias("r")).select("r.*")


def assign_ids(df: DataFrame, order_by: Sequence[str], start: int = 0, id_col: str = "id") -> DataFrame:
    """Dense INT64 keys in the order of ``order_by``, which must be unique.

    One range shuffle sorts the rows; the sorted copy is written once, so the
    counts per slice and the positions within slices belong together even when
    a task is run again. No task sees more than its own slice.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in order_by]).sortWithinPartitions(*order_by)
    placed = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()))
    # The upper bits of _at number the slice, the lower 33 the row in it.
    slice_no = F.shiftrightunsigned("_at", 33)
    counts = placed.groupBy(slice_no.alias("_slice")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # One row per slice: bounded by the number of shuffle partitions.
    return (
        placed.withColumn("_slice", slice_no)
        .join(F.broadcast(offsets), "_slice")
        .withColumn(
            id_col, F.col("_offset") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.lit(start + 1)
        )
        .drop("_slice", "_offset", "_at")
    )


def insert(
    rows: DataFrame,
    spec: CollectionSpec,
    path: str,
    partition_name: str | None = None,
    order_by: Sequence[str] | None = None,
) -> tuple[int, DataFrame]:
    """Conform a batch and append the accepted rows; returns their number and a frame of their keys.

    Rows are appended to the collection as ``load`` reads it: to its last saved state, if there is one.

    With ``auto_id`` the rows need no key: they are numbered in the order of
    ``order_by`` (a unique field), behind the highest key that the collection holds.
    """
    spark = rows.sparkSession
    path = current_path(spark, path)
    if spec.auto_id and spec.key not in rows.columns:
        if not order_by:
            raise ValueError("numbering rows needs order_by, a unique field of the batch")
        last = 0
        if _exists(spark, path):
            last = spark.read.parquet(path).agg(F.max(spec.key)).first()[0] or 0
        rows = assign_ids(rows, order_by, last, spec.key)
    # Written once: the count, the keys and the appended rows are the same ones.
    good = materialize(accepted(conform(rows, spec)))
    count = good.count()
    if not count:
        raise ValueError("data is required: the batch holds no acceptable row")
    if partition_name is None:
        good.write.mode("append").parquet(path)
    else:
        write_partitioned(good.withColumn(PARTITION_COLUMN, F.lit(partition_name)), path)
    return count, good.select(spec.key)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def write_partitioned(df: DataFrame, path: str, by: str | Sequence[str] = PARTITION_COLUMN, mode="append"):
    """Write a collection split into named partitions."""
    names = [by] if isinstance(by, str) else list(by)
    df.write.mode(mode).partitionBy(*names).parquet(path)


def names_list(names: str | Sequence[str] | None) -> list[str]:
    if names is None:
        return []
    parts = names.split(",") if isinstance(names, str) else names
    return [p.strip() for p in parts if p.strip()]


def in_partitions(df: DataFrame, names: str | Sequence[str] | None, column: str = PARTITION_COLUMN) -> DataFrame:
    """Restrict a scan to named partitions; nothing given means all of them."""
    wanted = names_list(names)
    return df.where(F.col(column).isin(wanted)) if wanted else df


def _versions(spark: SparkSession, root: str) -> list[int]:
    if not _exists(spark, root):
        return []
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("version=") and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found.append(int(name.split("=")[1]))
    return sorted(found)


def save(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> int:
    """Write the new state of a collection beside the old one.

    A state counts only once its success marker exists, so a job lost halfway
    leaves the collection as it was, and a plan may read the state it replaces.
    """
    version = (_versions(df.sparkSession, root) or [0])[-1] + 1
    writer = df.write.mode("overwrite")
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    writer.parquet(f"{root}/version={version}")
    return version


def current_path(spark: SparkSession, root: str) -> str:
    """Where a collection's rows are: its last saved state, or the folder itself if it only grew by inserts."""
    versions = _versions(spark, root)
    return f"{root}/version={versions[-1]}" if versions else root


def load(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of a collection, whether they were inserted, saved, or both; an earlier saved state by its number."""
    if version is not None and version not in _versions(spark, root):
        raise ValueError(f"no version {version} at {root}")
    path = current_path(spark, root) if version is None else f"{root}/version={version}"
    if not _exists(spark, path):
        raise ValueError(f"no collection at {root}")
    return spark.read.parquet(path)


def storage(df: DataFrame) -> DataFrame:
    """``files, bytes, row_count`` of a collection that is read from files; only their names and sizes are read."""
    held = df.select("_metadata.file_path", "_metadata.file_size")
    each = held.groupBy("file_path").agg(F.max("file_size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    return each.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
    )


def describe(df: DataFrame) -> DataFrame:
    """Fields of a collection with their counts: ``(position, field, type, row_count, null_count)``, in one pass."""
    fields = list(enumerate(df.schema.fields))
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"_n{i}") for i, f in fields]
    )
    lines = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("field"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("_rows").alias("row_count"),
            F.col(f"_n{i}").alias("null_count"),
        )
        for i, f in fields
    ]
    return counts.select(F.inline(F.array(*lines)))


def profile(df: DataFrame, vector_col: str | None = None, approximate: bool = True) -> DataFrame:
    """One row of statistics from one pass: counts, nulls, text lengths, vector shape and norms."""
    base = df
    if vector_col:
        base = df.withColumn("_norm", norm(F.col(vector_col)))
    out = [F.count(F.lit(1)).alias("row_count")]
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        out.append(F.count_if(c.isNull()).alias(f"{f.name}_nulls"))
        if isinstance(f.dataType, T.StringType):
            out.append(F.min(F.char_length(c)).cast("long").alias(f"{f.name}_min_length"))
            out.append(F.max(F.char_length(c)).cast("long").alias(f"{f.name}_max_length"))
        if approximate and not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            out.append(F.approx_count_distinct(c).alias(f"{f.name}_distinct"))
    if vector_col:
        size, length = F.size(vector_col), F.col("_norm")
        out += [
            F.min(size).cast("long").alias("dim_min"),
            F.max(size).cast("long").alias("dim_max"),
            F.round(F.min(length), 6).alias("norm_min"),
            F.round(F.avg(length), 6).alias("norm_avg"),
            F.round(F.max(length), 6).alias("norm_max"),
            F.count_if(length == 0).alias("zero_vectors"),
        ]
    return base.agg(*out)


def inventory(collections: Mapping[str, DataFrame]) -> DataFrame:
    """``(collection, row_count, n_fields, vector_dim)`` of several collections, in one job."""

    def line(name: str, df: DataFrame) -> DataFrame:
        vectors = [
            f.name
            for f in df.schema.fields
            if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.FractionalType)
        ]
        dim = F.max(F.size(vectors[0])).cast("long") if vectors else F.lit(None).cast("long")
        return df.agg(F.count(F.lit(1)).alias("row_count"), dim.alias("vector_dim")).select(
            F.lit(name).alias("collection"),
            "row_count",
            F.lit(len(df.columns)).cast("long").alias("n_fields"),
            "vector_dim",
        )

    return reduce(DataFrame.unionByName, [line(n, d) for n, d in sorted(collections.items())])
