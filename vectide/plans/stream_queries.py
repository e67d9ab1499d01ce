"""Streaming ingest of the embeddings."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectide.plans.registry import REGISTRY, table
from vectide.session import work_dir
from vectide.sources.collections import CollectionSpec
from vectide.streaming import ingest

# Keyed by label: each label keeps the vector that came last.
BY_LABEL = CollectionSpec("by_label", 64, fields=(("vec_id", T.LongType()),), auto_id=False)


@REGISTRY.add(
    "stream_ingest",
    """select label::bigint as id, max(vec_id) as vec_id, 64 as dim, round(arg_max(embedding[1], vec_id)::double, 6) as first
from embeddings group by label""",
)
def stream_ingest(spark, sf):
    base = f"{work_dir(spark)}/stream-{uuid.uuid4().hex}"
    schema = table(spark, sf, "embeddings").schema
    files = ingest.file_stream(spark, schema, ingest.table_path(f"{sf}/embeddings.parquet"))
    rows = files.select(F.col("label").alias("id"), F.col("embedding").alias("vector"), "vec_id")
    ingest.ingest(rows, BY_LABEL, f"{base}/table", f"{base}/checkpoint", "vec_id").awaitTermination()
    state = ingest.current(spark, BY_LABEL, f"{base}/table", "vec_id")
    first = F.round(F.get("vector", F.lit(0)).cast("double"), 6)
    return state.select("id", "vec_id", F.size("vector").alias("dim"), first.alias("first"))


@REGISTRY.add(
    "stream_state",
    """select label::bigint as id, max(vec_id) as vec_id, 64 as dim, round(arg_max(embedding[1], vec_id)::double, 6) as first
from embeddings group by label""",
)
def stream_state(spark, sf):
    """Four micro-batches, the newest rows first and some of them twice; the state is what is read."""
    base = f"{work_dir(spark)}/stream-{uuid.uuid4().hex}"
    given = table(spark, sf, "embeddings")
    rows = given.select(F.col("label").alias("id"), F.col("embedding").alias("vector"), "vec_id")
    for part in (2, 0, 1, 2):
        rows.where(F.col("vec_id") % 3 == part).coalesce(1).write.mode("append").parquet(f"{base}/in")
    files = ingest.file_stream(spark, rows.schema, f"{base}/in", maxFilesPerTrigger="1")
    ingest.ingest_state(files, BY_LABEL, f"{base}/table", f"{base}/checkpoint", "vec_id").awaitTermination()
    state = ingest.state(spark, BY_LABEL, f"{base}/checkpoint")
    first = F.round(F.get("vector", F.lit(0)).cast("double"), 6)
    return state.select("id", "vec_id", F.size("vector").alias("dim"), first.alias("first"))
