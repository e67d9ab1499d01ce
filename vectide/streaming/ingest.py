"""Streaming ingest into a keyed collection.

Two ways to keep the last version of each key:

* ``ingest`` writes every micro-batch, conformed, into its own folder, named by the stream and
  the batch number. A batch that runs again overwrites its own folder, so nothing is
  written twice. Readers resolve the last version of each key.
* ``ingest_state`` keeps the last version in the state of a streaming aggregation: a
  micro-batch updates the keys that it holds, and readers read the state (``state``), not
  what led to it. Late rows, whose sequence is below that of the state, and repeated ones
  change nothing. With very many keys use the RocksDB state store
  (``spark.sql.streaming.stateStore.providerClass``).

Either way a batch costs as much as it is large, not as much as the collection.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vectide.operators.rows import latest, newest
from vectide.sources.collections import CollectionSpec, accepted, conform, rejected, save


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of the stream, kept in its checkpoint from the first batch on."""
    line = spark.read.text(f"{checkpoint}/metadata").first()
    return json.loads(line[0])["id"]


def write_batch(batch: DataFrame, spec: CollectionSpec, root: str, folder: str, sequence: str) -> None:
    """Write one batch: the last row of each key, and the refused rows beside it."""
    typed = conform(batch, spec)
    newest = latest(accepted(typed), spec.key, sequence)
    newest.write.mode("overwrite").parquet(f"{root}/rows/{folder}")
    rejected(typed).write.mode("overwrite").parquet(f"{root}/rejects/{folder}")


def ingest(
    stream: DataFrame,
    spec: CollectionSpec,
    root: str,
    checkpoint: str,
    sequence: str,
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start ingesting a stream. ``sequence`` is a field that grows with every change of a key."""
    if sequence not in spec.schema.fieldNames():
        raise ValueError(f"{sequence!r} is no field of the collection")

    def sink(batch: DataFrame, number: int) -> None:
        name = _stream_id(batch.sparkSession, checkpoint)
        write_batch(batch, spec, root, f"stream={name}/batch={number}", sequence)

    writer = stream.writeStream.foreachBatch(sink)
    return _start(writer, checkpoint, available_now, interval)


def _start(writer, checkpoint: str, available_now: bool, interval: str) -> StreamingQuery:
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def ingest_state(
    stream: DataFrame,
    spec: CollectionSpec,
    root: str,
    checkpoint: str,
    sequence: str,
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start ingesting a stream into state. ``sequence`` grows with every change of a key.

    Of rows with one key and one sequence the one with the highest hash of its values
    counts, so the outcome does not depend on how rows fall into batches. What a batch
    touched is written, as it then is, into a folder of its own below ``root``; refused
    rows go to ``ingest_rejects``.
    """
    if sequence not in spec.schema.fieldNames():
        raise ValueError(f"{sequence!r} is no field of the collection")
    good = accepted(conform(stream, spec))
    kept = good.groupBy(spec.key).agg(newest(good, spec.key, sequence).alias("_row"))

    def sink(batch: DataFrame, number: int) -> None:
        name = _stream_id(batch.sparkSession, checkpoint)
        rows = batch.select(spec.key, "_row.*").select(*spec.schema.fieldNames())
        rows.write.mode("overwrite").parquet(f"{root}/changes/stream={name}/batch={number}")

    return _start(kept.writeStream.outputMode("update").foreachBatch(sink), checkpoint, available_now, interval)


def ingest_rejects(
    stream: DataFrame, spec: CollectionSpec, root: str, checkpoint: str, available_now: bool = True, interval: str = "1 minute"
) -> StreamingQuery:
    """Write the rows of a stream that the collection refuses, with their reasons; the sink commits each batch once."""
    writer = rejected(conform(stream, spec)).writeStream.format("parquet").option("path", f"{root}/rejects")
    return _start(writer, checkpoint, available_now, interval)


def state(spark: SparkSession, spec: CollectionSpec, checkpoint: str, batch: int | None = None) -> DataFrame:
    """The last version of each key, from the state itself; as it was after ``batch``, if that is asked for."""
    reader = spark.read.format("statestore")
    reader = reader if batch is None else reader.option("batchId", batch)
    held = reader.load(checkpoint)
    # The aggregate's buffer: the row and what it was ordered by.
    row = held.schema["value"].dataType.names[0]
    return held.select(f"key.{spec.key}", f"value.{row}.*").select(*spec.schema.fieldNames())


def current(spark: SparkSession, spec: CollectionSpec, root: str, sequence: str) -> DataFrame:
    """The state of the collection: the last version of each key."""
    log = spark.read.schema(spec.schema).option("recursiveFileLookup", "true").parquet(f"{root}/rows")
    return latest(log, spec.key, sequence)


def rejects(spark: SparkSession, spec: CollectionSpec, root: str) -> DataFrame:
    schema = spec.schema.add("reject_reason", "string")
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{root}/rejects")


def compact(spark: SparkSession, spec: CollectionSpec, root: str, target: str, sequence: str) -> int:
    """Write the current state as a collection of its own and return its version."""
    return save(current(spark, spec, root, sequence), target)


def file_stream(spark: SparkSession, spec_schema, path: str, kind: str = "parquet", **options: str) -> DataFrame:
    reader = spark.readStream.format(kind).schema(spec_schema)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def table_path(path: str) -> str:
    """The path of a table for ``file_stream``, whether it is one file or a folder of files.

    A stream takes a plain path for a folder; a pattern that only this path fits may be either.
    """
    return f"{path[:-1]}[{path[-1]}]"
