"""Sessions, the shared work folder and tables written to it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "vectide", cores: int | str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``).

    A folder of this machine is used only by a local-mode session that names none.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = sc.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="vectide-")
    return _LOCAL_DIRS[app]


def materialize(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back, in folders by the values of a column if one is named.

    Used where two branches of a plan need the same costly frame; the copy
    outlives lost executors, unlike a cached one.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    writer = df.write if by is None else df.write.partitionBy(by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_parts(parts: Iterable[DataFrame]) -> DataFrame:
    """As `materialize` for frames of one schema, written one after another and read as one frame."""
    paths, spark, schema = [], None, None
    for df in parts:
        spark, schema = df.sparkSession, df.schema
        paths.append(f"{work_dir(spark)}/{uuid.uuid4().hex}")
        df.write.parquet(paths[-1])
    return spark.read.schema(schema).parquet(*paths)
