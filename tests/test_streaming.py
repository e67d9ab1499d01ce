import uuid

import pytest
from pyspark.sql import types as T

from vectide.session import work_dir
from vectide.sources.collections import CollectionSpec, load
from vectide.streaming import ingest as S

SPEC = CollectionSpec("s", 2, fields=(("version", T.IntegerType()),))
SCHEMA = "id long, vector array<float>, version int"


@pytest.fixture
def place(spark):
    return f"{work_dir(spark)}/{uuid.uuid4().hex}"


def put(spark, place, *rows):
    spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(f"{place}/in")


def run(spark, place, checkpoint="cp"):
    files = S.file_stream(spark, SCHEMA, f"{place}/in", maxFilesPerTrigger="1")
    query = S.ingest(files, SPEC, f"{place}/out", f"{place}/{checkpoint}", "version")
    query.awaitTermination()
    return sorted((r.id, r.version, r.vector[0]) for r in S.current(spark, SPEC, f"{place}/out", "version").collect())


def test_last_version_wins_and_replays_change_nothing(spark, place):
    put(spark, place, (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (1, [1.5, 0.0], 2))
    put(spark, place, (3, [3.0], 1), (2, [2.5, 0.0], 3))
    first = run(spark, place)
    assert first == [(1, 2, 1.5), (2, 3, 2.5)]
    assert [(r.id, r.reject_reason) for r in S.rejects(spark, SPEC, f"{place}/out").collect()] == [(3, "wrong dimension")]
    # Nothing new: the same checkpoint reads nothing, another one reads all files again.
    assert run(spark, place) == first
    assert run(spark, place, "other") == first
    put(spark, place, (3, [9.0, 0.0], 1), (1, [0.0, 0.0], 1))
    assert run(spark, place) == [(1, 2, 1.5), (2, 3, 2.5), (3, 1, 9.0)]
    S.compact(spark, SPEC, f"{place}/out", f"{place}/compact", "version")
    assert load(spark, f"{place}/compact").count() == 3


def test_a_batch_that_runs_again_overwrites_its_folder(spark, place):
    batch = spark.createDataFrame([(1, [1.0, 2.0], 1)], SCHEMA)
    for _ in range(2):
        S.write_batch(batch, SPEC, place, "stream=x/batch=0", "version")
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{place}/rows").count() == 1


def test_sequence_must_exist(spark, place):
    with pytest.raises(ValueError):
        S.ingest(None, SPEC, place, place, "nope")


def run_state(spark, place, checkpoint="cp"):
    files = S.file_stream(spark, SCHEMA, f"{place}/in", maxFilesPerTrigger="1")
    S.ingest_state(files, SPEC, f"{place}/out", f"{place}/{checkpoint}", "version").awaitTermination()
    return state_of(spark, place, checkpoint)


def state_of(spark, place, checkpoint="cp", batch=None):
    return sorted((r.id, r.version, r.vector[0]) for r in S.state(spark, SPEC, f"{place}/{checkpoint}", batch).collect())


def test_state_keeps_the_last_version_through_late_and_repeated_rows(spark, place):
    put(spark, place, (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 5), (1, [1.5, 0.0], 2))
    put(spark, place, (2, [2.5, 0.0], 3), (3, [3.0, 0.0], None), (4, [4.0], 1))
    put(spark, place, (1, [1.5, 0.0], 2), (3, [3.5, 0.0], 1), (2, [2.0, 0.0], 5), (3, [9.0, 0.0], None))
    got = run_state(spark, place)
    assert got == [(1, 2, 1.5), (2, 5, 2.0), (3, 1, 3.5)]
    # The state after the first batch alone; a batch that holds a late row touches its key without changing it.
    assert state_of(spark, place, batch=0) == [(1, 2, 1.5), (2, 5, 2.0)]
    changes = spark.read.schema(SPEC.schema).option("recursiveFileLookup", "true").parquet(f"{place}/out/changes")
    assert changes.where("id = 2").select("version").distinct().collect()[0].version == 5
    # The same files in another stream, and a run with nothing new, give the same state.
    assert run_state(spark, place) == got
    assert run_state(spark, place, "other") == got
    put(spark, place, (2, [0.0, 0.0], 4), (5, [5.0, 0.0], 1))
    assert run_state(spark, place) == [*got, (5, 1, 5.0)]
    files = S.file_stream(spark, SCHEMA, f"{place}/in")
    S.ingest_rejects(files, SPEC, f"{place}/out", f"{place}/refused").awaitTermination()
    assert [(r.id, r.reject_reason) for r in S.rejects(spark, SPEC, f"{place}/out").collect()] == [(4, "wrong dimension")]
    with pytest.raises(ValueError):
        S.ingest_state(None, SPEC, place, place, "nope")


@pytest.mark.parametrize("files", ["folder", "file"])
def test_a_table_may_be_a_folder_or_a_file(spark, place, files):
    import glob
    import shutil

    put(spark, place, (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1))
    path = f"{place}/{files}.parquet"
    shutil.copytree(f"{place}/in", path) if files == "folder" else shutil.copy(glob.glob(f"{place}/in/part-*.parquet")[0], path)
    stream = S.file_stream(spark, SCHEMA, S.table_path(path))
    S.ingest(stream, SPEC, f"{place}/out", f"{place}/cp", "version").awaitTermination()
    assert sorted(r.id for r in S.current(spark, SPEC, f"{place}/out", "version").collect()) == [1, 2]
