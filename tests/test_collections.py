import json
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectide.operators import rows as R
from vectide.session import work_dir
from vectide.sources import collections as coll
from vectide.sources import ordered, sketches, zorder

SPEC = coll.CollectionSpec("things", 2, enable_bm25=True, fields=(("n", T.IntegerType()),), max_length={"text": 5})


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [(1, "a", 10), (2, "b", None), (3, "c", 30), (4, "d", 40)], "id long, name string, n int"
    )


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize("dimension", [0, -1, 32769, "x", None, ""])
def test_dimension_is_checked(dimension):
    with pytest.raises(ValueError):
        coll.CollectionSpec("c", dimension)


@pytest.mark.parametrize("name", ["", "1a", "a-b", "a b", "x" * 256])
def test_name_is_checked(name):
    with pytest.raises(ValueError):
        coll.CollectionSpec(name, 4)


def test_dimension_given_as_text():
    assert coll.CollectionSpec("c", "128").dimension == 128 and coll.CollectionSpec("c", 32768).dimension == 32768


def test_conform(spark):
    rows = [
        ("1", [1.0, 2.0], "ok", "7"),
        ("2", [1.0], "ok", "7"),
        ("3", None, "ok", "7"),
        ("4", [1.0, float("nan")], "ok", "7"),
        ("5", [1.0, None], "ok", "7"),
        ("x", [1.0, 2.0], "ok", "7"),
        ("6", [1.0, 2.0], "too long", "7"),
        ("7", [1.0, 2.0], None, "no number"),
    ]
    raw = spark.createDataFrame(rows, "id string, vector array<double>, text string, n string")
    out = coll.conform(raw, SPEC)
    reasons = [r.reject_reason for r in out.collect()]
    assert reasons == [
        None, "wrong dimension", "missing vector", "invalid vector element", "invalid vector element",
        "missing key", "text too long", None,
    ]
    good = coll.accepted(out)
    assert [(r.id, r.n) for r in good.collect()] == [(1, 7), (7, None)]
    assert coll.rejected(out).count() == 6
    assert [f.name for f in good.schema] == [f.name for f in SPEC.schema]


def test_conform_keeps_unknown_fields_when_dynamic(spark):
    spec = coll.CollectionSpec("c", 1, dynamic=True)
    raw = spark.createDataFrame([(1, [1.0], "red", 3)], "id long, vector array<float>, colour string, size int")
    assert coll.conform(raw, spec).first()[coll.DYNAMIC_COLUMN] == {"colour": "red", "size": "3"}
    with pytest.raises(ValueError, match="vector"):
        coll.conform(raw.drop("vector"), spec)


def test_empty_collection_has_the_schema(spark):
    assert coll.empty(spark, SPEC).schema == SPEC.schema


def test_insert_json(spark):
    data = [{"id": 1, "vector": [0.1, 0.2], "text": "one"}, {"id": 2, "vector": [0.4, 0.5], "text": "two"}]
    rows = coll.insert_json(spark, json.dumps(data), SPEC)
    assert [(r.id, r.text, len(r.vector)) for r in rows.collect()] == [(1, "one", 2), (2, "two", 2)]
    for bad in ("", "[]", "no json", '{"id": 1}'):
        with pytest.raises(ValueError):
            coll.insert_json(spark, bad, SPEC)
    lines = spark.createDataFrame([(json.dumps(data),), ("broken",), ("[]",)], "data string")
    assert ids(coll.rows_from_json(lines, "data", SPEC)) == [1, 2]
    lines = spark.createDataFrame([(json.dumps(data),), ("broken",), ("[]",), ('{"id": 1}',), (None,)], "data string")
    reasons = [(r.id, r.reject_reason) for r in coll.conform_json(lines, "data", SPEC).collect()]
    assert sorted(reasons, key=str) == sorted([(1, None), (2, None), *[(None, "not a JSON array")] * 3], key=str)


def test_assign_ids_is_dense_ordered_and_repeatable(spark):
    df = spark.range(1000).select((F.lit(5000) - F.col("id") * 3).alias("k")).repartition(7)
    out = coll.assign_ids(df, ["k"], start=100)
    rows = out.orderBy("k").collect()
    assert [r.id for r in rows] == list(range(101, 1101))
    assert sorted(out.collect()) == sorted(coll.assign_ids(df.repartition(3), ["k"], start=100).collect())


def test_partitions(spark, table):
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    named = table.withColumn("partition_name", F.when(F.col("id") < 3, "low").otherwise("high"))
    coll.write_partitioned(named, path)
    read = spark.read.parquet(path)
    assert ids(coll.in_partitions(read, " low ,none")) == [1, 2] and ids(coll.in_partitions(read, None)) == [1, 2, 3, 4]
    plan = coll.in_partitions(read, ["low"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_name" in plan
    assert ids(R.delete_where(read, "n > 0", partition_names="high")) == [1, 2]


def test_save_and_load_versions(spark, table):
    root = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    with pytest.raises(ValueError):
        coll.load(spark, root)
    assert coll.save(table, root) == 1
    # A plan may read the state that it replaces.
    assert coll.save(R.delete_where(coll.load(spark, root), "n > 20"), root) == 2
    assert ids(coll.load(spark, root)) == [1, 2] and ids(coll.load(spark, root, 1)) == [1, 2, 3, 4]


def test_profile_and_describe(spark, vectors):
    df = vectors([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, None)])
    row = coll.profile(df, "vector").first()
    assert (row.row_count, row.vector_nulls, row.dim_min, row.norm_max, row.zero_vectors) == (3, 1, 2, 5.0, 1)
    assert row.id_distinct == 3
    lines = {r.field: r for r in coll.describe(df).collect()}
    assert lines["vector"].type == "array<float>" and lines["vector"].null_count == 1 and lines["id"].row_count == 3


def test_upsert(spark, table):
    batch = spark.createDataFrame(
        [(3, "new", 1, 5), (3, "newest", 2, 9), (3, "old", 0, 1), (9, "nine", 9, 0)], "id long, name string, n int, seq int"
    )
    once = R.upsert(table, batch, sequence="seq")
    assert sorted((r.id, r.name, r.n) for r in once.collect() if r.id in (3, 9)) == [(3, "newest", 2), (9, "nine", 9)]
    assert ids(once) == [1, 2, 3, 4, 9]
    assert sorted(R.upsert(once, batch, sequence="seq").collect(), key=str) == sorted(once.collect(), key=str)


def test_delete(table):
    assert ids(R.delete_where(table, "n > 15")) == [1, 2]
    assert R.delete_count(table, "n > 15").first().delete_count == 2
    for empty in ("", "  ", None):
        with pytest.raises(ValueError):
            R.delete_where(table, empty)
    assert ids(R.delete_ids(table, "[1, 2, 77]")) == [3, 4]
    assert ids(R.delete_ids(table, table.where("id > 2").select("id"))) == [1, 2]
    for bad in ("[]", []):
        with pytest.raises(ValueError):
            R.delete_ids(table, bad)


def test_get_and_query(table):
    assert [tuple(r) for r in R.get(table, "[4, 1]", "name").orderBy("id").collect()] == [(1, "a"), (4, "d")]
    assert ids(R.get(table, ["2"])) == [2]
    assert [tuple(r) for r in R.query(table, "n in [10, 40]", "name", 1).collect()] == [(1, "a")]
    assert [r.id for r in R.query(table).collect()] == [1, 2, 3, 4]
    assert [r.id for r in R.query(table, limit=2, offset=1).collect()] == [2, 3]
    assert [r.id for r in R.page_after(table, 2, 5).collect()] == [3, 4]
    for limit, offset in ((0, 0), (5, -1)):
        with pytest.raises(ValueError):
            R.query(table, limit=limit, offset=offset)


@pytest.mark.parametrize("top", [R.TOP_ROWS, 0])
def test_pages_of_repeated_and_missing_keys(spark, monkeypatch, top):
    monkeypatch.setattr(R, "TOP_ROWS", top)
    rows = sorted(((None if i % 9 == 0 else i % 7, str(i)) for i in range(500)), key=lambda r: (r[0] is not None, r))
    df = spark.createDataFrame(rows, "id long, name string").repartition(6)
    for offset in (0, 1, 50, 55, 300, 490, 600):
        found = [tuple(r) for r in R.query(df, output_fields="name", limit=20, offset=offset).collect()]
        assert found == rows[offset : offset + 20]


def test_latest_with_missing_and_equal_sequences(spark):
    base = spark.createDataFrame([(1, "old", 1), (2, "old", 1)], "id long, v string, s long")
    batch = [(1, "x", None), (3, "a", 5), (3, "b", 5), (3, "c", 4), (4, None, None), (4, "only", None)]
    found = set()
    for order in (batch, batch[::-1]):
        fresh = spark.createDataFrame(order, "id long, v string, s long").repartition(3)
        found.add(tuple(sorted(map(str, R.upsert(base, fresh, sequence="s").collect()))))
        no_sequence = R.upsert(base, fresh).collect()
        assert sorted(r.id for r in no_sequence) == [1, 2, 3, 4]
    assert len(found) == 1
    state = {r.id: r for r in R.upsert(base, fresh, sequence="s").collect()}
    assert state[1].v == "x" and state[2].v == "old" and state[3].s == 5
    with_old = spark.createDataFrame([(1, "x", None), (1, "kept", 1)], "id long, v string, s long")
    assert R.latest(with_old, "id", "s").first().v == "kept"
    maps = spark.createDataFrame([(1, {"a": "b", "c": "d"}), (1, {"c": "d", "a": "b"})], "id long, m map<string,string>")
    assert R.latest(maps, "id").count() == 1


def test_string_keys_are_limited_only_on_request(spark):
    rows = spark.createDataFrame([("k" * 256, [1.0]), ("k" * 257, [1.0])], "id string, vector array<float>")
    spec = coll.CollectionSpec("c", 1, key_type=T.StringType())
    assert [r.reject_reason for r in coll.conform(rows, spec).collect()] == [None, None]
    spec = coll.CollectionSpec("c", 1, key_type=T.StringType(), max_length={"id": 256})
    assert [r.reject_reason for r in coll.conform(rows, spec).collect()] == [None, "id too long"]


def test_infinite_elements_are_refused(spark):
    inf = float("inf")
    rows = spark.createDataFrame([(1, [inf, 1.0], "a"), (2, [1.0, -inf], "b"), (3, [1.0, None], "c"), (4, [1.0, 2.0], "d")], "id long, vector array<float>, text string")
    found = {r.id: r.reject_reason for r in coll.conform(rows, SPEC).collect()}
    assert found == {1: "invalid vector element", 2: "invalid vector element", 3: "invalid vector element", 4: None}


def test_inventory(spark, table, vectors):
    rows = coll.inventory({"b": table, "a": vectors([(1, [1.0, 2.0])])}).collect()
    assert sorted(tuple(r) for r in rows) == [("a", 1, 2, 2), ("b", 4, 3, None)]


def test_insert_numbers_rows_behind_the_last_key(spark):
    spec = coll.CollectionSpec("c", 2, fields=(("name", T.StringType()),))
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    schema = "name string, vector array<float>"
    batch = spark.createDataFrame([("b", [1.0, 2.0]), ("a", [1.0, 2.0])], schema)
    count, keys = coll.insert(batch, spec, path, order_by=["name"])
    assert count == 2 and ids(keys) == [1, 2]
    count, keys = coll.insert(spark.createDataFrame([("c", [3.0, 4.0]), ("bad", [1.0])], schema), spec, path, order_by=["name"])
    assert count == 1 and ids(keys) == [4]
    assert sorted((r.id, r.name) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b"), (4, "c")]
    with pytest.raises(ValueError):
        coll.insert(batch.where("false"), spec, path, order_by=["name"])
    with pytest.raises(ValueError):
        coll.insert(batch, spec, path)


def test_insert_into_a_partition(spark):
    spec = coll.CollectionSpec("c", 1, auto_id=False)
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    for name, key in (("old", 1), ("new", 2)):
        coll.insert(spark.createDataFrame([(key, [1.0])], "id long, vector array<float>"), spec, path, name)
    assert ids(coll.in_partitions(spark.read.parquet(path), "new")) == [2]


def test_a_page_is_a_seek(spark):
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    rows = [(k % 7 if k % 3 else None, k, f"n{k % 5}") for k in range(2000)] + [(3, 5000, None)] * 4
    df = spark.createDataFrame(rows, "id long, n long, name string").repartition(5)
    ordered.store(df, path, ["id", "n"], slice_rows=100)
    held = ordered.load(spark, path)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for offset, limit in ((0, 5), (95, 10), (1990, 50), (3000, 5), (150, 400), (2003, 1)):
        got = [(r.id, r.n, r.name) for r in ordered.page(held, limit, offset).collect()]
        assert got == want[offset : offset + limit], offset
    chosen = [r for r in want if r[2] == "n2"]
    counts = ordered.matching(held, "name == 'n2'")
    for offset in (0, 90, 395, 500):
        got = [(r.id, r.n) for r in ordered.page(held, 20, offset, "name == 'n2'", "n", counts).collect()]
        assert got == [r[:2] for r in chosen[offset : offset + 20]]
        assert got == [(r.id, r.n) for r in ordered.page(held, 20, offset, "name == 'n2'", "n").collect()]
    # A deep page reads the files of one or two slices.
    plan = ordered.page(held, 10, 1900)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_slice" in plan and "Exchange" not in plan
    read = ordered.page(held, 10, 1900).inputFiles()
    assert len(read) == len(held.rows.inputFiles()) > 10
    touched = {r.f for r in held.rows.where(F.col("_slice").isin([19])).select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(touched) == 1
    places = {(r.id, r.n): r.place for r in ordered.place_of(held, spark.createDataFrame([(6, 1000), (None, 3), (9, 9)], "id long, n long")).collect()}
    assert places == {(6, 1000): want.index((6, 1000, "n0"))}
    with pytest.raises(ValueError):
        ordered.page(held, 0)


def test_pages_of_an_empty_collection(spark):
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    ordered.store(spark.createDataFrame([], "id long, n long"), path, "id")
    held = ordered.load(spark, path)
    assert ordered.page(held, 10).count() == 0 and ordered.page(held, 10, 5, "n > 1").count() == 0
    with pytest.raises(ValueError):
        ordered.store(spark.createDataFrame([], "id long, _slice long"), path, "id")


def test_small_slices_share_folders(spark):
    """Folders grow with the rows, not with the number of slices."""
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("id"), F.lit("x").alias("name"))
    ordered.store(df, path, "id", slice_rows=50)
    held = ordered.load(spark, path)
    assert held.slices.count() >= 400 and len(held.rows.inputFiles()) <= ordered.FEW_PARTS
    for offset in (0, 4_990, 19_995):
        assert [r.id for r in ordered.page(held, 120, offset).collect()] == list(range(offset, min(20_000, offset + 120)))
    assert [r.id for r in ordered.page(held, 60, 500, "id >= 700").collect()] == list(range(1200, 1260))
    places = ordered.place_of(held, df.where("id % 997 = 0").select("id"))
    assert {(r.id, r.place) for r in places.collect()} == {(k, k) for k in range(0, 20_000, 997)}


def test_sketches_of_batches_merge_into_that_of_all(spark):
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    df = spark.range(30_000).select(
        (F.col("id") * 7919 % 20_011).alias("k"),
        F.when(F.col("id") % 10 != 0, F.col("id").cast("double")).alias("x"),
        F.concat(F.lit("s"), F.col("id") % 50).alias("s"),
        F.lit(None).cast("int").alias("nothing"),
        F.when(F.col("id") == 3, F.lit(float("nan"))).otherwise(F.col("id") % 2).alias("odd"),
    )
    for b in range(4):
        sketches.keep(df.where(F.col("k") % 4 == b), path, f"b{b}")
    sketches.keep(df.where(F.col("k") % 4 == 1), path, "b1")
    got = {r.field: r for r in sketches.profile(spark, path).collect()}
    whole = {r.field: r for r in sketches.report(sketches.sketch(df)).collect()}
    exact = {"k": df.select("k").distinct().count(), "s": 50}
    for f, n in exact.items():
        for r in (got[f], whole[f]):
            assert abs(r.distinct_values - n) <= 4 * sketches.DISTINCT_ERROR * n + 1
    assert all(got[f].rows == 30_000 and got[f].nulls == whole[f].nulls for f in got)
    assert got["x"].nulls == 3000 and got["nothing"].distinct_values == 0 and got["nothing"].quantiles is None and got["s"].quantiles is None
    values = sorted(r.x for r in df.where("x is not null").select("x").collect())
    for q, value in zip((0.0, 0.25, 0.5, 0.75, 1.0), got["x"].quantiles):
        assert abs(sum(v <= value for v in values) / len(values) - q) <= 2 * sketches.RANK_ERROR
    assert got["odd"].quantiles[-1] == 1.0
    assert got.keys() == whole.keys() and sketches.profile(spark, path).count() == 5


def test_z_order_skips_row_groups_for_each_field(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    df = spark.range(40_000).select(
        F.col("id"),
        (F.col("id") * 7919 % 40_009).cast("double").alias("x"),
        F.expr("date_add(date'2020-01-01', cast(id * 104729 % 3001 as int))").alias("d"),
        F.when(F.col("id") % 9 == 0, None).otherwise(F.col("id") * 31 % 997).cast("int").alias("n"),
        F.concat(F.lit("name"), F.col("id") * 17 % 4001).alias("name"),
    )
    zorder.write(df, f"{tmp_path}/z", ["x", "d"], ["name"], n_files=64)
    df.repartitionByRange(64, "x").write.parquet(f"{tmp_path}/plain")
    back = spark.read.parquet(f"{tmp_path}/z")
    assert back.columns == df.columns and back.count() == 40_000 and back.exceptAll(df).count() == 0

    def share(path, field, low, high):
        groups = hit = 0
        for f in glob.glob(f"{path}/*.parquet"):
            meta = pq.ParquetFile(f).metadata
            for g in range(meta.num_row_groups):
                stats = next(meta.row_group(g).column(c).statistics for c in range(meta.num_columns) if meta.row_group(g).column(c).path_in_schema == field)
                groups += 1
                hit += stats.min <= high and stats.max >= low
        return hit / groups

    import datetime

    start = datetime.date(2020, 6, 1)
    days = (start, start + datetime.timedelta(days=100))
    # A tenth of a field's range takes a fraction of the files, whichever field it is.
    assert share(f"{tmp_path}/z", "x", 4000, 8000) < 0.35 and share(f"{tmp_path}/z", "d", *days) < 0.35
    assert share(f"{tmp_path}/plain", "d", *days) > 0.9
    meta = pq.ParquetFile(glob.glob(f"{tmp_path}/z/*.parquet")[0]).metadata
    assert meta.num_rows > 0
    assert back.where("name = 'name17' and x between 0 and 40009").count() == df.where("name = 'name17'").count()
    zorder.write(df, f"{tmp_path}/n", ["n"])
    assert spark.read.parquet(f"{tmp_path}/n").where("n is null").count() == df.where("n is null").count()
    with pytest.raises(ValueError):
        zorder.write(df, f"{tmp_path}/no", ["name"])
    with pytest.raises(ValueError):
        zorder.write(df, f"{tmp_path}/no", [])
    zorder.write(df.limit(0), f"{tmp_path}/empty", ["x", "d"])
    assert spark.read.schema(df.schema).parquet(f"{tmp_path}/empty").count() == 0


def test_inserted_and_saved_collections_are_loaded_alike(spark):
    spec = coll.CollectionSpec("grows", 2, fields=(("n", T.IntegerType()),), auto_id=False)
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"

    def batch(*ids_):
        return spark.createDataFrame([(i, [1.0, 2.0], i) for i in ids_], "id long, vector array<float>, n int")

    with pytest.raises(ValueError):
        coll.load(spark, path)
    coll.insert(batch(1, 2), spec, path)
    coll.insert(batch(3), spec, path)
    assert ids(coll.load(spark, path)) == [1, 2, 3]
    assert coll.save(R.delete_where(coll.load(spark, path), "id = 2"), path) == 1
    assert ids(coll.load(spark, path)) == [1, 3]
    coll.insert(batch(4), spec, path)
    assert ids(coll.load(spark, path)) == [1, 3, 4]
    assert coll.save(R.delete_where(coll.load(spark, path), "id = 1"), path) == 2
    assert ids(coll.load(spark, path)) == [3, 4] and ids(coll.load(spark, path, 1)) == [1, 3, 4]
    with pytest.raises(ValueError):
        coll.load(spark, path, 7)


def test_storage(spark):
    import glob
    import os

    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    spark.range(1000).repartition(3).write.parquet(path)
    found = coll.storage(spark.read.parquet(path)).first()
    files = glob.glob(f"{path}/*.parquet")
    assert (found.files, found.bytes, found.row_count) == (3, sum(map(os.path.getsize, files)), 1000)
    assert coll.storage(spark.read.parquet(path).where("id < 0")).first().files == 0
