import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["qid", "rank", "id", "score", "similarity"] and df.count() == 5000


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def key(row):
    return tuple("" if v is None else f"{v + 0.0!r}" if isinstance(v, float) else repr(v) for v in row)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    columns = sorted(df.columns)
    mine = sorted(map(key, df.select(*columns).collect()))
    if name not in entry.oracle_sql():
        assert mine
        return
    theirs = duck.execute(f"select {', '.join(columns)} from ({entry.oracle_sql()[name]})").fetchall()
    assert mine == sorted(map(key, theirs))
