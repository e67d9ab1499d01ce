"""Collections, ingest and row-level operators on the given tables."""

import json
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectide.operators import rows
from vectide.plans.registry import REGISTRY, table
from vectide.session import work_dir
from vectide.sources import collections as coll
from vectide.sources import ordered, sketches, zorder

EMBEDDINGS = coll.CollectionSpec("embeddings", 64, fields=(("label", T.IntegerType()),), auto_id=False)

# Faults put into the vectors of three labels, so that every check has something to refuse.
FAULTY = """case label when 0 then slice(embedding, 1, 63)
    when 1 then concat(array(float('NaN')), slice(embedding, 2, 63))
    when 2 then cast(null as array<float>)
    when 4 then concat(slice(embedding, 1, 63), array(float('-Infinity'))) else embedding end"""


@REGISTRY.add(
    "conform_embeddings",
    """select case when label = 3 then null else vec_id end as id, label, case when label = 3 then 'missing key'
  when label = 2 then 'missing vector' when label = 0 then 'wrong dimension' when label in (1, 4) then 'invalid vector element' end
  as reject_reason, case when label > 4 then round(list_sum(embedding::double[]), 6) end as total from embeddings""",
)
def conform_embeddings(spark, sf):
    raw = table(spark, sf, "embeddings").select(
        F.when(F.col("label") == 3, F.lit("none")).otherwise(F.col("vec_id").cast("string")).alias("id"),
        F.expr(FAULTY).alias("vector"),
        "label",
    )
    total = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double"))
    kept = F.when(F.col("reject_reason").isNull(), F.round(total, 6))
    return coll.conform(raw, EMBEDDINGS).select("id", "label", "reject_reason", kept.alias("total"))


@REGISTRY.add(
    "conform_json",
    """select case when label <> 5 then vec_id end as id, case when label <> 5 then label end as label,
  case when label = 5 then 'not a JSON array' end as reject_reason from embeddings""",
)
def conform_json(spark, sf):
    """Every vector as a JSON array of one object; those of one label are cut so that they are none."""
    row = F.struct(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("label"))
    data = F.to_json(F.array(row))
    text = table(spark, sf, "embeddings").select(F.when(F.col("label") == 5, F.substr(data, F.lit(2))).otherwise(data).alias("data"))
    return coll.conform_json(text, "data", EMBEDDINGS).select("id", "label", "reject_reason")


@REGISTRY.add(
    "insert_json_rows",
    """select vec_id as id, label, len(embedding)::integer as dim, round(list_sum(embedding::double[]), 6) as total
from embeddings""",
)
def insert_json_rows(spark, sf):
    row = F.struct(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("label"))
    text = table(spark, sf, "embeddings").select(F.to_json(F.array(row)).alias("data"))
    good = coll.accepted(coll.conform(coll.rows_from_json(text, "data", EMBEDDINGS), EMBEDDINGS))
    total = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return good.select("id", "label", F.size("vector").alias("dim"), F.round(total, 6).alias("total"))


NUMBERED = coll.CollectionSpec("numbered", 64, fields=(("vec_id", T.LongType()), ("label", T.IntegerType())), auto_id=True)


@REGISTRY.add(
    "insert_batches",
    """with b as (select *, case when label < 5 then 0 else 1 end as batch from embeddings),
n as (select batch, count(*) as inserted from b group by batch)
select row_number() over (order by batch, vec_id) as id, vec_id, label, len(embedding)::integer as dim, inserted
from b join n using (batch)""",
)
def insert_batches(spark, sf):
    """Two batches appended with automatic keys and read back, each with the count its insert returned."""
    path = f"{work_dir(spark)}/inserted-{uuid.uuid4().hex}"
    given = table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").alias("vector"))
    counts = [coll.insert(given.where(part), NUMBERED, path, order_by=["vec_id"])[0] for part in ("label < 5", "label >= 5")]
    back = spark.read.parquet(path)
    inserted = F.when(F.col("label") < 5, F.lit(counts[0])).otherwise(F.lit(counts[1])).cast("long")
    return back.select("id", "vec_id", "label", F.size("vector").alias("dim"), inserted.alias("inserted"))


@REGISTRY.add(
    "auto_id",
    "select row_number() over (order by c_mktsegment, c_custkey) as id, c_custkey from customer",
)
def auto_id(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return coll.assign_ids(customers, ["c_mktsegment", "c_custkey"]).select("id", "c_custkey")


@REGISTRY.add(
    "partitioned_read",
    """select event_id, event_type as partition_name, month(ts)::integer as m, value from events
where event_type in ('click', 'error')""",
)
def partitioned_read(spark, sf):
    path = f"{work_dir(spark)}/events-{uuid.uuid4().hex}"
    events = table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("partition_name"), F.month("ts").alias("m"), "value"
    )
    coll.write_partitioned(events, path, ["partition_name", "m"])
    found = coll.in_partitions(spark.read.parquet(path), "click, error")
    return found.select("event_id", "partition_name", "m", "value")


@REGISTRY.add(
    "upsert",
    """with batch as (select o_custkey as c_custkey, arg_max(o_orderpriority, o_orderkey) as c_mktsegment,
    arg_max(o_totalprice, o_orderkey) as c_acctbal from orders where o_orderstatus = 'F' group by o_custkey)
select c_custkey, c_mktsegment, c_acctbal from customer where c_custkey not in (select c_custkey from batch)
union all select * from batch""",
)
def upsert(spark, sf):
    base = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    batch = (
        table(spark, sf, "orders")
        .where("o_orderstatus = 'F'")
        .select(
            F.col("o_custkey").alias("c_custkey"),
            F.col("o_orderpriority").alias("c_mktsegment"),
            F.col("o_totalprice").alias("c_acctbal"),
            "o_orderkey",
        )
    )
    return rows.upsert(base, batch, key="c_custkey", sequence="o_orderkey")


@REGISTRY.add(
    "upsert_ties",
    """with batch as (select o_custkey as c_custkey, max(case when o_orderpriority <> '1-URGENT' then o_orderkey % 3 end) as s
  from orders group by o_custkey)
select c_custkey, c_mktsegment, null::bigint as s from customer where c_custkey not in (select c_custkey from batch)
union all select c_custkey, coalesce(s::varchar, 'none'), s from batch""",
)
def upsert_ties(spark, sf):
    """Sequences that are missing or equal: a row without one never replaces a row that has one."""
    base = table(spark, sf, "customer").selectExpr("c_custkey", "c_mktsegment", "cast(null as bigint) as s")
    s = "case when o_orderpriority <> '1-URGENT' then o_orderkey % 3 end"
    batch = table(spark, sf, "orders").selectExpr("o_custkey as c_custkey", f"coalesce(cast({s} as string), 'none') as c_mktsegment", f"{s} as s")
    return rows.upsert(base, batch, key="c_custkey", sequence="s")


BALANCES = "select *, case when c_mktsegment = 'BUILDING' then null else c_acctbal end as balance from customer"


def balances(spark, sf):
    return table(spark, sf, "customer").selectExpr(
        "c_custkey", "c_mktsegment", "case when c_mktsegment = 'BUILDING' then null else c_acctbal end as balance"
    )


@REGISTRY.add(
    "delete_where",
    f"select c_custkey, c_mktsegment, balance from ({BALANCES}) where balance is null or balance <= 2500",
)
def delete_where(spark, sf):
    return rows.delete_where(balances(spark, sf), "balance > 2500")


@REGISTRY.add("delete_count", f"select count(*) as delete_count from ({BALANCES}) where balance > 2500")
def delete_count(spark, sf):
    return rows.delete_count(balances(spark, sf), "balance > 2500")


@REGISTRY.add(
    "delete_ids",
    """select o_orderkey, o_custkey, o_totalprice from orders
where o_orderkey not in (select l_orderkey from lineitem where l_quantity >= 45)""",
)
def delete_ids(spark, sf):
    gone = table(spark, sf, "lineitem").where("l_quantity >= 45").select("l_orderkey")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rows.delete_ids(orders, gone, key="o_orderkey")


@REGISTRY.add("get_by_ids", "select o_orderkey, o_orderstatus from orders where o_orderkey in (3, 5, 8, 13, 21, 34, 999999)")
def get_by_ids(spark, sf):
    ids = json.dumps([3, 5, 8, 13, 21, 34, 999999])
    return rows.get(table(spark, sf, "orders"), ids, "o_orderstatus", key="o_orderkey")


@REGISTRY.add(
    "query_filter",
    """select o_orderkey, o_orderstatus, o_orderpriority, o_totalprice from orders
where o_orderstatus = 'F' and o_totalprice > 100000 and o_orderpriority in ('1-URGENT', '2-HIGH')
order by o_orderkey limit 100""",
)
def query_filter(spark, sf):
    filter = 'o_orderstatus == "F" and o_totalprice > 100000 and o_orderpriority in ["1-URGENT", "2-HIGH"]'
    fields = "o_orderstatus, o_orderpriority, o_totalprice"
    return rows.query(table(spark, sf, "orders"), filter, fields, key="o_orderkey")


@REGISTRY.add(
    "query_predicates",
    """select p_partkey, p_name, p_type from part
where p_name like '%widget%' and not p_size in (1, 2, 3) and p_type <> 'SMALL' and (p_size < 20 or p_retailprice >= 950)""",
)
def query_predicates(spark, sf):
    filter = "p_name like '%widget%' and not p_size in [1, 2, 3] and p_type != \"SMALL\" and (p_size < 20 or p_retailprice >= 950)"
    from vectide.functions.predicates import predicate

    return table(spark, sf, "part").where(predicate(filter)).select("p_partkey", "p_name", "p_type")


@REGISTRY.add("page_offset", "select o_orderkey, o_totalprice from orders where o_totalprice > 50000 order by o_orderkey limit 50 offset 200")
def page_offset(spark, sf):
    return rows.query(
        table(spark, sf, "orders"), "o_totalprice > 50000", "o_totalprice", limit=50, offset=200, key="o_orderkey"
    )


@REGISTRY.add(
    "page_repeated_keys",
    "select o_custkey, o_orderkey, o_totalprice from orders order by o_custkey, o_orderkey limit 300 offset 1000",
)
def page_repeated_keys(spark, sf):
    return rows.query(table(spark, sf, "orders"), None, "o_orderkey, o_totalprice", limit=300, offset=1000, key="o_custkey")


@REGISTRY.add("page_after", "select o_orderkey, o_totalprice from orders where o_orderkey > 4711 order by o_orderkey limit 50")
def page_after(spark, sf):
    return rows.page_after(table(spark, sf, "orders"), 4711, 50, output_fields="o_totalprice", key="o_orderkey")


def ordered_orders(spark, sf, *order, slice_rows=500):
    path = f"{work_dir(spark)}/ordered-{uuid.uuid4().hex}"
    ordered.store(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), path, order, slice_rows)
    return ordered.load(spark, path)


@REGISTRY.add(
    "page_seek",
    "select o_custkey, o_orderkey, o_totalprice from orders order by o_custkey, o_orderkey limit 700 offset 10100",
)
def page_seek(spark, sf):
    """A page far behind, over more than one slice, from the order kept with the collection."""
    return ordered.page(ordered_orders(spark, sf, "o_custkey", "o_orderkey"), limit=700, offset=10100)


@REGISTRY.add(
    "page_seek_filtered",
    "select o_orderkey, o_totalprice from orders where o_totalprice > 50000 order by o_orderkey limit 50 offset 7000",
)
def page_seek_filtered(spark, sf):
    held = ordered_orders(spark, sf, "o_orderkey")
    return ordered.page(held, 50, 7000, "o_totalprice > 50000", "o_totalprice")


@REGISTRY.add(
    "place_of_keys",
    """select o_orderkey, place from (select *, row_number() over (order by o_custkey, o_orderkey) - 1 as place from orders)
where o_orderkey in (select l_orderkey from lineitem where l_quantity >= 49)""",
)
def place_of_keys(spark, sf):
    """Where some rows stand in the collection's order."""
    asked = table(spark, sf, "lineitem").where("l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return ordered.place_of(ordered_orders(spark, sf, "o_custkey", "o_orderkey"), asked)


@REGISTRY.add(
    "describe_collection",
    """select (row_number() over () - 1)::integer as position, column_name as field,
  case column_type when 'BIGINT' then 'bigint' when 'VARCHAR' then 'string' end as type,
  (select count(*) from documents) as row_count, 0::bigint as null_count from (describe documents)""",
)
def describe_collection(spark, sf):
    return coll.describe(table(spark, sf, "documents"))


@REGISTRY.add(
    "storage_statistics",
    "select 4::bigint as files, true as has_bytes, count(*) as row_count from documents",
)
def storage_statistics(spark, sf):
    """Files and rows of a stored collection, and whether its files have a size."""
    path = f"{work_dir(spark)}/stored-{uuid.uuid4().hex}"
    table(spark, sf, "documents").repartition(4).write.parquet(path)
    return coll.storage(spark.read.parquet(path)).select("files", (F.col("bytes") > 0).alias("has_bytes"), "row_count")


@REGISTRY.add(
    "profile_vectors",
    """with n as (select *, sqrt(list_sum(list_transform(embedding::double[], lambda x: x * x))) as norm from embeddings)
select count(*) as row_count, count(*) filter (vec_id is null) as vec_id_nulls,
  count(*) filter (embedding is null) as embedding_nulls, count(*) filter (label is null) as label_nulls,
  min(len(embedding))::bigint as dim_min, max(len(embedding))::bigint as dim_max, round(min(norm), 6) as norm_min,
  round(avg(norm), 6) as norm_avg, round(max(norm), 6) as norm_max, count(*) filter (norm = 0) as zero_vectors from n""",
)
def profile_vectors(spark, sf):
    return coll.profile(table(spark, sf, "embeddings"), "embedding", approximate=False)


@REGISTRY.add(
    "profile_documents",
    """select count(*) as row_count, count(*) filter (doc_id is null) as doc_id_nulls,
  count(*) filter (text is null) as text_nulls, min(length(text))::bigint as text_min_length,
  max(length(text))::bigint as text_max_length, count(*) filter (lang is null) as lang_nulls,
  min(length(lang))::bigint as lang_min_length, max(length(lang))::bigint as lang_max_length,
  count(*) filter (source is null) as source_nulls, min(length(source))::bigint as source_min_length,
  max(length(source))::bigint as source_max_length, count(*) filter (n_chars is null) as n_chars_nulls from documents""",
)
def profile_documents(spark, sf):
    return coll.profile(table(spark, sf, "documents"), approximate=False)


NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()

WIDTHS = "(select count(*) from (describe {0}))"


@REGISTRY.add(
    "collection_inventory",
    " union all ".join(
        f"select '{n}' as collection, (select count(*) from {n}) as row_count, {WIDTHS.format(n)} as n_fields, "
        + ("(select max(len(embedding)) from embeddings)::bigint" if n == "embeddings" else "null::bigint")
        + " as vector_dim"
        for n in NAMES
    ),
)
def collection_inventory(spark, sf):
    return coll.inventory({n: table(spark, sf, n) for n in NAMES})


@REGISTRY.add(
    "profile_by_sketches",
    """select 'o_custkey' as field, count(*) as row_count, 0::bigint as null_count, true as distinct_close, true as median_close from orders
union all select 'balance', count(*), count(*) filter (c_mktsegment = 'BUILDING'), true, true from customer""",
)
def profile_by_sketches(spark, sf):
    """Profiles merged from the sketches of four batches, held against exact ones."""
    orders = table(spark, sf, "orders").select("o_custkey")
    parts = []
    for df, field in ((orders, "o_custkey"), (balances(spark, sf).select("c_custkey", "balance"), "balance")):
        path = f"{work_dir(spark)}/sketches-{uuid.uuid4().hex}"
        for b in range(4):
            sketches.keep(df.where(F.pmod(F.xxhash64(df.columns[0]), F.lit(4)) == b), path, str(b), [field])
        told = sketches.profile(spark, path, [0.5]).first()
        # Equal values share a range of ranks: half of all must lie in it, give or take the error.
        value, median = F.col(field).cast("double"), F.lit(told["quantiles"][0])
        exact = df.agg(
            F.countDistinct(field).alias("d"), F.count(field).alias("n"), F.count_if(value < median).alias("below"), F.count_if(value <= median).alias("upto")
        )
        close = F.abs(F.lit(told["distinct_values"]) - F.col("d")) <= 5 * sketches.DISTINCT_ERROR * F.col("d") + 1
        half, slack = F.col("n") / 2, 2 * sketches.RANK_ERROR * F.col("n") + 1
        middle = (F.col("below") <= half + slack) & (F.col("upto") >= half - slack)
        counts = [F.lit(told[c]).cast("long").alias(name) for c, name in (("rows", "row_count"), ("nulls", "null_count"))]
        parts.append(exact.select(F.lit(field).alias("field"), *counts, close.alias("distinct_close"), middle.alias("median_close")))
    return parts[0].unionByName(parts[1])


@REGISTRY.add(
    "zorder_range",
    """select l_orderkey, l_linenumber, l_quantity, l_extendedprice from lineitem
where l_quantity between 10 and 15 and l_extendedprice between 20000 and 30000""",
)
def zorder_range(spark, sf):
    """A range in two fields over files along a Z curve."""
    path = f"{work_dir(spark)}/zorder-{uuid.uuid4().hex}"
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    zorder.write(rows, path, ["l_quantity", "l_extendedprice"], ["l_orderkey"])
    return spark.read.parquet(path).where("l_quantity between 10 and 15 and l_extendedprice between 20000 and 30000")
