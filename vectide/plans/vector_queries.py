"""Vector search over the embeddings: every vector is a query against the whole table."""

from pyspark.sql import functions as F

from vectide.functions.vectors import norm, normalize
from vectide.operators import nearest, selection
from vectide.plans.registry import REGISTRY, table

SCORES = {
    "COSINE": "round(list_cosine_similarity(q.v, c.v), 9)",
    "L2": "round(list_distance(q.v, c.v), 9)",
    "IP": "round(list_inner_product(q.v, c.v), 9)",
}

VECTORS = "vecs as (select vec_id, label, embedding::double[] as v from embeddings)"


def ranked_sql(metric: str, k: int, where: str = "true", name: str = "ranked") -> str:
    """CTEs ``vecs`` and ``name(qid, rank, id, score, similarity)``."""
    order = "asc" if metric == "L2" else "desc"
    alike = "1 / (1 + score)" if metric == "L2" else "score"
    return f"""{VECTORS},
pairs_{name} as (
  select q.vec_id as qid, c.vec_id as id, {SCORES[metric]} as score
  from vecs q, vecs c where {where}),
{name} as (
  select qid, rank, id, score, {alike} as similarity from (
    select *, row_number() over (partition by qid order by score {order}, id) as rank from pairs_{name})
  where rank <= {k})"""


def out(hits):
    return hits.select(
        "qid", "rank", "id", "score", "similarity"
    )


OUT = "select qid, rank, id, score, similarity from ranked"


def vectors(spark, sf):
    return table(spark, sf, "embeddings").withColumnsRenamed({"vec_id": "id", "embedding": "vector"})


def as_queries(corpus):
    return corpus.select(F.col("id").alias("qid"), F.col("vector").alias("qv"))


def _knn(metric, k):
    def plan(spark, sf):
        corpus = vectors(spark, sf)
        return out(nearest.search(corpus, as_queries(corpus), limit=k, metric=metric))

    return plan


REGISTRY.add("knn_cosine", f"with {ranked_sql('COSINE', 10)} {OUT}")(_knn("COSINE", 10))
REGISTRY.add("knn_l2", f"with {ranked_sql('L2', 10)} {OUT}")(_knn("L2", 10))
REGISTRY.add("knn_inner_product", f"with {ranked_sql('IP', 10)} {OUT}")(_knn("IP", 10))


def short_sql(metric: str, k: int) -> str:
    kernel, order = {"L2": ("list_distance", "asc"), "IP": ("list_inner_product", "desc")}[metric]
    scale = "1e6" if metric == "L2" else "1e12"
    return f"""with vecs as (
  select vec_id, [x * 1e-6::double for x in embedding::double[]] as v from embeddings),
pairs as (select q.vec_id as qid, c.vec_id as id, {kernel}(q.v, c.v) as score from vecs q, vecs c),
ranked as (select *, row_number() over (partition by qid order by score {order}, id) as rank from pairs)
select qid, rank, id, round(score * {scale}::double, 6) as scaled from ranked where rank <= {k}"""


def _short(metric, k):
    """Vectors of a millionth of the length: ranked by unrounded scores."""

    def plan(spark, sf):
        short = F.transform("vector", lambda x: x.cast("double") * F.lit(1e-6))
        corpus = vectors(spark, sf).withColumn("vector", short)
        hits = nearest.search(corpus, as_queries(corpus), limit=k, metric=metric, decimals=None)
        scale = 1e6 if metric == "L2" else 1e12
        return hits.select("qid", "rank", "id", F.round(F.col("score") * F.lit(scale), 6).alias("scaled"))

    return plan


REGISTRY.add("knn_l2_short", short_sql("L2", 10))(_short("L2", 10))
REGISTRY.add("knn_inner_product_short", short_sql("IP", 10))(_short("IP", 10))


@REGISTRY.add(
    "knn_filtered",
    f"with {ranked_sql('COSINE', 10, where='c.label in (1, 2, 3) and c.vec_id <> 7')}, o as ({OUT})"
    " select o.*, e.label from o join embeddings e on e.vec_id = o.id",
)
def knn_filtered(spark, sf):
    corpus = vectors(spark, sf)
    hits = nearest.search(
        corpus, as_queries(corpus), filter="label in [1, 2, 3] and id != 7", output_fields="label"
    )
    return hits.select(
        "qid",
        "rank",
        "id",
        "score",
        "similarity",
        "label",
    )


@REGISTRY.add(
    "knn_min_similarity",
    f"with {ranked_sql('L2', 20)} {OUT} where similarity >= 0.45",
)
def knn_min_similarity(spark, sf):
    corpus = vectors(spark, sf)
    return out(nearest.search(corpus, as_queries(corpus), limit=20, metric="L2", min_similarity=0.45))


def range_sql(metric: str, low: float, high: float) -> str:
    alike = "1 / (1 + score)" if metric == "L2" else "score"
    return f"""with {VECTORS},
pairs as (select q.vec_id as qid, c.vec_id as id, {SCORES[metric]} as score from vecs q, vecs c)
select qid, id, score, {alike} as similarity from pairs
where {alike} >= {low} and {alike} <= {high}"""


@REGISTRY.add("range_cosine", range_sql("COSINE", 0.35, 0.9))
def range_cosine(spark, sf):
    corpus = vectors(spark, sf)
    hits = nearest.range_search(corpus, as_queries(corpus), 0.35, 0.9)
    return hits.select("qid", "id", "score", "similarity")


@REGISTRY.add("range_l2", range_sql("L2", 0.47, 0.99))
def range_l2(spark, sf):
    corpus = vectors(spark, sf)
    hits = nearest.range_search(corpus, as_queries(corpus), 0.47, 0.99, "L2")
    return hits.select("qid", "id", "score", "similarity")


@REGISTRY.add(
    "range_top_k",
    f"""with {VECTORS},
pairs as (select q.vec_id as qid, c.vec_id as id, {SCORES['IP']} as score from vecs q, vecs c),
ranked as (select *, score as similarity, row_number() over (partition by qid order by score desc, id) as rank
  from pairs where score >= 0.1 and score <= 0.5)
{OUT} where rank <= 5""",
)
def range_top_k(spark, sf):
    corpus = vectors(spark, sf)
    return out(nearest.search(corpus, as_queries(corpus), limit=5, metric="IP", radius=0.1, range_filter=0.5))


@REGISTRY.add(
    "knn_second_field",
    f"""with {VECTORS}, halves as (select vec_id, v[33:64] as v from vecs),
pairs as (select q.vec_id as qid, c.vec_id as id, round(list_cosine_similarity(q.v, c.v), 9) as score from halves q, halves c),
ranked as (select *, score as similarity, row_number() over (partition by qid order by score desc, id) as rank from pairs)
{OUT} where rank <= 10""",
)
def knn_second_field(spark, sf):
    corpus = vectors(spark, sf).withColumn("half", F.slice("vector", 33, 32))
    asked = corpus.select(F.col("id").alias("qid"), F.col("half").alias("qv"))
    return out(nearest.search(corpus, asked, anns_field="half"))


@REGISTRY.add(
    "knn_blocked",
    f"with {ranked_sql('L2', 7)} {OUT}",
)
def knn_blocked(spark, sf):
    """The plan for query tables too large to broadcast: blocks of rows meet blocks of queries."""
    corpus = vectors(spark, sf)
    return out(nearest.top_k(corpus, as_queries(corpus), 7, "L2", broadcast_bytes=0, block_bytes=64 * 1024))


@REGISTRY.add(
    "normalize_vectors",
    """select vec_id, (generate_subscripts(embedding, 1) - 1)::bigint as pos, round(unnest(embedding::double[])
  / sqrt(list_sum(list_transform(embedding::double[], lambda x: x * x))), 6) as value from embeddings""",
)
def normalize_vectors(spark, sf):
    rows = table(spark, sf, "embeddings").withColumn("length", norm(F.col("embedding")))
    unit = rows.select("vec_id", normalize(F.col("embedding"), F.col("length")).alias("unit"))
    flat = unit.select("vec_id", F.posexplode_outer("unit").alias("pos", "value")).where("value is not null")
    return flat.select("vec_id", F.col("pos").cast("long").alias("pos"), F.round("value", 6).alias("value"))


def _preset(name, k, least):
    where = f"where similarity >= {least}" if least is not None else ""

    @REGISTRY.add(f"preset_{name}", f"with {ranked_sql('COSINE', k)} {OUT} {where}")
    def plan(spark, sf):
        corpus = vectors(spark, sf)
        return out(selection.preset_search(corpus, as_queries(corpus), name))


_preset("basic", 10, 0.3)
_preset("recommended", 5, 0.4)
_preset("top_k", 5, None)


@REGISTRY.add("preset_threshold", range_sql("COSINE", 0.4, 2))
def preset_threshold(spark, sf):
    corpus = vectors(spark, sf)
    hits = selection.preset_search(corpus, as_queries(corpus), "threshold")
    return hits.select("qid", "id", "score", "similarity")


MIXED = "case when vec_id % 5 = 0 then (embedding::double[])[1:40] else embedding::double[] end"


def mixed(spark, sf):
    """Every fifth vector has lost its end."""
    cut = F.when(F.col("id") % 5 == 0, F.slice("vector", 1, 40)).otherwise(F.col("vector"))
    return vectors(spark, sf).withColumn("vector", cut)


@REGISTRY.add(
    "knn_mixed_lengths",
    f"""with vecs as (select vec_id, embedding::double[] as v from embeddings where vec_id % 5 <> 0),
pairs as (select q.vec_id as qid, c.vec_id as id, {SCORES['COSINE']} as score from vecs q, vecs c),
ranked as (select *, score as similarity, row_number() over (partition by qid order by score desc, id) as rank from pairs)
{OUT} where rank <= 10""",
)
def knn_mixed_lengths(spark, sf):
    """Vectors of another length than usual neither ask nor answer, and stop nobody else."""
    corpus = mixed(spark, sf)
    return out(nearest.search(corpus, as_queries(corpus), limit=10))


@REGISTRY.add(
    "vector_lengths",
    f"""with vecs as (select {MIXED} as v from embeddings)
select side, len(v)::integer as length, count(*) as n, len(v) = 64 as searched
from vecs, (values ('corpus'), ('queries')) as sides(side) group by all""",
)
def vector_lengths(spark, sf):
    """What a search leaves out for its length."""
    corpus = mixed(spark, sf)
    return nearest.lengths(corpus, as_queries(corpus))
