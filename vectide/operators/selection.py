"""Choosing the hits to hand on: adaptive selection, best chunk per document, title boost, presets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vectide.functions.text import keywords
from vectide.functions.vectors import SCORE_DECIMALS
from vectide.operators.nearest import cut_similarity, given_out, range_search, top_k
from vectide.sizing import spread_join

# Sizes and thresholds of each query type. A slice of the ranked
# list is taken first, the threshold applies to what is left of it.
SIMPLE = (2, 0.6)
GENERAL_STRONG = (2, 0.8)  # best above 0.8: two hits, no threshold
GENERAL_MEDIUM = (3, 0.6, 0.5)  # best above 0.6: three hits of at least 0.5
GENERAL_WEAK = (5, 0.4)
COMPLEX = (7, 0.4)
DOCUMENTS = 4
OTHER = 3

# Title boost and final number of chunks; retrieval presets.
TITLE_BOOST, MAX_FINAL = 0.1, 3
PRESETS = {
    "basic": {"limit": 10, "min_similarity": 0.3},
    "recommended": {"limit": 5, "min_similarity": 0.4},
    "top_k": {"limit": 5},
    "threshold": {"min_similarity": 0.4},
}


def _renumber(hits: DataFrame, *order) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("qid").orderBy(*order)).cast("long")
    return hits.withColumn("rank", place)


def adaptive(hits: DataFrame, types: DataFrame, path_col: str = "path") -> DataFrame:
    """Keep a part of each ranked list that depends on ``types(qid, query_type)``.

    All windows share the partitioning by query, so the hits move once.
    """
    typed = spread_join(hits, types.select("qid", "query_type"), ["qid"], "id")
    rank, alike, kind = F.col("rank"), F.col("similarity"), F.col("query_type")
    by_rank = Window.partitionBy("qid").orderBy("rank")
    strongest = [alike.desc_nulls_last(), rank.asc()]
    in_document = Window.partitionBy("qid", path_col).orderBy(*strongest)
    by_strength = Window.partitionBy("qid").orderBy(*strongest).rowsBetween(Window.unboundedPreceding, 0)
    marked = typed.withColumns(
        {"_best": F.first("similarity").over(by_rank), "_lead": (F.row_number().over(in_document) == 1).cast("int")}
    ).withColumn("_document", F.sum("_lead").over(by_strength))

    best = F.col("_best")
    general = (
        F.when(best > GENERAL_STRONG[1], rank <= GENERAL_STRONG[0])
        .when(best > GENERAL_MEDIUM[1], (rank <= GENERAL_MEDIUM[0]) & (alike >= GENERAL_MEDIUM[2]))
        .otherwise((rank <= GENERAL_WEAK[0]) & (alike >= GENERAL_WEAK[1]))
    )
    keep = (
        F.when(kind == "simple", (rank <= SIMPLE[0]) & (alike >= SIMPLE[1]))
        .when(kind == "general", general)
        .when(kind == "complex", (rank <= COMPLEX[0]) & (alike >= COMPLEX[1]))
        .when(kind == "comprehensive", (F.col("_lead") == 1) & (F.col("_document") <= DOCUMENTS))
        .otherwise(rank <= OTHER)
    )
    kept = marked.where(keep).drop("_best", "_lead", "_document")
    return _renumber(kept, *strongest)


def best_per_document(hits: DataFrame, path_col: str = "path", limit: int = DOCUMENTS) -> DataFrame:
    """The most similar hit of each document, ties to the earlier hit, for the best documents of each query."""
    rest = [c for c in hits.columns if c not in ("qid", path_col)]
    best = F.max_by(F.struct(*rest), F.struct(F.col("similarity"), -F.col("rank"))).alias("_hit")
    lead = hits.groupBy("qid", path_col).agg(best).select("qid", path_col, "_hit.*")
    ranked = lead.withColumnRenamed("rank", "_was")
    place = F.row_number().over(
        Window.partitionBy("qid").orderBy(F.col("similarity").desc_nulls_last(), F.col("_was").asc())
    )
    kept = ranked.withColumn("rank", place).where(F.col("rank") <= limit)
    return kept.withColumn("rank", F.col("rank").cast("long")).select(*hits.columns)


def boost_titles(
    hits: DataFrame, queries: DataFrame, title_col: str = "title", boost: float = TITLE_BOOST, limit: int = MAX_FINAL
) -> DataFrame:
    """Raise hits whose title contains a keyword of the query, then rank again.

    Similarity stays as found; ``boosted`` is what ranks.
    """
    words = queries.select("qid", keywords(F.col("query_text")).alias("_words"))
    both = spread_join(hits, words, ["qid"], "id")
    title = F.lower(F.col(title_col))
    match = F.coalesce(F.exists("_words", lambda w: F.contains(title, w)), F.lit(False))
    raised = both.withColumn(
        "boosted", F.round(F.col("similarity") + F.when(match, float(boost)).otherwise(0.0), 9)
    ).drop("_words", "rank")
    place = F.row_number().over(
        Window.partitionBy("qid").orderBy(F.col("boosted").desc_nulls_last(), F.col("id").asc())
    )
    kept = raised.withColumn("rank", place).where(F.col("rank") <= limit)
    return kept.withColumn("rank", F.col("rank").cast("long"))


def preset_search(corpus: DataFrame, queries: DataFrame, preset: str, metric: str = "COSINE", **names) -> DataFrame:
    """Search under a named preset: a size, a threshold, or both (the size comes first)."""
    if preset not in PRESETS:
        raise ValueError(f"preset must be one of {', '.join(PRESETS)}")
    chosen = PRESETS[preset]
    least = chosen.get("min_similarity")
    if "limit" not in chosen:
        return range_search(corpus, queries, least, None, metric, **names)
    decimals = names.pop("decimals", SCORE_DECIMALS)
    hits = top_k(corpus, queries, chosen["limit"], metric, decimals=None, **names)
    return given_out(cut_similarity(hits, least), metric, decimals)
