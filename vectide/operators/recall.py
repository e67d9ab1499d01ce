"""Several ways to find candidates, and their fusion.

Lists are merged by unrounded scores, which are equal if twelve significant digits are;
scores are rounded when they are given out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectide.functions.containing import containing
from vectide.functions.text import tokens
from vectide.functions.vectors import SCORE_DECIMALS, check_metric, kernel, settled, similarity
from vectide.operators.bm25 import LIMIT, TextIndex, bm25_search, query_weights
from vectide.operators.embedding import Encoder, embed
from vectide.operators.nearest import attach_fields, rank_hits, search, top_k
from vectide.operators.postings import K1, B, impact
from vectide.operators.query_text import (
    MAX_EXPANSIONS,
    MAX_REWRITES,
    RULES,
    SYNONYMS,
    extract_keywords,
    rule_variants,
    synonym_variants,
)
from vectide.operators.trigrams import GramIndex, contains
from vectide.session import materialize
from vectide.sizing import BROADCAST_BYTES, HIT_BYTES, deal_out, fits, measure, spread_join

# How many candidates each path gives, and at which score.
DENSE_LIMIT = 50
KEYWORD_LIMIT, KEYWORD_SCORE = 20, 0.5
TITLE_LIMIT, TITLE_SCORE = 5, 0.9
MERGED_LIMIT = 10

# Weight and size of the searches with original, expanded and rewritten queries.
ORIGINAL = (1.0, 30)
EXPANDED = (0.8, 20)
REWRITTEN = (0.6, 15)

# Weights of dense and keyword scores.
VECTOR_WEIGHT, TEXT_WEIGHT = 0.7, 0.3


def _first(df: DataFrame, key: str, limit: int) -> DataFrame:
    """The lowest ids of each key, cut before and after the shuffle."""
    order = Window.partitionBy(key).orderBy("id")
    return df.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= limit).drop("_n")


def _rounded(score: Column, decimals: int | None) -> Column:
    return score if decimals is None else F.round(score, decimals)


def _few(keys: DataFrame, limit: int) -> bool:
    """Whether ``limit`` hits of each distinct key stay within the broadcast bound."""
    return measure(keys).bytes * limit <= BROADCAST_BYTES


def title_equals(corpus: DataFrame, queries: DataFrame, limit: int = TITLE_LIMIT, title_col="title") -> DataFrame:
    """Rows whose title is the query text: ``(qid, id)``, the lowest ids first.

    Titles are cut to ``limit`` rows each before the queries come in, so a title
    shared by many rows, or asked by many queries, cannot swell the join.
    """
    titles = corpus.where(F.col(title_col).isNotNull()).select(F.col(title_col).alias("query_text"), "id")
    asked = queries.where("query_text is not null").select("qid", "query_text")
    few = _few(asked.select("query_text"), limit)
    if few:
        titles = titles.join(F.broadcast(asked.select("query_text").distinct()), "query_text", "left_semi")
    return spread_join(asked, _first(titles, "query_text", limit), ["query_text"], "qid", small=few).select("qid", "id")


def title_contains(
    corpus: DataFrame, words: DataFrame, limit: int = KEYWORD_LIMIT, title_col="title", grams: GramIndex | None = None
) -> DataFrame:
    """Rows whose title contains a word, for a table ``(qid, word)``: ``(qid, id)``.

    All words are looked for at once where the titles lie, or with ``grams``, a trigram
    index of the titles, in candidates only. Each word keeps its lowest ids; only then do the
    queries come in.
    """
    few = _few(words.select("word"), limit)
    if grams is None:
        found = containing(deal_out(corpus.select("id", F.col(title_col).alias("text"))), words, first=limit)
    else:
        found = contains(grams, words, limit)
    return spread_join(words, _first(found, "word", limit), ["word"], "qid", small=few).select("qid", "id")


def keyword_search(
    corpus: DataFrame,
    queries: DataFrame,
    index: TextIndex | None = None,
    limit: int = LIMIT,
    text_col: str = "text",
    grams: GramIndex | None = None,
) -> DataFrame:
    """Keyword search of ``queries(qid, query_text)``: BM25 with an index, otherwise by containment.

    Without an index a row counts if its text contains one of the query's words anywhere,
    case aside; such rows have no score (0) and are ordered by id. ``grams``, a trigram index
    of the lower-cased texts, saves reading all of them.
    """
    if index is not None:
        return bm25_search(index, queries, limit)
    asked = queries.select("qid", F.explode_outer(F.array_distinct(tokens(F.col("query_text")))).alias("word"))
    asked = asked.where("word is not null")
    if grams is None:
        texts = deal_out(corpus.select("id", F.lower(F.col(text_col)).alias("text")))
        found = _first(containing(texts, asked, first=limit), "word", limit)
    else:
        found = _first(contains(grams, asked, limit), "word", limit)
    few = _few(asked.select("word"), limit)
    hits = spread_join(asked, found, ["word"], "qid", small=few).select("qid", "id").distinct()
    ranked = rank_hits(hits.withColumn("score", F.lit(0.0)), "IP", limit)
    return ranked.select("qid", "rank", "id", "score", F.col("score").alias("similarity"))


def multi_path(
    corpus: DataFrame,
    queries: DataFrame,
    dense_limit: int = DENSE_LIMIT,
    keyword_limit: int = KEYWORD_LIMIT,
    title_limit: int = TITLE_LIMIT,
    title_col: str = "title",
    vector_col: str = "vector",
    decimals: int | None = SCORE_DECIMALS,
) -> DataFrame:
    """Candidates ``(qid, id, source, path, score)`` by vector, first keyword in the title and exact title.

    ``queries`` holds ``qid, query_text, qv``. With ``decimals=None`` scores stay unrounded, for
    ``merge_paths`` to rank them.
    """
    dense = top_k(corpus, queries, dense_limit, "COSINE", vector_col=vector_col, decimals=decimals)
    first = extract_keywords(queries, limit=1).select("qid", F.get("keywords", F.lit(0)).alias("word"))
    by_word = title_contains(corpus, first.where("word is not null"), keyword_limit, title_col)
    by_title = title_equals(corpus, queries, title_limit, title_col)

    def path(df, name, number, score):
        return df.select("qid", "id", F.lit(name).alias("source"), F.lit(number).alias("path"), score.alias("score"))

    return (
        path(dense, "vector", 1, F.col("score"))
        .unionByName(path(by_word, "keyword", 2, F.lit(KEYWORD_SCORE)))
        .unionByName(path(by_title, "title", 3, F.lit(TITLE_SCORE)))
    )


def merge_paths(
    candidates: DataFrame, limit: int | None = MERGED_LIMIT, decimals: int | None = SCORE_DECIMALS
) -> DataFrame:
    """One row per ``(qid, id)`` with its best score; equal scores go to the earlier path.

    Scores are compared as they come and rounded afterwards.
    """
    best = F.max(F.struct(settled(F.col("score")).alias("score"), (-F.col("path")).alias("_late"), F.col("source"))).alias("_best")
    merged = (
        candidates.where("id is not null")
        .groupBy("qid", "id")
        .agg(best)
        .select("qid", "id", "_best.source", "_best.score")
    )
    if limit is None:
        return merged.withColumn("score", _rounded(F.col("score"), decimals))
    similarity = _rounded(F.col("score"), decimals).alias("similarity")
    return rank_hits(merged, "IP", limit).select("qid", "rank", "id", "source", similarity)


def expansion_variants(queries, synonyms=SYNONYMS, rules=RULES) -> DataFrame:
    """Every text to search with: ``(qid, variant, weight, size, variant_text)``."""
    text = F.col("query_text")

    def tagged(texts, weight, size):
        return F.transform(
            texts,
            lambda t: F.struct(t.alias("variant_text"), F.lit(weight).alias("weight"), F.lit(size).alias("size")),
        )

    variants = F.concat(
        tagged(F.array(text), *ORIGINAL),
        tagged(synonym_variants(text, synonyms, MAX_EXPANSIONS), *EXPANDED),
        tagged(rule_variants(text, rules, MAX_REWRITES), *REWRITTEN),
    )
    rows = queries.select("qid", F.posexplode_outer(variants).alias("variant", "v"))
    return rows.where("v.variant_text is not null").select("qid", "variant", "v.weight", "v.size", "v.variant_text")


def expansion_recall(
    corpus: DataFrame,
    queries: DataFrame,
    encoder: Encoder,
    synonyms=SYNONYMS,
    rules=RULES,
    limit: int = MERGED_LIMIT,
    metric: str = "COSINE",
    vector_col: str = "vector",
    decimals: int | None = SCORE_DECIMALS,
) -> DataFrame:
    """Search with the query, its synonyms and its rewrites; best weighted similarity per row.

    Equal texts are embedded and searched once.
    """
    variants = expansion_variants(queries, synonyms, rules)
    # The search carries a hash of the text, so the size of texts does not matter to it.
    variants = variants.withColumn("text_key", F.sha2("variant_text", 256))
    texts = variants.select(F.col("text_key").alias("qid"), "variant_text").dropDuplicates(["qid"])
    variants = variants.drop("variant_text")
    # Written once: the search first counts its queries, and a model should not run twice.
    asked = materialize(embed(texts, "variant_text", encoder, vector_col="qv").select("qid", "qv"))
    most = max(size for _, size in (ORIGINAL, EXPANDED, REWRITTEN))
    hits = top_k(corpus, asked, most, metric, vector_col=vector_col, decimals=None).withColumnRenamed("qid", "text_key")
    # A text that a third of all queries share is searched once and handed out in slices.
    few = measure(asked.select("qid")).bytes * most <= BROADCAST_BYTES
    weighted = (
        spread_join(variants, hits, ["text_key"], "qid", small=few)
        .where(F.col("rank") <= F.col("size"))
        .groupBy("qid", "id")
        .agg(F.max(settled(F.col("weight") * F.col("similarity"))).alias("score"))
    )
    similarity = _rounded(F.col("score"), decimals).alias("similarity")
    return rank_hits(weighted, "IP", limit).select("qid", "rank", "id", similarity)


def fuse(
    dense: DataFrame,
    keyword: DataFrame,
    limit: int = 10,
    vector_weight: float = VECTOR_WEIGHT,
    text_weight: float = TEXT_WEIGHT,
    decimals: int | None = None,
) -> DataFrame:
    """Weighted sum of dense similarities and keyword scores scaled by each query's best.

    A row that one side lacks counts 0 there.
    """
    best = F.max("score").over(Window.partitionBy("qid"))
    texts = keyword.select("qid", "id", F.coalesce(F.try_divide(F.col("score"), best), F.lit(0.0)).alias("text_score"))
    vectors = dense.select("qid", "id", F.coalesce("similarity", F.lit(0.0)).alias("vector_score"))
    both = vectors.join(texts, ["qid", "id"], "full_outer").fillna(0.0, ["vector_score", "text_score"])
    total = F.col("vector_score") * float(vector_weight) + F.col("text_score") * float(text_weight)
    scored = both.withColumn("score", settled(total))
    return _fused(rank_hits(scored, "IP", limit), decimals)


def _fused(ranked: DataFrame, decimals: int | None) -> DataFrame:
    scores = [_rounded(F.col(c), decimals).alias(c) for c in ("vector_score", "text_score", "score")]
    return ranked.select("qid", "rank", "id", *scores)


def hybrid_search(
    corpus: DataFrame,
    index: TextIndex,
    queries: DataFrame,
    limit: int = 10,
    vector_weight: float = VECTOR_WEIGHT,
    text_weight: float = TEXT_WEIGHT,
    candidates: int = DENSE_LIMIT,
    metric: str = "COSINE",
    vector_col: str = "vector",
    filter: str | None = None,
    output_fields=None,
    decimals: int | None = SCORE_DECIMALS,
) -> DataFrame:
    """Dense and keyword search of ``queries(qid, query_text, qv)``, fused.

    ``candidates`` rows of each side decide; ``hybrid_exact`` needs no such number. ``filter``
    restricts the rows of both sides; hits carry ``output_fields`` of the corpus.
    """
    dense = search(corpus, queries, candidates, metric, filter, anns_field=vector_col, decimals=None)
    keyword = bm25_search(index, queries, candidates, corpus=corpus if filter else None, filter=filter)
    return attach_fields(fuse(dense, keyword, limit, vector_weight, text_weight, decimals), corpus, output_fields)


def _pair_scores(
    corpus: DataFrame, index: TextIndex, queries: DataFrame, pairs: DataFrame, words: DataFrame, n_pairs: int, metric: str, vector_col: str, k1: float, b: float
) -> DataFrame:
    """``qid, id, vector_score, text_score`` of given pairs, the keyword score not yet scaled; 0 where a side is missing.

    Pairs come in bounded number for each query. Both scores are looked up by id, so a row
    that one list lacks is scored like all others.
    """
    small = n_pairs * HIT_BYTES <= BROADCAST_BYTES
    pairs = F.broadcast(pairs) if small else pairs
    asked = queries.select("qid", "qv")
    asked = F.broadcast(asked) if fits(asked) else asked
    rows = corpus.select("id", F.col(vector_col).alias("vector"))
    alike = similarity(metric, kernel(metric, F.col("qv"), F.col("vector")))
    # Vectors of another length, and scores that do not exist, count 0.
    alike = F.when(F.size("qv") == F.size("vector"), F.nanvl(alike, F.lit(0.0)))
    dense = rows.join(pairs, "id").join(asked, "qid").select("qid", "id", F.coalesce(alike, F.lit(0.0)).alias("vector_score"))
    totals = index.totals.first()
    mean = float(totals["avg_dl"] or 1.0)
    by_query = words.groupBy("qid").agg(F.map_from_entries(F.collect_list(F.struct("term", "w"))).alias("words"))
    by_query = F.broadcast(by_query) if fits(words) else by_query
    weight = lambda t: F.coalesce(F.element_at("words", t["term"]), F.lit(0.0))
    value = F.aggregate("terms", F.lit(0.0), lambda total, t: total + weight(t) * impact(t["tf"], F.col("dl"), k1, b, mean))
    held = index.rows.select("id", "dl", "terms").join(pairs, "id").join(by_query, "qid")
    texts = held.select("qid", "id", F.round(value, SCORE_DECIMALS).alias("text_score"))
    return dense.join(texts, ["qid", "id"], "full_outer").fillna(0.0, ["vector_score", "text_score"])


def hybrid_exact(
    corpus: DataFrame,
    index: TextIndex,
    queries: DataFrame,
    limit: int = 10,
    vector_weight: float = VECTOR_WEIGHT,
    text_weight: float = TEXT_WEIGHT,
    start: int = DENSE_LIMIT,
    metric: str = "COSINE",
    vector_col: str = "vector",
    output_fields=None,
    decimals: int | None = SCORE_DECIMALS,
) -> DataFrame:
    """The best rows by the weighted sum over *all* rows, by the threshold algorithm.

    Both lists are read to a depth, what they hold is scored on both sides, and the last
    scores of the lists bound what any row beyond them can reach. Queries whose
    ``limit``-th row reaches that bound are done; for the others the depth doubles. A row
    without a vector, or without one of the words, counts 0 on that side; keyword scores
    are scaled by the query's best. Weights must not be negative.
    """
    if vector_weight < 0 or text_weight < 0:
        raise ValueError("weights must not be negative")
    metric = check_metric(metric)
    k1, b = K1, B
    queries = materialize(queries.select("qid", "query_text", "qv"))
    words = materialize(query_weights(index, queries))
    n_rows = max(corpus.count(), index.totals.first()["n_docs"])
    open_, depth, done = queries, max(start, limit), []
    while True:
        n_open = open_.count()
        if not n_open:
            break
        dense = materialize(search(corpus, open_, depth, metric, anns_field=vector_col, decimals=None))
        keyword = materialize(bm25_search(index, open_, depth))
        pairs = materialize(dense.select("qid", "id").unionByName(keyword.select("qid", "id")).distinct())
        asked = words.join(open_.select("qid"), "qid", "left_semi")
        both = _pair_scores(corpus, index, open_, pairs, asked, 2 * n_open * depth, metric, vector_col, k1, b)
        best = keyword.groupBy("qid").agg(
            F.max("score").alias("best"), F.min("score").alias("text_last"), F.count(F.lit(1)).alias("n_text")
        )
        scaled = F.coalesce(F.try_divide(F.col("text_score"), F.col("best")), F.lit(0.0))
        both = both.join(best.select("qid", "best"), "qid", "left").withColumn("text_score", scaled)
        total = F.col("vector_score") * float(vector_weight) + F.col("text_score") * float(text_weight)
        ranked = materialize(rank_hits(both.withColumn("score", settled(total)), "IP", limit))
        if depth >= n_rows:
            done.append(ranked.select("qid", "rank", "id", "vector_score", "text_score", "score"))
            break
        # The most a row can have that neither list shows. Without a vector it counts 0.
        ends = dense.groupBy("qid").agg(F.min(F.coalesce("similarity", F.lit(0.0))).alias("last"), F.count(F.lit(1)).alias("n_dense"))
        vector_most = F.when(F.col("n_dense") >= depth, F.greatest("last", F.lit(0.0))).otherwise(F.lit(0.0))
        text_most = F.when(F.col("n_text") >= depth, F.col("text_last") / F.col("best")).otherwise(F.lit(0.0))
        most = F.coalesce(vector_most, F.lit(0.0)) * float(vector_weight) + F.coalesce(text_most, F.lit(0.0)) * float(text_weight)
        reached = ranked.groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
        state = open_.select("qid").distinct().join(ends, "qid", "left").join(best, "qid", "left").join(reached, "qid", "left")
        # Ties at the bound may be won by a lower id beyond it.
        closed = (F.col("n") >= limit) & (F.col("least") > most + 10.0**-SCORE_DECIMALS)
        state = materialize(state.select("qid", F.coalesce(closed, F.lit(False)).alias("closed")))
        over = state.where("closed").select("qid")
        done.append(ranked.join(over, "qid", "left_semi").select("qid", "rank", "id", "vector_score", "text_score", "score"))
        open_ = materialize(open_.join(state.where("not closed").select("qid"), "qid", "left_semi"))
        depth *= 2
    empty = queries.sparkSession.createDataFrame([], _fused_schema(corpus, queries))
    found = reduce(DataFrame.unionByName, done) if done else empty
    return attach_fields(_fused(found, decimals), corpus, output_fields)


def _fused_schema(corpus: DataFrame, queries: DataFrame) -> T.StructType:
    scores = [T.StructField(c, T.DoubleType()) for c in ("vector_score", "text_score", "score")]
    ends = [T.StructField("qid", queries.schema["qid"].dataType), T.StructField("rank", T.LongType()), T.StructField("id", corpus.schema["id"].dataType)]
    return T.StructType(ends + scores)

