"""Keyword search: sparse term vectors and BM25 over a table of query texts.

The index keeps one row per text, ``(id, dl, terms)``, and the text count of each
term. A search scans the rows once without moving them: the texts of a batch are scored
against all queries at once where they lie, and only the best k per query and task are
shuffled.

A stored index also holds postings by term (``postings.py``); a search then reads only
the blocks of the asked words that can hold one of the best k texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from vectide.functions.kernels import MERGE_AT, PAIRS_PER_STEP, id_values
from vectide.functions.predicates import predicate
from vectide.functions.text import term_counts, tokens
from vectide.functions.vectors import SCORE_DECIMALS
from vectide.operators.nearest import attach_fields, cut_similarity, rank_hits
from vectide.operators.postings import K1, SLICE_TEXTS, B, Blocks, blocks_of, place_texts, slices_of, term_hits
from vectide.session import materialize
from vectide.sizing import BROADCAST_BYTES, Size, broadcast_if_small, deal_out, measure

# Fixed value: the number of hits.
LIMIT = 10


@dataclass(frozen=True)
class TextIndex:
    """``rows(id, dl, terms)``, ``terms(term, df)`` and one row of totals; of a stored index also its postings."""

    rows: DataFrame
    terms: DataFrame
    totals: DataFrame
    blocks: Blocks | None = None


def postings(rows: DataFrame) -> DataFrame:
    """One row per text and term: ``(id, dl, term, tf)``.

    The outer form keeps the optimizer from adding a filter on the array, which
    would count every text again below the explode.
    """
    held = rows.select("id", "dl", F.explode_outer("terms").alias("p")).where("p is not null")
    return held.select("id", "dl", "p.term", "p.tf")


def index_rows(docs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """The sparse vector of each text, counted inside the text's own row."""
    return term_counts(deal_out(docs.select(id_col, text_col)), id_col, text_col)


def statistics(rows: DataFrame) -> DataFrame:
    """Number of texts, mean length and the number of terms held."""
    return rows.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.avg("dl").alias("avg_dl"),
        F.sum(F.size("terms")).cast("long").alias("n_postings"),
    )


def _index(rows: DataFrame) -> TextIndex:
    terms = postings(rows).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return TextIndex(rows, terms, statistics(rows))


def build_index(docs: DataFrame, id_col: str = "id", text_col: str = "text") -> TextIndex:
    """Count all texts once; the counted rows are written to the shared folder."""
    return _index(materialize(index_rows(docs, id_col, text_col)))


def store_index(
    docs: DataFrame,
    table: str,
    buckets: int,
    id_col: str = "id",
    text_col: str = "text",
    path: str | None = None,
    slice_texts: int = SLICE_TEXTS,
) -> None:
    """Write the index as tables: rows bucketed by id, document counts bucketed by term, totals and postings by term."""

    def write(df: DataFrame, name: str, key: str | None = None, part: str | None = None) -> None:
        writer = df.write.mode("overwrite").format("parquet")
        writer = writer.bucketBy(buckets, key).sortBy(key) if key else writer
        writer = writer.partitionBy(part) if part else writer
        writer = writer.option("path", f"{path}/{name}") if path else writer
        writer.saveAsTable(name)

    spark = docs.sparkSession
    # All texts of a bucket in one task, so each bucket is one file.
    write(index_rows(docs, id_col, text_col).repartition(buckets, "id"), f"{table}_rows", "id")
    rows = spark.table(f"{table}_rows")
    write(statistics(rows), f"{table}_totals")
    placed = place_texts(rows, slice_texts)
    write(slices_of(placed), f"{table}_slices")
    mean = spark.table(f"{table}_totals").first()["avg_dl"] or 1.0
    write(blocks_of(placed, buckets, mean), f"{table}_postings", part="part")
    # Blocks know their numbers of texts, so the postings are not counted again.
    terms = spark.table(f"{table}_postings").groupBy("term").agg(F.sum("n").alias("df"))
    write(terms.repartition(buckets, "term"), f"{table}_terms", "term")


def load_index(spark: SparkSession, table: str) -> TextIndex:
    held = spark.table(f"{table}_postings")
    blocks = Blocks(held, spark.table(f"{table}_slices"))
    return TextIndex(spark.table(f"{table}_rows"), spark.table(f"{table}_terms"), spark.table(f"{table}_totals"), blocks)


def query_terms(queries: DataFrame, qid_col: str = "qid", text_col: str = "query_text") -> DataFrame:
    """``(qid, term, qtf)``; a word asked twice counts twice."""
    words = queries.select(F.col(qid_col).alias("qid"), F.explode_outer(tokens(F.col(text_col))).alias("term"))
    return words.where("term is not null").groupBy("qid", "term").agg(F.count(F.lit(1)).alias("qtf"))


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(1.0 + (n_docs - df + 0.5) / (df + 0.5))


class Weights:
    """Query words prepared for scoring: for each word the queries that ask it and its weight there."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.ids = pc.unique(table["qid"])
        self.words = pc.unique(table["term"])
        query = pc.index_in(table["qid"], value_set=self.ids).to_numpy()
        word = pc.index_in(table["term"], value_set=self.words).to_numpy()
        order = np.argsort(word, kind="stable")
        self.query, self.weight = query[order].astype(np.int64), table["w"].to_numpy()[order]
        self.count = np.bincount(word, minlength=len(self.words))
        self.first = np.cumsum(self.count) - self.count

    def scores(self, batch: pa.RecordBatch, k1: float, b: float, mean: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of some rows and their scores by all queries, 0 where they share no word."""
        lists, n = batch["terms"], batch.num_rows
        flat = lists.flatten()
        word = pc.fill_null(pc.index_in(pc.struct_field(flat, "term"), value_set=self.words), -1).to_numpy(zero_copy_only=False)
        tf = pc.struct_field(flat, "tf").to_numpy(zero_copy_only=False).astype(np.float64)
        row = np.repeat(np.arange(n), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        asked = word >= 0
        word, tf, row = word[asked], tf[asked], row[asked]
        dl = batch["dl"].to_numpy(zero_copy_only=False).astype(np.float64)[row]
        part = tf * (k1 + 1.0) / (tf + k1 * (1.0 - b + b * dl / mean))
        most = max(1, PAIRS_PER_STEP // len(self.ids))
        times = self.count[word]
        # Words of the first rows, times the queries that ask them.
        upto = np.cumsum(times)
        ends = np.searchsorted(row, np.arange(n + 1))
        start = 0
        while start < n:
            # As many rows as have few enough pairs with queries, and few enough shared words with them; at least one.
            low = ends[start]
            before = upto[low - 1] if low else 0
            stop = int(np.searchsorted(ends, np.searchsorted(upto, before + PAIRS_PER_STEP, side="right"), side="right")) - 1
            stop = min(max(stop, start + 1), start + most, n)
            rows, high = stop - start, ends[stop]
            if low < high:
                some = times[low:high]
                at = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
                at += np.repeat(self.first[word[low:high]], some)
                cell = (np.repeat(row[low:high], some) - start) * len(self.ids) + self.query[at]
                total = np.bincount(cell, np.repeat(part[low:high], some) * self.weight[at], rows * len(self.ids))
                yield np.arange(start, stop), np.round(total, SCORE_DECIMALS).reshape(rows, -1)
            start = stop


class Best:
    """The best k texts of every query over the batches of a task, ties to the lower id."""

    def __init__(self, k: int):
        self.k, self.held, self.new = k, None, []

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        bar = np.zeros(scores.shape[1])
        if len(ids) > self.k:
            bar = np.partition(scores, len(ids) - self.k, axis=0)[len(ids) - self.k]
        row, query = np.nonzero((scores >= bar) & (scores > 0))
        self.new.append((query, scores[row, query], ids[row]))
        if sum(len(x[0]) for x in self.new) > MERGE_AT:
            self.merge()

    def merge(self) -> None:
        parts = [p for p in [self.held, *self.new] if p is not None]
        self.new = []
        if not parts:
            return
        query, score, ids = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        keep = np.arange(len(query)) - np.searchsorted(query, query) < self.k
        self.held = (query[keep], score[keep], ids[keep])


def _scan(
    rows: DataFrame, weights: DataFrame, schema: T.StructType, k: int, k1: float, b: float, mean: float
) -> tuple[DataFrame, Broadcast]:
    """Score the texts of every task in place against a bounded table of query words; also what was sent."""
    table = weights.toArrow()
    shared = rows.sparkSession.sparkContext.broadcast(table)
    id_type = to_arrow_type(schema["id"].dataType)

    def run(batches):
        if not len(shared.value):
            return
        prepared, best = Weights(shared.value), Best(k)
        for batch in batches:
            if batch.num_rows:
                ids = id_values(batch["id"])
                for places, scores in prepared.scores(batch, k1, b, mean):
                    best.add(ids[places], scores)
        best.merge()
        if best.held is not None:
            query, score, ids = best.held
            found = pa.array(ids.tolist() if ids.dtype.kind == "U" else ids).cast(id_type)
            yield pa.RecordBatch.from_arrays([prepared.ids.take(pa.array(query)), found, pa.array(score)], ["qid", "id", "score"])

    return rows.select("id", "dl", "terms").mapInArrow(run, schema), shared


def _weights(index: TextIndex, asked: DataFrame, small: bool, n_docs: int) -> DataFrame:
    """``qid, term, w``: what a word that some text holds is worth to a query."""
    vocabulary = asked.select("term").distinct()
    known = index.terms.join(F.broadcast(vocabulary) if small else vocabulary, "term", "left_semi")
    worth = F.col("qtf") * idf(F.lit(float(n_docs)), F.col("df").cast("double"))
    return asked.join(known, "term").select("qid", "term", worth.alias("w"))


def query_weights(index: TextIndex, queries: DataFrame) -> DataFrame:
    """``qid, term, w`` of a table of query texts."""
    asked = query_terms(queries)
    return _weights(index, asked, measure(asked).bytes <= BROADCAST_BYTES, index.totals.first()["n_docs"] or 0)


def bm25_hits(
    index: TextIndex,
    asked: DataFrame,
    size: Size,
    k: int,
    k1: float = K1,
    b: float = B,
    candidates: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(qid, id, score)``: of every task the best ``k`` texts of each query.

    ``asked`` and ``size`` are the query words and their measured size. With postings by
    term only blocks of the asked words are read. Otherwise a table above the bound is
    cut into blocks of queries, each of which is a scan of its own: texts never move. ``candidates(id)`` restricts the texts, never the statistics.
    """
    small = size.bytes <= broadcast_bytes
    totals = index.totals.first()
    schema = T.StructType(
        [T.StructField("qid", asked.schema["qid"].dataType), T.StructField("id", index.rows.schema["id"].dataType), T.StructField("score", T.DoubleType())]
    )
    if not totals["n_docs"]:
        return asked.sparkSession.createDataFrame([], schema)
    mean = float(totals["avg_dl"]) or 1.0
    weights = _weights(index, asked, small, totals["n_docs"])
    if index.blocks is not None:
        return term_hits(index.blocks, weights, schema, k, float(k1), float(b), mean, candidates)[0]
    rows = index.rows
    if candidates is not None:
        # The ids alone decide; sent to the rows where they are few.
        rows = rows.join(broadcast_if_small(candidates.distinct(), measured=candidates), "id", "left_semi")
    if small:
        return _scan(rows, weights, schema, k, float(k1), float(b), mean)[0]
    # One scan for each block of queries, one after another: the driver holds one block at a time.
    n_blocks = min(size.rows, -(-size.bytes // max(1, broadcast_bytes)))
    kept = materialize(weights.withColumn("_block", F.pmod(F.xxhash64("qid"), F.lit(n_blocks))))
    parts = []
    for n in range(n_blocks):
        hits, shared = _scan(rows, kept.where(F.col("_block") == n).drop("_block"), schema, k, float(k1), float(b), mean)
        parts.append(materialize(hits))
        shared.destroy()
    return reduce(DataFrame.unionByName, parts)


def bm25_search(
    index: TextIndex,
    queries: DataFrame,
    limit: int = LIMIT,
    k1: float = K1,
    b: float = B,
    corpus: DataFrame | None = None,
    filter: str | Column | None = None,
    output_fields=None,
    min_similarity: float | None = None,
    id_col: str = "id",
    qid_col: str = "qid",
    text_col: str = "query_text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Best texts per query as ``(qid, rank, id, score, similarity)``.

    ``filter`` and ``output_fields`` refer to ``corpus``, the table the index was built from.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    if corpus is None and (filter is not None or output_fields):
        raise ValueError("a filter and output fields need the corpus they refer to")
    candidates = None
    if filter is not None:
        candidates = corpus.where(predicate(filter)).select(F.col(id_col).alias("id"))
    asked = query_terms(queries, qid_col, text_col)
    size = measure(asked)
    found = bm25_hits(index, asked, size, limit, k1, b, candidates, broadcast_bytes)
    hits = rank_hits(found, "IP", limit).select(
        "qid", "rank", "id", "score", F.col("score").alias("similarity")
    )
    hits = cut_similarity(hits, min_similarity)
    if corpus is None:
        return hits
    # At least one row of query words per query.
    return attach_fields(hits, corpus, output_fields, id_col, size.rows * limit)


def keyword_match(
    docs: DataFrame, words: list[str], limit: int = LIMIT, id_col: str = "id", text_col: str = "text"
) -> DataFrame:
    """Texts that contain a word, by id: the fallback where no sparse field exists.

    ``(term, rank, id)``; the words are a parameter, checked in the row itself.
    """
    wanted = [w.strip().lower() for w in words if w and w.strip()]
    if not wanted:
        raise ValueError("at least one word is required")
    text = F.lower(F.col(text_col))
    found = F.array_compact(F.array(*[F.when(F.contains(text, F.lit(w)), F.lit(w)) for w in dict.fromkeys(wanted)]))
    hits = docs.select(F.col(id_col).alias("id"), F.explode_outer(found).alias("qid")).where("qid is not null")
    hits = hits.withColumn("score", F.lit(0.0))
    return rank_hits(hits, "IP", limit).select(F.col("qid").alias("term"), "rank", "id")
