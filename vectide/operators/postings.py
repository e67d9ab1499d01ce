"""Postings by term, in blocks that know the most they can add to a score.

Texts are dealt into slices of ``SLICE_TEXTS`` texts of about equal length. A block holds
the postings of one term in one slice: places within the slice and counts, and the
highest impact among them, the BM25 weight of a posting before the idf. Blocks lie in
folders by the hash of their term, so a search reads the folders of the asked words and
of these the rows of the words themselves.

A slice cannot give a query more than the sum of the highest impacts of its words there.
The search first scores the slices with the highest such bounds; the k-th best score
found so far is a bar, and slices whose bound is below it are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from vectide.functions.kernels import id_values
from vectide.functions.vectors import SCORE_DECIMALS
from vectide.session import materialize
from vectide.sizing import BROADCAST_BYTES, broadcast_if_small, measure, spread_join

# BM25 parameters.
K1, B = 1.2, 0.75

# Texts of a slice, and slices of each query that are scored before the bar is set.
SLICE_TEXTS = 1024
FIRST_SLICES = 4
# Postings of a slice that one task holds at once.
SLICE_POSTINGS = 4_000_000
# Words that a filter names; more are sent as a table.
NAMED_WORDS = 1000
# Bytes of query words that meet a slice in one task.
QUERY_BYTES = 16 * 1024 * 1024
# Bounds and scores are compared with this much slack: scores are rounded.
SLACK = 10.0**-SCORE_DECIMALS


@dataclass(frozen=True)
class Blocks:
    """``postings(term, slice, places, tfs, n, top, max_tf, min_dl, part)`` and ``slices(slice, ids, dls)``."""

    postings: DataFrame
    slices: DataFrame

    @property
    def parts(self) -> int:
        row = self.postings.select("parts").first()
        return row["parts"] if row else 1


def impact(tf: Column, dl: Column, k1: float, b: float, mean: float) -> Column:
    """What a posting adds to a score for each unit of the word's weight."""
    tf = tf.cast("double")
    return tf * (k1 + 1.0) / (tf + k1 * (1.0 - b + b * dl.cast("double") / mean))


def place_texts(rows: DataFrame, slice_texts: int = SLICE_TEXTS) -> DataFrame:
    """``slice, place, id, dl, terms``: texts in the order of their length, numbered through."""
    ordered = rows.repartitionByRange("dl", F.xxhash64("id")).sortWithinPartitions("dl", F.xxhash64("id"), "id")
    at = F.monotonically_increasing_id()
    held = materialize(ordered.withColumn("at", at).withColumn("held", F.greatest(F.size("terms"), F.lit(0))))
    row = F.col("at").bitwiseAND((1 << 33) - 1)
    slices = F.shiftright("at", 33) * (1 << 24) + F.floor(row / slice_texts)
    return held.select(slices.alias("slice"), (row % slice_texts).cast("int").alias("place"), "id", "dl", "terms", "held")


def slices_of(placed: DataFrame) -> DataFrame:
    """``slice, ids, dls``: the texts of each slice in the order of their places."""
    texts = F.sort_array(F.collect_list(F.struct("place", "id", "dl")))
    held = placed.groupBy("slice").agg(texts.alias("t"))
    return held.select("slice", F.col("t.id").alias("ids"), F.col("t.dl").alias("dls"))


def part_of(term: Column, parts: Column) -> Column:
    return F.pmod(F.xxhash64(term), parts).cast("int")


def _inverted(placed: DataFrame, mean: float) -> DataFrame:
    """Blocks of bounded slices: a task inverts one slice at a time, so texts move and not their postings."""

    def invert(table: pa.Table) -> pa.Table:
        lists = table["terms"].combine_chunks()
        flat = lists.flatten()
        row = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        terms = pc.struct_field(flat, "term").dictionary_encode()
        code = terms.indices.to_numpy()
        place, dl = (table[c].to_numpy()[row] for c in ("place", "dl"))
        order = np.lexsort((place, code))
        code, place, dl = code[order], place[order], dl[order]
        tf = pc.struct_field(flat, "tf").to_numpy(zero_copy_only=False)[order]
        most = tf * (K1 + 1.0) / (tf + K1 * (1.0 - B + B * dl / mean))
        first = np.flatnonzero(np.diff(code, prepend=-1))
        offsets = pa.array(np.append(first, len(code)), pa.int32())
        lists_of = lambda values: pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))
        best = lambda values: np.maximum.reduceat(values, first) if len(first) else values
        columns = {
            "term": terms.dictionary.take(pa.array(code[first])),
            "slice": pa.array(np.full(len(first), table["slice"][0].as_py(), np.int64)),
            "places": lists_of(place),
            "tfs": lists_of(tf),
            "n": pa.array(np.diff(np.append(first, len(code))), pa.int32()),
            "top": pa.array(best(most)),
            "max_tf": pa.array(best(tf), pa.int32()),
            "min_dl": pa.array(-best(-dl)),
        }
        return pa.table(columns)

    shape = "term string, slice long, places array<int>, tfs array<int>, n int, top double, max_tf int, min_dl long"
    return placed.select("slice", "place", "dl", "terms").groupBy("slice").applyInArrow(invert, shape)


def _collected(placed: DataFrame, mean: float) -> DataFrame:
    """The same blocks from a shuffle of all postings, however large a slice is."""
    flat = placed.select("slice", "place", "dl", F.explode_outer("terms").alias("t")).where("t is not null")
    entry = F.struct("place", F.col("t.tf").alias("tf"), "dl")
    held = flat.groupBy(F.col("t.term").alias("term"), "slice").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    return held.select(
        "term",
        "slice",
        F.col("e.place").alias("places"),
        F.transform("e", lambda x: x["tf"].cast("int")).alias("tfs"),
        F.size("e").alias("n"),
        F.array_max(F.transform("e", lambda x: impact(x["tf"], x["dl"], K1, B, mean))).alias("top"),
        F.array_max("e.tf").cast("int").alias("max_tf"),
        F.array_min("e.dl").alias("min_dl"),
    )


def blocks_of(placed: DataFrame, parts: int, mean: float, slice_postings: int = SLICE_POSTINGS) -> DataFrame:
    """The blocks, at most one for each term and slice, in the order in which they are written."""
    largest = placed.groupBy("slice").agg(F.sum("held").alias("n")).agg(F.max("n")).first()[0] or 0
    blocks = _inverted(placed, mean) if largest <= slice_postings else _collected(placed, mean)
    # Written once: dealing them out by ranges reads them twice.
    blocks = materialize(blocks).select("*", F.lit(parts).alias("parts"), part_of(F.col("term"), F.lit(parts)).alias("part"))
    # A term of most texts may fill several files of its folder; words stand together in each.
    return blocks.repartitionByRange("part", "term", "slice").sortWithinPartitions("part", "term", "slice")


def asked_blocks(blocks: Blocks, weights: DataFrame) -> DataFrame:
    """The blocks of the asked words: by folder, and by word within."""
    words = weights.select("term").distinct()
    size = measure(words)
    parts = F.lit(blocks.parts)
    if size.rows <= NAMED_WORDS:
        named = words.select("term", part_of(F.col("term"), parts).alias("part")).collect()
        in_folder = F.col("part").isin(sorted({r["part"] for r in named}))
        return blocks.postings.where(in_folder & F.col("term").isin(sorted(r["term"] for r in named)))
    asked = words.withColumn("part", part_of(F.col("term"), parts))
    asked = F.broadcast(asked) if size.bytes <= BROADCAST_BYTES else asked
    return blocks.postings.join(asked, ["part", "term"], "left_semi")


def bounds(held: DataFrame, weights: DataFrame, k1: float, b: float, mean: float) -> DataFrame:
    """``qid, slice, bound, words``: the most a slice can give a query; no postings are read."""
    # The stored impact holds for the usual parameters; for others the longest count meets the shortest text.
    most = F.col("top") if (k1, b) == (K1, B) else impact(F.col("max_tf"), F.col("min_dl"), k1, b, mean)
    tops = held.select("term", "slice", most.alias("most"))
    small = measure(weights).bytes <= BROADCAST_BYTES
    both = spread_join(tops, weights, ["term"], "slice", small=small)
    return both.groupBy("qid", "slice").agg(F.sum(F.col("w") * F.col("most")).alias("bound"), F.count(F.lit(1)).alias("words"))


def _score(
    blocks: Blocks, held: DataFrame, weights: DataFrame, pairs: DataFrame, schema, k: int, k1: float, b: float, mean: float, allowed: DataFrame | None
) -> DataFrame:
    """Best ``k`` texts of each query and slice, for the pairs ``qid, slice``; a task meets the texts of one slice."""
    size = measure(weights)
    # Very many queries meet a slice in several tasks.
    n_groups = max(1, -(-size.bytes // QUERY_BYTES))
    group = F.pmod(F.xxhash64("qid"), F.lit(n_groups)).cast("int")
    asked = pairs.select("qid", "slice").join(broadcast_if_small(weights, measured=weights), "qid").withColumn("g", group)
    needed = asked.select("slice", "term", "g").distinct()
    lists = held.select("term", "slice", "places", "tfs").join(needed, ["slice", "term"])
    texts = blocks.slices.join(asked.select("slice", "g").distinct(), "slice")
    if allowed is not None:
        texts = texts.join(allowed, "slice")
    else:
        texts = texts.withColumn("open", F.lit(None).cast("array<int>"))
    id_list = blocks.slices.schema["ids"].dataType.simpleString()
    none = lambda kind: F.lit(None).cast(kind)
    left = texts.select("slice", "g", none("string").alias("term"), none("array<int>").alias("places"), none("array<int>").alias("tfs"), "ids", "dls", "open").unionByName(
        lists.select("slice", "g", "term", "places", "tfs", none(id_list).alias("ids"), none("array<long>").alias("dls"), none("array<int>").alias("open"))
    )
    qid_type, id_type = (to_arrow_type(schema[c].dataType) for c in ("qid", "id"))
    empty = to_arrow_schema(schema).empty_table()

    def meet(a: pa.Table, b_: pa.Table) -> pa.Table:
        if not len(b_):
            return empty
        impacts: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        rows = a.to_batches()
        for batch in rows:
            for i in range(batch.num_rows):
                if batch["term"][i].as_py() is None:
                    ids, dls = batch["ids"][i].values, batch["dls"][i].values.to_numpy().astype(np.float64)
                    opened = batch["open"][i]
        if not a["ids"].drop_null():
            return empty
        mask = np.ones(len(dls), bool)
        if opened.is_valid:
            mask[:] = False
            mask[opened.values.to_numpy()] = True
        norm = k1 * (1.0 - b + b * dls / mean)
        for batch in rows:
            for i in range(batch.num_rows):
                term = batch["term"][i].as_py()
                if term is not None:
                    at, tf = batch["places"][i].values.to_numpy(), batch["tfs"][i].values.to_numpy().astype(np.float64)
                    impacts[term] = (at, tf * (k1 + 1.0) / (tf + norm[at]))
        names = id_values(ids)
        found: dict[object, np.ndarray] = {}
        for qid, term, w in zip(b_["qid"].to_pylist(), b_["term"].to_pylist(), b_["w"].to_numpy()):
            total = found.setdefault(qid, np.zeros(len(dls)))
            at, part = impacts[term] if term in impacts else (np.zeros(0, np.int64), np.zeros(0))
            total[at] += w * part
        q, place, value = [], [np.zeros(0, np.int64)], [np.zeros(0)]
        for qid, total in found.items():
            total = np.round(total, SCORE_DECIMALS)
            hit = np.flatnonzero(mask & (total > 0))
            best = hit[np.lexsort((names[hit], -total[hit]))[:k]]
            q += [qid] * len(best)
            place.append(best)
            value.append(total[best])
        return pa.table([pa.array(q, qid_type), ids.take(pa.array(np.concatenate(place))).cast(id_type), pa.array(np.concatenate(value))], names=["qid", "id", "score"])

    right = asked.select(F.col("slice").alias("_slice"), F.col("g").alias("_g"), "qid", "term", "w")
    return left.groupBy("slice", "g").cogroup(right.groupBy("_slice", "_g")).applyInArrow(meet, schema)


def term_hits(
    blocks: Blocks,
    weights: DataFrame,
    schema: T.StructType,
    k: int,
    k1: float,
    b: float,
    mean: float,
    candidates: DataFrame | None = None,
    first_slices: int = FIRST_SLICES,
) -> tuple[DataFrame, DataFrame]:
    """``qid, id, score`` of at least the best ``k`` texts of each query, and ``qid, slices, read``.

    ``weights(qid, term, w)`` are the query words with weights above zero. ``candidates(id)``
    restricts the texts; the bar is then set by candidates alone. The report says in how
    many slices a query's words occur and how many of them were read.
    """
    weights = materialize(weights)
    held = asked_blocks(blocks, weights)
    allowed = None
    if candidates is not None:
        texts = blocks.slices.select("slice", F.posexplode("ids").alias("place", "id"))
        open_ = texts.join(broadcast_if_small(candidates.distinct(), measured=candidates), "id", "left_semi")
        allowed = materialize(open_.groupBy("slice").agg(F.collect_list("place").alias("open")))
    most = bounds(held, weights, k1, b, mean)
    if allowed is not None:
        most = most.join(allowed.select("slice"), "slice", "left_semi")
    place = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("bound"), "slice"))
    most = materialize(most.withColumn("place", place))

    def score(pairs: DataFrame) -> DataFrame:
        return _score(blocks, held, weights, pairs, schema, k, k1, b, mean, allowed)

    hits = materialize(score(most.where(F.col("place") <= first_slices)))
    order = Window.partitionBy("qid").orderBy(F.desc("score"))
    bars = hits.withColumn("n", F.row_number().over(order)).where(F.col("n") == k).select("qid", F.col("score").alias("bar"))
    rest = most.where(F.col("place") > first_slices).join(broadcast_if_small(bars), "qid", "left")
    rest = materialize(rest.where(F.col("bar").isNull() | (F.col("bound") >= F.col("bar") - SLACK)).select("qid", "slice"))
    report = most.select("qid", (F.col("place") <= first_slices).cast("int").alias("read")).unionByName(rest.select("qid", F.lit(1).alias("read")))
    seen = most.groupBy("qid").agg(F.count(F.lit(1)).alias("slices")).join(report.groupBy("qid").agg(F.sum("read").alias("read")), "qid")
    more = score(rest) if not rest.isEmpty() else hits.limit(0)
    return hits.unionByName(more), seen
