"""Containment by an index of trigrams, stored once.

``like '%word%'`` has to read every text; with the index it reads candidates. Texts are dealt
into slices of ``SLICE_TEXTS`` texts, and for each run of three characters a posting says
at which places of a slice it occurs. A text can contain a word only if it holds all the
word's trigrams, so their places are intersected, slice by slice, and the texts that are
left are read and searched for the word itself.

Words of fewer than three characters have no trigram: they are looked for in all texts
(``containing``), which is the same result at the cost of a scan.
"""

from __future__ import annotations

from array import array
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from vectide.functions.containing import containing, matched, sortable
from vectide.session import materialize, materialize_parts
from vectide.sizing import BROADCAST_BYTES, broadcast_if_small, deal_out, measure, spread_join

GRAM = 3
SLICE_TEXTS = 1024
PARTS = 64
# Characters of a text that are cut into trigrams at once.
PIECE = 1 << 20
# Places that a task gathers, and trigrams of words that meet the postings of a slice at once.
GATHERED, MET_GRAMS = 2_000_000, 50_000
# Trigrams that a filter names; more are sent as a table.
NAMED_GRAMS = 1000
# Trigrams of a slice that are packed into bits at once.
PACKED_ROWS = 4096
# Characters of the words that are looked for at once: the automaton takes some 64 bytes for each.
LETTERS = 3_000_000


@dataclass(frozen=True)
class GramIndex:
    """``texts(id, text, place, slice)`` and ``postings(gram, places, part, slice)``."""

    texts: DataFrame
    postings: DataFrame
    parts: int


def grams(text: Column) -> Column:
    """The distinct runs of three characters of a text; none of a shorter one."""
    size = F.char_length(text)
    cut = F.transform(F.sequence(F.lit(1), size - GRAM + 1), lambda at: F.substr(text, at, F.lit(GRAM)))
    return F.when(size >= GRAM, F.array_distinct(cut)).otherwise(F.array().cast("array<string>"))


def _gram_keys(text: str) -> np.ndarray:
    """The distinct trigrams of a text as numbers of three times 21 bits, a piece of the text at a time."""
    keys = np.zeros(0, np.int64)
    for begin in range(0, len(text) - GRAM + 1, PIECE):
        points = np.frombuffer(text[begin : begin + PIECE + GRAM - 1].encode("utf-32-le"), np.uint32).astype(np.int64)
        piece = np.unique((points[:-2] << 42) | (points[1:-1] << 21) | points[2:])
        keys = np.union1d(keys, piece) if len(keys) else piece
    return keys


def _gathered(batches):
    """``gram, slice, places`` of the texts of a task, for one slice after another or what fits of it."""

    def table(keys: list, at: list, number: int) -> pa.RecordBatch:
        key, place = np.concatenate(keys), np.repeat(np.array(at, np.int32), [len(k) for k in keys])
        order = np.argsort(key, kind="stable")
        own, begin = np.unique(key[order], return_index=True)
        places = pa.ListArray.from_arrays(pa.array(np.append(begin, len(key)).astype(np.int32)), pa.array(place[order]))
        letters = np.stack([own >> 42, (own >> 21) & 0x1FFFFF, own & 0x1FFFFF], axis=1).astype("<u4").tobytes().decode("utf-32-le")
        held = pa.array([letters[k : k + GRAM] for k in range(0, len(letters), GRAM)], pa.string())
        return pa.RecordBatch.from_arrays([held, pa.array(np.full(len(own), number)), places], ["gram", "slice", "places"])

    keys, at, last, n = [], [], None, 0
    for batch in batches:
        for number, place, text in zip(*(batch[c].to_pylist() for c in ("slice", "place", "text"))):
            if n and (number != last or n >= GATHERED):
                yield table(keys, at, last)
                keys, at, n = [], [], 0
            last = number
            keys.append(_gram_keys(text))
            at.append(place)
            n += len(keys[-1])
    if n:
        yield table(keys, at, last)


def _part(gram: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(parts)).cast("int")


def store(texts: DataFrame, path: str, parts: int = PARTS, slice_texts: int = SLICE_TEXTS) -> None:
    """Write the index of ``texts(id, text)``; texts are compared as they come. Missing texts contain nothing."""
    spark = texts.sparkSession
    held = texts.select("id", "text").where("text is not null")
    # Sorted, so that a task that runs again numbers its texts alike.
    ordered = deal_out(held).sortWithinPartitions(F.xxhash64("id", "text"), "id")
    at = F.monotonically_increasing_id()
    row = F.col("_at").bitwiseAND((1 << 33) - 1)
    numbered = ordered.withColumn("_at", at).select(
        "id",
        "text",
        (row % slice_texts).cast("int").alias("place"),
        (F.shiftrightunsigned("_at", 33) * (1 << 24) + F.floor(row / slice_texts)).alias("slice"),
    )
    numbered.write.partitionBy("slice").parquet(f"{path}/texts")
    back = spark.read.schema(numbered.schema).parquet(f"{path}/texts")
    # At most a slice of places for each trigram and slice; what tasks hand in is gathered text by text.
    partial = back.select("slice", "place", "text").mapInArrow(_gathered, "gram string, slice long, places array<int>")
    # Written once: ordering them by range reads them twice. They are gathered where the order brings them together.
    partial = materialize(partial.withColumn("part", _part(F.col("gram"), parts)))
    keys = ("part", "gram", "slice")
    lists = partial.repartitionByRange(*keys).groupBy(*keys).agg(F.sort_array(F.flatten(F.collect_list("places"))).alias("places"))
    spread = lists.sortWithinPartitions(*keys).select("gram", "slice", "places", "part")
    spread.write.partitionBy("part").parquet(f"{path}/postings")
    spark.createDataFrame([(parts,)], "parts int").coalesce(1).write.parquet(f"{path}/about")


def load(spark: SparkSession, path: str) -> GramIndex:
    parts = spark.read.parquet(f"{path}/about").first()["parts"]
    id_type = _schema(spark, f"{path}/texts")
    texts = spark.read.schema(id_type).parquet(f"{path}/texts")
    shape = "gram string, slice long, places array<int>, part int"
    return GramIndex(texts, spark.read.schema(shape).parquet(f"{path}/postings"), parts)


def _schema(spark: SparkSession, path: str) -> T.StructType:
    """The stored schema with a slice number of 64 bits, which folders' names do not tell."""
    fields = [f for f in spark.read.parquet(path).schema.fields if f.name != "slice"]
    return T.StructType([*fields, T.StructField("slice", T.LongType())])


def _asked_lists(index: GramIndex, asked: DataFrame) -> DataFrame:
    """The postings of the trigrams ``gram``: by folder, and by trigram within."""
    wanted = asked.select("gram").distinct().withColumn("part", _part(F.col("gram"), index.parts))
    size = measure(wanted)
    if size.rows <= NAMED_GRAMS:
        named = wanted.collect()
        in_folder = F.col("part").isin(sorted({r["part"] for r in named}))
        return index.postings.where(in_folder & F.col("gram").isin(sorted(r["gram"] for r in named)))
    return index.postings.join(F.broadcast(wanted) if size.bytes <= BROADCAST_BYTES else wanted, ["part", "gram"], "left_semi")


def candidates(index: GramIndex, words: DataFrame) -> DataFrame:
    """``word, slice, places``: where all trigrams of a distinct word of three characters or more occur."""
    asked = words.select("word", F.explode(grams(F.col("word"))).alias("gram"))
    lists = _asked_lists(index, asked)
    # A trigram that most words share meets them slice by slice.
    met = spread_join(lists.select("gram", "slice", "places"), asked, ["gram"], "slice", small=measure(asked).bytes <= BROADCAST_BYTES)
    count = F.count(F.lit(1)).alias("n")
    both = met.groupBy("word", "slice").agg(count, F.collect_list("places").alias("lists"))
    both = both.where(F.col("n") == F.size(grams(F.col("word"))))
    # The shortest list first: what it lacks no other can bring back.
    ordered = F.array_sort(F.transform("lists", lambda x: F.struct(F.size(x).alias("n"), x.alias("x"))))
    common = F.aggregate(F.slice(ordered, 2, F.size(ordered)), F.get(ordered, F.lit(0))["x"], lambda held, y: F.array_intersect(held, y["x"]))
    return both.select("word", "slice", common.alias("places")).where(F.size("places") > 0)


def _numbered_grams(words: Sequence[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct trigrams of all words, their numbers word by word, and where those of each word begin."""
    number, flat, starts = {}, array("i"), np.zeros(len(words), np.int64)
    for k, word in enumerate(words):
        starts[k] = len(flat)
        flat.extend({number.setdefault(word[i : i + GRAM], len(number)) for i in range(len(word) - GRAM + 1)})
    return list(number), np.array(flat, np.int32), starts


def _met_places(gram: pa.Array, places: pa.ListArray, known: Sequence[str], flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The places of a slice where all trigrams of some word stand."""
    at, offsets = places.flatten().to_numpy(), places.offsets.to_numpy()
    offsets = offsets - offsets[0]
    width = int(at.max(initial=-1)) + 1
    bits = np.zeros((len(gram), -(-width // 8)), np.uint8)
    for low in range(0, len(gram), PACKED_ROWS):
        ends = offsets[low : low + PACKED_ROWS + 1]
        held = np.zeros((len(ends) - 1, width), bool)
        held[np.repeat(np.arange(len(held)), np.diff(ends)), at[ends[0] : ends[-1]]] = True
        bits[low : low + len(held)] = np.packbits(held, axis=1)
    # Words with a trigram that the slice lacks stand nowhere in it.
    row = np.full(len(known), -1)
    row[pc.index_in(gram, pa.array(known, pa.string())).to_numpy()] = np.arange(len(gram))
    sizes = np.diff(np.append(starts, len(flat)))
    all_there = np.logical_and.reduceat(row[flat] >= 0, starts) if len(starts) else np.zeros(0, bool)
    own, sizes = row[flat[np.repeat(all_there, sizes)]], sizes[all_there]
    ends = np.cumsum(sizes)
    found, most = np.zeros(bits.shape[1], np.uint8), np.bitwise_or.reduce(bits, axis=0, initial=0)
    word = 0
    while word < len(sizes) and not np.array_equal(found, most):
        begin = ends[word] - sizes[word]
        last = max(word + 1, int(np.searchsorted(ends, begin + MET_GRAMS, "right")))
        common = np.bitwise_and.reduceat(bits[own[begin : ends[last - 1]]], ends[word:last] - sizes[word:last] - begin)
        found |= np.bitwise_or.reduce(common, axis=0)
        word = last
    return np.flatnonzero(np.unpackbits(found, count=width)).astype(np.int32)


def _matches(index: GramIndex, words: DataFrame, first: int | None) -> tuple[DataFrame, Broadcast]:
    """``(word, id)`` for a bounded table of words of three characters or more; also what was sent."""
    spark = words.sparkSession
    names = words.toArrow().column("word").to_pylist()
    shared = spark.sparkContext.broadcast((names, *_numbered_grams(names)))
    lists = _asked_lists(index, words.select(F.explode(grams(F.col("word"))).alias("gram"))).select("gram", "slice", "places")

    def meet(table: pa.Table) -> pa.Table:
        """The places of a slice where some word may stand."""
        place = _met_places(table["gram"].combine_chunks(), table["places"].combine_chunks(), *shared.value[1:])
        slices = pa.array(np.full(len(place), table["slice"][0].as_py()))
        return pa.table([slices, pa.array(place)], names=["slice", "place"])

    asked = materialize(lists.groupBy("slice").applyInArrow(meet, "slice long, place int"))
    found = index.texts.join(broadcast_if_small(asked), ["slice", "place"]).select("id", "text")
    kind = index.texts.schema["id"].dataType
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("id", kind)])
    id_type, first = to_arrow_type(kind), first if sortable(kind) else None

    def verify(batches):
        # All words at once, so what a text costs does not grow with the words that may stand in it.
        yield from matched(shared.value[0], batches, id_type, first)

    return found.mapInArrow(verify, schema), shared


def contains(index: GramIndex, words: DataFrame, first: int | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(word, id)`` once for each text that contains a word ``(word)`` anywhere.

    Missing and empty words match nothing. With ``first`` at least the ``first`` lowest ids of
    each word. Words are sent to all tasks, above the bound in blocks, one after another; a task
    meets the postings of one slice with all words of a block and tells the places where one may stand. The
    texts there are read once for each block, with all its words.
    """
    distinct = words.select("word").where("word <> ''").distinct()
    long = distinct.where(F.char_length("word") >= GRAM)
    size = measure(long)
    letters = long.agg(F.sum(F.char_length("word"))).first()[0] or 0
    n_blocks = max(-(-size.bytes // max(1, broadcast_bytes)), -(-letters // LETTERS))
    if n_blocks <= 1:
        hits = _matches(index, long, first)[0]
    else:
        n_blocks = min(size.rows, n_blocks)
        kept = materialize(long.withColumn("_block", F.pmod(F.xxhash64("word"), F.lit(n_blocks))))

        def parts():
            for n in range(n_blocks):
                found, shared = _matches(index, kept.where(F.col("_block") == n).select("word"), first)
                yield found
                shared.destroy()

        hits = materialize_parts(parts())
    short = distinct.where(F.char_length("word") < GRAM)
    return hits.unionByName(containing(index.texts, short, first=first)) if not short.isEmpty() else hits
