"""Synonyms and intent rules as tables of any size.

A dictionary becomes one automaton that finds all its words in a text at once, so a text
costs as much as it is long, not as the dictionary is large, and the plan does not grow
with it. Dictionaries above the broadcast bound are cut into blocks, one after another;
of each block only the best few entries of a text are kept.

The outcome is that of ``query_text.expand_synonyms`` and ``rewrite_intent``: entries apply in the
order of their priority, each to the text as it was asked.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vectide.operators.query_text import MAX_EXPANSIONS, MAX_REWRITES, Rule, _variants
from vectide.session import materialize
from vectide.sizing import BROADCAST_BYTES, measure

_ENTRY = "array<struct<priority:bigint,place:int,words:array<string>,olds:array<string>,news:array<string>,suffix:string>>"
_PLAIN = "priority long, place int, words array<string>, olds array<string>, news array<string>, suffix string"


def synonym_table(spark: SparkSession, synonyms: Mapping[str, Sequence[str]]) -> DataFrame:
    """``priority, place, word, synonym``, as ``expand_from_table`` takes it."""
    rows = [(i, k, word, other) for i, (word, others) in enumerate(synonyms.items()) for k, other in enumerate(others)]
    return spark.createDataFrame(rows, "priority long, place int, word string, synonym string")


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """``priority, any_of, replace, suffix``, as ``rewrite_from_table`` takes it."""
    rows = [(i, list(r.any_of), [{"old": a, "new": b} for a, b in r.replace], r.suffix) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, "priority long, any_of array<string>, replace array<struct<old:string,new:string>>, suffix string")


def _finder(entries: pa.Table, limit: int) -> Callable[[str | None], list[dict]]:
    """The first entries, by priority and place, one of whose words a text contains."""
    import ahocorasick

    rows = entries.to_pylist()
    by_word: dict[str, list[tuple]] = {}
    for k, row in enumerate(rows):
        for word in row["words"] or ():
            if word:
                by_word.setdefault(word, []).append((row["priority"], row["place"], k))
    automaton = ahocorasick.Automaton()
    for word, found in by_word.items():
        # No more than the limit of a word's entries can count.
        automaton.add_word(word, (word, sorted(found)[:limit]))
    automaton.make_automaton()

    def find(text: str | None) -> list[dict]:
        if not text or not len(automaton):
            return []
        seen: set[str] = set()
        best: set[tuple] = set()
        for _, (word, found) in automaton.iter(text):
            if word not in seen:
                seen.add(word)
                best.update(found)
        return [rows[k] for _, _, k in sorted(best)[:limit]]

    return find


def _with_entries(queries: DataFrame, text_col: str, entries: DataFrame, limit: int, broadcast_bytes: int) -> DataFrame:
    """``queries`` with ``_entries``, the first entries that each text calls for."""
    spark = queries.sparkSession
    numbered = materialize(queries.withColumn("_no", F.monotonically_increasing_id()))

    def scan(block: DataFrame):
        shared = spark.sparkContext.broadcast(block.toArrow())

        def run(batches):
            find = _finder(shared.value, limit)
            kind = pa.list_(pa.struct([(n, shared.value.schema.field(n).type) for n in shared.value.schema.names]))
            for batch in batches:
                found = [find(t) for t in batch["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([batch["_no"], pa.array(found, kind)], ["_no", "_entries"])

        texts = numbered.select("_no", F.col(f"`{text_col}`").alias("text"))
        return texts.mapInArrow(run, f"_no long, _entries {_ENTRY}"), shared

    entries = materialize(entries)
    size = measure(entries)
    if size.bytes <= broadcast_bytes:
        found = scan(entries)[0]
    else:
        n_blocks = min(size.rows, -(-size.bytes // max(1, broadcast_bytes)))
        dealt = materialize(entries.withColumn("_block", F.pmod(F.xxhash64("priority", "place"), F.lit(n_blocks))))
        parts = []
        for n in range(n_blocks):
            part, shared = scan(dealt.where(F.col("_block") == n).drop("_block"))
            parts.append(materialize(part.where(F.size("_entries") > 0)))
            shared.destroy()
        both = reduce(DataFrame.unionByName, parts).groupBy("_no").agg(F.flatten(F.collect_list("_entries")).alias("_entries"))
        found = both.select("_no", F.slice(F.array_sort("_entries"), 1, limit).alias("_entries"))
    found = found.withColumnRenamed("_no", "_of")
    return numbered.join(found, numbered["_no"] == found["_of"], "left").drop("_no", "_of")


def _rewritten(text: Column, entry: Column) -> Column:
    """A text with each old word replaced by its new one, in their order."""
    pairs = F.arrays_zip(entry["olds"].alias("olds"), entry["news"].alias("news"))
    return F.aggregate(pairs, text, lambda held, p: F.replace(held, p["olds"], p["news"]))


def expand_from_table(
    queries: DataFrame,
    dictionary: DataFrame,
    text_col: str = "query_text",
    limit: int = MAX_EXPANSIONS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per variant: ``variant`` 0 is the query itself, the others replace one word by one synonym.

    ``dictionary`` has ``priority`` of the word, ``place`` of the synonym, ``word`` and ``synonym``.
    Empty words and rows with nulls match nothing; a query without text has no variant.
    """
    word = F.array("word")
    entries = dictionary.where("word is not null and synonym is not null").select(
        F.col("priority").cast("long").alias("priority"),
        F.col("place").cast("int").alias("place"),
        word.alias("words"),
        word.alias("olds"),
        F.array("synonym").alias("news"),
        F.lit("").alias("suffix"),
    )
    if limit <= 1:
        return _variants(queries, text_col, F.array(F.col(text_col)))
    held = _with_entries(queries, text_col, entries, limit - 1, broadcast_bytes)
    text = F.col(f"`{text_col}`")
    others = F.transform(F.coalesce("_entries", F.array().cast(_ENTRY)), lambda e: _rewritten(text, e))
    return _variants(held, text_col, F.concat(F.array(text), others)).drop("_entries")


def rewrite_from_table(
    queries: DataFrame,
    rules: DataFrame,
    text_col: str = "query_text",
    limit: int = MAX_REWRITES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per rewritten query; a query that no rule knows has none.

    ``rules`` has ``priority, any_of, replace`` (pairs ``old, new``) and ``suffix``. A rule gives a
    variant with its replacements and one with its suffix.
    """
    pairs = F.coalesce("replace", F.array().cast("array<struct<old:string,new:string>>"))
    replaced = F.struct(F.lit(0).alias("place"), pairs["old"].alias("olds"), pairs["new"].alias("news"), F.lit("").alias("suffix"))
    none = F.array().cast("array<string>")
    suffixed = F.struct(F.lit(1).alias("place"), none.alias("olds"), none.alias("news"), F.coalesce("suffix", F.lit("")).alias("suffix"))
    made = F.filter(F.array(replaced, suffixed), lambda m: (F.size(m["olds"]) > 0) | (m["suffix"] != ""))
    entries = rules.select(F.col("priority").cast("long").alias("priority"), F.col("any_of").alias("words"), F.explode(made).alias("m"))
    entries = entries.select("priority", "m.place", "words", "m.olds", "m.news", "m.suffix")
    held = _with_entries(queries, text_col, entries, limit, broadcast_bytes)
    text = F.col(f"`{text_col}`")
    made = F.transform(F.coalesce("_entries", F.array().cast(_ENTRY)), lambda e: F.concat(_rewritten(text, e), e["suffix"]))
    return _variants(held, text_col, made).drop("_entries")
