"""Audit of filters that are applied one after another, in every order.

The sets of filters applied so far are the states of a lattice, from none to all, and an
order of the filters is a path through it. What a step does depends on its edge alone:
the filter, and the state before it, not on the order within that state. So each state
counts the rows that pass all its filters, the difference along an edge is what the
filter removes there, and all orders are read from the same edges:

* Forward counts say how many orders reach a state, backward counts how many leave it.
  Their product over an edge is the number of orders that use it, and a filter's Shapley
  sum is that of its edges' removals weighted by them.
* The steps of an order are the edges along its path.

Rows are counted once, by part and by the set of filters they fail: the lattice never
sees a row, and its size depends on the number of filters and parts alone.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectide.llm.common import col, let, words, written
from vectide.sizing import broadcast_if_small, spread_join

#: Filters of one audit at most: 5,040 orders of seven steps, for each part.
MAX_FILTERS = 7
SALTS = 16


def path_counts(k: int) -> tuple[list[int], list[int]]:
    """How many orders of ``k`` filters reach each state, and how many lead from it to the full one."""
    states = range(1 << k)
    forward, backward = [0] * (1 << k), [0] * (1 << k)
    forward[0] = backward[-1] = 1
    for s in states:
        for f in range(k):
            if not s >> f & 1:
                forward[s | 1 << f] += forward[s]
    for s in reversed(states):
        for f in range(k):
            if not s >> f & 1:
                backward[s] += backward[s | 1 << f]
    return forward, backward


def edges(k: int) -> list[tuple[int, int, int, int]]:
    """``(state, filter, its bit, orders that use the edge)``."""
    forward, backward = path_counts(k)
    return [(s, f, 1 << f, forward[s] * backward[s | 1 << f]) for s in range(1 << k) for f in range(k) if not s >> f & 1]


def steps_of(names: list[str]) -> list[tuple[str, int, int, int]]:
    """``(order, step, state before, filter)`` of every order."""
    out = []
    for order in permutations(range(len(names))):
        state = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(names[x] for x in order), step, state, f))
            state |= 1 << f
    return out


def tally(rows: DataFrame, filters: Mapping[str, Column], part: Column, flags: Mapping[str, Column]) -> DataFrame:
    """Rows by ``part`` and ``mask`` (the filters that fail): their number ``n`` and that of each flag."""
    mask = F.lit(0)
    for k, failed in enumerate(filters.values()):
        mask = mask + F.when(failed, 1 << k).otherwise(0)
    flagged = [F.when(is_so, 1).otherwise(0).alias(f"_{name}") for name, is_so in flags.items()]
    small = rows.select(part.alias("part"), mask.alias("mask"), *flagged)
    sums = [F.sum(F.col(f"_{name}").cast("long")).alias(name) for name in flags]
    return small.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), *sums)


def audit(rows: DataFrame, filters: Mapping[str, Column], part: Column, flags: Mapping[str, Column]) -> DataFrame:
    """One row for each part, order of the filters and step, zeros included.

    ``filters`` gives names and failure conditions, ``flags`` names and conditions of rows
    whose loss is counted; a null condition is not met. The columns are ``part,
    filter_order, step, kept, removed, redundant, unique_fails``, those of the flags, and
    ``shapley``. A null part is a part of its own; rows that repeat count each; no rows give
    no parts.
    """
    names = list(filters)
    k = len(names)
    if not 1 <= k <= MAX_FILTERS:
        raise ValueError(f"1 to {MAX_FILTERS} filters are expected")
    spark = rows.sparkSession
    full = (1 << k) - 1
    counted = ["n", *flags]
    masks = tally(rows, filters, part, flags)
    # State by state the rows that fail none of its filters; 4 ** k rows a part at most.
    states = masks.withColumn("state", F.explode(F.sequence(F.lit(0), F.lit(full))))
    passing = F.col("mask").bitwiseAND(F.col("state")) == 0
    states = states.groupBy("part", "state").agg(*[F.sum(F.when(passing, F.col(c)).otherwise(F.lit(0).cast("long"))).alias(c) for c in counted])
    # One row a part holds the lattice, in the order of the states.
    lattice = states.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("state", *counted))).alias("s"))
    table = [F.struct(*[F.lit(x).cast(t).alias(c) for x, c, t in zip(e, ("state", "filter", "bit", "paths"), ("int", "int", "int", "long"))]) for e in edges(k)]
    held = lattice.select("part", "s", F.explode(F.array(*table)).alias("e")).select("part", "s", "e.*")
    bit = F.col("bit")
    after = F.col("state").bitwiseOR(bit)

    def at(state: Column, c: str) -> Column:
        return F.get(F.col("s"), state)[c]

    removed = at(F.col("state"), "n") - at(after, "n")
    along = held.select(
        "part",
        "state",
        "filter",
        "paths",
        at(after, "n").alias("kept"),
        removed.alias("removed"),
        (at(F.lit(0), "n") - at(bit, "n") - removed).alias("redundant"),
        (at(F.lit(full).bitwiseXOR(bit), "n") - at(F.lit(full), "n")).alias("unique_fails"),
        *[(at(F.col("state"), c) - at(after, c)).alias(c) for c in flags],
    )
    shapley = along.groupBy(F.col("part").alias("_part"), F.col("filter").alias("_filter")).agg(F.sum(F.col("paths") * F.col("removed")).alias("shapley"))
    along = along.join(shapley, F.col("part").eqNullSafe(F.col("_part")) & (F.col("filter") == F.col("_filter")))
    orders = spark.createDataFrame(steps_of(names), "filter_order string, step int, state int, filter int")
    # MAX_FILTERS bounds the steps.
    return along.join(F.broadcast(orders), ["state", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *flags, "shapley"
    )


SYMBOLS = r"[#$%&*|]"


def text_failures(text: Column) -> Column:
    """Failures of a text by its words and characters: struct of ``few, repetitive, capitals, symbols``.

    A null text is empty, which has too few words and fails nothing else.
    """
    text = F.coalesce(text, F.lit(""))

    def by_words(w: Column) -> Column:
        n = F.size(w).cast("long")
        return F.struct((n < 100).alias("few"), (100 * F.size(F.array_distinct(w)).cast("long") < 80 * n).alias("repetitive"))

    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return F.struct(
        let(words(text), by_words).alias("words"),
        (100 * capitals > 10 * F.length(text).cast("long")).alias("capitals"),
        text.rlike(SYMBOLS).alias("symbols"),
    )


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Narrow rows ``id, part, fails, repeated``; the text is read once and left behind.

    ``repeated``: some row with a smaller id has the same text, by its SHA-256. Null and
    empty texts are the same text. A null id is neither smaller nor larger than others.
    """
    digest = F.unhex(F.sha2(F.coalesce(col(text_col).cast("string"), F.lit("")), 256))
    rows = docs.select(
        col(id_col).alias("id"),
        col(part_col).cast("string").alias("part"),
        F.array(text_failures(col(text_col).cast("string"))).alias("f"),
        digest.alias("digest"),
    )
    rows = written(rows.select("id", "part", "digest", F.explode("f").alias("f")).select("id", "part", "digest", "f.words.*", "f.capitals", "f.symbols"))
    copies = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1").select("digest", "first")
    # A text that a third of all rows share is one row there and many here.
    held = spread_join(rows, copies, ["digest"], "id", salts=SALTS, how="left")
    return held.withColumn("repeated", F.coalesce(F.col("first") < F.col("id"), F.lit(False))).drop("digest", "first")


def audit_texts(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """The audit of five filters on texts, by language.

    A: too few words; B: too many repeated words; C: too many capitals; D: a symbol; E: a
    copy of an earlier text. ``good_lost`` and ``toxic_lost`` count labelled rows; an id
    that is labelled more than once is good or toxic if any of its labels says so, and
    rows with a null id have no labels. A null part is the empty string.
    """
    rows = measured(docs, id_col, text_col, part_col)
    says = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    known = labels.select(col(id_col).alias("id"), "quality", "toxic").where("id is not null")
    known = known.groupBy("id").agg(says("quality").alias("good"), says("toxic").alias("toxic"))
    rows = rows.join(broadcast_if_small(known, measured=labels.select(col(id_col))), "id", "left")
    filters = {"A": F.col("few"), "B": F.col("repetitive"), "C": F.col("capitals"), "D": F.col("symbols"), "E": F.col("repeated")}
    flags = {"good_lost": F.col("good"), "toxic_lost": F.col("toxic")}
    return audit(rows, filters, F.coalesce("part", F.lit("")), flags)
