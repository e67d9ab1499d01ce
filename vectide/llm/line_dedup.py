r"""Removal of repeated passages: chunks of lines and runs of lines with many words.

A text is cut into lines at ``\n``. Two kinds of pieces are compared:

* Content-defined chunks, whatever their length in words. Each line is hashed, and a
  rolling hash over the last ``window`` line hashes (a cyclic polynomial: every hash is
  rotated by its distance and all are combined by exclusive or) decides after which
  lines a chunk ends: where it is divisible by ``spacing``, but was not one line before,
  so that only the first and the last chunk of a text can be single lines, which are not
  compared as chunks.
* Passages: runs of lines with ``min_words`` words or more. From every line with words
  the shortest such run onwards and the shortest one back are compared. They depend on
  their own lines alone, and those inside a longer run cover all of it, so a repeated
  run is found whole, wherever it stands and whatever surrounds it.

Pieces that occur more than once among all documents are removed, but for the first
occurrence (lowest id, then place). Hashes only select what is compared: the pieces'
bytes are the key of the comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectide.llm.common import WORD, col, let, whole_row, words, written

WINDOW = 2
SPACING = 2
# A passage has more than 50 words.
MIN_WORDS = 51
MIN_LINES = 1


def rolling(hashes: Column, i: Column, window: int) -> Column:
    """The combined hash of the last ``window`` hashes up to place ``i``."""
    total = F.get(hashes, i)
    for back in range(1, window):
        earlier = F.get(hashes, i - back)
        turned = F.shiftleft(earlier, back).bitwiseOR(F.shiftrightunsigned(earlier, 64 - back))
        total = total.bitwiseXOR(F.coalesce(turned, F.lit(0).cast("long")))
    return total


def hashed(lines: Column) -> Column:
    return F.transform(lines, lambda line: F.xxhash64(line))


def chunks(lines: Column, hashes: Column, window: int, spacing: int) -> Column:
    """The chunks of a text in order: struct(start, n_lines)."""

    def ends(marks: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(lines) - 1)
        first = lambda i: F.get(marks, i) & ~F.coalesce(F.get(marks, i - 1), F.lit(False))
        return F.filter(places, lambda i: first(i) | (i == F.size(lines) - 1))

    def cut(ends: Column) -> Column:
        def chunk(end: Column, i: Column) -> Column:
            start = F.coalesce(F.get(ends, i - 1) + 1, F.lit(0))
            return F.struct(start.alias("start"), (end - start + 1).alias("n_lines"))

        return F.transform(ends, chunk)

    marks = F.transform(hashes, lambda _, i: F.pmod(rolling(hashes, i, window), F.lit(spacing).cast("long")) == 0)
    return let(let(marks, ends), cut)


def passages(lines: Column, min_words: int, min_lines: int) -> Column:
    """The shortest passages from every line with words onwards and back: struct(start, n_lines).

    They begin and end with a line with words; lines without words inside belong to them.
    """
    zero = F.struct(F.lit(0).alias("words"), F.lit(0).alias("lines"))

    def enough(held: Column) -> Column:
        return (held["words"] >= min_words) & (held["lines"] >= min_lines)

    def add(held: Column, line: Column) -> Column:
        more = F.struct((held["words"] + line["words"]).alias("words"), (held["lines"] + 1).alias("lines"))
        return F.when(enough(held), held).otherwise(more)

    def runs(full: Column, back: bool) -> Column:
        def reach(i: Column, limit: int) -> Column:
            if not back:
                return F.aggregate(F.slice(full, i + 1, F.lit(limit)), zero, add)
            first = F.greatest(i - limit + 1, F.lit(0))
            return F.aggregate(F.reverse(F.slice(full, first + 1, i - first + 1)), zero, add)

        def run(line: Column, i: Column) -> Column:
            def found(h: Column) -> Column:
                other = F.get(full, i - h["lines"] + 1 if back else i + h["lines"] - 1)["at"]
                start, end = (other, line["at"]) if back else (line["at"], other)
                return F.when(enough(h), F.struct(start.alias("start"), (end - start + 1).alias("n_lines")))

            # Most are short; the longest has one word a line.
            longest = max(min_words, min_lines)
            return let(let(reach(i, 4), lambda h: F.when(enough(h), h).otherwise(reach(i, longest))), found)

        return F.filter(F.transform(full, run), lambda r: r.isNotNull())

    counted = F.transform(lines, lambda line, i: F.struct(i.alias("at"), F.size(words(line)).alias("words")))
    full = let(counted, lambda c: F.filter(c, lambda line: line["words"] > 0))
    return let(full, lambda f: F.concat(runs(f, back=False), runs(f, back=True)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def part(lines: Column, piece: Column) -> Column:
    """The elements of a piece: of the lines, or of their hashes."""
    return F.slice(lines, piece["start"] + 1, piece["n_lines"])


def pieces(text: Column, window: int, spacing: int, min_words: int, min_lines: int) -> Column:
    """What is compared of a text: struct(start, n_lines, h), the hash of the lines' hashes."""

    def of(lines: Column, hashes: Column) -> Column:
        cut = F.filter(chunks(lines, hashes, window, spacing), lambda c: c["n_lines"] > 1)
        every = F.array_distinct(F.concat(cut, passages(lines, min_words, min_lines)))
        return F.transform(every, lambda p: F.struct(p["start"].alias("start"), p["n_lines"].alias("n_lines"), F.xxhash64(part(hashes, p)).alias("h")))

    return let(lines_of(text), lambda lines: let(hashed(lines), lambda hashes: of(lines, hashes)))


def key_of(id_col: str, text_col: str) -> Column:
    """The id with the hash of the text: rows of one id with different texts stay apart."""
    return F.struct(col(id_col).alias("id"), F.xxhash64(F.coalesce(col(text_col), F.lit(""))).alias("h"))


def same_key(a: str, b: str) -> Column:
    return (F.col(f"{a}.h") == F.col(f"{b}.h")) & F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id"))


def repeated(
    docs: DataFrame, id_col: str, text_col: str, window: int, spacing: int, min_words: int, min_lines: int
) -> DataFrame:
    """Occurrences to remove: ``key`` and its repeated pieces ``gone``, struct(start, n_lines).

    Only pieces whose hash occurs more than once are compared with their text.
    """
    key = key_of(id_col, text_col).alias("key")
    found = (
        docs.select(key, pieces(col(text_col), window, spacing, min_words, min_lines).alias("pieces"))
        # The outer form: the inner one adds a filter that cuts every text a second time.
        .select("key", F.explode_outer("pieces").alias("p"))
        .where("p.h is not null")
        .select("key", "p.start", "p.n_lines", F.col("p.h").alias("h"))
    )
    often = found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    some = found.join(often, "h", "left_semi").groupBy("key").agg(F.collect_set(F.struct("start", "n_lines")).alias("some"))
    some = written(some).select(F.col("key").alias("k"), "some")

    def texts(lines: Column) -> Column:
        text = lambda p: F.array_join(part(lines, p), "\n").alias("text")
        return F.transform(F.col("some"), lambda p: F.struct(p["start"].alias("start"), p["n_lines"].alias("n_lines"), text(p)))

    found = (
        docs.select(key, col(text_col).alias("text"))
        .join(some, same_key("key", "k"))
        .select("key", F.explode_outer(let(lines_of(F.col("text")), texts)).alias("p"))
        .where(F.col("p.text").rlike(WORD))
        .select("key", "p.start", "p.n_lines", F.xxhash64("p.text").alias("h"), F.col("p.text").alias("text"))
    )
    found = written(found)
    at = F.struct("key", "start")
    first = found.groupBy("h", "text").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # In one text, an occurrence that overlaps the first one is no copy of it.
    apart = ~F.col("key").eqNullSafe(F.col("first.key")) | (F.col("start") >= F.col("first.start") + F.col("n_lines"))
    return (
        found.join(first.drop("n"), ["h", "text"])
        .where(apart)
        .groupBy("key")
        .agg(F.collect_set(F.struct("start", "n_lines")).alias("gone"))
    )


def dedupe(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    spacing: int = SPACING,
    min_words: int = MIN_WORDS,
    min_lines: int = MIN_LINES,
) -> DataFrame:
    """Each row as ``_row`` with its ``new_text`` and the number of chunks ``n_removed`` that lost lines.

    No row is dropped; a text may become empty. A text that loses nothing is returned
    as it is, and null stays null. A null id is an id of its own, the lowest. Rows that
    agree in id and text are one document: they keep or lose the same lines. Pieces
    without a word and empty texts are never removed. A repetition within one text
    counts like any other.
    """
    rows = whole_row(docs, key_of(id_col, text_col).alias("key"))
    gone = repeated(docs, id_col, text_col, window, spacing, min_words, min_lines).select(F.col("key").alias("k"), "gone")
    text = F.col("_row")[text_col]
    one = lambda p: F.sequence(p["start"], p["start"] + p["n_lines"] - 1)
    places = F.array_distinct(F.flatten(F.transform("gone", one)))

    def without(lines: Column, places: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places)
        left = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
        cut = let(hashed(lines), lambda hashes: chunks(lines, hashes, window, spacing))
        starts = F.flatten(F.transform(cut, lambda c: F.array_repeat(c["start"], c["n_lines"])))
        touched = let(starts, lambda s: F.array_distinct(F.transform(places, lambda i: F.get(s, i))))
        return F.struct(left.alias("text"), F.size(touched).alias("n"))

    done = F.when(F.col("gone").isNotNull(), let(lines_of(text), lambda lines: let(places, lambda p: without(lines, p))))
    # Left alone, the projections would be merged and the text cut once for each field.
    rows = rows.join(gone, same_key("key", "k"), "left").select("_row", F.array(done).alias("_done"))
    rows = rows.select("_row", F.explode("_done").alias("_done"))
    left = F.when(F.col("_done").isNull(), text).otherwise(F.col("_done.text"))
    return rows.select("_row", left.alias("new_text"), F.coalesce(F.col("_done.n"), F.lit(0)).alias("n_removed"))


def filter_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The rows and columns of ``docs`` with repeated passages removed from the text.

    ``length_col``, where there is one, gets the new length of a changed text.
    """
    done = dedupe(docs, id_col, text_col)
    changed = F.col("n_removed") > 0

    def out(c: str) -> Column:
        old = F.col("_row")[c]
        if c == text_col:
            return F.col("new_text").alias(c)
        if c == length_col:
            kind = docs.schema[c].dataType
            return F.when(changed, F.length("new_text").cast(kind)).otherwise(old).alias(c)
        return old.alias(c)

    return done.select(*[out(c) for c in docs.columns])
