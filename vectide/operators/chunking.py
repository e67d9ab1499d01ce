"""Splitting texts into chunks, chunk tables and cleaning.

A text is split inside its own row. Array columns are exploded in the outer form:
the inner form makes the optimizer add a filter on the array, which would run the
split once more for every text.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectide.functions.text import strip
from vectide.sources.collections import assign_ids
from vectide.session import materialize
from vectide.sizing import broadcast_if_small, deal_out, fits, spread_join

# Default sizes in characters, sentence ends and the paragraph delimiter.
MAX_CHUNK, OVERLAP, MIN_CHUNK = 600, 100, 100
SECTION_MAX, SECTION_OVERLAP = 1000, 100
SENTENCE_END = "[.!?。！？]+"
PARAGRAPH = "\n\n"

# A fenced code block as a whole, or one line.
# (``d``: only a line feed ends a line.)
MARKDOWN_UNIT = r"(?dms)^```.*?(?:^```[^\n]*$|\z)|^[^\n]*$"
HEADING = r"^#{1,6}\s"


def _rows(df: DataFrame, chunks: Column, text_col: str) -> DataFrame:
    """One row per chunk, numbered from 0 in text order, with all columns but the text.

    The text itself is left out: it would be repeated in full for every chunk.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != text_col]
    rows = df.select(*others, F.posexplode_outer(chunks).alias("chunk_index", "content"))
    return rows.where("content is not null")


def _unit(piece: Column, joined: bool, fresh=False) -> Column:
    fresh = fresh if isinstance(fresh, Column) else F.lit(fresh)
    return F.struct(piece.alias("piece"), F.lit(joined).alias("joined"), fresh.alias("fresh"))


def fill(pieces: list[str], joints: list[str], fresh: list[bool], most: int, overlap: int, least: int) -> list[str]:
    """Chunks of one text. Running lengths tell where each chunk ends, so a step is a chunk, not a unit."""
    sizes = [len(p) for p in pieces]
    glued = [j + p for j, p in zip(joints, pieces)]
    upto = list(accumulate(map(len, glued)))  # characters up to and with a unit, joints included
    reach = [u - len(j) for u, j in zip(upto, joints)]  # the same without the unit's own joint
    starts = [i for i, f in enumerate(fresh) if f]
    chunks, tail, at = [], "", 0
    while at < len(pieces):
        n = len(tail) + sizes[at]
        if not n:
            at += 1
            continue
        end = bisect_right(reach, most - n + upto[at], at + 1)
        mark = bisect_right(starts, at)
        if mark < len(starts):
            end = min(end, starts[mark])
        chunk = tail + pieces[at] + "".join(glued[at + 1 : end])
        kept = len(chunk) >= least
        if kept:
            chunks.append(chunk)
        repeats = kept and overlap and end < len(pieces) and not fresh[end]
        tail = chunk[-overlap:] if repeats else ""
        at = end
    return chunks


def pack(units: Column, joint: str, most: int, overlap: int, least: int) -> Column:
    """Fill chunks with units, in order.

    A unit that would make the open chunk longer than ``most`` closes it. A closed
    chunk of at least ``least`` characters is kept and its end repeated at the start
    of the next; a shorter one is dropped. A ``fresh`` unit always closes the open
    chunk and repeats nothing. Joints are not counted in the test but do lengthen the chunk.

    An SQL fold copies all chunks found so far at every step, which is quadratic in
    the text, so the cutting is done on Arrow batches.
    """

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def run(lists: pa.Array) -> pa.Array:
        flat = lists.flatten()
        pieces, fresh = flat.field("piece").to_pylist(), flat.field("fresh").to_pylist()
        joints = [joint if j else "" for j in flat.field("joined").to_pylist()]
        ends = lists.offsets.to_pylist()
        spans = [slice(a - ends[0], b - ends[0]) for a, b in zip(ends, ends[1:])]
        found = [fill(pieces[x], joints[x], fresh[x], most, overlap, least) for x in spans]
        return pa.array(found, pa.list_(pa.string()))

    return run(units)


def _check(most: int, overlap: int, least: int = 0) -> None:
    if most < 1 or overlap < 0 or least < 0 or overlap >= most:
        raise ValueError("need 0 <= overlap < max size and a minimum of at least 0")


def chunk_paragraphs(
    df: DataFrame,
    text_col: str = "text",
    max_chunk: int = MAX_CHUNK,
    overlap: int = OVERLAP,
    min_chunk: int = MIN_CHUNK,
    delimiter: str = PARAGRAPH,
) -> DataFrame:
    """Paragraphs packed into overlapping chunks; longer paragraphs are packed by sentence.

    Sentence ends are dropped and sentences joined without a gap. A sentence longer
    than ``max_chunk`` stays whole, so a chunk may be longer than that.
    """
    _check(max_chunk, overlap, min_chunk)

    def units(paragraph):
        sentences = F.transform(F.split(paragraph, SENTENCE_END, -1), lambda s: _unit(s, False))
        return F.when(F.char_length(paragraph) > max_chunk, sentences).otherwise(F.array(_unit(paragraph, True)))

    paragraphs = F.split(F.col(text_col), _literal(delimiter), -1)
    split = F.flatten(F.transform(paragraphs, units))
    chunks = _rows(deal_out(df), pack(split, delimiter, max_chunk, overlap, min_chunk), text_col)
    return chunks.withColumn("content", strip(F.col("content")))


def _literal(delimiter: str) -> str:
    return re.escape(delimiter)


def chunk_fixed(df: DataFrame, text_col: str = "text", size: int = 500, overlap: int = 100) -> DataFrame:
    """Windows of ``size`` characters, each repeating the last ``overlap`` of the one before.

    The text is cut once into steps and windows are put together from them, so the
    work grows with the text and not with its square.
    """
    _check(size, overlap)
    stride = size - overlap
    text = F.col(text_col)
    cut = deal_out(df).withColumn("_steps", F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % stride), F.lit(0)))
    count = F.greatest(F.lit(1), F.ceil((F.char_length(text) - overlap) / F.lit(stride)).cast("int"))

    def window(step, i):
        # Single elements are cheap to reach; a slice would copy the whole array each time.
        later = [F.coalesce(F.get("_steps", i + n), F.lit("")) for n in range(1, math.ceil(size / stride))]
        return F.substring(F.concat(step, *later), 1, size)

    windows = F.transform(F.slice("_steps", F.lit(1), F.least(count, F.size("_steps"))), window)
    return _rows(cut, windows, text_col).drop("_steps")


def chunk_sentences(df: DataFrame, text_col: str = "text", min_chunk: int = 1) -> DataFrame:
    """One chunk per sentence, without its end mark; shorter ones than ``min_chunk`` are dropped."""
    return _pieces(df, text_col, F.split(F.col(text_col), SENTENCE_END, -1), min_chunk)


def chunk_by_paragraph(
    df: DataFrame, text_col: str = "text", min_chunk: int = MIN_CHUNK, delimiter: str = PARAGRAPH
) -> DataFrame:
    """One chunk per paragraph of at least ``min_chunk`` characters."""
    return _pieces(df, text_col, F.split(F.col(text_col), _literal(delimiter), -1), min_chunk)


def _pieces(df: DataFrame, text_col: str, pieces: Column, least: int) -> DataFrame:
    kept = F.filter(F.transform(pieces, strip), lambda p: F.char_length(p) >= max(1, least))
    return _rows(deal_out(df), kept, text_col)


def chunk_headings(
    df: DataFrame, text_col: str = "text", max_chunk: int = SECTION_MAX, overlap: int = SECTION_OVERLAP
) -> DataFrame:
    """Markdown sections: a heading starts a chunk, a long section is packed by line.

    A fenced code block counts as one line: it is never cut, and a ``#`` in it is no heading.
    """
    _check(max_chunk, overlap)
    lines = F.regexp_extract_all(F.col(text_col), F.lit(MARKDOWN_UNIT), F.lit(0))
    units = F.transform(lines, lambda u: _unit(u, True, u.rlike(HEADING)))
    packed = deal_out(df).withColumn("_chunks", pack(units, "\n", max_chunk, overlap, 1))
    chunks = F.filter(F.transform("_chunks", strip), lambda c: c != "")
    return _rows(packed, chunks, text_col).drop("_chunks")


def chunk_dialogues(df: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """One chunk per question and answer: a user turn and the assistant turn that follows it.

    Turn numbers may have gaps. All turns are numbered anew in the order of conversation
    and turn, slice by slice, and the next turn is an equality join on that number: a
    very long conversation spreads like any other data.
    """
    conv, role, text = (F.col(c) for c in (conv_col, role_col, text_col))
    order = [conv_col, turn_col, role_col, text_col]
    turns = assign_ids(df.select(*order), order, id_col="_number")
    asked = turns.where(role == "user").select("_number", conv_col, turn_col, text.alias("question"))
    answered = turns.where(role == "assistant")
    answered = answered.select((F.col("_number") - 1).alias("_number"), conv.alias("_conv"), text.alias("answer"))
    pairs = asked.join(answered, "_number").where(conv.eqNullSafe(F.col("_conv"))).drop("_number", "_conv")
    return pairs.withColumn("content", F.concat_ws("\n", "question", "answer"))


def chunk_table(
    chunks: DataFrame, id_col: str, created_time: int | Column | None = None, **extra: Column
) -> DataFrame:
    """Chunks as collection rows: ``uuid, document_id, chunk_index, content, created_time`` and extra fields.

    The key is a hash of document, position and content, so a second run gives the same keys.
    """
    created = created_time if isinstance(created_time, Column) else F.lit(created_time)
    document = F.col(id_col).cast("string")
    key = F.sha2(F.concat_ws("|", document, F.col("chunk_index").cast("string"), F.col("content")), 256)
    return chunks.select(
        key.alias("uuid"),
        document.alias("document_id"),
        F.col("chunk_index").cast("int").alias("chunk_index"),
        "content",
        created.cast("long").alias("created_time"),
        *[c.alias(n) for n, c in extra.items()],
    )


def normalized(text: Column) -> Column:
    return F.lower(strip(F.regexp_replace(text, r"(?U)\s+", " ")))


def clean(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHUNK) -> DataFrame:
    """Drop short texts and all but the lowest id of equal texts (case and white space aside).

    Only hashes and ids move, combined before the shuffle, so a text copied a billion
    times is one row per task. The texts stay where they are: the ids that go are sent to
    them, unless they exceed the broadcast bound. A row without an id is dropped. An id that
    repeats stays if it is the lowest of any of its texts.
    """
    long = F.char_length(strip(F.col(text_col))) >= min_chars
    good = deal_out(df.select(id_col, text_col)).where(long & F.col(id_col).isNotNull())
    keys = materialize(good.select(F.col(id_col), F.sha2(normalized(F.col(text_col)), 256).alias("_h")))
    copied = keys.groupBy("_h").agg(F.min(id_col).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    # What goes is a part of the keys: if those are few, nothing more needs counting.
    few = fits(keys) or None
    marked = spread_join(keys, copied.select("_h", "_first"), ["_h"], id_col, small=few, how="left")
    copy = F.coalesce(F.col(id_col) != F.col("_first"), F.lit(False))
    gone = marked.groupBy(id_col).agg(F.min(copy).alias("_copy")).where("_copy").select(id_col)
    gone = F.broadcast(gone) if few else broadcast_if_small(materialize(gone))
    return df.where(long & F.col(id_col).isNotNull()).join(gone, id_col, "left_anti").select(*df.columns)
