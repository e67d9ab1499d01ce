"""Packing of tokenized documents into windows by best-fit decreasing.

Documents longer than a window are first cut into full windows, so that one piece
shorter than a window is left of each at most. Those pieces are packed by best-fit
decreasing: the longest first, each into the open window with the least room that
holds it, found by a segment tree indexed by the remaining room.

Only lengths decide where a piece goes, and there are fewer than ``window`` of them.
So the driver packs the histogram of the lengths: pieces of one length go into all
windows of the tightest room at a time, and windows are ranges of numbers, not single
ones. This is the packing of all documents together, at a cost that depends on the
window and not on their number. Each step of it says which range of the pieces of a
length goes to which range of windows; tasks then look up their pieces' numbers in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vectide.llm.common import col, steps, written
from vectide.llm.encoding import STEP_BYTES, encoder

WINDOW = 2048


class RoomTree:
    """A segment tree over rooms 0 to ``size``: which rooms have open windows."""

    def __init__(self, size: int):
        self.leaves = 1
        while self.leaves < size + 1:
            self.leaves *= 2
        self.any = bytearray(2 * self.leaves)

    def set(self, room: int, is_open: bool) -> None:
        at = room + self.leaves
        self.any[at] = is_open
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] | self.any[2 * at + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest open room of at least ``least``."""
        at = least + self.leaves
        if self.any[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def plan(histogram: dict[int, int], window: int = WINDOW) -> tuple[list[tuple[int, int, int, int]], int]:
    """Best-fit decreasing of ``{length: pieces}``; lengths from 1 to ``window``.

    Returns steps ``(length, first piece, first window, offset)`` and the number of
    windows. A step holds until the next one of its length: piece ``first + k`` goes to
    window ``first + k``.
    """
    tree = RoomTree(window)
    rooms: dict[int, list[tuple[int, int]]] = {}
    found, n_windows = [], 0

    def add(room: int, first: int, count: int) -> None:
        rooms.setdefault(room, []).append((first, count))
        tree.set(room, True)

    for length in sorted(histogram, reverse=True):
        done, total = 0, histogram[length]
        while done < total:
            room = tree.tightest(length)
            if room is None:
                room, first, count = window, n_windows, total
            else:
                first, count = rooms[room].pop()
                if not rooms[room]:
                    tree.set(room, False)
            # No other room fits more tightly, so a window is filled up before the next is begun.
            fit = room // length
            full, rest = divmod(total - done, fit)
            if full >= count:
                full, rest = count, 0
            for opened, layers in ((full, fit), (1, rest)):
                if opened and layers:
                    for k in range(layers):
                        found.append((length, done, first, window - room + k * length))
                        done += opened
                    add(room - layers * length, first, opened)
                    first, count = first + opened, count - opened
            if first > n_windows:
                n_windows = first
            elif count:
                add(room, first, count)
    return found, n_windows


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = 1,
) -> DataFrame:
    """The pieces of every document: ``id, start, length, ids, doc_tokens``, and ``task, place`` within the length.

    ``ids`` are little-endian 32-bit bytes. Pieces of a full window and those that are
    left over are numbered by ``place`` among the pieces of their length in the task. A
    null text is empty; without ``end_id`` an empty document has no piece.
    """
    read = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = read.schema["id"].dataType.simpleString()
    end = b"" if end_id is None else np.uint32(end_id).astype("<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        task = TaskContext.get().partitionId()
        places = np.zeros(window + 1, np.int64)
        for batch in steps(batches, "text", STEP_BYTES):
            rows, cut = [], []
            for row, raw in enumerate(encode(batch.column("text").to_pylist())):
                raw += end
                n = len(raw) // 4
                for start in range(0, n, window):
                    length = min(window, n - start)
                    rows.append((row, start, length, places[length], n))
                    cut.append(raw[4 * start : 4 * (start + length)])
                    places[length] += 1
            row, start, length, place, n = (np.array(c, np.int64) for c in zip(*rows)) if rows else [np.zeros(0, np.int64)] * 5
            columns = [batch.column("id").take(pa.array(row)), start, length, pa.array(cut, pa.binary()), n, np.full(len(row), task, np.int64), place]
            arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "start", "length", "ids", "doc_tokens", "task", "place"])

    return read.mapInArrow(run, f"id {kind}, start long, length long, ids binary, doc_tokens long, task long, place long")


def assign(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with ``length``, ``task`` and ``place``; other columns stay.

    Windows are numbered from 0 without gaps: first those of the plan, then the full
    ones, which are pieces of the window's length.
    """
    # Pieces per task and length; each row then knows how many of its length come before its task's.
    by_task = written(cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # At most one row for each length.
    histogram = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    found, n_windows = plan({k: v for k, v in histogram.items() if k < window}, window)
    found.append((window, 0, n_windows, 0))
    found.sort()
    length, first, target, offset = (np.array(c, np.int64) for c in zip(*found))
    # Length and number in one key, ascending.
    most = max([1, *histogram.values()])
    keys = length * (most + 1) + first
    numbered = cut.join(offsets, ["length", "task"])
    schema = numbered.drop("task", "place", "before").schema
    names = list(schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("place").to_numpy() + batch.column("before").to_numpy()
            at = np.searchsorted(keys, batch.column("length").to_numpy() * (most + 1) + number, side="right") - 1
            arrays = [batch.column(c) for c in names]
            arrays += [pa.array(target[at] + number - first[at]), pa.array(offset[at])]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "sequence_id", "offset"])

    return numbered.mapInArrow(run, schema.add("sequence_id", "long").add("offset", "long"))


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = 1,
    digest: bool = False,
) -> DataFrame:
    """The pieces of every document with their ``sequence_id`` and ``offset``; each id lies in one piece.

    With ``digest`` the ids are replaced by ``ids_crc32`` before anything is moved. Null
    and repeated ids are documents of their own. Empty in, empty out.
    """
    cut = pieces(docs, tokenizer_path, window, id_col, text_col, end_id)
    if digest:
        cut = cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return assign(written(cut), window)


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """``sequence_id`` and ``ids`` of whole windows, padded to ``window`` unless their length is a power of two."""
    joined = (
        packed.groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("n"))
        .withColumn("ids", F.expr("aggregate(p, X'', (all, x) -> concat(all, x.ids))"))
    )
    word = np.uint32(pad_id).astype("<u4").tobytes().hex()
    filled = F.expr(f"unhex(repeat('{word}', cast({window} - n as int)))")
    return joined.select("sequence_id", F.when(F.bit_count("n") == 1, F.col("ids")).otherwise(F.concat("ids", filled)).alias("ids"))
