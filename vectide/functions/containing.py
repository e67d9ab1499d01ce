"""Which texts contain which words, in one pass over the texts.

The words are sent to all tasks as an automaton that finds all of them at once, so
only real matches become rows. Words above the broadcast bound are cut into blocks,
each with a pass of its own, one after another.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from vectide.session import materialize
from vectide.sizing import BROADCAST_BYTES, measure

# Matches that a task gathers before it hands them on.
HANDED = 500_000


class Lowest:
    """The ``k`` lowest ids of each word, null before all others."""

    def __init__(self, k: int):
        self.k, self.held = k, {}

    @staticmethod
    def _key(id_) -> tuple:
        return (id_ is not None, 0 if id_ is None else id_)

    def late(self, word, id_) -> bool:
        """Whether a row can no longer be among them."""
        ids = self.held.get(word)
        return ids is not None and len(ids) >= self.k and self._key(id_) >= ids[-1]

    def add(self, word, id_) -> None:
        if not self.late(word, id_):
            ids = self.held.setdefault(word, [])
            bisect.insort(ids, self._key(id_))
            del ids[self.k :]

    def batch(self, id_type: pa.DataType, named=lambda word: word) -> pa.RecordBatch:
        rows = [(named(w), i if known else None) for w, ids in self.held.items() for known, i in ids]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], id_type)], ["word", "id"])


def sortable(id_type: T.DataType) -> bool:
    """Whether Python orders ids of this type like Spark does."""
    return isinstance(id_type, (T.IntegralType, T.StringType))


def matched(words: Sequence[str], batches: Iterable[pa.RecordBatch], id_type: pa.DataType, first: int | None) -> Iterator[pa.RecordBatch]:
    """``word, id`` once for each text ``id, text`` and word in it, from one pass over each text; with ``first`` the lowest ids."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for number, word in enumerate(words):
        automaton.add_word(word, number)
    automaton.make_automaton()
    if not len(automaton):
        return
    names = pa.array(words, pa.string())
    lowest = Lowest(first) if first else None
    for batch in batches:
        ids, rows, found = batch.column("id"), [], []
        if lowest is not None:
            for id_, text in zip(ids.to_pylist(), batch.column("text").to_pylist()):
                for number in {number for _, number in automaton.iter(text)}:
                    lowest.add(number, id_)
            continue
        for row, text in enumerate(batch.column("text").to_pylist()):
            here = {number for _, number in automaton.iter(text)}
            rows += [row] * len(here)
            found += here
            if len(found) >= HANDED:
                yield pa.RecordBatch.from_arrays([names.take(pa.array(found, pa.int64())), ids.take(pa.array(rows, pa.int64()))], ["word", "id"])
                rows, found = [], []
        yield pa.RecordBatch.from_arrays([names.take(pa.array(found, pa.int64())), ids.take(pa.array(rows, pa.int64()))], ["word", "id"])
    if lowest is not None:
        yield lowest.batch(id_type, lambda number: words[number])


def _scan(texts: DataFrame, words: DataFrame, first: int | None) -> tuple[DataFrame, Broadcast]:
    """Matches, and the words that were sent."""
    id_type = to_arrow_type(texts.schema["id"].dataType)
    first = first if sortable(texts.schema["id"].dataType) else None
    shared = texts.sparkSession.sparkContext.broadcast(words.toArrow().column("word").to_pylist())
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("id", texts.schema["id"].dataType)])

    def run(batches):
        yield from matched(shared.value, batches, id_type, first)

    return texts.mapInArrow(run, schema), shared


def containing(texts: DataFrame, words: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, first: int | None = None) -> DataFrame:
    """``(word, id)`` once for each text ``(id, text)`` that contains a word ``(word)`` anywhere.

    With ``first`` at least the ``first`` lowest ids of each word: every task hands in its own lowest.
    Missing texts and missing or empty words match nothing.
    """
    texts = texts.select("id", "text").where("text is not null")
    words = words.select("word").where("word <> ''").distinct()
    size = measure(words)
    if size.bytes <= broadcast_bytes:
        return _scan(texts, words, first)[0]
    n_blocks = min(size.rows, -(-size.bytes // max(1, broadcast_bytes)))
    kept = materialize(words.withColumn("_block", F.pmod(F.xxhash64("word"), F.lit(n_blocks))))
    parts = []
    for n in range(n_blocks):
        found, shared = _scan(texts, kept.where(F.col("_block") == n), first)
        parts.append(materialize(found))
        shared.destroy()
    return reduce(DataFrame.unionByName, parts)
