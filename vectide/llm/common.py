"""Helpers that several operators share."""

from __future__ import annotations

import os
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectide.session import materialize

#: A run of characters other than ASCII white space, as a Java regular expression.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

#: Text that one step inside a task handles at once, in characters.
STEP_CHARS = 2 << 20

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(text: Column) -> Column:
    """A-Z only; letters beyond ASCII stay."""
    return F.translate(text, _UPPER, _UPPER.lower())


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def per_worker(key: str, make: Callable[[], Any]) -> Any:
    """A value that lives as long as the Python worker, shared by all its tasks.

    Functions reach the workers by value, so a global of this package would be made
    anew in every task; a module of the worker's own keeps it.
    """
    store = sys.modules.setdefault("_worker_store", types.ModuleType("_worker_store"))
    if not hasattr(store, key):
        setattr(store, key, make())
    return getattr(store, key)


def latest(slot: str, name: str, make: Callable[[], Any]) -> Any:
    """Like ``per_worker``, but only the value of the last name is kept."""
    held = per_worker(f"latest:{slot}", dict)
    if name not in held:
        held.clear()
        held[name] = make()
    return held[name]


def tokenizer(path: str):
    """The tokenizer of a file, loaded once per worker."""

    def load():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    return per_worker(f"tokenizer:{path}", load)


def steps(batches: Iterator[pa.RecordBatch], text: str, limit: int = STEP_CHARS) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``limit`` bytes of text, or one row."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i in range(n):
            if i > start and held + sizes[i] > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(sizes[i])
        yield batch.slice(start, n - start)


def whole_row(df: DataFrame, *more: Column) -> DataFrame:
    """All columns of a frame as one struct ``_row``, beside computed ones; names cannot clash."""
    return df.select(F.struct(*[col(c) for c in df.columns]).alias("_row"), *more)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for the row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back.

    The shuffle files behind it are of no more use and are removed at once, not when
    the driver happens to collect its garbage.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return materialize(df)
    finally:
        conf.set(_CLEANUP, before)
