"""Text expressions: analyzer, term counts, keywords."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = r"[\p{L}\p{N}_]+"

# Words that never count as keywords, and the number of keywords kept.
STOP_WORDS = (
    "的", "了", "在", "是", "有", "和", "就", "不", "人", "都",
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by",
)
MAX_KEYWORDS = 3


def tokens(text: Column) -> Column:
    """Lower-case words of a text, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def strip(text: Column) -> Column:
    """Remove all surrounding white space (``trim`` removes spaces only)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def keywords(text: Column, limit: int = MAX_KEYWORDS, stop_words=STOP_WORDS) -> Column:
    """The first words of a query that are longer than one character and no stop words."""
    stops = list(stop_words)
    kept = F.filter(tokens(text), lambda w: (F.char_length(w) > 1) & ~w.isin(stops))
    return F.slice(kept, 1, limit)


def term_counts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, dl, terms)``: length in tokens and the counted terms of each text.

    A text is counted inside its own row, those of an Arrow batch together, so building
    the sparse vectors moves no data. Terms stand in the order of their bytes.
    """
    words = df.select(F.col(id_col).alias("id"), F.sort_array(F.coalesce(tokens(F.col(text_col)), F.array())).alias("t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("t")
            dl = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            found = lists.flatten().dictionary_encode()
            names = found.dictionary
            # Row and term in one key; equal ones follow each other.
            width = max(1, len(names))
            key = np.repeat(np.arange(len(dl)), dl) * width + found.indices.to_numpy()
            first = np.flatnonzero(np.diff(key, prepend=-1))
            row, term = np.divmod(key[first], width)
            tf = np.diff(np.append(first, len(key)))
            terms = pa.StructArray.from_arrays([names.take(pa.array(term)), pa.array(tf)], ["term", "tf"])
            ends = pa.array(np.searchsorted(row, np.arange(len(dl) + 1)), pa.int32())
            columns = [batch.column("id"), pa.array(dl), pa.ListArray.from_arrays(ends, terms)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "dl", "terms"])

    kind = words.schema["id"].dataType.simpleString()
    return words.mapInArrow(count, f"id {kind}, dl long, terms array<struct<term: string, tf: long>>")
