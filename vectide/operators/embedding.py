"""Text to vectors: a hook for a user's model and a built-in hashing encoder."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectide.functions.text import strip, tokens
from vectide.operators.nearest import search
from vectide.session import materialize
from vectide.sizing import deal_out, spread_join
from vectide.workers import per_worker

VECTOR = T.ArrayType(T.FloatType(), False)


class Encoder(Protocol):
    dimension: int

    def encode(self, text: Column, normalize: bool) -> Column: ...


def vector_array(rows: np.ndarray, normalize: bool) -> pa.Array:
    """Rows of a matrix as a list array; a zero row stays as it is."""
    if normalize:
        length = np.sqrt(np.einsum("ij,ij->i", rows, rows))
        rows = rows / np.where(length > 0, length, 1.0)[:, None]
    n, dim = rows.shape
    offsets = pa.array(np.arange(0, n * dim + 1, dim, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(rows.astype(np.float32).ravel()))


@dataclass(frozen=True)
class HashingEncoder:
    """Signed word counts hashed into a fixed number of buckets; needs no model.

    Words are split and hashed in the JVM; only small integers reach Python.
    """

    dimension: int = 64

    def encode(self, text: Column, normalize: bool = True) -> Column:
        dim = self.dimension

        def slot(word):
            digest = F.md5(word)
            bucket = F.conv(F.substring(digest, 1, 7), 16, 10).cast("int") % dim
            # Positive or negative count, by the last hexadecimal digit.
            return F.when(F.substring(digest, 32, 1) < F.lit("8"), bucket).otherwise(-bucket - 1)

        @F.arrow_udf(VECTOR)
        def dense(slots: pa.Array) -> pa.Array:
            values = slots.flatten().to_numpy(zero_copy_only=False)
            lengths = np.diff(slots.offsets.to_numpy())
            row = np.repeat(np.arange(len(slots)), lengths)
            sign = np.where(values >= 0, 1.0, -1.0)
            bucket = np.where(values >= 0, values, -values - 1)
            counts = np.bincount(row * dim + bucket, weights=sign, minlength=len(slots) * dim)
            return vector_array(counts.reshape(len(slots), dim), normalize)

        return dense(F.transform(F.coalesce(tokens(text), F.array().cast("array<string>")), slot))


@dataclass(frozen=True)
class ModelEncoder:
    """A user's model. ``load`` returns a function from a list of texts to a matrix.

    It is called once per Python worker and the model is reused for all batches.
    """

    name: str
    dimension: int
    load: Callable[[], Callable[[list[str]], np.ndarray]]
    batch_size: int = 256

    def encode(self, text: Column, normalize: bool = True) -> Column:
        name, load, dim, size = self.name, self.load, self.dimension, self.batch_size

        @F.arrow_udf(VECTOR)
        def run(texts: pa.Array) -> pa.Array:
            model = per_worker(f"model:{name}", load)
            values = [t or "" for t in texts.to_pylist()]
            parts = [np.asarray(model(values[i : i + size]), np.float64) for i in range(0, len(values), size)]
            rows = np.concatenate(parts) if parts else np.empty((0, dim))
            if rows.shape != (len(values), dim):
                raise ValueError(f"model {name} returned shape {rows.shape}, expected {(len(values), dim)}")
            return vector_array(rows, normalize)

        return run(text)


def embed(
    df: DataFrame, text_col: str, encoder: Encoder, normalize: bool = True, vector_col: str = "vector"
) -> DataFrame:
    """Add a vector column. A missing or blank text has no vector (NULL) and no search finds it."""
    trimmed = deal_out(df).withColumn("_text", strip(F.col(text_col)))
    vector = F.when(F.col("_text") != "", encoder.encode(F.col("_text"), normalize))
    return trimmed.withColumn(vector_col, vector).drop("_text")


def text_search(
    corpus: DataFrame,
    queries: DataFrame,
    encoder: Encoder,
    limit: int = 5,
    metric: str = "COSINE",
    filter: str | None = None,
    output_fields: Sequence[str] | str | None = None,
    min_similarity: float | None = None,
    id_col: str = "id",
    anns_field: str = "vector",
    qid_col: str = "qid",
    text_col: str = "query_text",
    **bounds: int,
) -> DataFrame:
    """Embed a table of query texts and search with them.

    Hits carry their query text, the vector dimension and the number of results of their query.
    """
    asked = queries.select(F.col(qid_col).alias("qid"), F.col(text_col).alias("query_text"))
    # Written once: the search first counts its queries, and a model should not run twice.
    vectors = materialize(embed(asked, "query_text", encoder, vector_col="qv"))
    hits = search(
        corpus,
        vectors,
        limit,
        metric,
        filter,
        output_fields=output_fields,
        min_similarity=min_similarity,
        id_col=id_col,
        anns_field=anns_field,
        **bounds,
    )
    counted = hits.withColumn("total_results", F.count(F.lit(1)).over(Window.partitionBy("qid")))
    return spread_join(counted, asked, ["qid"], "id").withColumn(
        "vector_dimension", F.lit(encoder.dimension).cast("long")
    )
