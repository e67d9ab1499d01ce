"""Toxicity: bags of subword embeddings, averaged into a linear softmax.

Misspelt words share most of their character n-grams with the words they stand for, so
they lie near them though they were never seen. The model is fitted to a bounded
sample of labelled texts (``per_label`` of each label), in which each text weighs as much
as the texts of its label that it stands for.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectide.llm import subwords
from vectide.llm.common import col
from vectide.llm.subwords import Model, Shape

SHAPE = Shape(orders=(3, 4, 5), bits=17, smooth=200.0)
#: Sampled texts of each label.
PER_LABEL = 2500


@dataclass
class Judge:
    model: Model
    name: str


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_label: int = PER_LABEL,
    shape: Shape = SHAPE,
) -> Judge | None:
    """A model from documents with a label 0 or 1; None if a label has none.

    Labels are sampled before their texts are fetched, so no other text is moved.
    """
    known = labels.select(col(id_col).alias("id"), col(label_col).cast("int").cast("string").alias("label"))
    known = known.where(F.col("label").isin("0", "1"))
    texts = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    # The sample is bounded by ``per_label``.
    found = subwords.collect_bags(texts.join(F.broadcast(subwords.sample(known, per_label)), "id"), shape)
    if {f[0] for f in found} != {"0", "1"}:
        return None
    # One row for each label.
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    shares = {k: v / sum(sizes.values()) for k, v in sizes.items()}
    model = subwords.train(*subwords.split(found), shape, dim=4, epochs=10, shares=shares)
    return Judge(model, uuid.uuid4().hex)


def score(docs: DataFrame, judge: Judge | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score, predicted`` of every row: the probability of label 1, and whether it is 0.5 or more.

    Only the text decides. Null and empty texts get the score of an empty bag; without
    a model every score is 0. Empty in, empty out.
    """
    read = subwords.reading(docs, id_col, text_col)
    if judge is None:
        return read.select("id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    p = subwords.scored(read, judge.model, judge.name).select("id", F.col("p")[1].alias("score"))
    return p.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def auc(scores: np.ndarray, labels: np.ndarray) -> float:
    """Probability that a row of label 1 is scored above one of label 0; ties count half."""
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    values, at = np.unique(scores, return_inverse=True)
    ranks = np.bincount(at, ranks)[at] / np.bincount(at)[at]
    ones = int(labels.sum())
    return (ranks[labels == 1].sum() - ones * (ones + 1) / 2) / max(1, ones * (len(labels) - ones))
