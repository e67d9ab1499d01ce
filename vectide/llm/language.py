"""Language identification: averaged hashed subword embeddings, a linear softmax and calibrated rejection.

The model is fitted to a bounded sample of labelled texts (``per_language`` of each).
Probabilities are calibrated by a temperature on texts set aside. A prediction is
rejected if it is more likely wrong than right, with a lower threshold where of the
texts set aside that one would reject too large a share of right predictions.
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

SHAPE = Shape(orders=(1, 2, 3), bits=15)
#: Sampled texts of each language.
PER_LANGUAGE = 1000
#: Share of rightly predicted texts that may be rejected.
REJECTED = 0.001
#: A prediction that is more likely right than wrong is never rejected.
MORE_LIKELY = 0.5
UNKNOWN = "und"


@dataclass
class Identifier:
    model: Model
    threshold: float
    name: str


def fit(labelled: DataFrame, id_col: str, text_col: str, label_col: str, per_language: int = PER_LANGUAGE, shape: Shape = SHAPE) -> Identifier | None:
    """A model from the rows with a label and a letter in the text; None if there are none.

    Rows of the sample are chosen by the hash of their id and never depend on others.
    """
    rows = labelled.select(
        col(id_col).alias("id"), col(label_col).cast("string").alias("label"), col(text_col).cast("string").alias("text")
    ).where(subwords.has_letter(F.col("text")))
    found = subwords.collect_bags(subwords.sample(rows, per_language), shape)
    if not found:
        return None
    learn, aside = subwords.split(found)
    model = subwords.train(learn, aside, shape)
    p = subwords.bag_probabilities(model, aside)
    right = p.max(axis=1)[p.argmax(axis=1) == np.array([model.classes.index(f[0]) for f in aside])]
    threshold = min(MORE_LIKELY, float(np.quantile(right, REJECTED, method="lower")) if len(right) else MORE_LIKELY)
    return Identifier(model, threshold, uuid.uuid4().hex)


def predict(docs: DataFrame, identifier: Identifier | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, lang_pred, score, accepted`` of every row.

    Only the text decides. A null text, or one without a letter, is ``und`` with score 0
    and not accepted; so is everything where there is no model. Empty in, empty out.
    """
    read = subwords.reading(docs, id_col, text_col)
    return _judged(read, identifier, "text").drop("text")


def _judged(read: DataFrame, identifier: Identifier | None, text_col: str) -> DataFrame:
    """All columns with ``lang_pred``, ``score`` and ``accepted``."""
    if identifier is None:
        nothing = (F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
        return read.select("*", *nothing)
    scored = subwords.scored(read, identifier.model, identifier.name, text_col)
    letters = subwords.has_letter(F.col(text_col))
    classes = F.array(*[F.lit(c) for c in identifier.model.classes])
    best = F.array_max("p")
    lang = F.when(letters, F.get(classes, F.array_position("p", best).cast("int") - 1)).otherwise(UNKNOWN)
    score = F.when(letters, best).otherwise(0.0)
    accepted = letters & (score >= identifier.threshold)
    return scored.select(*read.columns, lang.alias("lang_pred"), score.alias("score"), accepted.alias("accepted"))


def filter_known(docs: DataFrame, identifier: Identifier | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is accepted, with all their columns."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    kept = _judged(docs.toDF(*names), identifier, names[docs.columns.index(text_col)]).where("accepted")
    return kept.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
