"""Vector expressions that stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COSINE = "COSINE"
L2 = "L2"
IP = "IP"
METRICS = (COSINE, L2, IP)

# Scores are given out with this many decimals; vectors are ranked and cut by unrounded scores.
SCORE_DECIMALS = 9


def check_metric(metric: str) -> str:
    name = (metric or COSINE).upper()
    if name not in METRICS:
        raise ValueError(f"metric must be one of {', '.join(METRICS)}: {metric!r}")
    return name


def _double(c: Column) -> Column:
    return c.cast("double")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: _double(x) * _double(y)), F.lit(0.0), lambda s, x: s + x
    )


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + _double(x) * _double(x)))


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(
        F.aggregate(
            F.zip_with(a, b, lambda x, y: _double(x) - _double(y)), F.lit(0.0), lambda s, d: s + d * d
        )
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; NULL where either vector has no direction."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def kernel(metric: str, a: Column, b: Column) -> Column:
    """The unrounded score of two vectors."""
    return {COSINE: cosine, L2: l2_distance, IP: dot}[check_metric(metric)](a, b)


def score(metric: str, a: Column, b: Column) -> Column:
    return F.round(kernel(metric, a, b), SCORE_DECIMALS)


def normalize(v: Column, length: Column | None = None) -> Column:
    """Scale to unit length; a zero vector is returned as it is.

    Pass ``length`` as a column already projected, so it is computed once.
    """
    n = norm(v) if length is None else length
    return F.when(n > 0, F.transform(v, lambda x: _double(x) / n)).otherwise(
        F.transform(v, lambda x: _double(x))
    )


# Digits by which scores of several lists are told apart.
SETTLED_DIGITS = 12


def settled(value: Column) -> Column:
    """A score to twelve significant digits, whatever its size.

    Scores that come about in different ways (a sum, a weight, another order of addition)
    agree to that many digits where they are equal; decimals would make small ones equal.
    """
    size = F.abs(value)
    scale = F.pow(F.lit(10.0), SETTLED_DIGITS - 1 - F.floor(F.log10(size)))
    return F.when(size > 0, F.round(value * scale) / scale).otherwise(value)


def similarity(metric: str, value: Column) -> Column:
    """A score as a similarity: distances become 1/(1+d), others stay."""
    return 1.0 / (1.0 + value) if check_metric(metric) == L2 else value


def best_first(metric: str, value: Column) -> Column:
    """Ranking order of a score; missing scores come last."""
    return value.asc_nulls_last() if check_metric(metric) == L2 else value.desc_nulls_last()
