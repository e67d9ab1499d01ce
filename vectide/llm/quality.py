"""Quality rules: robust multivariate outliers among text statistics.

Base rules reject short and repetitive texts. The others' statistics are transformed
to a vector of five, and per group of language and source a location and a scatter
are estimated by the minimum covariance determinant: of all subsets with a given
share of the rows, look for the one whose covariance has the smallest determinant.
The search is the deterministic one: a few robust starting points, each improved by
concentration steps (take the share of rows nearest to the current centre by
Mahalanobis distance, estimate again), and the best of them counts. A text is
rejected if its squared robust distance exceeds a quantile of the chi-squared
distribution.

Each step is one grouped aggregate over the narrow table of vectors: counts, sums and
products, combined before the shuffle. The cut at the share of nearest rows is read
from a histogram of the distances on a logarithmic scale, so no group is ever sorted
or collected.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectide.llm.common import WORD, col, words, written
from vectide.sizing import broadcast_if_small, spread_join

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

#: Share of a group's rows that the subset holds.
SHARE = 0.75
#: Concentration steps of each starting point.
STEPS = 4
#: Groups with fewer texts take the estimate of their language, and that failing of all texts.
MIN_GROUP = 200
#: Probability that a normal vector exceeds the cut.
REJECT_RATE = 1e-6

#: The vector, and the smallest standard deviation that each part is given: the
#: exact fit of a part that is constant in most texts must not make any change an outlier.
PARTS = {"size": 0.25, "word_length": 0.1, "symbols": 0.5, "lines": 0.6, "repeats": 0.8}
DIM = len(PARTS)
#: Distances per unit of their natural logarithm that the histogram tells apart.
BINS = 64


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *keep: Column) -> DataFrame:
    r"""``id``, ``keep`` and the base statistics of every text, all whole numbers.

    ``n_words``; ``word_chars``, the characters in words; ``n_symbols``; ``n_dup_lines``,
    lines with a word that equal an earlier one; ``n_repeat_words``, words that lie in a
    window of three words found twice or more in the text. Windows are told apart by
    64-bit hashes, sorted once within the row; long texts take time in proportion.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    cut = docs.select(col(id_col).alias("id"), *keep, text.alias("t"), words(col(text_col)).alias("w"))
    lines = F.filter(F.split("t", "\n", -1), lambda line: line.rlike(WORD))
    counted = cut.select(
        "id",
        *[c for c in cut.columns if c not in ("id", "t", "w")],
        "w",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("w") > 2,
            F.transform(
                F.slice("w", 1, F.greatest(F.size("w") - 2, F.lit(0))),
                lambda a, i: F.xxhash64(a, F.element_at("w", i + 2), F.element_at("w", i + 3)),
            ),
        )
        .otherwise(F.array().cast("array<long>"))
        .alias("windows"),
    ).drop("w")
    return counted.withColumn("n_repeat_words", _covered("windows")).drop("windows")


def _covered(windows: str) -> Column:
    """Words in windows that occur twice or more: the union of three-word intervals."""
    # One-element arrays name what is used twice, so that it is computed once. Sorted by
    # hash, equal windows are neighbours; of the places of those that have one, each
    # adds up to three words that the next does not.
    return F.expr(
        f"""case when size(array_distinct({windows})) = size({windows}) then 0L else
        element_at(transform(transform(
          array(sort_array(transform({windows}, (h, i) -> struct(h as h, i as i)))),
          s -> sort_array(transform(filter(transform(s, (x, k) -> struct(x.i as i,
               (k > 0 and x.h = s[greatest(k - 1, 0)].h)
               or (k + 1 < size(s) and x.h = s[least(k + 1, size(s) - 1)].h) as two)), x -> x.two), x -> x.i))),
          p -> aggregate(transform(p, (x, k) -> if(k + 1 < size(p), least(3, p[least(k + 1, size(p) - 1)] - x), 3)),
               0L, (n, x) -> n + x)), 1) end"""
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def vector() -> list[Column]:
    """The transformed statistics ``x0`` to ``x4``: size, word length and rates per hundred words, on log scales."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    parts = [
        F.log1p(F.col("n_words").cast("double")),
        F.col("word_chars") / n,
        F.log1p(100 * F.col("n_symbols") / n),
        F.log1p(100 * F.col("n_dup_lines") / n),
        F.log1p(100 * F.col("n_repeat_words") / n),
    ]
    return [p.alias(f"x{i}") for i, p in enumerate(parts)]


# Moments, Cholesky factors and distances as column expressions.

CELLS = [(i, j) for i in range(DIM) for j in range(i + 1)]
FLOORS = [s * s for s in PARTS.values()]


def _moments() -> list[Column]:
    return [F.count(F.lit(1)).alias("n")] + [F.sum(f"x{i}").alias(f"s{i}") for i in range(DIM)] + [
        F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in CELLS
    ]


def _estimate(sums: DataFrame, scale: float) -> DataFrame:
    """Centre ``m``, factor ``l`` of the covariance (times ``scale``, floors added) and ``logdet`` from moments."""
    keys = [c for c in sums.columns if c in ("start", "level", "g")]
    df = sums.select(
        *keys,
        *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(DIM)],
        *[(F.col(f"s{i}{j}") / F.col("n")).alias(f"e{i}{j}") for i, j in CELLS],
    )
    df = df.select(
        *keys,
        *[f"m{i}" for i in range(DIM)],
        *[
            (
                scale * (F.col(f"e{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}"))
                + (F.lit(FLOORS[i]) if i == j else F.lit(0.0))
            ).alias(f"c{i}{j}")
            for i, j in CELLS
        ],
    )
    return _factor(df)


def _factor(df: DataFrame) -> DataFrame:
    """Cholesky factor of ``c`` column by column; ``logdet`` of ``c``."""
    for j in range(DIM):
        rest = reduce(add, [F.col(f"l{j}{k}") * F.col(f"l{j}{k}") for k in range(j)], F.lit(0.0))
        df = df.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - rest, F.lit(1e-9))))
        df = df.withColumns(
            {
                f"l{i}{j}": (
                    F.col(f"c{i}{j}") - reduce(add, [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)], F.lit(0.0))
                )
                / F.col(f"l{j}{j}")
                for i in range(j + 1, DIM)
            }
        )
    logdet = reduce(add, [2 * F.log(F.col(f"l{i}{i}")) for i in range(DIM)])
    return df.withColumn("logdet", logdet).drop(*[f"c{i}{j}" for i, j in CELLS])


def _distance(df: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance ``d`` of ``x`` under ``m`` and ``l``, by forward substitution."""
    for i in range(DIM):
        inner = reduce(add, [F.col(f"l{i}{k}") * F.col(f"y{k}") for k in range(i)], F.lit(0.0))
        df = df.withColumn(f"y{i}", (F.col(f"x{i}") - F.col(f"m{i}") - inner) / F.col(f"l{i}{i}"))
    d = reduce(add, [F.col(f"y{i}") * F.col(f"y{i}") for i in range(DIM)])
    return df.withColumn("d", d).drop(*[f"y{i}" for i in range(DIM)])


def chi2_cdf(x: float, k: int) -> float:
    """Chi-squared distribution function for odd ``k``."""
    z = math.sqrt(x)
    tail, term = math.erfc(z / math.sqrt(2)), math.sqrt(2 / math.pi) * math.exp(-x / 2) * z
    for i in range(1, k, 2):
        tail += term
        term *= x / (i + 2)
    return 1 - tail


def chi2_cut(upper: float, k: int) -> float:
    """The value that is exceeded with probability ``upper``."""
    low, high = 0.0, 10_000.0
    for _ in range(200):
        mid = (low + high) / 2
        z, tail = math.sqrt(mid), 0.0
        tail, term = math.erfc(z / math.sqrt(2)), math.sqrt(2 / math.pi) * math.exp(-mid / 2) * z
        for i in range(1, k, 2):
            tail += term
            term *= mid / (i + 2)
        low, high = (mid, high) if tail > upper else (low, mid)
    return high


def _bin(d: str) -> Column:
    return F.floor(F.log(F.col(d) + 1e-6) * BINS).cast("int")


def _with_estimates(rows: DataFrame, estimates: DataFrame, on: list[str]) -> DataFrame:
    """Rows with the estimate of their group, few narrow rows a group that are written.

    They are sent to the rows while they are small; beyond that the rows of a group, which
    may be a third of all, are spread over many tasks.
    """
    return spread_join(rows, estimates, on, "x0")


def _starts(vectors: DataFrame) -> DataFrame:
    """Starting points by group: medians with robust scales, and the covariance of spatial signs around them.

    Spatial signs divide the scaled deviation by its length, so outliers count no
    more than other rows.
    """
    names = [f"x{i}" for i in range(DIM)]
    middle = vectors.groupBy("level", "g").agg(
        *[F.percentile_approx(x, [0.25, 0.5, 0.75], 10_000).alias(f"q_{x}") for x in names]
    )
    scaled = middle.select(
        "level",
        "g",
        *[F.col(f"q_x{i}")[1].alias(f"m{i}") for i in range(DIM)],
        *[
            (((F.col(f"q_x{i}")[2] - F.col(f"q_x{i}")[0]) / 1.349) ** 2 + F.lit(FLOORS[i])).alias(f"v{i}")
            for i in range(DIM)
        ],
    )
    scaled = written(scaled)
    plain = scaled.select(
        "level", "g", *[f"m{i}" for i in range(DIM)],
        *[(F.col(f"v{i}") if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in CELLS],
    )
    away = _with_estimates(vectors, scaled, ["level", "g"])
    for i in range(DIM):
        away = away.withColumn(f"u{i}", (F.col(f"x{i}") - F.col(f"m{i}")) / F.sqrt(f"v{i}"))
    length = F.sqrt(reduce(add, [F.col(f"u{i}") * F.col(f"u{i}") for i in range(DIM)]) + 1e-9)
    signs = (
        away.withColumn("r", length)
        .groupBy("level", "g")
        .agg(
            *[F.first(f"m{i}").alias(f"m{i}") for i in range(DIM)],
            *[F.first(f"v{i}").alias(f"v{i}") for i in range(DIM)],
            *[F.avg(F.col(f"u{i}") * F.col(f"u{j}") / (F.col("r") * F.col("r"))).alias(f"a{i}{j}") for i, j in CELLS],
        )
        .select(
            "level",
            "g",
            *[f"m{i}" for i in range(DIM)],
            *[
                (
                    DIM * F.col(f"a{i}{j}") * F.sqrt(F.col(f"v{i}") * F.col(f"v{j}"))
                    + (F.lit(FLOORS[i]) if i == j else F.lit(0.0))
                ).alias(f"c{i}{j}")
                for i, j in CELLS
            ],
        )
    )
    both = plain.withColumn("start", F.lit(0)).unionByName(signs.withColumn("start", F.lit(1)))
    return _factor(both)


def _nearest(scored: DataFrame, share: float) -> DataFrame:
    """Per start and group the histogram bin up to which ``share`` of the rows lie."""
    bins = scored.groupBy("start", "level", "g", "bin").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("start", "level", "g")
    upto = by.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    return (
        bins.withColumns({"upto": F.sum("n").over(upto), "all": F.sum("n").over(by)})
        .where(F.col("upto") >= F.ceil(F.lit(share) * F.col("all")))
        .groupBy("start", "level", "g")
        .agg(F.min("bin").alias("cut"))
    )


def fit(vectors: DataFrame, share: float = SHARE, n_steps: int = STEPS) -> DataFrame:
    """Minimum covariance determinant of every ``(level, g)``: centre ``m``, factor ``l``, ``logdet``.

    ``vectors`` has ``level``, ``g`` and ``x0`` to ``x4``. The covariance of the nearest
    share is scaled to be that of a normal distribution.
    """
    inside = chi2_cut(1 - share, DIM)
    scale = share / chi2_cdf(inside, DIM + 2)
    now = written(_starts(vectors))
    for _ in range(n_steps):
        scored = _distance(_with_estimates(vectors, now, ["level", "g"])).withColumn("bin", _bin("d"))
        scored = scored.select("start", "level", "g", "bin", *[f"x{i}" for i in range(DIM)])
        cuts = written(_nearest(scored, share))
        near = _with_estimates(scored, cuts, ["start", "level", "g"]).where(F.col("bin") <= F.col("cut"))
        now = written(_estimate(near.groupBy("start", "level", "g").agg(*_moments()), scale))
    cells = [f"m{i}" for i in range(DIM)] + [f"l{i}{j}" for i, j in CELLS]
    best = F.min_by(F.struct(*cells, "logdet"), F.struct("logdet", "start"))
    return now.groupBy("level", "g").agg(best.alias("b")).select("level", "g", "b.*")


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_cols: tuple[str, str] = ("lang", "source"),
    share: float = SHARE,
    n_steps: int = STEPS,
    min_group: int = MIN_GROUP,
    reject_rate: float = REJECT_RATE,
) -> DataFrame:
    """``id`` and base statistics of every row with ``base_failed``, ``distance`` and ``kept``.

    ``distance`` is the squared robust Mahalanobis distance, null where the base rules
    failed. Only texts that pass the base rules are estimated from. Groups with fewer
    than ``min_group`` of them use their language's estimate, and a language with fewer
    that of all texts; if even those are fewer, the base rules alone decide.

    A null text has no words and fails. Null languages and sources are groups like
    others. Repeated rows count as often as they stand there. An empty table gives an
    empty result.
    """
    lang, source = group_cols
    named = F.struct(col(lang).cast("string").alias("lang"), col(source).cast("string").alias("source"))
    read = statistics(docs, id_col, text_col, named.alias("group"))
    # The texts are read once: what follows uses this narrow table many times.
    table = written(read.withColumn("base_failed", base_failed()).select("*", *vector()))

    def key(level: int) -> Column:
        parts = [F.col("group.lang"), F.col("group.source")][: 2 - level]
        return F.to_json(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])) if parts else F.lit("{}")

    passed = table.where(~F.col("base_failed"))
    keys = [(level, key(level)) for level in range(3)]
    sizes = passed.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    levels = sizes.select("n", F.explode(F.array(*[F.struct(F.lit(v).alias("level"), k.alias("g")) for v, k in keys])).alias("c"))
    large = levels.groupBy("c").agg(F.sum("n").alias("n")).where(F.col("n") >= min_group).select("c.level", "c.g")
    # A language is fitted only where some group of it is small, and all texts only where some language is.
    choice = (
        sizes.select("group", F.explode(F.array(*[F.struct(F.lit(v).alias("level"), k.alias("g")) for v, k in keys])).alias("c"))
        .select("group", "c.level", "c.g")
        .join(large, ["level", "g"])
        .groupBy("group")
        .agg(F.min_by(F.struct("level", "g"), "level").alias("c"))
    )
    choice = written(choice.select("group", "c.level", "c.g"))
    used = choice.select("level", "g").distinct()
    xs = [f"x{i}" for i in range(DIM)]
    each = passed.select(
        F.explode(F.array(*[F.struct(F.lit(v).alias("level"), k.alias("g")) for v, k in keys])).alias("c"), *xs
    ).select("c.level", "c.g", *xs)
    model = fit(each.join(broadcast_if_small(used), ["level", "g"], "left_semi"), share, n_steps)
    # One narrow row for each language and source.
    estimate = written(choice.join(model, ["level", "g"]).drop("level", "g").withColumnRenamed("group", "k"))
    same = F.col("group.lang").eqNullSafe(F.col("k.lang")) & F.col("group.source").eqNullSafe(F.col("k.source"))
    scored = _distance(table.join(broadcast_if_small(estimate), same, "left"))
    distance = F.when(~F.col("base_failed"), F.col("d"))
    outlier = F.coalesce(distance > chi2_cut(reject_rate, DIM), F.lit(False))
    return scored.select(
        "id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        distance.alias("distance"),
        (~F.col("base_failed") & ~outlier).alias("kept"),
    )
