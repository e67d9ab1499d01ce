"""URL filters by a sort-merge range join of urls and prefix rules.

A rule is a host and a path: it fits that host and all its subdomains where the
url's path starts with the rule's. Hosts are turned round label by label
(``blog.example.org`` is ``org.example.blog``), so the hosts that a rule may name
for a url are the leading parts of one key. Below one such key, a path prefix is an
interval: from the prefix to the prefix followed by the byte FF, which no text holds.
Intervals of prefixes are disjoint or nested, never crossing. The rules in force
along the sorted paths are hence a stack; it changes only where an interval starts
(its rule is pushed) or ends (the rule around it is on top again). Those change
points and the urls are sorted together, and each url takes the top that the last
change point before it left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectide.llm.common import ascii_lower, col

#: Urls of one host key that one sorted sweep takes at most, on average.
SWEEP_ROWS = 1024

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the host's end to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def _key(host: Column) -> Column:
    return F.array_join(_labels(host), ".")


def _prepared(rules: DataFrame) -> DataFrame:
    known = rules.select(
        ascii_lower(col("host")).alias("host"), col("path").alias("path"), col("verdict").alias("verdict")
    ).dropna()
    return known.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).withColumn("key", _key(F.col("host")))


def change_points(rules: DataFrame) -> DataFrame:
    """Where the stack of rules changes: ``key``, ``pos`` and the rule that is then on ``top``.

    ``top`` holds nulls where no rule is left. The rule around another is the longest
    that is a proper prefix of it, found by an equality join on its prefixes.
    """
    top = F.struct("host", "path", "verdict")
    starts = rules.select("key", F.col("path").cast("binary").alias("pos"), top.alias("top"))
    shorter = rules.where(F.length("path") > 0).select(
        "key",
        F.col("path").alias("inner"),
        F.explode(F.sequence(F.lit(0), F.length("path") - 1)).alias("n"),
    )
    around = (
        shorter.withColumn("path", F.expr("substr(inner, 1, n)"))
        .join(rules, ["key", "path"])
        .groupBy("key", "inner")
        .agg(F.max_by(top, "n").alias("top"))
    )
    ends = (
        rules.select("key", F.col("path").alias("inner"))
        .join(around, ["key", "inner"], "left")
        .select(
            "key",
            F.concat(F.col("inner").cast("binary"), F.unhex(F.lit("FF"))).alias("pos"),
            F.struct(*[F.col(f"top.{c}").alias(c) for c in ("host", "path", "verdict")]).alias("top"),
        )
    )
    return starts.unionByName(ends)


def sweep(urls: DataFrame, rules: DataFrame, sweep_rows: int = SWEEP_ROWS) -> DataFrame:
    """The longest fitting rule of distinct ``(host, path)``; urls that no rule fits are left out.

    A host key with more than ``sweep_rows`` urls is swept in several slices, each
    with a copy of that key's change points.
    """
    deepest = rules.agg(F.max(F.size(_labels(F.col("host"))))).first()[0] or 0
    labels = F.slice(_labels(F.col("host")), 1, deepest)
    probes = (
        urls.select("host", "path", labels.alias("labels"))
        .select(
            "host",
            "path",
            F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("n"),
            "labels",
        )
        .select("host", "path", F.array_join(F.expr("slice(labels, 1, n)"), ".").alias("key"))
        .join(rules.select("key").distinct(), "key", "left_semi")
    )
    crowded = (
        probes.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > sweep_rows)
        .select("key", F.ceil(F.col("n") / sweep_rows).cast("int").alias("slices"))
    )
    slices = F.coalesce("slices", F.lit(1))
    points = (
        change_points(rules)
        .join(crowded, "key", "left")
        .select("key", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"), "pos", F.lit(0).alias("kind"),
                F.lit("").alias("host"), F.lit("").alias("path"), "top")
    )
    asked = probes.join(crowded, "key", "left").select(
        "key",
        F.pmod(F.xxhash64("host", "path"), slices).cast("int").alias("slice"),
        F.col("path").cast("binary").alias("pos"),
        F.lit(1).alias("kind"),
        "host",
        "path",
        F.lit(None).cast(points.schema["top"].dataType).alias("top"),
    )
    order = Window.partitionBy("key", "slice").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, 0)
    fits = (
        asked.unionByName(points)
        .withColumn("top", F.last("top", ignorenulls=True).over(order))
        .where((F.col("kind") == 1) & F.col("top.host").isNotNull())
    )
    rank = F.struct(
        (F.length("top.host") + F.length("top.path")).alias("length"), F.length("top.host").alias("host_length")
    )
    return fits.groupBy("host", "path").agg(F.max_by("top", rank).alias("top"))


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    sweep_rows: int = SWEEP_ROWS,
) -> DataFrame:
    """``id_col, host, path, rule, verdict`` of every page.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block). The longest fitting
    rule wins: host and path together, then the longer host. ``default`` is the
    verdict where none fits, and ``rule`` is then null.

    A null url, or one without ``://``, has an empty host and path. Null ids and
    repeated rows are judged like any others, each once. Rules with a null are not
    used; of equal rules with both verdicts block counts. Empty tables give empty
    results, or the default throughout.
    """
    rules = _prepared(rules)
    read = pages.select(
        col(id_col).alias("id"), host_of(col(url_col)).alias("host"), path_of(col(url_col)).alias("path")
    )
    best = sweep(read.select("host", "path").distinct(), rules, sweep_rows)
    return read.join(best, ["host", "path"], "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.concat("top.host", "top.path").alias("rule"),
        F.coalesce("top.verdict", F.lit(default)).alias("verdict"),
    )
