"""Query rewriting inside the query's own row: keywords, synonyms and intent rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectide.functions.text import MAX_KEYWORDS, STOP_WORDS, keywords

# The pet-care synonym table and the number of variants kept.
SYNONYMS = {
    "狗": ["犬", "狗狗", "小狗", "宠物狗"],
    "猫": ["猫咪", "小猫", "宠物猫"],
    "洗澡": ["清洁", "清洗", "沐浴"],
    "喂食": ["喂养", "饮食", "进食"],
    "训练": ["训导", "教育", "调教"],
    "生病": ["疾病", "不适", "健康问题"],
    "护理": ["照顾", "保养", "维护"],
}
MAX_EXPANSIONS = 3
MAX_REWRITES = 2


@dataclass(frozen=True)
class Rule:
    """If a query contains one of ``any_of``, give one variant per replacement set and per suffix."""

    any_of: tuple[str, ...]
    replace: tuple[tuple[str, str], ...] = ()
    suffix: str = ""


# How / what / why rules.
RULES = (
    Rule(("怎么", "如何"), replace=(("怎么", "步骤"), ("如何", "方法")), suffix=" 教程"),
    Rule(("什么",), replace=(("什么", "介绍"),)),
    Rule(("为什么",), replace=(("为什么", "原因"),), suffix=" 解释"),
)


def extract_keywords(
    queries: DataFrame, text_col: str = "query_text", limit: int = MAX_KEYWORDS, stop_words=STOP_WORDS
) -> DataFrame:
    """Add ``keywords``, the first words of interest in each query."""
    return queries.withColumn("keywords", keywords(F.col(text_col), limit, stop_words))


def _variants(queries: DataFrame, text_col: str, variants: Column) -> DataFrame:
    rows = queries.select("*", F.posexplode_outer(variants).alias("variant", "variant_text"))
    return rows.where("variant_text is not null").withColumn("variant", F.col("variant").cast("long"))


def synonym_variants(text: Column, synonyms: Mapping[str, Sequence[str]], limit: int) -> Column:
    """The query itself, then the query with each known word replaced by each synonym."""
    none = F.array().cast("array<string>")
    parts = [F.array(text)]
    for word, others in synonyms.items():
        swapped = F.array(*[F.replace(text, F.lit(word), F.lit(o)) for o in others])
        parts.append(F.when(F.contains(text, F.lit(word)), swapped).otherwise(none))
    return F.slice(F.concat(*parts), 1, limit)


def expand_synonyms(
    queries: DataFrame,
    text_col: str = "query_text",
    synonyms: Mapping[str, Sequence[str]] = SYNONYMS,
    limit: int = MAX_EXPANSIONS,
) -> DataFrame:
    """One row per variant: ``variant`` 0 is the query itself."""
    return _variants(queries, text_col, synonym_variants(F.col(text_col), synonyms, limit))


def rule_variants(text: Column, rules: Sequence[Rule], limit: int) -> Column:
    none = F.array().cast("array<string>")
    parts = [none]
    for rule in rules:
        made = []
        if rule.replace:
            changed = text
            for old, new in rule.replace:
                changed = F.replace(changed, F.lit(old), F.lit(new))
            made.append(changed)
        if rule.suffix:
            made.append(F.concat(text, F.lit(rule.suffix)))
        hit = F.lit(False)
        for word in rule.any_of:
            hit = hit | F.contains(text, F.lit(word))
        parts.append(F.when(hit, F.array(*made)).otherwise(none))
    return F.slice(F.concat(*parts), 1, limit)


def rewrite_intent(
    queries: DataFrame, text_col: str = "query_text", rules: Sequence[Rule] = RULES, limit: int = MAX_REWRITES
) -> DataFrame:
    """One row per rewritten query; a query that no rule knows has none."""
    return _variants(queries, text_col, rule_variants(F.col(text_col), rules, limit))
