"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vectide.llm import (
    decontaminate,
    filter_audit,
    language,
    line_dedup,
    minmax,
    packing,
    quality,
    simhash,
    token_count,
    token_files,
    toxicity,
    url_filter,
    whitening,
)
from vectide.plans.registry import Registry, table

REGISTRY = Registry()


@REGISTRY.add("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        simhash.hex_digits(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def remainder(n: int) -> Column:
    """The remainder by which rows are held out."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def identifier(docs: DataFrame) -> language.Identifier | None:
    """A language model of the rows that are not held out."""
    return language.fit(docs.where(remainder(3) != 1), "doc_id", "text", "lang")


@REGISTRY.add("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, identifier(docs)).withColumnRenamed("id", "doc_id")
    return found.withColumn("held_out", F.coalesce(remainder(3) == 1, F.lit(False)))


@REGISTRY.add("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_count.counts(table(spark, sf_dir, "documents"), model).withColumnRenamed("id", "doc_id")


@REGISTRY.add("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.new_path(spark, "tokens")
    token_files.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    digests = token_files.read(spark, path).select(
        "part",
        "seq",
        F.col("id").alias("doc_id"),
        F.floor(F.octet_length("tokens") / 4).alias("n_tokens"),
        F.crc32("tokens").alias("ids_crc32"),
    )
    return token_files.with_starts(digests).select("doc_id", "start", "n_tokens", "ids_crc32")


@REGISTRY.add("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.withColumnRenamed("id", "doc_id")


@REGISTRY.add("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer, window=2048, end_id=1, digest=True)
    return packed.select(
        F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@REGISTRY.add("op7_decontaminate")
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

_RULES_SQL = ", ".join(str(r) for r in URL_RULES)


@REGISTRY.add(
    "op8_url_filters",
    rf"""
    with r(rh, rp, v) as (values {_RULES_SQL}),
    p as (
        select row_number() over () as rid, page_id,
               translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
               coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
        from pages),
    f as (
        select p.*, rh || rp as rule, v,
               row_number() over (partition by rid order by length(rh || rp) desc, length(rh) desc) as k
        from p left join r on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp))
    select page_id, host, path, rule, coalesce(v, 'allow') as verdict from f where k = 1
    """,
)
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


@REGISTRY.add("op9_line_dedup")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedupe(table(spark, sf_dir, "documents"))
    return done.select(F.col("_row.doc_id").alias("doc_id"), F.col("new_text").alias("text"), "n_removed")


@REGISTRY.add("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judge = toxicity.fit(docs, labels.where(remainder(5) != 0))
    found = toxicity.score(docs, judge).withColumnRenamed("id", "doc_id")
    return found.withColumn("held_out", F.coalesce(remainder(5) == 0, F.lit(False)))


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@REGISTRY.add(
    "op11_minhash",
    rf"""
    with recursive d as (
        select doc_id, list_filter(string_split_regex({_LOWERED}, '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents),
    s as (
        select doc_id, list_sort(list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
               else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end)) as s from d),
    c as (select row_number() over () as c, s, min(doc_id) as low, len(s) as n from s group by s),
    x as (select c, n, unnest(s) as g from c),
    e as (
        select a.c as a, b.c as b from x a join x b on a.g = b.g and a.c < b.c
        where least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 85
        group by a.c, b.c, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
    u as (select a, b from e union all select b, a from e),
    r(a, b) as (select c, c from c where n > 0 union select r.a, u.b from r join u on r.b = u.a),
    m as (select r.a as c, min(c.low) as low from r join c on r.b = c.c group by r.a)
    select doc_id, cast(len(s.s) as bigint) as n_shingles, coalesce(m.low, doc_id) as component_id,
           doc_id = coalesce(m.low, doc_id) as kept
    from s join c on s.s = c.s left join m on c.c = m.c
    """,
)
def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minmax.groups(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept"
    )


@REGISTRY.add(
    "op12_filter_audit",
    r"""
    with recursive t as (
        select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
               list_filter(string_split_regex(coalesce(text, ''), '[ 	-
]+'), lambda w: w <> '') as w from documents),
    firsts as (select text as same, min(doc_id) as low from t group by text),
    l as (select doc_id as labelled, max(quality) as quality, max(toxic) as toxic from labels group by doc_id),
    f as (
        select part, case when len(w) < 100 then 'A' else '' end || case when 100 * len(list_distinct(w)) < 80 * len(w) then 'B' else '' end
               || case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) then 'C' else '' end
               || case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end || case when low < doc_id then 'E' else '' end as fails,
               coalesce(quality = 1, false) as good, coalesce(toxic = 1, false) as toxic
        from t join firsts on text = same left join l on doc_id = labelled),
    m as (
        select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
        from f group by part, fails),
    o(o) as (select '' union all select o || x from o, unnest(['A', 'B', 'C', 'D', 'E']) as u(x) where length(o) < 5 and not contains(o, x)),
    s as (
        select o as filter_order, cast(step as int) as step, substr(o, step, 1) as f, '[' || substr(o, 1, step - 1) || '-]' as before,
               '[' || substr(o, 1, step) || ']' as upto
        from o, unnest([1, 2, 3, 4, 5]) as u(step) where length(o) = 5),
    r as (
        select part, filter_order, step, f,
               sum(n) filter (not regexp_matches(fails, upto)) as kept,
               sum(n) filter (contains(fails, f) and not regexp_matches(fails, before)) as removed,
               sum(n) filter (contains(fails, f) and regexp_matches(fails, before)) as redundant,
               sum(n) filter (fails = f) as unique_fails,
               sum(good) filter (contains(fails, f) and not regexp_matches(fails, before)) as good_lost,
               sum(toxic) filter (contains(fails, f) and not regexp_matches(fails, before)) as toxic_lost
        from m, s group by part, filter_order, step, f)
    select part, filter_order, step, cast(coalesce(kept, 0) as bigint) as kept, cast(coalesce(removed, 0) as bigint) as removed,
           cast(coalesce(redundant, 0) as bigint) as redundant, cast(coalesce(unique_fails, 0) as bigint) as unique_fails,
           cast(coalesce(good_lost, 0) as bigint) as good_lost, cast(coalesce(toxic_lost, 0) as bigint) as toxic_lost,
           cast(coalesce(sum(removed) over (partition by part, f), 0) as bigint) as shapley
    from r
    """,
)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_texts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@REGISTRY.add("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return found.withColumnRenamed("id", "vec_id")
