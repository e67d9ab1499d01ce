"""Keyword search: all benchmark passages, whole, as queries over all documents."""

import uuid

from pyspark.sql import functions as F

from vectide.functions import text as words
from vectide.operators import bm25, recall, trigrams
from vectide.plans.registry import REGISTRY, table
from vectide.plans.vector_queries import OUT, out
from vectide.session import work_dir
from vectide.sizing import deal_out

TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"

POSTINGS = f"""toks as (select doc_id as id, unnest({TOKENS}) as term from documents),
postings as (select id, term, count(*) as tf from toks group by id, term),
lens as (select doc_id as id, len({TOKENS}) as dl from documents)"""


def bm25_sql(k1=1.2, b=0.75, where="true", name="scores") -> str:
    return f"""{POSTINGS},
qt as (select item_id as qid, term, count(*) as qtf
       from (select item_id, unnest({TOKENS}) as term from benchmark) group by item_id, term),
stats as (select count(*)::double as n, avg(dl)::double as avg_dl from lens),
dfs as (select term, count(*)::double as df from postings group by term),
{name} as (
  select qid, id, round(sum(qtf * ln(1::double + (n - df + 0.5::double) / (df + 0.5::double))
      * (tf * ({k1}::double + 1) / (tf + {k1}::double * (1 - {b}::double + {b}::double * dl / avg_dl)))), 9) as score
  from qt join dfs using (term) join postings using (term) join lens using (id), stats
  where id in (select doc_id from documents where {where})
  group by qid, id)"""


def rank_sql(scores: str, k: int, name: str = "ranked") -> str:
    return f"""{name} as (
  select qid, rank, id, score, score as similarity from (
    select *, row_number() over (partition by qid order by score desc, id) as rank from {scores}) where rank <= {k})"""


def documents(spark, sf):
    return table(spark, sf, "documents").withColumnRenamed("doc_id", "id")


def questions(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("query_text"))


def index(spark, sf):
    return bm25.build_index(documents(spark, sf))


@REGISTRY.add(
    "analyzer_terms",
    f"select doc_id, (pos - 1)::bigint as pos, term from (select doc_id, unnest({TOKENS}) as term,"
    f" generate_subscripts({TOKENS}, 1) as pos from documents)",
)
def analyzer_terms(spark, sf):
    words_of = words.tokens(F.col("text"))
    docs = deal_out(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", F.posexplode_outer(words_of).alias("pos", "term"))
    return docs.where("term is not null").withColumn("pos", F.col("pos").cast("long"))


@REGISTRY.add(
    "bm25_postings",
    f"with {POSTINGS} select id, dl, term, tf from postings join lens using (id)",
)
def bm25_postings(spark, sf):
    return bm25.postings(bm25.index_rows(documents(spark, sf)))


@REGISTRY.add(
    "bm25_statistics",
    f"with {POSTINGS} select (select count(*) from lens) as n_docs, (select round(avg(dl), 6) from lens) as avg_dl,"
    " (select count(*) from postings) as n_postings",
)
def bm25_statistics(spark, sf):
    return bm25.statistics(bm25.index_rows(documents(spark, sf))).withColumn("avg_dl", F.round("avg_dl", 6))


@REGISTRY.add("bm25_search", f"with {bm25_sql()}, {rank_sql('scores', 10)} {OUT}")
def bm25_search(spark, sf):
    return out(bm25.bm25_search(index(spark, sf), questions(spark, sf)))


@REGISTRY.add(
    "bm25_filtered_tuned",
    f"with {bm25_sql(0.9, 0.4, where=chr(39).join(['lang = ', 'en', ' and n_chars > 300']))}, {rank_sql('scores', 5)}, o as ({OUT})"
    " select o.*, d.lang, d.source from o join documents d on d.doc_id = o.id",
)
def bm25_filtered_tuned(spark, sf):
    hits = bm25.bm25_search(
        index(spark, sf),
        questions(spark, sf),
        limit=5,
        k1=0.9,
        b=0.4,
        corpus=documents(spark, sf),
        filter='lang == "en" and n_chars > 300',
        output_fields="lang, source",
    )
    return hits.select(
        "qid", "rank", "id", "score", "similarity", "lang", "source"
    )


MATCH_WORDS = ["the", "worthless", "que", "mentation"]


@REGISTRY.add(
    "keyword_fallback",
    f"""with hits as (select t.term, d.doc_id as id from (select unnest({MATCH_WORDS!r}) as term) t, documents d
  where contains(lower(d.text), t.term))
select term, rank, id from (select *, row_number() over (partition by term order by id) as rank from hits)
where rank <= 10""",
)
def keyword_fallback(spark, sf):
    return bm25.keyword_match(documents(spark, sf), MATCH_WORDS)


@REGISTRY.add(
    "keyword_search",
    f"""with asked as (select distinct item_id as qid, unnest({TOKENS}) as word from benchmark),
hits as (select distinct qid, d.doc_id as id from asked, documents d where contains(lower(d.text), word))
select qid, rank, id, 0.0::double as score, 0.0::double as similarity
from (select *, row_number() over (partition by qid order by id) as rank from hits) where rank <= 10""",
)
def keyword_search(spark, sf):
    """All questions over a collection that has no text index."""
    return recall.keyword_search(documents(spark, sf), questions(spark, sf))


@REGISTRY.add("bm25_stored_index", f"with {bm25_sql()}, {rank_sql('scores', 10)} {OUT}")
def bm25_stored_index(spark, sf):
    """Search an index written as tables bucketed by id and by term."""
    name = f"texts_{uuid.uuid4().hex}"
    bm25.store_index(documents(spark, sf), name, buckets=8, path=work_dir(spark))
    return out(bm25.bm25_search(bm25.load_index(spark, name), questions(spark, sf)))


def gram_index(spark, texts):
    path = f"{work_dir(spark)}/grams-{uuid.uuid4().hex}"
    trigrams.store(texts, path)
    return trigrams.load(spark, path)


@REGISTRY.add(
    "keyword_search_indexed",
    f"""with asked as (select distinct item_id as qid, unnest({TOKENS}) as word from benchmark),
hits as (select distinct qid, d.doc_id as id from asked, documents d where contains(lower(d.text), word))
select qid, rank, id, 0.0::double as score, 0.0::double as similarity
from (select *, row_number() over (partition by qid order by id) as rank from hits) where rank <= 10""",
)
def keyword_search_indexed(spark, sf):
    """All questions over texts with a trigram index: only candidates are read."""
    docs = documents(spark, sf)
    held = gram_index(spark, docs.select("id", F.lower("text").alias("text")))
    return recall.keyword_search(docs, questions(spark, sf), grams=held)


@REGISTRY.add(
    "like_indexed",
    """with asked as (select distinct text[1:7] as word from conversations where length(text) >= 7)
select word, doc_id as id from asked join documents on contains(text, word)""",
)
def like_indexed(spark, sf):
    """The first characters of every turn as ``like '%...%'`` over all documents."""
    words = table(spark, sf, "conversations").where("char_length(text) >= 7").select(F.substr("text", F.lit(1), F.lit(7)).alias("word"))
    return trigrams.contains(gram_index(spark, documents(spark, sf)), words.distinct())
