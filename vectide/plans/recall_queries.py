"""Embedding, semantic and hybrid search, recall paths, expansion and selection."""

from pyspark.sql import functions as F

from vectide.operators import embedding, query_text, recall, rewriting, selection
from vectide.operators.bm25 import build_index
from vectide.operators.query_text import Rule
from vectide.plans.registry import REGISTRY, table
from vectide.plans.text_queries import TOKENS, bm25_sql, documents, questions, rank_sql
from vectide.session import materialize
from vectide.sources.collections import assign_ids

ENCODER = embedding.HashingEncoder(64)


def encode_sql(name: str, texts: str) -> str:
    """CTE ``name(id, v)`` from ``texts(id, text)``: hashed, signed and scaled word counts."""
    return f"""{name}_w as (select id, md5(word) as h from (select id, unnest({TOKENS}) as word from ({texts}))),
{name}_c as (select id, ('0x' || h[1:7])::bigint % 64 as b, sum(case when h[32:32] < '8' then 1 else -1 end)::double as c
  from {name}_w group by id, b),
{name}_n as (select id, sqrt(sum(c * c)) as n from {name}_c group by id),
{name} as (select t.id, list(coalesce(c / nullif(n, 0), 0)::float::double order by g.b) as v
  from ({texts}) t cross join range(64) g(b) left join {name}_c c on c.id = t.id and c.b = g.b left join {name}_n n on n.id = t.id
  group by t.id)"""


def dense_sql(name: str, queries: str, rows: str, k: int) -> str:
    """CTE ``name(qid, id, rank, similarity, raw)`` of the k nearest rows by cosine."""
    return f"""{name}_p as (select q.id as qid, r.id, list_cosine_similarity(q.v, r.v) as exact from {queries} q, {rows} r),
{name}_s as (select qid, id, case when isnan(exact) then null else exact end as raw,
  case when isnan(exact) then null else round(exact, 9) end as similarity from {name}_p),
{name} as (select * from (select *, row_number() over (partition by qid order by similarity desc nulls last, id) as rank from {name}_s)
  where rank <= {k})"""


def settled_sql(x: str) -> str:
    """A score to twelve significant digits."""
    scale = f"power(10::double, 11 - floor(log10(nullif(abs({x}), 0))))"
    return f"coalesce(round({x} * {scale}) / {scale}, {x})"


DOCS = "select doc_id as id, text from documents"
ASKED = "select item_id as id, text from benchmark"


def embedded_documents(spark, sf):
    return embedding.embed(documents(spark, sf), "text", ENCODER)


@REGISTRY.add(
    "embed_documents",
    f"with {encode_sql('e', DOCS)} select id, (generate_subscripts(v, 1) - 1)::bigint as pos, round(unnest(v), 6) as value from e",
)
def embed_documents(spark, sf):
    vectors = embedded_documents(spark, sf).select("id", F.posexplode_outer("vector").alias("pos", "value"))
    flat = vectors.where("value is not null")
    value = F.round(F.col("value").cast("double"), 6)
    return flat.select("id", F.col("pos").cast("long").alias("pos"), value.alias("value"))


@REGISTRY.add(
    "text_search",
    f"""with {encode_sql('e', "select doc_id as id, text from documents where lang = 'en'")}, {encode_sql('q', ASKED)},
{dense_sql('hits', 'q', 'e', 5)},
kept as (select *, count(*) over (partition by qid) as total_results from hits where similarity >= 0.5)
select qid, rank, kept.id, similarity as score, similarity, total_results,
  b.text as query_text, 64::bigint as vector_dimension, d.source
from kept join benchmark b on b.item_id = qid join documents d on d.doc_id = kept.id""",
)
def text_search(spark, sf):
    # Filtered before the encoder runs; the text is not kept.
    searched = documents(spark, sf).where("lang = 'en'").select("id", "text", "source")
    corpus = materialize(embedding.embed(searched, "text", ENCODER).select("id", "vector", "source"))
    return embedding.text_search(corpus, questions(spark, sf), ENCODER, min_similarity=0.5, output_fields="source")


@REGISTRY.add(
    "hybrid_search",
    f"""with {encode_sql('e', DOCS)}, {encode_sql('q', ASKED)}, {dense_sql('dense', 'q', 'e', 50)},
{bm25_sql()}, {rank_sql('scores', 50, 'keyword')},
texts as (select qid, id, coalesce(score / nullif(max(score) over (partition by qid), 0), 0) as text_score from keyword),
sides as (select coalesce(d.qid, t.qid) as qid, coalesce(d.id, t.id) as id, coalesce(raw, 0) as vector_score,
    coalesce(text_score, 0) as text_score from dense d full join texts t on d.qid = t.qid and d.id = t.id),
total as (select *, {settled_sql('(vector_score * 0.7::double + text_score * 0.3::double)')} as score from sides)
select qid, rank, id, round(vector_score, 9) as vector_score, round(text_score, 9) as text_score, round(score, 9) as score
from (select *, row_number() over (partition by qid order by score desc, id) as rank from total) where rank <= 10""",
)
def hybrid_search(spark, sf):
    index = build_index(documents(spark, sf))
    corpus = materialize(embedded_documents(spark, sf).select("id", "vector"))
    asked = materialize(embedding.embed(questions(spark, sf), "query_text", ENCODER, vector_col="qv"))
    return recall.hybrid_search(corpus, index, asked)


@REGISTRY.add(
    "hybrid_exact",
    f"""with {encode_sql('e', DOCS)}, {encode_sql('q', ASKED)}, {bm25_sql()},
texts as (select qid, id, score / max(score) over (partition by qid) as text_score from scores),
sides as (select q.id as qid, e.id, coalesce(case when isnan(list_cosine_similarity(q.v, e.v)) then 0 else list_cosine_similarity(q.v, e.v) end, 0) as vector_score,
    coalesce(text_score, 0) as text_score from q cross join e left join texts t on t.qid = q.id and t.id = e.id),
total as (select *, {settled_sql('(vector_score * 0.7::double + text_score * 0.3::double)')} as score from sides)
select qid, rank, id, round(vector_score, 9) as vector_score, round(text_score, 9) as text_score, round(score, 9) as score
from (select *, row_number() over (partition by qid order by score desc, id) as rank from total) where rank <= 10""",
)
def hybrid_exact(spark, sf):
    """The weighted sum over all rows, whatever the depth of the lists: five rows of each to begin with."""
    index = build_index(documents(spark, sf))
    corpus = materialize(embedded_documents(spark, sf).select("id", "vector"))
    asked = embedding.embed(questions(spark, sf), "query_text", ENCODER, vector_col="qv")
    return recall.hybrid_exact(corpus, index, asked, start=5)


EN = "select doc_id as id, text from documents where lang = 'en'"


@REGISTRY.add(
    "hybrid_filtered",
    f"""with {encode_sql('e', EN)}, {encode_sql('q', ASKED)}, {dense_sql('dense', 'q', 'e', 50)},
{bm25_sql(where="lang = 'en'")}, {rank_sql('scores', 50, 'keyword')},
texts as (select qid, id, coalesce(score / nullif(max(score) over (partition by qid), 0), 0) as text_score from keyword),
sides as (select coalesce(d.qid, t.qid) as qid, coalesce(d.id, t.id) as id, coalesce(raw, 0) as vector_score,
    coalesce(text_score, 0) as text_score from dense d full join texts t on d.qid = t.qid and d.id = t.id),
total as (select *, {settled_sql('(vector_score * 0.7::double + text_score * 0.3::double)')} as score from sides)
select qid, rank, id, round(vector_score, 9) as vector_score, round(text_score, 9) as text_score, round(score, 9) as score, source, n_chars
from (select *, row_number() over (partition by qid order by score desc, id) as rank from total)
join documents on doc_id = id where rank <= 10""",
)
def hybrid_filtered(spark, sf):
    docs = documents(spark, sf)
    corpus = materialize(embedding.embed(docs, "text", ENCODER).select("id", "vector", "lang", "source", "n_chars"))
    asked = materialize(embedding.embed(questions(spark, sf), "query_text", ENCODER, vector_col="qv"))
    return recall.hybrid_search(corpus, build_index(docs), asked, filter='lang == "en"', output_fields="source, n_chars")


STOPS = "[" + ", ".join(f"'{w}'" for w in query_text.STOP_WORDS) + "]"


def keywords_sql(text: str, limit: int = 3) -> str:
    return (
        rf"list_filter(regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]+'),"
        f" lambda w: length(w) > 1 and not list_contains({STOPS}, w))[1:{limit}]"
    )


@REGISTRY.add(
    "extract_keywords",
    f"""with k as (select conv_id, turn, {keywords_sql('text')} as k from conversations)
select conv_id, turn, (generate_subscripts(k, 1) - 1)::bigint as pos, unnest(k) as keyword from k""",
)
def extract_keywords(spark, sf):
    asked = table(spark, sf, "conversations")
    words = query_text.extract_keywords(asked, "text")
    flat = words.select("conv_id", "turn", F.posexplode_outer("keywords").alias("pos", "keyword")).where("keyword is not null")
    return flat.withColumn("pos", F.col("pos").cast("long"))


SYNONYMS = {"the": ["this", "that"], "with": ["without", "beside", "by"], "que": ["qui"], "und": ["oder"]}

RULES = (
    Rule(("how", "whan"), replace=(("how", "steps"), ("whan", "method")), suffix=" guide"),
    Rule(("whon",), replace=(("whon", "about"),)),
    Rule(("that", "for"), replace=(("that", "reason"),), suffix=" explained"),
)


def _list(items):
    return "[" + ", ".join(items) + "]" if items else "[]::varchar[]"


def synonyms_sql(text: str) -> str:
    parts = [f"[{text}]"]
    for word, others in SYNONYMS.items():
        swapped = _list([f"replace({text}, '{word}', '{o}')" for o in others])
        parts.append(f"case when contains({text}, '{word}') then {swapped} else []::varchar[] end")
    return "list_concat(" + ", ".join(parts) + ")[1:3]"


def rules_sql(text: str) -> str:
    parts = ["[]::varchar[]"]
    for rule in RULES:
        changed = text
        for old, new in rule.replace:
            changed = f"replace({changed}, '{old}', '{new}')"
        made = [changed] if rule.replace else []
        made += [f"{text} || '{rule.suffix}'"] if rule.suffix else []
        hit = " or ".join(f"contains({text}, '{w}')" for w in rule.any_of)
        parts.append(f"case when {hit} then {_list(made)} else []::varchar[] end")
    return "list_concat(" + ", ".join(parts) + ")[1:2]"


def _variants_sql(variants: str) -> str:
    return f"""with v as (select conv_id, turn, {variants} as l from conversations)
select conv_id, turn, (generate_subscripts(l, 1) - 1)::bigint as variant, unnest(l) as variant_text from v"""


def _asked(spark, sf):
    return table(spark, sf, "conversations")


@REGISTRY.add("expand_synonyms", _variants_sql(synonyms_sql("text")))
def expand_synonyms(spark, sf):
    made = query_text.expand_synonyms(_asked(spark, sf), "text", SYNONYMS)
    return made.select("conv_id", "turn", "variant", "variant_text")


@REGISTRY.add("rewrite_intent", _variants_sql(rules_sql("text")))
def rewrite_intent(spark, sf):
    made = query_text.rewrite_intent(_asked(spark, sf), "text", RULES)
    return made.select("conv_id", "turn", "variant", "variant_text")


@REGISTRY.add("expand_synonyms_table", _variants_sql(synonyms_sql("text")))
def expand_synonyms_table(spark, sf):
    """The same synonyms as a table."""
    made = rewriting.expand_from_table(_asked(spark, sf), rewriting.synonym_table(spark, SYNONYMS), "text")
    return made.select("conv_id", "turn", "variant", "variant_text")


@REGISTRY.add("rewrite_intent_table", _variants_sql(rules_sql("text")))
def rewrite_intent_table(spark, sf):
    made = rewriting.rewrite_from_table(_asked(spark, sf), rewriting.rule_table(spark, RULES), "text")
    return made.select("conv_id", "turn", "variant", "variant_text")


@REGISTRY.add(
    "expand_by_names",
    """with words as (select row_number() over (order by word) as priority, word from (select distinct text[1:5] as word from conversations
    where length(text) >= 5)),
hits as (select conv_id, turn, text, word, row_number() over (partition by conv_id, turn, text order by priority) as variant
  from conversations join words on contains(text, word))
select conv_id, turn, variant, replace(text, word, '<' || word || '>') as variant_text from hits where variant <= 2
union all select conv_id, turn, 0::bigint, text from conversations""",
)
def expand_by_names(spark, sf):
    """A dictionary that grows with the data: the beginnings of all turns, each with one synonym."""
    asked = _asked(spark, sf)
    words = asked.where("char_length(text) >= 5").select(F.substr("text", F.lit(1), F.lit(5)).alias("word")).distinct()
    numbered = assign_ids(words, ["word"], id_col="priority")
    entries = numbered.select("priority", F.lit(0).alias("place"), "word", F.concat(F.lit("<"), "word", F.lit(">")).alias("synonym"))
    return rewriting.expand_from_table(asked, entries, "text").select("conv_id", "turn", "variant", "variant_text")


PAGES = """pages_t as (select page_id as id, nullif(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '') as title,
  regexp_extract(url, '^https?://([^/]+)', 1) as path from pages),
words_t as (select id, title, path from pages_t)"""

TITLES = "select id, title as text from words_t where title is not null"


def pages(spark, sf):
    """Pages as a collection: title, host as path, vector of the title; pages without a title have no vector."""
    title = F.nullif(F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1), F.lit(""))
    rows = table(spark, sf, "pages").select(
        F.col("page_id").alias("id"), title.alias("title"), F.regexp_extract("url", "^https?://([^/]+)", 1).alias("path")
    )
    return materialize(embedding.embed(rows, "title", ENCODER))


def title_queries(corpus):
    """Every title is a query."""
    return corpus.select(F.col("id").alias("qid"), F.col("title").alias("query_text"), F.col("vector").alias("qv"))


PATHS = f"""{PAGES}, {encode_sql('e', TITLES)}, {dense_sql('dense', 'e', 'e', 50)},
first as (select id as qid, {keywords_sql('title', 1)}[1] as word from words_t),
by_word as (select * from (select qid, t.id, row_number() over (partition by qid order by t.id) as n
  from first join words_t t on contains(t.title, word)) where n <= 20),
by_title as (select * from (select q.id as qid, t.id, row_number() over (partition by q.id order by t.id) as n
  from words_t q join words_t t on t.title = q.title) where n <= 5),
paths as (select qid, id, 'vector' as source, 1 as path, raw as score from dense
  union all select qid, id, 'keyword', 2, 0.5::double from by_word
  union all select qid, id, 'title', 3, 0.9::double from by_title)"""


@REGISTRY.add("title_contains", f"with {PATHS} select qid, id from by_word")
def title_contains(spark, sf):
    corpus = pages(spark, sf)
    words = query_text.extract_keywords(title_queries(corpus), limit=1)
    first = words.select("qid", F.get("keywords", F.lit(0)).alias("word")).where("word is not null")
    return recall.title_contains(corpus, first)


@REGISTRY.add("title_equals", f"with {PATHS} select qid, id from by_title")
def title_equals(spark, sf):
    corpus = pages(spark, sf)
    return recall.title_equals(corpus, title_queries(corpus))


@REGISTRY.add("multi_path_recall", f"with {PATHS} select qid, id, source, path, round(score, 9) as score from paths")
def multi_path_recall(spark, sf):
    corpus = pages(spark, sf)
    return recall.multi_path(corpus, title_queries(corpus))


MERGED = f"""{PATHS},
known as (select * replace ({settled_sql('score')} as score) from paths),
merged as (select * from (select *, row_number() over (partition by qid, id order by score desc, path) as n from known) where n = 1),
fused as (select qid, rank, id, source, round(score, 9) as similarity from (
  select *, row_number() over (partition by qid order by score desc, id) as rank from merged) where rank <= 10)"""


@REGISTRY.add("merge_paths", f"with {MERGED} select qid, rank, id, source, similarity from fused")
def merge_paths(spark, sf):
    corpus = pages(spark, sf)
    return recall.merge_paths(recall.multi_path(corpus, title_queries(corpus), decimals=None))


@REGISTRY.add(
    "expansion_recall",
    f"""with {PAGES}, {encode_sql('e', TITLES)},
raw as (select id as qid, title as variant_text, 1.0::double as weight, 30 as size from words_t
  union all select id, unnest({synonyms_sql('title')}), 0.8::double, 20 from words_t
  union all select id, unnest({rules_sql('title')}), 0.6::double, 15 from words_t),
variants as (select *, md5(variant_text) as key from raw),
{encode_sql('q', 'select distinct key as id, variant_text as text from variants')}, {dense_sql('hits', 'q', 'e', 30)},
merged as (select v.qid, h.id, max({settled_sql('(weight * raw)')}) as score
  from variants v join hits h on h.qid = v.key and h.rank <= v.size group by v.qid, h.id)
select qid, rank, id, round(score, 9) as similarity from (
  select *, row_number() over (partition by qid order by score desc nulls last, id) as rank from merged) where rank <= 10""",
)
def expansion_recall(spark, sf):
    corpus = pages(spark, sf)
    found = recall.expansion_recall(corpus, title_queries(corpus), ENCODER, SYNONYMS, RULES)
    return found


KINDS = "case qid % 5 when 0 then 'simple' when 1 then 'general' when 2 then 'complex' when 3 then 'comprehensive' else 'other' end"

HITS = f"""{PAGES}, {encode_sql('e', TITLES)}, {dense_sql('found', 'e', 'e', 10)},
hits as (select f.*, w.path, w.title from found f join words_t w using (id))"""


def page_hits(spark, sf):
    corpus = pages(spark, sf)
    asked = title_queries(corpus)
    return asked, recall.search(corpus, asked, limit=10, output_fields="title, path")


@REGISTRY.add(
    "adaptive_selection",
    f"""with {HITS},
typed as (select *, {KINDS} as query_type, first_value(similarity) over (partition by qid order by rank) as best,
  row_number() over (partition by qid, path order by similarity desc nulls last, rank) as lead from hits),
places as (select *, sum(case when lead = 1 then 1 else 0 end) over
  (partition by qid order by similarity desc nulls last, rank rows unbounded preceding) as place from typed),
kept as (select * from places where case query_type
  when 'simple' then rank <= 2 and similarity >= 0.6
  when 'general' then case when best > 0.8 then rank <= 2 when best > 0.6 then rank <= 3 and similarity >= 0.5
    else rank <= 5 and similarity >= 0.4 end
  when 'complex' then rank <= 7 and similarity >= 0.4
  when 'comprehensive' then lead = 1 and place <= 4 else rank <= 3 end)
select qid, query_type, row_number() over (partition by qid order by similarity desc nulls last, rank) as rank, id, path,
  similarity from kept""",
)
def adaptive_selection(spark, sf):
    asked, hits = page_hits(spark, sf)
    chosen = selection.adaptive(hits, asked.select("qid", F.expr(KINDS).alias("query_type")))
    return chosen.select("qid", "query_type", "rank", "id", "path", "similarity")


@REGISTRY.add(
    "best_per_document",
    f"""with {HITS},
lead as (select * from (select *, row_number() over (partition by qid, path order by similarity desc, rank) as n from hits) where n = 1)
select qid, new_rank as rank, id, path, similarity from (
  select * exclude rank, row_number() over (partition by qid order by similarity desc nulls last, rank) as new_rank from lead)
where new_rank <= 4""",
)
def best_per_document(spark, sf):
    _, hits = page_hits(spark, sf)
    best = selection.best_per_document(hits.select("qid", "rank", "id", "path", "similarity"))
    return best


@REGISTRY.add(
    "title_boost",
    f"""with {HITS}, words as (select id as qid, {keywords_sql('title')} as k from words_t),
raised as (select h.*, round(similarity + case when len(list_filter(k, lambda w: contains(lower(title), w))) > 0 then 0.1::double
  else 0 end, 9) as boosted from hits h join words using (qid))
select qid, new_rank as rank, id, title, similarity, boosted from (
  select *, row_number() over (partition by qid order by boosted desc nulls last, id) as new_rank from raised) where new_rank <= 3""",
)
def title_boost(spark, sf):
    asked, hits = page_hits(spark, sf)
    top = selection.boost_titles(hits, asked)
    return top.select(
        "qid", "rank", "id", "title", "similarity", "boosted"
    )
