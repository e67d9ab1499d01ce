"""Chunking and cleaning of all documents, pages and conversations."""

from pyspark.sql import functions as F

from vectide.operators import chunking
from vectide.plans.registry import REGISTRY, table

# The documents separate paragraphs by a single line feed.
DELIMITER = "\n"

STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def stripped(x: str) -> str:
    return STRIP.format(x)


def fold_sql(units: str, source: str, most: int, overlap: int, least: int) -> str:
    """CTE ``folded(key, chunk_index, content)`` from ``units(key, u)``, a list of (piece, joint, fresh)."""
    closes = "(length(a.cur) + length(x.piece) > {m} or (x.fresh and a.cur <> ''))".format(m=most)
    kept = f"({closes} and length(a.cur) >= {least})"
    return f"""units as ({units}),
folded as (
  select key, list_reduce(u, lambda a, x: {{
      'piece': '', 'joint': '', 'fresh': false,
      'done': case when {kept} then list_append(a.done, a.cur) else a.done end,
      'cur': case when {kept} and not x.fresh then right(a.cur, {overlap}) || x.piece
                  when {closes} or a.cur = '' then x.piece
                  else a.cur || x.joint || x.piece end}},
    {{'piece': '', 'joint': '', 'fresh': false, 'done': []::varchar[], 'cur': ''}}) as s from units),
lists as (select key, case when length(s.cur) >= {least} then list_append(s.done, s.cur) else s.done end as l from folded),
{source} as (select key, unnest(l) as raw, generate_subscripts(l, 1) - 1 as chunk_index from lists)"""


def unit(piece: str, joint: str, fresh: str = "false") -> str:
    return f"{{'piece': {piece}, 'joint': {joint}, 'fresh': {fresh}, 'done': []::varchar[], 'cur': ''}}"


PARAGRAPH_UNITS = f"""select doc_id as key, flatten(list_transform(string_split(text, chr(10)), lambda p:
  case when length(p) > 600
       then list_transform(regexp_split_to_array(p, '[.!?。！？]+'), lambda s: {unit("s", "''")})
       else [{unit("p", "chr(10)")}] end)) as u from documents"""

CHUNKS = "with " + fold_sql(PARAGRAPH_UNITS, "cut", 600, 100, 100)


def paragraphs(spark, sf):
    return chunking.chunk_paragraphs(table(spark, sf, "documents"), delimiter=DELIMITER)


@REGISTRY.add(
    "chunk_paragraphs",
    f"{CHUNKS} select key as doc_id, chunk_index::integer as chunk_index, {stripped('raw')} as content from cut",
)
def chunk_paragraphs(spark, sf):
    return paragraphs(spark, sf).select("doc_id", "chunk_index", "content")


@REGISTRY.add(
    "chunk_fixed",
    """select doc_id, i::integer as chunk_index, substring(text, i * 400 + 1, 500) as content
from (select doc_id, text, unnest(range(0, greatest(1, ceil((length(text) - 100) / 400.0)::bigint))) as i
      from documents where text <> '')""",
)
def chunk_fixed(spark, sf):
    docs = chunking.chunk_fixed(table(spark, sf, "documents"), size=500, overlap=100)
    return docs.select("doc_id", "chunk_index", "content")


def pieces_sql(split: str, least: int) -> str:
    return f"""with p as (select doc_id, list_filter(list_transform({split}, lambda s: {stripped('s')}),
  lambda s: length(s) >= {least}) as l from documents)
select doc_id, (generate_subscripts(l, 1) - 1)::integer as chunk_index, unnest(l) as content from p"""


@REGISTRY.add("chunk_sentences", pieces_sql("regexp_split_to_array(text, '[.!?。！？]+')", 1))
def chunk_sentences(spark, sf):
    return chunking.chunk_sentences(table(spark, sf, "documents")).select("doc_id", "chunk_index", "content")


@REGISTRY.add("chunk_by_paragraph", pieces_sql("string_split(text, chr(10))", 100))
def chunk_by_paragraph(spark, sf):
    chunks = chunking.chunk_by_paragraph(table(spark, sf, "documents"), min_chunk=100, delimiter=DELIMITER)
    return chunks.select("doc_id", "chunk_index", "content")


def as_markdown(html):
    """Pages as Markdown: headings, a code block per script, one line per paragraph."""
    text = F.regexp_replace(html, "<script>(.*?)</script>", "\n```\n# $1\n```\n")
    text = F.regexp_replace(text, "<h1>(.*?)</h1>", "\n# $1\n")
    text = F.regexp_replace(text, "<(br|p|/p|/li|/div)>", "\n")
    return F.regexp_replace(text, "<[^>]*>", "")


MARKDOWN_SQL = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
  '<script>(.*?)</script>', chr(10) || '```' || chr(10) || '# \1' || chr(10) || '```' || chr(10), 'g'),
  '<h1>(.*?)</h1>', chr(10) || '# \1' || chr(10), 'g'),
  '<(br|p|/p|/li|/div)>', chr(10), 'g'), '<[^>]*>', '', 'g')"""

HEADING_UNITS = rf"""select page_id as key, list_transform(
  regexp_extract_all({MARKDOWN_SQL}, '(?ms)^```.*?(?:^```[^\n]*$|\z)|^[^\n]*$'),
  lambda p: {unit("p", "chr(10)", r"regexp_matches(p, '^#{1,6}\s')")}) as u from pages"""


@REGISTRY.add(
    "chunk_headings",
    f"with {fold_sql(HEADING_UNITS, 'cut', 1000, 100, 1)}, kept as (select key, chunk_index, {stripped('raw')} as content from cut)"
    " select key as page_id, (row_number() over (partition by key order by chunk_index) - 1)::integer as chunk_index, content"
    " from kept where content <> ''",
)
def chunk_headings(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", as_markdown(F.col("html")).alias("text"))
    return chunking.chunk_headings(pages).select("page_id", "chunk_index", "content")


@REGISTRY.add(
    "chunk_dialogues",
    """select conv_id, turn, text as question, answer, text || chr(10) || answer as content from (
  select *, lead(role) over w as next_role, lead(text) over w as answer from conversations
  window w as (partition by conv_id order by turn))
where role = 'user' and next_role = 'assistant'""",
)
def chunk_dialogues(spark, sf):
    return chunking.chunk_dialogues(table(spark, sf, "conversations"))


@REGISTRY.add(
    "chunk_dialogues_gaps",
    """select conv_id, turn, text as question, answer, text || chr(10) || answer as content from (
  select conv_id, turn * 3 + conv_id % 2 as turn, role, text, lead(role) over w as next_role, lead(text) over w as answer
  from conversations window w as (partition by conv_id order by turn))
where role = 'user' and next_role = 'assistant'""",
)
def chunk_dialogues_gaps(spark, sf):
    """The same where turn numbers have gaps."""
    apart = table(spark, sf, "conversations").withColumn("turn", F.col("turn") * 3 + F.col("conv_id") % 2)
    return chunking.chunk_dialogues(apart)


@REGISTRY.add(
    "chunk_table",
    f"""{CHUNKS}
select sha256(concat_ws('|', key::varchar, chunk_index::varchar, {stripped('raw')})) as uuid, key::varchar as document_id,
  chunk_index::integer as chunk_index, {stripped('raw')} as content, 1700000000::bigint as created_time, source
from cut join documents on doc_id = key""",
)
def chunk_table(spark, sf):
    return chunking.chunk_table(paragraphs(spark, sf), "doc_id", 1_700_000_000, source=F.col("source"))


@REGISTRY.add(
    "clean_documents",
    rf"""with d as (select doc_id, lang, n_chars, {stripped('text')} as t, lower({stripped(r"regexp_replace(text, '\s+', ' ', 'g')")}) as n
  from documents)
select min(doc_id) as doc_id, arg_min(lang, doc_id) as lang, arg_min(n_chars, doc_id) as n_chars
from d where length(t) >= 100 group by n""",
)
def clean_documents(spark, sf):
    return chunking.clean(table(spark, sf, "documents")).select("doc_id", "lang", "n_chars")
