import re

import pyarrow as pa
from pyspark.sql import functions as F

from vectide.operators import bm25, chunking, nearest, recall
from vectide.plans.vector_queries import as_queries, vectors

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark):
    corpus = vectors(spark, SF)
    text = plan(nearest.search(corpus, as_queries(corpus), filter="label in [1, 2]"))
    assert re.search(r"PushedFilters: \[[^\]]*In\(label, \[1,2\]\)", text)
    hits = plan(nearest.search(corpus, as_queries(corpus)))
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in hits
    # Only lists of k rows are shuffled, once.
    assert len(re.findall("Exchange hashpartitioning", hits)) == 1


def test_lists_are_cut_before_the_shuffle(spark):
    corpus = vectors(spark, SF)
    text = plan(nearest.search(corpus, as_queries(corpus)))
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_bm25_sums_where_the_text_lies(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumnRenamed("doc_id", "id")
    asked = spark.createDataFrame([(1, "the and")], "qid long, query_text string")
    text = plan(bm25.bm25_search(bm25.build_index(docs), asked))
    assert len(re.findall("Exchange", text)) == 1 and "Exchange hashpartitioning(qid" in text
    assert "Aggregate" not in text and "Join" not in text and "WindowGroupLimit" in text


def test_texts_are_split_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = plan(chunking.chunk_paragraphs(docs, delimiter="\n"))
    assert len(re.findall(r"split\(text", text)) == 1
    rows = plan(bm25.postings(bm25.index_rows(docs, "doc_id")))
    assert len(re.findall(r"regexp_extract_all\(", rows)) == 1 and len(re.findall(r"sort_array\(", rows)) == 1


def test_shared_titles_and_words_are_cut_before_the_queries_join(spark):
    corpus = spark.createDataFrame([(1, "cat")], "id long, title string")
    words = spark.createDataFrame([(1, "cat")], "qid long, word string")
    assert "WindowGroupLimit" in plan(recall.title_contains(corpus, words))
    asked = spark.createDataFrame([(1, "cat")], "qid long, query_text string")
    assert "WindowGroupLimit" in plan(recall.title_equals(corpus, asked))


def test_grid_blocks_are_bounded(spark):
    """A hot cell is cut into blocks of the size asked for."""
    rows = spark.range(2000).select("id", F.array(F.lit(1.0).cast("float")).alias("vector"), F.lit(3).alias("cell"))
    asked = spark.range(50).select(
        F.col("id").alias("qid"), F.array(F.lit(1.0).cast("float")).alias("qv"), F.lit(3).alias("cell")
    )
    schema = nearest.hit_schema(rows, asked)

    def run(queries, batches):
        n = sum(b.num_rows for b in batches)
        yield pa.RecordBatch.from_pydict({"qid": [len(queries[1])], "id": [n], "score": [0.0]})

    met = nearest.meet_blocks(rows, asked, 1, schema, run, block_bytes=8 * 100).collect()
    sizes = [(r.qid, r.id) for r in met]
    assert len(sizes) == 20 and max(n for _, n in sizes) < 160 and sum(n for _, n in sizes) == 2000
    assert {q for q, _ in sizes} == {50}
