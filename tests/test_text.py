import math
import uuid

import pytest
from pyspark.sql import functions as F

from vectide.functions import text as W
from vectide.operators import bm25
from vectide.session import work_dir

DOCS = [(1, "red fox red", "x"), (2, "Blue fox!", "y"), (3, "one two three four", "x"), (4, "", "x")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id long, text string, kind string")


@pytest.fixture(scope="module")
def index(docs):
    return bm25.build_index(docs)


def expected(query, k1=1.2, b=0.75):
    """Scores worked out word by word."""
    texts = {i: t.lower().replace("!", "").split() for i, t, _ in DOCS}
    n, mean = len(texts), sum(map(len, texts.values())) / len(texts)
    out = {}
    for i, words in texts.items():
        total = 0.0
        for w in query.split():
            df = sum(w in t for t in texts.values())
            tf = words.count(w)
            if tf:
                total += (
                    math.log(1 + (n - df + 0.5) / (df + 0.5))
                    * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(words) / mean))
                )
        if total:
            out[i] = total
    return out


def ask(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "qid long, query_text string")


def test_term_counts(index):
    rows = {r.id: r for r in index.rows.collect()}
    assert [(t.term, t.tf) for t in rows[1].terms] == [("fox", 1), ("red", 2)]
    assert rows[1].dl == 3 and rows[4].dl == 0 and rows[4].terms == []
    stats = index.totals.first()
    assert {r.term: r.df for r in index.terms.collect()}["fox"] == 2
    assert (stats.n_docs, stats.avg_dl, stats.n_postings) == (4, 9 / 4, 8)


@pytest.mark.parametrize("k1, b", [(1.2, 0.75), (0.0, 0.75), (2.0, 0.0)])
@pytest.mark.parametrize("query", ["fox", "red fox", "red red two", "absent"])
@pytest.mark.parametrize("bytes", [64 * 1024 * 1024, 0])
def test_scores(spark, index, query, k1, b, bytes):
    got = bm25.bm25_search(index, ask(spark, query), 10, k1, b, broadcast_bytes=bytes).collect()
    want = expected(query, k1, b)
    assert {r.id: r.score for r in got} == pytest.approx(want, abs=2e-9)


def test_filter_restricts_texts_not_statistics(spark, docs, index):
    hits = bm25.bm25_search(index, ask(spark, "fox"), corpus=docs, filter="kind == 'y'", output_fields="kind").collect()
    assert [(r.id, r.kind) for r in hits] == [(2, "y")]
    assert hits[0].score == pytest.approx(expected("fox")[2])


def test_limit_ties_and_cut(spark, index):
    hits = bm25.bm25_search(index, ask(spark, "one two"), limit=1).collect()
    assert [(r["rank"], r.id) for r in hits] == [(1, 3)]
    assert bm25.bm25_search(index, ask(spark, "fox"), min_similarity=99).count() == 0


def test_stored_index_answers_from_its_postings(spark, docs):
    name = f"fox_{uuid.uuid4().hex}"
    bm25.store_index(docs, name, 4, path=work_dir(spark))
    stored = bm25.load_index(spark, name)
    hits = bm25.bm25_search(stored, ask(spark, "red fox"))
    assert [r.id for r in hits.orderBy("rank").collect()] == [1, 2]
    assert stored.blocks.postings.where("term = 'fox'").count() >= 1
    for part in ("rows", "terms", "totals", "slices", "postings"):
        spark.sql(f"drop table {name}_{part}")


def test_keyword_match(docs):
    hits = bm25.keyword_match(docs, ["FOX", " two ", "nothing"], limit=1).collect()
    assert sorted((r.term, r["rank"], r.id) for r in hits) == [("fox", 1, 1), ("two", 1, 3)]
    with pytest.raises(ValueError):
        bm25.keyword_match(docs, ["  "])


def test_strip(spark):
    row = spark.createDataFrame([(" \t a b\n ",)], "s string").select(W.strip(F.col("s")).alias("s")).first()
    assert row.s == "a b"


def test_words_that_all_queries_ask_are_scored_in_bounded_steps(monkeypatch):
    import numpy as np
    import pyarrow as pa

    n_queries, n_words, n_rows = 50, 40, 30
    asked = [(q, f"w{w}", 1.0 + w) for q in range(n_queries) for w in range(n_words)]
    weights = bm25.Weights(pa.table([list(c) for c in zip(*asked)], names=["qid", "term", "w"]))
    terms = [[{"term": f"w{w}", "tf": 1 + (r + w) % 3} for w in range(n_words)] if r % 4 else [] for r in range(n_rows)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(n_rows)), "dl": [40] * n_rows, "terms": terms})
    whole = np.zeros((n_rows, n_queries))
    for places, scores in weights.scores(batch, 1.2, 0.75, 40.0):
        whole[places] = scores
    sizes, count = [], np.bincount
    monkeypatch.setattr(bm25, "PAIRS_PER_STEP", 5000)
    monkeypatch.setattr(np, "bincount", lambda x, *a, **k: (sizes.append(len(x)), count(x, *a, **k))[1])
    again = np.zeros((n_rows, n_queries))
    for places, scores in weights.scores(batch, 1.2, 0.75, 40.0):
        again[places] = scores
    assert (again == whole).all() and whole[1].min() > 0 and max(sizes) <= 5000


def test_terms_are_counted_once_for_a_batch(spark):
    rows = [(1, "b a É b"), (None, None), (3, ""), (4, "..."), (4, "Z z _9 中 É a"), (5, "\U0001F600 \U00020000 \uFF5A")]
    docs = spark.createDataFrame(rows, "id int, text string").coalesce(1)
    found = W.term_counts(docs, "id", "text")
    assert found.schema["id"].dataType.simpleString() == "int"
    assert [(r.id, r.dl, [tuple(t) for t in r.terms]) for r in found.collect()] == [
        (1, 4, [("a", 1), ("b", 2), ("é", 1)]), (None, 0, []), (3, 0, []), (4, 0, []),
        (4, 6, [("_9", 1), ("a", 1), ("z", 2), ("é", 1), ("中", 1)]), (5, 2, [("\uFF5A", 1), ("\U00020000", 1)]),
    ]
    assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
