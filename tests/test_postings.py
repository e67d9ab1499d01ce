import random
import uuid

import pytest

from vectide.operators import bm25, postings
from vectide.session import work_dir

WORDS = [f"w{k}" for k in range(60)]


def texts_of(rng, n):
    out = []
    for i in range(n):
        length = rng.choice([0, 3, 8, 30])
        words = [WORDS[min(int(rng.expovariate(0.15)), 59)] for _ in range(length)]
        out.append((i, " ".join(words), rng.choice(["x", "y"])))
    return out


@pytest.fixture(scope="module")
def held(spark):
    rng = random.Random(2)
    rows = texts_of(rng, 600) + [(1000, None, "x"), (1001, "", "y"), (1002, "w59 w59 w59", "y")]
    docs = spark.createDataFrame(rows, "id long, text string, kind string").repartition(3)
    name = f"texts_{uuid.uuid4().hex}"
    bm25.store_index(docs, name, 4, path=work_dir(spark), slice_texts=16)
    return docs, bm25.load_index(spark, name)


def hits(found):
    return sorted((r.qid, r["rank"], r.id, r.score) for r in found.collect())


@pytest.fixture(scope="module")
def asked(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(WORDS, k=rng.randrange(1, 6))) for _ in range(25)]
    texts += ["w0 w0 w1", "w59", "unknown", "", None, "W0 w0!", "w0 unknown"]
    return spark.createDataFrame(list(enumerate(texts)), "qid long, query_text string")


@pytest.mark.parametrize("more", [{}, {"k1": 0.6, "b": 0.2}, {"k1": 2.0, "b": 1.0}, {"limit": 1}, {"limit": 1000}])
def test_same_hits_as_the_scan(held, asked, more):
    docs, stored = held
    assert hits(bm25.bm25_search(stored, asked, **more)) == hits(bm25.bm25_search(bm25.build_index(docs), asked, **more))


@pytest.mark.parametrize("bound", [10**9, 0])
def test_other_plans_give_the_same_hits(held, asked, monkeypatch, bound):
    docs, stored = held
    monkeypatch.setattr(postings, "NAMED_WORDS", 0)
    monkeypatch.setattr(postings, "QUERY_BYTES", 200)
    monkeypatch.setattr(postings, "BROADCAST_BYTES", bound)
    assert hits(bm25.bm25_search(stored, asked)) == hits(bm25.bm25_search(bm25.build_index(docs), asked))


def test_filter(held, asked):
    docs, stored = held
    plain = bm25.build_index(docs)
    for clause in ("kind == 'y'", "id < 40", "id > 5000"):
        want = bm25.bm25_search(plain, asked, corpus=docs, filter=clause, output_fields="kind", limit=3)
        got = bm25.bm25_search(stored, asked, corpus=docs, filter=clause, output_fields="kind", limit=3)
        assert hits(got) == hits(want)


def test_blocks(held):
    docs, stored = held
    blocks = stored.blocks.postings.collect()
    assert len({(b.term, b.slice) for b in blocks}) == len(blocks)
    slices = {r.slice: r for r in stored.blocks.slices.collect()}
    assert sum(len(r.ids) for r in slices.values()) == 603 and all(len(r.ids) <= 16 for r in slices.values())
    lengths = {r.id: r.dl for r in stored.rows.collect()}
    seen = {}
    mean = stored.totals.first()["avg_dl"]
    for b in blocks:
        s = slices[b.slice]
        impacts = []
        for at, tf in zip(b.places, b.tfs):
            assert s.dls[at] == lengths[s.ids[at]]
            seen.setdefault(s.ids[at], {})[b.term] = tf
            impacts.append(tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * s.dls[at] / mean)))
        assert b.top == pytest.approx(max(impacts)) and b.max_tf == max(b.tfs) and b.n == len(b.tfs)
    assert seen == {r.id: {t.term: t.tf for t in r.terms} for r in stored.rows.collect() if r.terms}


def test_slices_that_cannot_win_are_not_read(spark, held):
    _, stored = held
    ask = spark.createDataFrame([(0, "w0"), (1, "w59 w0"), (2, "w1 w2 w3"), (3, "nothing")], "qid long, query_text string")
    weights = bm25.query_weights(stored, ask)
    totals = stored.totals.first()
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("qid", T.LongType()), T.StructField("id", T.LongType()), T.StructField("score", T.DoubleType())])
    _, seen = postings.term_hits(stored.blocks, weights, schema, 1, 1.2, 0.75, totals["avg_dl"], first_slices=2)
    read = {r.qid: (r.read, r.slices) for r in seen.collect()}
    assert set(read) == {0, 1, 2} and all(2 <= a <= b for a, b in read.values())
    assert sum(a for a, _ in read.values()) < 0.6 * sum(b for _, b in read.values())


def test_only_folders_of_asked_words_are_read(spark, held):
    _, stored = held
    ask = spark.createDataFrame([(0, "w7")], "qid long, query_text string")
    found = postings.asked_blocks(stored.blocks, bm25.query_weights(stored, ask))
    assert {r.term for r in found.select("term").distinct().collect()} == {"w7"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PushedFilters: [" in plan and "EqualTo(term,w7)" in plan.replace("In(term, [w7])", "EqualTo(term,w7)")


def test_empty_index(spark):
    docs = spark.createDataFrame([], "id long, text string")
    name = f"texts_{uuid.uuid4().hex}"
    bm25.store_index(docs, name, 2, path=work_dir(spark))
    ask = spark.createDataFrame([(0, "fox")], "qid long, query_text string")
    assert bm25.bm25_search(bm25.load_index(spark, name), ask).count() == 0


def test_slices_of_any_size_give_the_same_blocks(spark, monkeypatch):
    docs = spark.createDataFrame(texts_of(random.Random(5), 200) + [(500, None, "x")], "id long, text string, kind string")
    placed = postings.place_texts(bm25.index_rows(docs), 16)
    columns = ["term", "slice", "places", "tfs", "n", "top", "max_tf", "min_dl", "parts", "part"]
    calls = []
    collected = postings._collected
    monkeypatch.setattr(postings, "_collected", lambda *a: calls.append(1) or collected(*a))
    small, large = (sorted(map(tuple, postings.blocks_of(placed, 3, 7.5, n).select(columns).collect())) for n in (10**6, 1))
    assert small == large and small and len(calls) == 1


def test_postings_are_neither_shuffled_nor_counted_again(spark, held):
    _, stored = held
    placed = postings.place_texts(stored.rows, 16)
    assert "Generate" not in postings._inverted(placed, 8.0)._jdf.queryExecution().executedPlan().toString()
    counted = {r.term: r.df for r in bm25._index(stored.rows).terms.collect()}
    assert {r.term: r.df for r in stored.terms.collect()} == counted
