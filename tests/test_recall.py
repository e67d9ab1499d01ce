import numpy as np
import pytest
from pyspark.sql import functions as F

from vectide import sizing
from vectide.functions.containing import containing
from vectide.operators import bm25, embedding, query_text, recall, selection
from vectide.operators.query_text import Rule

ENCODER = embedding.HashingEncoder(16)


@pytest.fixture
def queries(spark):
    return lambda *t: spark.createDataFrame(list(enumerate(t)), "qid long, query_text string")


def test_hashing_encoder(spark, queries):
    rows = embedding.embed(queries("red fox", "fox  RED", "  ", None, "?!", "blue"), "query_text", ENCODER).collect()
    got = {r.qid: r.vector for r in rows}
    assert got[0] == got[1] and len(got[0]) == 16 and np.linalg.norm(got[0]) == pytest.approx(1.0)
    assert got[2] is None and got[3] is None
    assert got[4] == [0.0] * 16
    raw = embedding.embed(queries("a a a"), "query_text", ENCODER, normalize=False).first().vector
    assert sorted(map(abs, raw))[-1] == 3.0


def test_model_encoder_is_loaded_once_per_worker(spark, queries, tmp_path):
    log = str(tmp_path / "loads")

    def load():
        with open(log, "a") as f:
            f.write("x")
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    encoder = embedding.ModelEncoder("lengths-test", 2, load, batch_size=2)
    df = queries("a", "bb", "ccc", "dddd", "eeeee").coalesce(1)
    rows = embedding.embed(df, "query_text", encoder, normalize=False).collect()
    assert {r.qid: r.vector for r in rows} == {i: [i + 1.0, 1.0] for i in range(5)}
    assert len(open(log).read()) <= 2 * spark.sparkContext.defaultParallelism
    with pytest.raises(Exception, match="expected"):
        embedding.embed(df, "query_text", embedding.ModelEncoder("wrong", 3, load)).collect()


def test_text_search(spark, queries):
    docs = spark.createDataFrame([(1, "red fox"), (2, "blue whale"), (3, "red red fox")], "id long, text string")
    corpus = embedding.embed(docs, "text", ENCODER)
    hits = embedding.text_search(corpus, queries("red fox", "", "blue whale"), ENCODER, limit=2, output_fields="text")
    rows = {(r.qid, r["rank"]): r for r in hits.collect()}
    assert rows[0, 1].id == 1 and rows[0, 1].similarity == pytest.approx(1.0)
    assert rows[0, 1].query_text == "red fox" and rows[0, 1].vector_dimension == 16 and rows[0, 1].total_results == 2
    assert rows[2, 1].text == "blue whale" and all(q != 1 for q, _ in rows)


def test_keywords(queries):
    rows = query_text.extract_keywords(queries("The cat and A dog in the Dog house", "的 猫咪 of x", "")).collect()
    assert [r.keywords for r in rows] == [["cat", "dog", "dog"], ["猫咪"], []]


def test_synonyms(queries):
    rows = query_text.expand_synonyms(queries("狗洗澡", "nothing")).collect()
    assert [(r.qid, r.variant, r.variant_text) for r in rows] == [
        (0, 0, "狗洗澡"), (0, 1, "犬洗澡"), (0, 2, "狗狗洗澡"), (1, 0, "nothing"),
    ]


def test_rewrites(queries):
    rows = query_text.rewrite_intent(queries("如何洗澡", "什么是猫", "为什么", "plain")).collect()
    got = {}
    for r in rows:
        got.setdefault(r.qid, []).append(r.variant_text)
    # "why" contains "what", so the what rule comes first.
    assert got == {0: ["方法洗澡", "如何洗澡 教程"], 1: ["介绍是猫"], 2: ["为介绍", "原因"]}


def corpus_of(spark, rows):
    return embedding.embed(spark.createDataFrame(rows, "id long, title string"), "title", ENCODER)


@pytest.mark.parametrize("bound", [sizing.BROADCAST_BYTES, 0])
def test_title_paths(spark, queries, monkeypatch, bound):
    monkeypatch.setattr(recall, "BROADCAST_BYTES", bound)
    corpus = corpus_of(spark, [(i, "cat food") for i in range(30)] + [(90, "the category"), (91, "dog"), (92, None)])
    words = spark.createDataFrame([(1, "cat"), (2, "cat"), (3, "dog"), (4, "bird")], "qid long, word string")
    got = {}
    for r in recall.title_contains(corpus, words, 3).collect():
        got.setdefault(r.qid, []).append(r.id)
    assert {q: sorted(v) for q, v in got.items()} == {1: [0, 1, 2], 2: [0, 1, 2], 3: [91]}
    assert sorted(r.id for r in recall.title_contains(corpus, words, 100).where("qid = 1").collect()) == [*range(30), 90]
    assert recall.title_contains(corpus, words.where("false"), 3).count() == 0
    equal = recall.title_equals(corpus, queries("cat food", "dog", "Dog"), 5)
    assert sorted((r.qid, r.id) for r in equal.collect()) == [(0, i) for i in range(5)] + [(1, 91)]


def test_multi_path(spark, queries):
    corpus = corpus_of(spark, [(1, "cat food"), (2, "a cat"), (3, "dog")])
    asked = embedding.embed(queries("cat food"), "query_text", ENCODER, vector_col="qv")
    paths = recall.multi_path(corpus, asked, dense_limit=2)
    got = sorted((r.path, r.source, r.id, round(r.score, 3)) for r in paths.collect())
    assert [g[:3] for g in got if g[0] > 1] == [(2, "keyword", 1), (2, "keyword", 2), (3, "title", 1)]
    merged = {r.id: r for r in recall.merge_paths(paths).collect()}
    assert merged[1].source == "vector" and merged[1].similarity == pytest.approx(1.0)


def test_merge_keeps_the_best_score_and_the_earlier_path(spark):
    rows = [
        (1, 7, "vector", 1, 0.5), (1, 7, "keyword", 2, 0.5), (1, 8, "vector", 1, 0.2), (1, 8, "title", 3, 0.9),
        (1, None, "vector", 1, 1.0), (1, 9, "vector", 1, 0.1),
    ]
    df = spark.createDataFrame(rows, "qid long, id long, source string, path int, score double")
    got = [(r["rank"], r.id, r.source, r.similarity) for r in recall.merge_paths(df, 2).orderBy("rank").collect()]
    assert got == [(1, 8, "title", 0.9), (2, 7, "vector", 0.5)]
    assert recall.merge_paths(df, None).count() == 3


def test_expansion_weights(spark, queries):
    corpus = corpus_of(spark, [(1, "dog bath"), (2, "hound bath"), (3, "method bath")])
    synonyms, rules = {"dog": ["hound"]}, (Rule(("dog",), replace=(("dog", "method"),)),)
    hits = recall.expansion_recall(corpus, queries("dog bath"), ENCODER, synonyms, rules)
    got = {r.id: r.similarity for r in hits.collect()}
    assert got[1] == pytest.approx(1.0) and got[2] >= 0.8 - 1e-6 and got[3] >= 0.6 - 1e-6


def test_fuse_counts_a_missing_side_as_zero(spark):
    dense = spark.createDataFrame([(1, 5, 0.8), (1, 6, 0.5)], "qid long, id long, similarity double")
    keyword = spark.createDataFrame([(1, 6, 4.0), (1, 7, 2.0)], "qid long, id long, score double")
    got = {
        r.id: (r["rank"], r.vector_score, r.text_score, round(r.score, 9)) for r in recall.fuse(dense, keyword).collect()
    }
    assert got == {6: (1, 0.5, 1.0, 0.65), 5: (2, 0.8, 0.0, 0.56), 7: (3, 0.0, 0.5, 0.15)}


def test_hybrid_search(spark, queries):
    docs = spark.createDataFrame([(1, "red fox"), (2, "blue fox"), (3, "green frog")], "id long, text string")
    asked = embedding.embed(queries("red fox"), "query_text", ENCODER, vector_col="qv")
    hits = recall.hybrid_search(embedding.embed(docs, "text", ENCODER), bm25.build_index(docs), asked, limit=1)
    assert [(r.id, round(r.score, 9)) for r in hits.collect()] == [(1, 1.0)]


def hits_of(spark, lists):
    rows = [(q, i + 1, 10 * q + i, s, p) for q, found in lists.items() for i, (s, p) in enumerate(found)]
    return spark.createDataFrame(rows, "qid long, rank long, id long, similarity double, path string")


def test_adaptive(spark):
    def flat(*scores):
        return [(s, "p") for s in scores]

    lists = {
        1: flat(0.85, 0.7, 0.65), 2: flat(0.85, 0.2, 0.1), 3: flat(0.7, 0.55, 0.5, 0.5), 4: flat(0.7, 0.45, 0.5),
        5: flat(0.5, 0.45, 0.4, 0.39, 0.3), 6: flat(0.9, *[0.4] * 8), 7: flat(0.1, 0.1, 0.1, 0.1),
        8: [(0.9, "a"), (0.8, "a"), (0.7, "b"), (0.6, "c"), (0.5, "d"), (0.4, "e")], 9: flat(0.59, 0.58),
    }
    kinds = {1: "simple", 2: "general", 3: "general", 4: "general", 5: "general", 6: "complex", 7: "else", 8: "comprehensive", 9: "simple"}
    types = spark.createDataFrame(list(kinds.items()), "qid long, query_type string")
    got = {}
    for r in selection.adaptive(hits_of(spark, lists), types).orderBy("qid", "rank").collect():
        got.setdefault(r.qid, []).append(r.similarity)
    assert got == {
        1: [0.85, 0.7], 2: [0.85, 0.2], 3: [0.7, 0.55, 0.5], 4: [0.7, 0.5], 5: [0.5, 0.45, 0.4],
        6: [0.9, *[0.4] * 6], 7: [0.1, 0.1, 0.1], 8: [0.9, 0.7, 0.6, 0.5],
    }


def test_best_per_document(spark):
    hits = hits_of(spark, {1: [(0.9, "a"), (0.9, "a"), (0.8, "b"), (0.7, "a"), (0.6, "c")]})
    got = selection.best_per_document(hits, limit=2).orderBy("rank").collect()
    assert [(r["rank"], r.id, r.path) for r in got] == [(1, 10, "a"), (2, 12, "b")]


def test_title_boost(spark, queries):
    hits = hits_of(spark, {0: [(0.9, "x"), (0.85, "Dog food"), (0.2, "dog")]}).withColumnRenamed("path", "title")
    got = selection.boost_titles(hits, queries("the dog"), limit=2).orderBy("rank").collect()
    assert [(r["rank"], r.similarity, r.boosted) for r in got] == [(1, 0.85, 0.95), (2, 0.9, 0.9)]


def test_presets(spark, vectors, asked):
    rows = vectors([(i, [1.0, i / 4]) for i in range(12)])
    query = asked([(1, [1.0, 0.0])])
    counts = {p: selection.preset_search(rows, query, p).count() for p in selection.PRESETS}
    assert counts == {"basic": 10, "recommended": 5, "top_k": 5, "threshold": 10}
    with pytest.raises(ValueError):
        selection.preset_search(rows, query, "none")


def test_spread_join_beyond_the_bound(spark):
    left = spark.range(1000).select("id", (F.col("id") % 3 == 0).cast("int").alias("k"))
    right = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c")], "k int, v string")
    small = sizing.spread_join(left, right, ["k"], "id")
    salted = sizing.spread_join(left, right, ["k"], "id", small=False, salts=8)
    assert sorted(small.collect()) == sorted(salted.select(*small.columns).collect())


@pytest.mark.parametrize("bound", [1 << 26, 20])
def test_containing(spark, bound):
    texts = [(1, "abcab é😀"), (2, "bca"), (3, None), (4, ""), (5, "a_b%")]
    words = ["ab", "bca", "abc", "é😀", "", None, "zz", "_b%", "ab", "%"]
    df = spark.createDataFrame(texts, "id long, text string")
    asked = spark.createDataFrame([(w,) for w in words], "word string")
    found = sorted(tuple(r) for r in containing(df, asked, bound).collect())
    assert found == sorted({(w, i) for i, t in texts for w in words if t and w and w in t})
    assert containing(df, asked.limit(0), bound).count() == 0


def test_keyword_search_falls_back_without_an_index(spark, queries):
    docs = spark.createDataFrame([(1, "The FOX"), (2, "foxes run"), (3, "nothing"), (4, None)], "id long, text string")
    found = recall.keyword_search(docs, queries("fox run fox")).collect()
    assert [(r["rank"], r.id, r.score) for r in found] == [(1, 1, 0.0), (2, 2, 0.0)]
    index = bm25.build_index(docs.where("text is not null"))
    assert [r.id for r in recall.keyword_search(docs, queries("fox"), index).collect()] == [1]


def every_row(docs, vectors, asked, index, weights=(0.7, 0.3), metric="COSINE"):
    """The weighted sum of every pair, in plain Python."""
    text = {(r.qid, r.id): r.score for r in bm25.bm25_search(index, asked, 10_000).collect()}
    out = []
    for q in asked.collect():
        best = max((s for (qid, _), s in text.items() if qid == q.qid), default=0)
        scored = []
        for i in docs:
            v = vectors.get(i)
            dense = 0.0
            if v is not None and q.qv is not None:
                a, b = np.array(q.qv, float), np.array(v, float)
                dense = 1 / (1 + np.linalg.norm(a - b)) if metric == "L2" else float(a @ b)
                if metric == "COSINE":
                    dense = dense / (np.linalg.norm(a) * np.linalg.norm(b)) if a.any() and b.any() else 0.0
            scored.append((weights[0] * dense + weights[1] * (text.get((q.qid, i), 0) / best if best else 0), i))
        seen = {i for i in docs if vectors.get(i) is not None} | {i for qid, i in text if qid == q.qid}
        scored = sorted(((s, i) for s, i in scored if i in seen), key=lambda x: (-round(x[0], 12), x[1]))
        out += [(q.qid, n + 1, i, round(s, 6)) for n, (s, i) in enumerate(scored[:5])]
    return sorted(out)


@pytest.mark.parametrize("metric", ["COSINE", "L2", "IP"])
def test_exact_fusion_equals_the_sum_over_all_rows(spark, queries, metric):
    import random

    rng = random.Random(4)
    words = [f"w{k}" for k in range(12)]
    texts = {i: " ".join(rng.choices(words, k=rng.randrange(1, 9))) for i in range(150)}
    texts |= {200: "w0 w0", 201: None}
    docs = spark.createDataFrame(list(texts.items()), "id long, text string")
    corpus = embedding.embed(docs, "text", ENCODER).select("id", F.when(F.col("id") % 11 != 0, F.col("vector")).alias("vector"))
    asked = embedding.embed(queries("w0 w1", "w5", "nothing here", "w11 w3 w3", ""), "query_text", ENCODER, vector_col="qv")
    index = bm25.build_index(docs)
    vectors = {r.id: r.vector for r in corpus.collect()}
    start, weights = {"COSINE": (20, (0.7, 0.3)), "L2": (60, (1.0, 0.0)), "IP": (160, (0.2, 0.8))}[metric]
    found = recall.hybrid_exact(corpus, index, asked, 5, *weights, start=start, metric=metric)
    got = sorted((r.qid, r["rank"], r.id, round(r.score, 6)) for r in found.collect())
    want = every_row(list(texts), vectors, asked, index, weights, metric)
    assert [g for g in got if g[3] > 0] == [w for w in want if w[3] > 0]
    with pytest.raises(ValueError):
        recall.hybrid_exact(corpus, index, asked, vector_weight=-1)


def test_the_row_behind_both_lists_wins(spark):
    # Rows 0-49 lead by vector, 50-99 by words; row 100 comes after them on both sides and has the best sum.
    rows = [(i, [1.0, 0.001 * i], "other") for i in range(50)]
    rows += [(50 + i, [-1.0, 0.0], "fox " * 12 + "a " * (i % 3)) for i in range(50)]
    rows += [(100, [1.0, 0.06], "fox " * 9)]
    df = spark.createDataFrame(rows, "id long, vector array<double>, text string")
    asked = spark.createDataFrame([(0, "fox", [1.0, 0.0])], "qid long, query_text string, qv array<double>")
    index = bm25.build_index(df)
    assert recall.hybrid_search(df, index, asked, 1).first().id != 100
    best = recall.hybrid_exact(df, index, asked, 1, output_fields="text").first()
    assert best.id == 100 and best.text.startswith("fox") and best.vector_score > 0.99 and best.text_score > 0.8


def test_lists_are_merged_by_unrounded_scores(spark, queries):
    rng = np.random.default_rng(3)
    rows = [(i, (v * 1e-6).tolist(), "fox") for i, v in enumerate(rng.normal(size=(60, 4)))]
    df = spark.createDataFrame(rows, "id long, vector array<double>, text string")
    q = rows[0][1]
    asked = spark.createDataFrame([(0, "fox", q)], "qid long, query_text string, qv array<double>")
    hits = recall.hybrid_search(df, bm25.build_index(df), asked, 5, 1.0, 0.0, metric="IP")
    order = sorted(range(60), key=lambda i: -np.dot(rows[i][1], q))[:5]
    assert [r.id for r in sorted(hits.collect(), key=lambda r: r["rank"])] == order


@pytest.mark.parametrize("bound", [10**9, 400])
def test_dictionaries_and_rules_as_tables(spark, queries, bound):
    from vectide.operators import rewriting

    texts = ["狗洗澡", "nothing", "猫生病 护理", "", None, "如何洗澡", "什么是猫", "为什么", "怎么 如何 什么 为什么"]
    asked = queries(*texts)
    key = lambda df: sorted(((r.qid, r.variant, r.variant_text) for r in df.collect()))
    for limit in (1, 3):
        plain = query_text.expand_synonyms(asked, limit=limit)
        table = rewriting.expand_from_table(asked, rewriting.synonym_table(spark, query_text.SYNONYMS), limit=limit, broadcast_bytes=bound)
        assert key(table) == key(plain) and table.columns == plain.columns
    for limit in (1, 6):
        plain = query_text.rewrite_intent(asked, limit=limit)
        table = rewriting.rewrite_from_table(asked, rewriting.rule_table(spark, query_text.RULES), limit=limit, broadcast_bytes=bound)
        assert key(table) == key(plain)


def test_a_hundred_thousand_synonyms(spark, queries):
    from vectide.operators import rewriting

    rows = spark.range(100_000).selectExpr("id as priority", "0 as place", "concat('word', id, 'x') as word", "concat('syn', id) as synonym")
    asked = queries("a word77777x and word5x", "word1", "word99999xword0x word5x")
    found = rewriting.expand_from_table(asked, rows, broadcast_bytes=2_000_000).collect()
    assert sorted((r.qid, r.variant, r.variant_text) for r in found) == [
        (0, 0, "a word77777x and word5x"), (0, 1, "a word77777x and syn5"), (0, 2, "a syn77777 and word5x"), (1, 0, "word1"),
        (2, 0, "word99999xword0x word5x"), (2, 1, "word99999xsyn0 word5x"), (2, 2, "word99999xword0x syn5"),
    ]
