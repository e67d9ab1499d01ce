import random
import zlib

import numpy as np
import pytest

from vectide.llm import language, subwords, toxicity
from vectide.llm.subwords import Shape

SF = "/root/testdata/sf0.01"


def test_ngrams():
    shape = Shape(orders=(2, 3), bits=20)
    words = ["ab", "", "é😀x", "ab"]
    buckets, of = shape.cut(words)
    each = [shape.cut([w])[0] for w in words]
    assert [sorted(buckets[of == k].tolist()) for k in range(4)] == [sorted(e.tolist()) for e in each]
    assert [len(e) for e in each] == [3 + 2, 1 + 0, 4 + 3, 5]
    assert shape.cut([])[0].size == 0


def test_repeated_words_count_by_their_logarithm():
    shape = Shape(orders=(3,), bits=16)
    buckets, weights = subwords.bag_of("one two two two", shape)
    one, two = (set(shape.cut([w])[0].tolist()) for w in ("one", "two"))
    found = dict(zip(buckets.tolist(), weights.tolist()))
    assert all(found[b] == pytest.approx(1.0) for b in one - two) and all(found[b] == pytest.approx(1 + np.log(3)) for b in two - one)


def toy(n, seed=0):
    rng = random.Random(seed)
    parts = {"x": ["ka", "ko", "mi"], "y": ["sch", "ung", "ein"], "z": ["que", "aux", "oi"]}
    out = []
    for k in range(n):
        lang = "xyz"[k % 3]
        out.append((lang, " ".join("".join(rng.choices(parts[lang], k=3)) for _ in range(rng.randrange(3, 30)))))
    return out


def test_model_learns_and_scores_as_its_bags():
    shape = Shape(orders=(1, 2, 3), bits=12, smooth=3.0)
    found = [(lang, *subwords.bag_of(t, shape)) for lang, t in toy(150)]
    model = subwords.train(*subwords.split(found), shape)
    fresh = toy(60, 1)
    bags = subwords.bag_probabilities(model, [(lang, *subwords.bag_of(t, shape)) for lang, t in fresh])
    scores = subwords.Scorer(model).score([t for _, t in fresh])
    assert np.allclose(bags, scores) and np.allclose(scores.sum(axis=1), 1)
    assert [model.classes[k] for k in scores.argmax(axis=1)] == [lang for lang, _ in fresh]


def test_small_cache_and_long_words(monkeypatch):
    shape = Shape(bits=12)
    found = [(lang, *subwords.bag_of(t, shape)) for lang, t in toy(60)]
    model = subwords.train(*subwords.split(found), shape)
    texts = [t for _, t in toy(30, 2)] + ["k" * 600_000, None, ""]
    whole = subwords.Scorer(model).score(texts)
    monkeypatch.setattr(subwords, "CACHE_ENTRIES", 5)
    monkeypatch.setattr(subwords, "CACHE_CHARS", 10)
    small = subwords.Scorer(model)
    assert np.allclose(whole, np.concatenate([small.score([t]) for t in texts]))
    assert np.allclose(whole[-1], whole[-2])


def test_sample_is_bounded_and_keeps_rare_labels(spark):
    rows = spark.range(5000).selectExpr("id", "case when id < 4 then 'rare' when id % 7 = 0 then null else 'often' end as label", "'t' as text")
    found = {r.label: r["count"] for r in subwords.sample(rows, 300).groupBy("label").count().collect()}
    assert found["rare"] == 4 and 200 < found["often"] < 400 and set(found) == {"rare", "often"}


def test_language_of_edge_rows(spark):
    rows = [(k, t, lang, "clash") for k, (lang, t) in enumerate(toy(90))] + [(None, "kako miko", "x", "c"), (5, None, "x", "c"), (5, "", None, "c"), (6, "12 %% ::", "y", "c"), (6, "12 %% ::", "y", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, accepted string")
    model = language.fit(df, "doc_id", "text", "lang")
    found = language.predict(df, model).collect()
    assert len(found) == len(rows)
    odd = [r for r in found if r.lang_pred == "und"]
    assert len(odd) == 4 and all(r.score == 0 and not r.accepted for r in odd)
    assert all(0 <= r.score <= 1 for r in found)
    kept = language.filter_known(df, model)
    assert kept.columns == df.columns and {r.accepted for r in kept.collect()} <= {"clash", "c"}
    assert kept.count() >= 85
    assert language.predict(df.limit(0), model).count() == 0
    nothing = language.fit(df.where("lang = 'none'"), "doc_id", "text", "lang")
    assert nothing is None and language.predict(df, nothing).where("lang_pred = 'und' and not accepted").count() == len(rows)


def test_language_query(spark):
    from vectide.llm.queries import REGISTRY

    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = REGISTRY.plans["op2_language_id"](spark, SF).collect()
    assert len(found) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    held = [r for r in found if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.98
    assert np.mean([r.accepted for r in held]) > 0.98


def test_toxicity_of_edge_rows(spark):
    rng = random.Random(3)
    rows = []
    for k in range(300):
        words = ["".join(rng.choices(["ka", "ko", "mi", "su"], k=3)) for _ in range(40)]
        if k % 3 == 0:
            words[5:5] = [rng.choice(["grobian", "lump"])] * 2
        rows.append((k, " ".join(words), int(k % 3 == 0), "clash"))
    df = spark.createDataFrame(rows + [(None, None, 1, ""), (7, "", None, "")], "doc_id long, text string, toxic int, score string")
    judge = toxicity.fit(df, df)
    found = toxicity.score(df, judge).collect()
    assert len(found) == 302 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    by_id = {r.id: r for r in found if r.id != 7}
    assert np.mean([by_id[k].predicted == (k % 3 == 0) for k in range(300) if k != 7]) > 0.97
    fresh = spark.createDataFrame([(1, "kako misu " * 10 + "grobiann grobian"), (2, "kako misu " * 10)], "doc_id long, text string")
    a, b = sorted(toxicity.score(fresh, judge).collect())
    assert a.score > b.score
    assert toxicity.score(df.limit(0), judge).count() == 0
    nothing = toxicity.fit(df, df.where("toxic = 0"))
    assert nothing is None and toxicity.score(df, nothing).where("predicted = 0").count() == 302


def test_auc():
    assert toxicity.auc(np.array([0.1, 0.4, 0.4, 0.9]), np.array([0, 1, 0, 1])) == pytest.approx(0.875)


def test_toxicity_query(spark):
    from vectide.llm.queries import REGISTRY

    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = REGISTRY.plans["op10_toxicity"](spark, sf).collect()
    assert len(found) == len({r.doc_id for r in found}) == 10_000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r.held_out and r.doc_id in labels]
    y = np.array([labels[r.doc_id] for r in held])
    assert toxicity.auc(np.array([r.score for r in held]), y) > 0.92
