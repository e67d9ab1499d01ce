import random
import uuid

import pytest

from vectide.operators import trigrams
from vectide.session import work_dir

TEXTS = [None, "", "a", "ab", "abc", "abcabc", "the cat sat", "cat", "concatenate", "ca t", "日本語テキスト", "é\nè\tab", "x" * 5000 + "needle" + "y" * 5000, "%_%", "aaaa", "\U0001f600abc"]


@pytest.fixture(scope="module")
def held(spark):
    rng = random.Random(1)
    rows = list(enumerate(TEXTS)) + [(100 + k, "".join(rng.choices("abc ", k=rng.randrange(60)))) for k in range(300)]
    rows += [(7, "another text of row seven"), (None, "cat without an id")]
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    trigrams.store(spark.createDataFrame(rows, "id long, text string").repartition(3), path, parts=8, slice_texts=16)
    return rows, trigrams.load(spark, path)


WORDS = ["cat", "abc", "a", "ab", "", None, "needle", "bca", "日本語", "nothing here", "aaaa", "x", "cat sat", "%_%", "aab c", "\U0001f600a", "é\nè", "cat", "abcabcabc"]


def want(rows, words):
    return sorted(((w, i) for w in set(words) if w for i, t in rows if t is not None and w in t), key=repr)


@pytest.mark.parametrize("named", [1000, 0])
def test_contains_equals_a_scan(spark, held, monkeypatch, named):
    rows, index = held
    monkeypatch.setattr(trigrams, "NAMED_GRAMS", named)
    words = spark.createDataFrame([(w,) for w in WORDS], "word string")
    found = trigrams.contains(index, words)
    assert sorted(map(tuple, found.collect()), key=repr) == want(rows, WORDS)


def test_candidates_hold_all_trigrams(spark, held):
    rows, index = held
    words = spark.createDataFrame([("cat",), ("abcabc",)], "word string")
    got = trigrams.candidates(index, words).collect()
    texts = {(r.slice, r.place): r.text for r in index.texts.collect()}
    listed = {(r.word, r.slice, p) for r in got for p in r.places}
    for w in ("cat", "abcabc"):
        parts = {w[k : k + 3] for k in range(len(w) - 2)}
        assert {(s, p) for x, s, p in listed if x == w} == {k for k, t in texts.items() if all(g in t for g in parts)}
    plan = trigrams.candidates(index, words)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PushedFilters: [" in plan and "ReadSchema: struct<gram:string,slice:bigint,places:array<int>>" in plan


def test_no_words_and_no_texts(spark, held):
    _, index = held
    none = spark.createDataFrame([], "word string")
    assert trigrams.contains(index, none).count() == 0
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    trigrams.store(spark.createDataFrame([("k", "abcd"), ("l", None)], "id string, text string"), path)
    few = trigrams.load(spark, path)
    assert [tuple(r) for r in trigrams.contains(few, spark.createDataFrame([("bcd",), ("zzz",)], "word string")).collect()] == [("bcd", "k")]


@pytest.mark.parametrize("bound", [1 << 20, 100])
def test_lowest_ids_of_each_word(spark, held, bound):
    rows, index = held
    found = trigrams.contains(index, spark.createDataFrame([(w,) for w in WORDS], "word string"), 3, bound)
    got = {}
    for word, id_ in found.collect():
        got.setdefault(word, []).append(id_)
    lowest = lambda ids: sorted(ids, key=lambda i: (i is not None, i or 0))[:3]
    full = {}
    for word, id_ in want(rows, WORDS):
        full.setdefault(word, []).append(id_)
    assert {w: lowest(ids) for w, ids in got.items()} == {w: lowest(ids) for w, ids in full.items()}
    assert len(got["abc"]) < len(full["abc"])


def test_long_texts_are_cut_in_one_pass(spark):
    """Trigrams of texts of a megabyte: the work grows with the text, not with its square."""
    path = f"{work_dir(spark)}/{uuid.uuid4().hex}"
    texts = [(k, "".join(chr(97 + (i * i + k) % 26) for i in range(1_000_000)) + f"end{k}") for k in range(4)]
    trigrams.store(spark.createDataFrame(texts, "id long, text string"), path)
    got = trigrams.contains(trigrams.load(spark, path), spark.createDataFrame([("end2",), ("zend",)], "word string")).collect()
    assert sorted(map(tuple, got)) == [("end2", 2), *[("zend", k) for k, t in texts if "zend" in t]]


@pytest.mark.parametrize("letters", [3_000_000, 12])
def test_texts_meet_all_words_at_once(spark, held, monkeypatch, letters):
    """What is kept between the postings and the texts are places, however many words may stand at them."""
    rows, index = held
    words = [a + b + c + d for a in "abc " for b in "abc " for c in "abc " for d in "abc "]
    written = []
    keep = trigrams.materialize
    monkeypatch.setattr(trigrams, "materialize", lambda df: written.append(df.columns) or keep(df))
    monkeypatch.setattr(trigrams, "LETTERS", letters * 16, raising=False)
    found = trigrams.contains(index, spark.createDataFrame([(w,) for w in words], "word string"))
    assert sorted(map(tuple, found.collect()), key=repr) == want(rows, words)
    assert [c for c in written if "_block" not in c] == [["slice", "place"]] * (1 if letters > 12 else 6)


def test_trigrams_of_pieces(monkeypatch):
    monkeypatch.setattr(trigrams, "PIECE", 5)
    for text in [t for t in TEXTS if t is not None] + ["abcabcabcab", "abcde", "abcdef", "abcdefg"]:
        own = {text[k : k + 3] for k in range(len(text) - 2)}
        keys = trigrams._gram_keys(text)
        assert [sum(ord(c) << s for c, s in zip(g, (42, 21, 0))) for g in sorted(own, key=lambda g: [*map(ord, g)])] == keys.tolist()
