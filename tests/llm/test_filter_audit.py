import random
import re
from itertools import permutations
from math import factorial

import pytest
from pyspark.sql import functions as F

from vectide.llm import filter_audit

WORD = r"[^\x20\x09-\x0D]+"
SF = "/root/testdata/sf0.001"


def failures(text):
    text = text or ""
    w = re.findall(WORD, text)
    return "".join(
        name
        for name, failed in {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
        }.items()
        if failed
    )


def plain_audit(rows, labels):
    """Every order applied filter by filter to sets of rows."""
    known = {}
    for i, quality, toxic in labels:
        old = known.get(i, (False, False))
        known[i] = (old[0] or quality == 1, old[1] or toxic == 1)
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    parts = {}
    for i, text, lang in rows:
        fails = failures(text) + ("E" if i is not None and first[text or ""] < i else "")
        good, toxic = known.get(i, (False, False)) if i is not None else (False, False)
        parts.setdefault(lang or "", []).append((fails, good, toxic))
    out = []
    for part, held in parts.items():
        removals = {}
        found = []
        for order in permutations("ABCDE"):
            left = held
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                removals[f] = removals.get(f, 0) + len(gone)
                redundant = sum(f in r[0] for r in held) - len(gone)
                unique = sum(r[0] == f for r in held)
                found.append((part, "".join(order), step, len(left), len(gone), redundant, unique, sum(r[1] for r in gone), sum(r[2] for r in gone), f))
        out += [(*r[:-1], removals[r[-1]]) for r in found]
    return sorted(out)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audited(docs, labels):
    return sorted(tuple(r[c] for c in COLUMNS) for r in filter_audit.audit_texts(docs, labels).collect())


@pytest.mark.parametrize("k", [1, 2, 5])
def test_path_counts(k):
    forward, backward = filter_audit.path_counts(k)
    assert all(forward[s] == factorial(bin(s).count("1")) and backward[s] == factorial(k - bin(s).count("1")) for s in range(1 << k))
    orders = filter_audit.steps_of(list("ABCDE"[:k]))
    used = {(s, f): n for s, f, _, n in filter_audit.edges(k)}
    assert len(orders) == factorial(k) * k
    assert all(sum((s, f) == e for _, _, s, f in orders) == n for e, n in used.items())


@pytest.mark.parametrize("broadcast", [True, False])
def test_audit_equals_all_orders(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr("vectide.sizing.fits", lambda *a, **k: False)
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "DELTA", "Eps", "#x", "é", "|"] + [f"w{k}" for k in range(150)]
    texts = [" ".join(rng.choices(words[: rng.choice([8, 158])], k=rng.choice([0, 5, 99, 100, 130, 400]))) for _ in range(60)]
    texts += [None, "", " ", "\n\t", "A" * 100_000, "x" * 200_000 + "#", " ".join(f"u{k}" for k in range(100)), "a\xa0b " * 120]
    rows = [(rng.choice([None, *range(200)]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(260)]
    rows += [(7, "same text", "en"), (7, "same text", "en"), (9, "same text", "fr"), (3, "same text", "de")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 200, 2)] + [(7, 0, 1), (7, 1, 0), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, lang string, part string, quality int")
    table = spark.createDataFrame([(*r, 5) for r in labels], "doc_id long, quality int, toxic int, id int")
    assert audited(docs, table) == plain_audit(rows, labels)
    assert audited(docs, table.limit(0)) == plain_audit(rows, [])
    assert audited(docs.limit(0), table) == []


def test_query_equals_all_orders(spark):
    from vectide.llm.queries import REGISTRY

    found = REGISTRY.plans["op12_filter_audit"](spark, SF)
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    assert sorted(tuple(r[c] for c in COLUMNS) for r in found.collect()) == plain_audit(rows, labels)


def test_any_filters_and_flags(spark):
    rows = spark.range(0, 100)
    found = filter_audit.audit(rows, {"two": F.col("id") % 2 == 0, "three": F.col("id") % 3 == 0, "none": F.lit(None).cast("boolean")}, F.lit("all"), {"big": F.col("id") >= 50})
    at = {(r.filter_order, r.step): r for r in found.collect()}
    assert len(at) == 18 and all(r.kept == 33 for (o, s), r in at.items() if s == 3)
    step = at["twothreenone", 2]
    assert (step.removed, step.redundant, step.unique_fails, step.big) == (17, 17, 17, 9)
    assert step.shapley == 3 * 34 + 3 * 17 and at["nonethreetwo", 1].removed == 0
    with pytest.raises(ValueError):
        filter_audit.audit(rows, {}, F.lit(""), {})
