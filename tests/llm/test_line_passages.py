import random
import re

import pytest

from vectide.llm import line_dedup

WORD = r"[^\x20\x09-\x0D]+"


def removable(rows, min_lines, min_words=51):
    """By brute force over all runs: lines (row, place) of every later occurrence of a passage."""
    runs = {}
    for order, (_, text) in enumerate(rows):
        lines = (text or "").split("\n")
        counts = [len(re.findall(WORD, x)) for x in lines]
        for a in range(len(lines)):
            for b in range(a + min_lines, len(lines) + 1):
                if sum(counts[a:b]) >= min_words and counts[a] and counts[b - 1]:
                    runs.setdefault(tuple(lines[a:b]), []).append((order, a))
    out = set()
    for run, at in runs.items():
        order, start = min(at)
        out |= {(o, i) for o, a in at if o != order or a >= start + len(run) for i in range(a, a + len(run))}
    return out


def kept_lines(rows, lost):
    return [[x for i, x in enumerate((t or "").split("\n")) if (o, i) not in lost] for o, (_, t) in enumerate(rows)]


def check(spark, rows, min_lines):
    """No copy of a passage is left, and nothing but passages and chunks is lost."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r._row.doc_id: r.new_text for r in line_dedup.dedupe(df, min_lines=min_lines).collect()}
    # With passages out of reach only chunks go.
    cut = {r._row.doc_id: r.new_text for r in line_dedup.dedupe(df, min_words=10**6).collect()}
    lost = removable(rows, min_lines)
    for (i, text), kept in zip(rows, kept_lines(rows, lost)):
        if cut[i] == text:
            assert found[i] == ("\n".join(kept) if len(kept) < len((text or "").split("\n")) else text), i
        else:
            # Lines that are in a passage are gone; those in neither piece stay.
            assert set(found[i].split("\n")) <= {*kept, ""}, i
            assert set(kept) & set(cut[i].split("\n")) <= {*found[i].split("\n")}, i
    return found


def line(rng, n, tag):
    return " ".join([tag] + [rng.choice("abcdefgh") + str(rng.randrange(1000)) for _ in range(n - 1)])


@pytest.mark.parametrize("n_lines", [2, 3, 4, 5, 9])
def test_planted_passages_go_whole(spark, n_lines):
    rng = random.Random(n_lines)
    rows, planted = [], []
    for g in range(12):
        passage = [line(rng, -(-52 // n_lines) + rng.randrange(3), f"p{g}.{k}") for k in range(n_lines)]
        if g % 3 == 0:
            passage[1:1] = [""]
        planted.append(passage)
    for i in range(60):
        own = [line(rng, rng.randrange(1, 20), f"o{i}.{k}") for k in range(rng.randrange(1, 9))]
        at = rng.randrange(len(own) + 1)
        own[at:at] = planted[i % 12]
        rows.append((i, "\n".join(own)))
    found = check(spark, rows, 2)
    for i, text in rows:
        left = set(found[i].split("\n"))
        whole = all(x in left for x in planted[i % 12])
        none = not any(x in left for x in planted[i % 12] if x)
        assert whole if i < 12 else none, (i, n_lines)


@pytest.mark.parametrize("min_lines", [1, 2])
def test_random_lines(spark, min_lines):
    rng = random.Random(5)
    lines = [line(rng, n, f"s{n}") for n in (1, 2, 3, 9, 12, 20, 26, 30, 40, 50, 51, 60)] + ["", " "]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 8)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "one\ntwo\n" * 60), (103, "\n".join([lines[7]] * 6)), (104, rows[0][1])]
    check(spark, rows, min_lines)


def test_single_lines_go(spark):
    rng = random.Random(6)
    long, short = line(rng, 51, "long"), line(rng, 50, "short")
    rows = [(i, "\n".join([f"head {i}", *([long, short] if i % 2 else [short, f"own {i}", long]), f"tail {i}"])) for i in range(8)]
    rows += [(8, long), (9, short)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r._row.doc_id: r.new_text for r in line_dedup.dedupe(df).collect()}
    assert [i for i in found if long in found[i]] == [0] and found[8] == ""
    # A line of fewer words is a passage only together with its neighbours.
    assert found[9] == short and all(f"head {i}" in found[i] and f"tail {i}" in found[i] for i in range(8))
