import pytest

from vectide.operators import chunking as C


@pytest.fixture
def texts(spark):
    return lambda *t: spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")


def contents(chunks):
    rows = sorted(chunks.collect(), key=lambda r: (r.doc_id, r.chunk_index))
    out = {}
    for r in rows:
        assert r.chunk_index == len(out.setdefault(r.doc_id, []))
        out[r.doc_id].append(r.content)
    return out


def test_short_text_is_dropped_and_exact_fit_is_kept(texts):
    got = contents(C.chunk_paragraphs(texts("a" * 9, "b" * 20, "c" * 10), max_chunk=20, overlap=3, min_chunk=10))
    assert got == {1: ["b" * 20], 2: ["c" * 10]}


def test_paragraphs_join_until_full_and_overlap(texts):
    text = "aaaaaaaaaa\n\nbbbbbbbb\n\ncccccc"
    # 10 + 8 fit into 20 (the joint is not counted); 20 + 6 do not.
    assert contents(C.chunk_paragraphs(texts(text), max_chunk=20, overlap=3, min_chunk=5)) == {
        0: ["aaaaaaaaaa\n\nbbbbbbbb", "bbbcccccc"]
    }


def test_long_paragraph_is_packed_by_sentence_without_end_marks(texts):
    text = "Alpha beta. Gamma delta! Epsilon zeta?"
    assert contents(C.chunk_paragraphs(texts(text), max_chunk=25, overlap=4, min_chunk=5)) == {
        0: ["Alpha beta Gamma delta", "elta Epsilon zeta"]
    }


def test_short_chunk_before_an_overflow_is_lost(texts):
    assert contents(C.chunk_paragraphs(texts("tiny\n\n" + "x" * 18), max_chunk=20, overlap=3, min_chunk=5)) == {
        0: ["x" * 18]
    }


def test_a_sentence_longer_than_the_maximum_stays_whole(texts):
    assert contents(C.chunk_paragraphs(texts("y" * 50), max_chunk=20, overlap=3, min_chunk=5)) == {0: ["y" * 50]}


def test_no_overlap_and_white_space(texts):
    text = "  " + "a" * 12 + "\n\n" + "b" * 12 + "\n\n\n\n"
    assert contents(C.chunk_paragraphs(texts(text), max_chunk=14, overlap=0, min_chunk=5)) == {0: ["a" * 12, "b" * 12]}


def test_delimiter_is_literal(texts):
    assert contents(C.chunk_paragraphs(texts("aaaaaa.|bbbbbb"), max_chunk=7, overlap=1, min_chunk=2, delimiter=".|")) == {
        0: ["aaaaaa", "abbbbbb"]
    }


@pytest.mark.parametrize("size, overlap", [(5, 2), (5, 0), (5, 4), (7, 3), (100, 10)])
@pytest.mark.parametrize("text", ["", "a", "abcde", "abcdefghijklmnopqrstuvwxyz", "zweiÜml😀ute\nund mehr Text hier"])
def test_fixed_windows(texts, size, overlap, text):
    expected, at = [], 0
    while text:
        expected.append(text[at : at + size])
        if at + size >= len(text):
            break
        at += size - overlap
    got = contents(C.chunk_fixed(texts(text), size=size, overlap=overlap))
    assert got == ({0: expected} if expected else {})


def test_sentences_and_paragraphs(texts):
    assert contents(C.chunk_sentences(texts("One. Two!! 三。 \n"))) == {0: ["One", "Two", "三"]}
    assert contents(C.chunk_by_paragraph(texts("long enough\n\nno\n\n also long "), min_chunk=5)) == {
        0: ["long enough", "also long"]
    }


def test_headings_keep_code_whole(texts):
    code = "```\n# no heading\n" + "x = 1\n" * 10 + "```"
    text = f"intro\n# One\nbody\n{code}\ntail\n## Two\nend"
    got = contents(C.chunk_headings(texts(text), max_chunk=30, overlap=4))[0]
    assert got[0] == "intro"
    assert any(code in c for c in got)
    assert got[-1] == "## Two\nend"
    assert sum("# no heading" in c for c in got) == 1
    assert [c for c in got if c.startswith("# One")]


def test_dialogues(spark):
    rows = [
        (1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "user", "q2"), (1, 3, "user", "q3"),
        (2, 0, "system", "s"), (2, 1, "user", "q"), (2, 2, "assistant", "a"),
        (3, 1, "user", "gap"), (3, 7, "assistant", "far"), (4, 0, "user", "q"), (4, 1, "system", "s"), (4, 2, "assistant", "a"), (5, 9, "user", "end"), (6, 1, "assistant", "start"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted((r.conv_id, r.turn, r.content) for r in C.chunk_dialogues(df).collect())
    assert got == [(1, 0, "q1\na1"), (2, 1, "q\na"), (3, 1, "gap\nfar")]


def test_chunk_table_is_stable(texts):
    chunks = C.chunk_sentences(texts("One. Two. One."))
    first = C.chunk_table(chunks, "doc_id", 5).collect()
    again = C.chunk_table(chunks, "doc_id", 5).collect()
    assert sorted(r.uuid for r in first) == sorted(r.uuid for r in again) and len({r.uuid for r in first}) == 3
    assert {(r.document_id, r.created_time) for r in first} == {("0", 5)}


def test_clean(texts):
    df = texts("Same  text", "same text ", "other text", "tiny", "SAME\ttext")
    assert sorted(r.doc_id for r in C.clean(df, min_chars=6).collect()) == [0, 2]


def test_sizes_are_checked(texts):
    with pytest.raises(ValueError):
        C.chunk_fixed(texts("a"), size=5, overlap=5)
    with pytest.raises(ValueError):
        C.chunk_paragraphs(texts("a"), max_chunk=0)
