import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from vectide.llm import encoding, packing, token_count, token_files

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")

ALPHABET = [
    " ", "  ", "\n", "\t", "\r\n", "　", "\x85", "\x1c", " ", "a", "the", " the", "ing", "'s", "'LL", "1", "23", ",", ".", "word,", "...", ".,", "é", "É",
    "Ä", "ß", "ﬁ", "Σ", "ς", "中", "文", "😀", "​", "̸", "▁", "▁▁", "<s>", "</s>", "<unk>", "<0x0A>", "<|endoftext|>", "<|startoftext|>", "x" * 9,
]


def odd_texts(n, seed=0):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 60))) for _ in range(n)]
    return texts + ["", " ", "   ", "\n", "\n\n a", "a\n", "x" * 3000, " " * 700, "ab" * 400, "word " * 5000, "▁" * 300 + "a"]


def documents(spark, sf="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")


def edge_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate(odd_texts(60, 3))] + [(5, None, "y"), (None, "null id", "z"), (7, "again", "z"), (7, "again", "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, tokens string"), rows


def test_counts_are_the_library_s():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = odd_texts(3000)
    assert token_count.Counter(PIECES).count(texts) == [len(x) for x in library.encode(texts)]


def test_long_pretokens_by_heap_and_by_rounds(monkeypatch):
    words = [SP + "".join(random.Random(i).choice("abcdeinrst▁ée中") for _ in range(250)) for i, SP in enumerate(["▁"] * 50)]
    merges = token_count.Merges(PIECES)
    by_rounds = merges.count(words)
    monkeypatch.setattr(token_count, "LONG", 0)
    assert by_rounds == merges.count(words)


def test_small_cache(monkeypatch):
    monkeypatch.setattr(token_count, "CACHE_ENTRIES", 10)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counter = token_count.Counter(PIECES)
    for t in odd_texts(50, 2):
        assert counter.count([t, None]) == [len(library.encode(t)), 0]


def test_count_query(spark):
    from vectide.llm.queries import REGISTRY

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = {r.doc_id: r for r in REGISTRY.plans["op3_token_counts"](spark, "/root/testdata/sf0.001").collect()}
    for r in documents(spark).collect():
        n = len(library.encode(r.text))
        assert tuple(found[r.doc_id]) == (r.doc_id, len(r.text.encode()), n, n > 4096)


def test_count_edge_rows(spark):
    df, rows = edge_rows(spark)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = token_count.counts(df, PIECES).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or "")), False) for i, t, _ in rows]
    assert sorted(map(repr, map(tuple, found))) == sorted(repr((a, b, c, c > 4096)) for a, b, c, _ in want)
    assert token_count.counts(df.limit(0), PIECES).count() == 0


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_chunks_give_the_library_s_ids(path, monkeypatch):
    library = Tokenizer.from_file(path)
    own = encoding.Encoder(path)
    assert own.pattern is not None
    for limit in (10**6, 20):
        monkeypatch.setattr(encoding, "CACHE_ENTRIES", limit)
        texts = odd_texts(2000, 4)
        found = own.encode(texts)
        for t, f in zip(texts, found):
            assert np.frombuffer(f, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def kraft(lengths):
    return sum(2.0 ** -int(x) for x in lengths)


def test_code_lengths():
    rng = np.random.default_rng(1)
    for n, bits in ((1, 4), (2, 4), (5, 3), (300, 12), (5000, 18), (256, 8)):
        counts = np.sort((rng.pareto(0.5, n) + 1).astype(np.int64))[::-1]
        lengths = token_files.code_lengths(counts, bits)
        assert lengths.max() <= bits and kraft(lengths) <= 1 and (np.diff(lengths) >= 0).all()
    # Without a binding limit the cost is that of Huffman's algorithm.
    import heapq

    counts = rng.integers(1, 1000, 200)
    heap, cost = sorted(counts.tolist()), 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert (token_files.code_lengths(counts, 30) * counts).sum() == cost
    # A binding limit, against all assignments.
    best = min(
        (x * np.array([1, 1, 2, 40])).sum()
        for x in (np.array(v) for v in np.ndindex(4, 4, 4, 4))
        if x.min() > 0 and x.max() <= 2 and kraft(x) <= 1
    )
    assert (token_files.code_lengths(np.array([1, 1, 2, 40]), 2) * np.array([1, 1, 2, 40])).sum() == best


def test_code_round_trip():
    rng = np.random.default_rng(2)
    tokens = np.sort(rng.choice(60_000, 9000, replace=False))
    counts = (rng.pareto(0.4, 9000) + 1).astype(np.int64)
    code = token_files.Code(tokens, token_files.code_lengths(counts))
    blocks = [tokens[rng.integers(0, 9000, n)] for n in (0, 1, 127, 128, 129, 5000, 256)]
    written = [code.encode(b) for b in blocks]
    found = code.decode([w[0] for w in written], [w[1] for w in written], list(map(len, blocks)))
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(found, blocks))


def expected_digests(rows, path, end):
    library = Tokenizer.from_file(path)
    out, start = [], 0
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [end]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_file_query(spark):
    from vectide.llm.queries import REGISTRY

    rows = sorted((r.doc_id, r.text) for r in documents(spark).collect())
    found = sorted(map(tuple, REGISTRY.plans["op4_token_files"](spark, "/root/testdata/sf0.001").collect()))
    assert found == expected_digests(rows, BYTES, 0)


@pytest.mark.parametrize("block", [1 << 16, 50])
def test_file_round_trip_of_edge_rows(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(token_files, "BLOCK", block)
    df, rows = edge_rows(spark)
    token_files.write(df, f"{tmp_path}/f", BYTES)
    back = token_files.read(spark, f"{tmp_path}/f").orderBy("part", "seq").collect()
    ids = [r.id for r in back]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    library = Tokenizer.from_file(BYTES)
    want = [(i, np.array([*library.encode(t or "").ids, 0], "<u4").tobytes()) for i, t, _ in rows]
    assert sorted(map(repr, ((r.id, bytes(r.tokens)) for r in back))) == sorted(map(repr, want))
    stored = spark.read.parquet(f"{tmp_path}/f/blocks")
    assert (stored.count() > 3) == (block == 50)
    token_files.write(df.limit(0), f"{tmp_path}/e", BYTES)
    assert token_files.read(spark, f"{tmp_path}/e").count() == 0


def plain_best_fit(lengths, window):
    rooms, total = [], 0
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms[rooms.index(min(fits))] -= n
        else:
            rooms.append(window - n)
    return sorted(rooms)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(1)
    for window in (7, 64, 2048):
        for n in (0, 1, 5, 300):
            lengths = [rng.choice([rng.randrange(1, window + 1), max(1, window // 3)]) for _ in range(n)]
            histogram = {x: lengths.count(x) for x in set(lengths)}
            found, n_windows = packing.plan(histogram, window)
            used, marks = {}, {}
            ends = {}
            for length, first, target, offset in sorted(found):
                ends.setdefault(length, []).append((first, target, offset))
            for length, runs in ends.items():
                for (first, target, offset), after in zip(runs, [*[r[0] for r in runs[1:]], histogram[length]]):
                    for k in range(after - first):
                        used.setdefault(target + k, []).append((offset, length))
            rooms = []
            for w in range(n_windows):
                at = 0
                for offset, length in sorted(used[w]):
                    assert offset == at
                    at += length
                assert at <= window
                rooms.append(window - at)
            assert sorted(rooms) == plain_best_fit(lengths, window), marks


def test_plan_does_not_grow_with_the_number_of_pieces():
    rng = random.Random(2)
    small = {n: rng.randrange(1, 50) for n in range(1, 2048)}
    steps = [len(packing.plan({k: v * f for k, v in small.items()}, 2048)[0]) for f in (1, 10**3, 10**9)]
    assert max(steps) < 60_000


def check_packing(rows, packed, path, window):
    library = Tokenizer.from_file(path)
    by_doc, by_sequence = {}, {}
    for r in packed:
        by_doc.setdefault(r.id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and len(r.ids) == 4 * r.length
            assert bytes(r.ids) == np.array(ids[at : at + r.length], "<u4").tobytes()
            at += r.length
        assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for found in by_sequence.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return len(by_sequence)


@pytest.mark.parametrize("window", [2048, 100])
def test_packing(spark, window):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    packed = packing.pack(docs.repartition(5), WORDS, window).collect()
    n = check_packing(rows, packed, WORDS, window)
    assert n <= 1.05 * sum(r.length for r in packed) / window + 1


def test_packing_edge_rows(spark):
    df, rows = edge_rows(spark)
    one_each = df.dropDuplicates(["doc_id"]).where("doc_id is not null")
    rows = [(r.doc_id, r.text) for r in one_each.collect()]
    packed = packing.pack(one_each, WORDS, 64)
    check_packing(rows, packed.collect(), WORDS, 64)
    whole = packing.pack(df, WORDS, 64)
    assert whole.where("start = 0").count() == df.count()
    assert packing.pack(df.limit(0), WORDS).count() == 0
    filled = packing.sequences(packed, 64, pad_id=9).collect()
    sizes = {r.sequence_id: r.n for r in packed.groupBy("sequence_id").sum("length").withColumnRenamed("sum(length)", "n").collect()}
    for r in filled:
        n = sizes[r.sequence_id]
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == (n if n & (n - 1) == 0 else 64) and (ids[n:] == 9).all()


def test_packing_query(spark):
    from vectide.llm.queries import REGISTRY

    library = Tokenizer.from_file(WORDS)
    found = REGISTRY.plans["op6_packing"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    for r in found:
        ids = [*library.encode(texts[r.doc_id], add_special_tokens=False).ids, 1]
        part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
        assert (r.doc_tokens, r.ids_crc32) == (len(ids), zlib.crc32(part))
    assert sum(r.length for r in found) == sum(r.doc_tokens for r in found if r.start == 0)
    assert {r.doc_id for r in found} == set(texts)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_distinct_chunks_are_looked_up_once_a_step(name, monkeypatch):
    own = encoding.Encoder(public_tokenizers.path(name))
    asked = []
    known = own._known
    monkeypatch.setattr(own, "_known", lambda chunks: asked.extend(chunks) or known(chunks))
    texts = ["alpha beta, alpha\nbeta gamma."] * 50 + ["alpha  beta"] * 50
    want = [np.array(own.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert own.encode(texts) == want
    assert len(asked) < 20


def test_codes_of_narrow_tokens_and_uneven_blocks():
    rng = np.random.default_rng(4)
    tokens, lengths = np.arange(3000), token_files.code_lengths(np.arange(1, 3001) ** 3)
    code = token_files.Code(tokens, lengths)
    parts = [rng.integers(0, 3000, n).astype(np.uint16) for n in (1, 700, 0, 128, 5000, 129)]
    coded = [code.encode(p) for p in parts]
    for p, (bits, _) in zip(parts, coded):
        plain = "".join(format(int(code.code[t]) >> 5, f"0{int(code.code[t]) & 31}b") for t in p)
        assert "".join(format(b, "08b") for b in bits)[: len(plain)] == plain and len(bits) == -(-len(plain) // 8)
    found = code.decode([b for b, _ in coded], [c for _, c in coded], list(map(len, parts)))
    assert all((f == p).all() for f, p in zip(found, parts))
