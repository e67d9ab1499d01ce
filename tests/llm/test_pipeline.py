import corpus_pipeline
import pytest
from test_decontaminate import plain_tiles
from test_native import plain_dedupe
from test_simhash import plain_components, plain_fingerprint
from test_tokens import WORDS

from vectide.llm import decontaminate, language
from vectide.llm.queries import identifier

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage read and returned."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path_factory.mktemp('stage')}/{k}"
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((docs, after))
        docs = after
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns(stages):
    assert all(after.columns == COLUMNS for _, after in stages[:-1])
    assert stages[-1][1].columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_language_stage(stages):
    before, after = stages[0]
    accepted = {r.id for r in language.predict(before, identifier(before)).where("accepted").collect()}
    assert {i for i, _ in rows(after)} == accepted and len(accepted) > 0.95 * before.count()


def test_line_stage(spark, stages):
    before, after = stages[1]
    assert sorted(rows(after)) == sorted((i, t) for i, t, _ in plain_dedupe(spark, rows(before)))
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_simhash_stage(stages):
    before, after = (sorted(rows(x)) for x in stages[2])
    ids = [i for i, _ in before]
    lowest = plain_components([plain_fingerprint(t) for _, t in before], ids)
    assert after == [r for r, c in zip(before, lowest) if r[0] == c] and len(after) < len(before)


def test_benchmark_stage(spark, stages):
    before, after = (sorted(rows(x)) for x in stages[3])
    items = [decontaminate.tokens(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    runs = [{tuple(a[i : i + 5]) for i in range(len(a) - 4)} for a in items]

    def leaks(text):
        b = decontaminate.tokens(text)
        own = {tuple(b[i : i + 5]) for i in range(len(b) - 4)}
        return any(r & own and sum(t[2] for t in plain_tiles(a, b, 5)) >= 0.8 * len(a) for a, r in zip(items, runs))

    assert after == [r for r in before if not leaks(r[1])] and len(after) < len(before)


def test_packing_stage(stages):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    texts = dict(rows(stages[4][0]))
    found = stages[4][1].collect()
    assert {r.doc_id for r in found} == set(texts)
    total = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts.items()}
    assert all(r.doc_tokens == total[r.doc_id] for r in found) and sum(r.length for r in found) == sum(total.values())


def test_run_is_the_stages_in_a_row(spark, stages):
    found = corpus_pipeline.run(spark, SF).collect()
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, found)) == sorted(map(key, stages[-1][1].collect()))


def test_empty_documents(spark, tmp_path):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty_out = stage(spark, empty, SF)
        assert empty_out.count() == 0
