import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from natatio.llm import decontaminate as dc
from natatio.llm.language import has_letters
from tests.llm.test_decontaminate import slow_align, words
from tests.llm.test_jaccard import slow
from tests.llm.test_mixing import slow as slow_mix

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{DIR}/documents.parquet"), []
    for name, stage in cp.STAGES:
        made = cp.stored(stage(spark, docs, DIR), name)
        out.append((docs.collect(), made.collect(), made.columns))
        docs = made
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "mixing_to_weights", "token_ids_binary"]
    assert all(columns == list(cp.COLUMNS) for _, _, columns in stages[:-1])
    assert all(len(before) >= len(after) > 0 for before, after, _ in stages)


def best_score(item, text):
    """Score of the best local alignment, a row of the table at a time: a gap to the left costs one a word, so what it leaves is a running maximum."""
    at = np.arange(len(text) + 1)
    row, best = np.zeros(len(text) + 1, int), 0
    for x in item:
        same = np.array([dc.MATCH if x == y else dc.UNLIKE for y in text], int)
        fresh = np.maximum(0, row + dc.GAP)
        fresh[1:] = np.maximum(fresh[1:], row[:-1] + same)
        row = np.maximum.accumulate(fresh - dc.GAP * at) + dc.GAP * at
        best = max(best, int(row.max()))
    return best


def test_best_score():
    r = np.random.default_rng(3)
    for _ in range(60):
        a, b = r.integers(0, 5, int(r.integers(1, 9))).tolist(), r.integers(0, 5, int(r.integers(1, 25))).tolist()
        assert best_score(a, b) == slow_align(a, b)


def test_each_stage_against_plain_code(spark, stages):
    before, after, _ = stages[0]
    assert {r.doc_id for r in after} == {r.doc_id for r in before if r.text and has_letters(r.text.encode())}
    before, after, _ = stages[1]
    groups = slow({r.doc_id: r.text for r in before})
    assert sorted(r.doc_id for r in after) == sorted(set(groups.values()))
    before, after, _ = stages[2]
    items = [words(r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in before if any(a and best_score(a, words(r.text)) >= dc.THRESHOLD * dc.MATCH * len(a) for a in items)}
    assert leaks
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - leaks
    before, after, _ = stages[3]
    assert sorted(r.doc_id for r in after) == sorted(x[0] for x in slow_mix([(r.doc_id, r.text, r.lang, r.source) for r in before], cp.MIX_SHARE, 1))
    before, after, _ = stages[4]
    whole, start, want = Tokenizer.from_file(cp.tokenizer_file()), 0, []
    for r in sorted(before, key=lambda r: r.doc_id):
        ids = [*whole.encode(r.text or "", add_special_tokens=False).ids, 1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, after)) == want


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(tuple, cp.run(spark, DIR).collect())) == sorted(map(tuple, stages[-1][1]))


def test_an_id_with_several_texts(spark):
    """Each text is judged by itself, and which row stays doesn't depend on chance."""
    long = " ".join(f"w{k}" for k in range(40))
    rows = [(5, "first text of the id", "en", "b", 1), (5, "first text of the id", "en", "a", 1), (5, long, "de", "c", 2), (3, long + " more", "fr", "d", 3), (7, "first text of the id", "en", "e", 1), (None, long, "en", "f", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(map(tuple, cp.simhash_near_dedup(spark, docs, DIR).collect()), key=str)
    assert got == sorted([rows[1], rows[3], rows[5]], key=str)


def test_run_leaves_only_the_token_files(spark):
    from natatio.llm import shared

    before = shared.written()
    assert cp.run(spark, DIR).count() > 0
    assert len(shared.last_written(before)) == 2  # the last stage's input and its files


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, "some words here", "en", "src0", 5), (2, "", "en", "src1", 0), (3, "same text twice " * 5, "en", "src1", 9), (3, "same text twice " * 5, "en", "src1", 9), (4, "!! 12", "de", "src2", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        for _, stage in cp.STAGES:
            table = cp.stored(stage(spark, table, DIR), "odd")
    assert table.count() == 0
