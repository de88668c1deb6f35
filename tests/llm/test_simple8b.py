import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from natatio.llm import simple8b
from natatio.llm.shared import shared_path

FILE = public_tokenizers.path("word_bpe_49k.json")


def coded(docs):
    sizes = [len(d) for d in docs]
    return simple8b.encode(np.array([x for d in docs for x in d], np.uint64), np.cumsum(sizes))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 50_000), st.integers(0, 2**64 - 1), st.just(2**64 - 1)), max_size=200), min_size=1, max_size=5))
def test_round_trip(docs):
    words, ends, offsets = coded(docs)
    begins = [0, *ends[:-1]]
    assert [simple8b.decode(words[a:b]).tolist() for a, b in zip(begins, ends)] == docs
    assert all(len(o) == -(-len(d) // simple8b.BLOCK) for o, d in zip(offsets, docs))


def test_blocks_stand_alone():
    ids = np.random.default_rng(1).choice([0, 1, 7, 300, 49_000, 2**61], 3 * simple8b.BLOCK + 17)
    words, ends, offsets = simple8b.encode(ids, np.array([5, len(ids)]))
    own = words[ends[0] :]
    for k in range(len(offsets[1])):
        assert np.array_equal(simple8b.decode_block(own, offsets[1], k), ids[5:][k * simple8b.BLOCK : (k + 1) * simple8b.BLOCK])


def test_packs_small_ids_densely():
    assert len(coded([[1] * 600])[0]) == 10
    assert len(coded([[2**61, 0]])[0]) == 3


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \t\n'sreS1é́ \u0085\x1c<|endoftext|>")), max_size=60))
def test_words_give_the_ids_of_whole_texts(text):
    ids = np.frombuffer(words_to_ids([text.encode()], b"")[0], "<u4").tolist()
    assert ids == whole.encode(text, add_special_tokens=False).ids


whole = Tokenizer.from_file(FILE)
with open(FILE, encoding="utf-8") as file:
    words_to_ids = simple8b.WordIds(file.read())


@pytest.mark.parametrize("rows", [[], [(5, "the cat sat"), (None, "no id"), (2, None), (5, "the cat sat"), (9, ""), (1, "Wörter " * 40_000), (3, " \n "), (4, "<|endoftext|> x"), (6, "<|ENDOFTEXT|> X.Y Don't STOP!! it'S A...")]])
def test_files_read_back(spark, rows):
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, words string")
    path = shared_path(spark, "test-ids")
    simple8b.write_token_ids(docs, path, FILE)
    got = simple8b.token_digests(simple8b.read_token_ids(spark, path)).collect()
    want, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.text(st.one_of(st.characters(exclude_categories=["Cs"], max_codepoint=255), st.sampled_from(" '1.,asB€")), max_size=20), max_size=6), max_size=4))
def test_texts_coded_together_keep_their_ids(batches):
    """Texts side by side, in Latin-1 or not, also while words of late are forgotten: the ids of each text alone."""
    forgetful = simple8b.WordIds(whole.to_str())
    remember, simple8b.REMEMBER = simple8b.REMEMBER, 3
    try:
        for texts in batches:
            got = [np.frombuffer(x, "<u4").tolist() for x in forgetful([t.encode() for t in texts], b"\1\0\0\0")]
            assert got == [[*whole.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    finally:
        simple8b.REMEMBER = remember


def test_texts_are_cut_together(monkeypatch):
    """Cuts are sought once for all texts of a batch, not once for each."""
    calls, seek = [], np.flatnonzero
    monkeypatch.setattr(simple8b.np, "flatnonzero", lambda x: calls.append(1) or seek(x))
    words_to_ids([b"It's 12 o'clock, isn't it?"] * 500, b"")
    assert len(calls) <= 2


def test_ids_are_read_without_a_shuffle(spark):
    """However large the files are, only totals of shards are moved."""
    path = shared_path(spark, "test-ids")
    simple8b.write_token_ids(spark.createDataFrame([(1, "one"), (2, "two")], "doc_id long, text string"), path, FILE)
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = simple8b.read_token_ids(spark, path)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
