import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from natatio.llm import pieces, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = SentencePieceProcessor(model_file=MODEL)
with open(MODEL, "rb") as file:
    OWN = pieces.Pieces(file.read(), check=1)
ODD = ["a", "th", "e", " ", "   ", "\n", "\t", "\r\n", "▁", "æ", "é", "中文", "の", "👍🏽", "́", "\x00", "\x85", " ", "<s>", "</s>", "<unk>", "<0x0A>", "0", "12", ".", ", ", "ing", " the", "�", "　", "zzzzzzz"]


def ids_of(texts):
    return [np.frombuffer(x, "<i4").tolist() for x in OWN.encode(texts)]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=4)), max_size=14).map("".join))
def test_ids_and_texts_are_the_librarys(text):
    ids = ids_of([text])[0]
    assert ids == LIBRARY.encode(text)
    assert OWN.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2), st.integers(3, 258), st.sampled_from([259, 29871]), st.integers(259, 31999)), max_size=9))
def test_any_ids_decode_as_the_library_does(ids):
    assert OWN.decode(ids) == LIBRARY.decode(ids)


@pytest.mark.parametrize("stretch", ["ab" * 4000, "thethe" * 30 + "ing" * 200, "中" * 500, "a" * 1000, "▁interestingly", "naïveté", "x中y"])
def test_heap_and_table_agree(stretch, monkeypatch):
    heap = np.frombuffer(OWN._by_heap(stretch), "<i4").tolist()
    assert heap == LIBRARY.encode("\n" + stretch.replace("▁", " "))[2:]
    monkeypatch.setattr(pieces, "SHORT", 1 << 30)
    OWN.known.clear()
    OWN._learn({stretch})
    assert np.frombuffer(OWN.known[stretch], "<i4").tolist() == heap


def test_full_tables_make_room(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBER", 3)
    texts = [f"word{n} other{n % 3} same\nline" for n in range(40)]
    for text in texts + texts:
        assert ids_of([text])[0] == LIBRARY.encode(text)


def test_a_difference_to_the_library_is_an_error(monkeypatch):
    with open(MODEL, "rb") as file:
        own = pieces.Pieces(file.read(), check=1)
    own.pair_ranks[:] = own.pair_ranks[::-1]
    with pytest.raises(AssertionError):
        own.encode(["interestingly, words that were never seen before"])


def test_frames(spark, monkeypatch):
    monkeypatch.setattr(pieces, "AT_ONCE", 64)
    rows = [(1, "A line.\nAnother  one"), (2, None), (3, ""), (3, ""), (None, "no id"), (4, "repeated"), (4, "repeated"), (5, "x" * 5000 + " y" * 3000), (6, "▁ \x00"), (7, "   ")]
    frame = spark.createDataFrame([(*r, "clash", "a") for r in rows], "doc_id long, text string, ids string, `a.b` string")
    coded = pieces.encode_pieces(frame, MODEL)
    got = pieces.decode_pieces(coded, MODEL).collect()
    want = [(i, LIBRARY.encode(t or ""), LIBRARY.decode(LIBRARY.encode(t or ""))) for i, t in rows]
    assert sorted((r.doc_id, r.ids, r.decoded) for r in got if r.doc_id) == sorted(w for w in want if w[0])
    assert [(r.ids, r.decoded) for r in got if r.doc_id is None] == [w[1:] for w in want if w[0] is None]
    both = pieces.encode_pieces(frame, MODEL, decode=True)
    assert sorted(map(tuple, both.collect()), key=str) == sorted(map(tuple, got), key=str)
    assert pieces.decode_pieces(pieces.encode_pieces(frame.limit(0), MODEL), MODEL).count() == 0
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.decoded for r in pieces.decode_pieces(none, MODEL).orderBy("doc_id").collect()] == [None, ""]
    names = spark.createDataFrame([("k", "text")], "name string, body string")
    assert pieces.encode_pieces(names, MODEL, "name", "body").first().doc_id == "k"


def test_query(spark):
    at = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_sentence_pieces(spark, at).collect()}
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    docs = spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(got)
    for doc_id, text in docs:
        ids = LIBRARY.encode(text or "")
        assert got[doc_id] == (len(ids), digest(",".join(map(str, ids))), digest(LIBRARY.decode(ids)))
