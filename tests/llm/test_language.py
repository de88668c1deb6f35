import zlib

import numpy as np
import pytest

from natatio.llm import language, linear

DOCS = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(DOCS)
    got = language.language_ids(docs).collect()
    assert len(got) == docs.count()
    held = [r for r in got if r.held_out and r.lang is not None]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in got)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    assert all(0 <= r.lang_score <= 1 for r in got)


def test_edges(spark):
    few = [(1, "the cat sat on the mat", "en"), (3, "der hund und die katze", "de"), (4, "le chat est noir", "fr"), (None, "el perro es de la casa", "es"), (5, None, "en"), (6, "", "de"), (7, "12 34 !!", "fr"), (8, "the " * 900_000, None), (9, "été", "fr"), (9, "été", "fr")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in few], "doc_id long, text string, lang string, lang_pred int, pick string")
    got = {(r.doc_id, r.text): r for r in language.language_ids(docs).collect()}
    assert {r.lang_pred for (i, t), r in got.items() if t in (None, "", "12 34 !!")} == {"und"}
    assert {r.lang_pred for (i, t), r in got.items() if t not in (None, "", "12 34 !!")} <= {"en", "de", "fr", "es"}
    assert language.language_ids(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in language.language_ids(docs.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()} == {"und"}
    only = language.language_ids(docs.where("lang = 'de' or lang is null"))
    assert {r.lang_pred for r in only.collect()} == {"de", "und"}


def test_chunks_do_not_change_counts(monkeypatch):
    data = bytes(np.random.default_rng(0).integers(32, 255, 1000, dtype=np.uint8))
    whole = linear.ngram_counts(data)
    monkeypatch.setattr(linear, "CHUNK", 64)
    assert np.array_equal(linear.ngram_counts(data), whole) and whole.sum() == 1000 + 999 + 998


@pytest.mark.parametrize("n", [2, 60])
def test_svm_separates(n):
    rng = np.random.default_rng(1)
    y = np.where(np.arange(n) % 2, 1, -1)
    x = (rng.normal(size=(n, 20)) * 0.3 + y[:, None]).astype(np.float32)
    w = linear.train_svm(x, y)
    assert np.array_equal(np.sign(x @ w[:-1] + w[-1]), y)


def test_decision_in_two_steps():
    """Against plain loops: the family with the greatest margin, then the language with the most won duels in it."""
    rng = np.random.default_rng(7)
    languages = ["de", "en", "nl", "fr", "es", "fi"]
    families = {"germanic": ["de", "en", "nl"], "romance": ["es", "fr"], "uralic": ["fi"]}
    pairs = [(a, b) for own in families.values() for a in own for b in own if a < b]
    weights = {task: rng.normal(size=9).astype(np.float32) for task in [*(("family", f) for f in families), *pairs]}
    x = rng.normal(size=(300, 8)).astype(np.float32)
    got, scores = language.Judge(languages, weights)(x)
    margin = lambda row, task: float(row @ weights[task][:-1] + weights[task][-1])
    for row, lang, score in zip(x, got, scores):
        family = max(families, key=lambda f: margin(row, ("family", f)))
        won = {a: sum(margin(row, (a, b)) > 0 if a < b else margin(row, (b, a)) <= 0 for b in families[family] if b != a) for a in families[family]}
        assert lang in [a for a in won if won[a] == max(won.values())]
        assert 0 <= score <= 1


def test_repeats_are_folded_before_the_draw(spark):
    """A common language whose rows repeat a few texts still has examples."""
    few = spark.createDataFrame([("en", "the cat sat on the mat"), ("de", "der hund und die katze"), ("de", "das ist ein kleines haus")], "lang string, text string")
    docs = spark.range(40_000).withColumnRenamed("id", "doc_id").join(few.withColumn("k", few.lang != "de"), (language.F.col("doc_id") % 7 == 0) == language.F.col("k"))
    got = language.language_ids(docs)
    wrong = got.where("lang <> lang_pred").count()
    assert wrong == 0 and got.count() == docs.count()


def test_languages_without_letters_are_not_learned(spark):
    rows = [(i, t, g) for i, (t, g) in enumerate([("12 34", "de"), ("!!", "en"), ("", "nl"), ("le chat est noir", "fr"), ("el perro es de la casa", "es"), ("一二三", "zh")] * 8)]
    got = language.language_ids(spark.createDataFrame([*rows, (1000, "the cat", "sv?")], "doc_id long, text string, lang string")).collect()
    assert {r.lang_pred for r in got} <= {"und", "fr", "es", "zh", "sv?"}
    assert {r.lang_pred for r in got if r.text in ("12 34", "!!", "")} == {"und"}
    assert all(r.lang_pred == r.lang for r in got if r.lang in ("fr", "es", "zh"))


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 2)
    docs = spark.createDataFrame([(i, f"text {i}", f"l{i}") for i in range(12)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        language.language_ids(docs)
