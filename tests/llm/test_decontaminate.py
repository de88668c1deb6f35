import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from natatio.llm import decontaminate as dc


def slow_align(a, b):
    """Score of the best local alignment, and no more."""
    best, table = 0, np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i, j] = max(0, table[i - 1, j - 1] + (dc.MATCH if x == y else dc.UNLIKE), table[i - 1, j] + dc.GAP, table[i, j - 1] + dc.GAP)
            best = max(best, table[i, j])
    return best


def test_alignment_matches_plain_table():
    rng = np.random.default_rng(8)
    items = [rng.integers(0, 6, int(rng.integers(1, 14))) for _ in range(80)]
    texts = [rng.integers(0, 6, int(rng.integers(0, 30))) for _ in range(80)]
    for (score, first, end), a, b in zip(dc.align(items, texts).tolist(), items, texts):
        assert score == slow_align(a, b)
        if score:
            assert slow_align(a, b[first:end]) == score


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def score(a, w):
    """Of whole texts; very long ones by the vectorised tables, which are held against plain ones above."""
    if len(w) < 2000:
        return slow_align(a, w)
    ids = {x: n for n, x in enumerate(dict.fromkeys([*a, *w]))}
    return int(dc.align([np.array([ids[x] for x in a])], [np.array([ids[x] for x in w])])[0, 0])


@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_finds_copies_and_edits(spark, monkeypatch, sent):
    monkeypatch.setattr(dc, "SENT", sent)
    r = random.Random(6)
    vocabulary = ["".join(r.choices("abcdefgh", k=r.randint(2, 5))) for _ in range(400)]
    text = lambda n: [r.choice(vocabulary) for _ in range(n)]
    items = [text(r.randint(18, 40)) for _ in range(6)]
    rows = []
    for i in range(60):
        body = text(r.randint(0, 120))
        if i % 3 == 0:
            item = list(items[i % 6])
            for _ in range(i % 5):
                item[r.randrange(len(item))] = "EDIT"
            at = r.randint(0, len(body))
            body[at:at] = item
        elif i % 3 == 1:
            body += items[i % 6][:6]
        rows.append((i, " ".join(body)))
    rows += [(70, None), (71, ""), (72, " ".join(items[0]).upper()), (72, " ".join(items[0]).upper()), (None, " ".join(items[1])), (73, "word " * 200_000 + " ".join(items[2]))]
    bench = [(k, " ".join(v)) for k, v in enumerate(items)] + [(90, None), (91, ""), (92, "two words")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    items_frame = spark.createDataFrame([(*b, "x") for b in bench], "item_id long, text string, seed string")
    got = sorted({(r.doc_id, r.item_id, round(r.score, 9)) for r in dc.find_leaks(docs, items_frame).collect()}, key=str)
    want = []
    for i, t in rows:
        for k, b in bench:
            a, w = words(b), words(t)
            if a and (share := score(a, w) / (dc.MATCH * len(a))) >= dc.THRESHOLD:
                if len(a) > 3 or "two words" in " ".join(w):
                    want.append((i, k, round(share, 9)))
    assert got == sorted(set(want), key=str)
    kept = dc.drop_leaks(docs, items_frame)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {i for i, _, _ in want}


def test_edges(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.find_leaks(docs, none).count() == 0
    assert dc.find_leaks(docs.where(F.lit(False)), spark.createDataFrame([(1, "a b c")], "item_id long, text string")).count() == 0


def test_dots_in_names(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g", 5), (2, "other words are here", 6)], "doc_id long, text string, `x.y` int")
    items = spark.createDataFrame([(1, "a b c d e f g", 0)], "item_id long, text string, `x.y` int")
    assert [tuple(r) for r in dc.drop_leaks(docs, items).collect()] == [(2, "other words are here", 6)]


def edited(item, how, rate, r):
    """A copy of an item: every third word changed, or words changed, put in or left out at a rate."""
    if how == "third":
        return [f"edit{r.randrange(10**6)}" if n % 3 == 2 else x for n, x in enumerate(item)]
    out = []
    for x in item:
        if r.random() < rate:
            kind = how if how != "mixed" else r.choice(["change", "insert", "delete"])
            out += [f"edit{r.randrange(10**6)}"] * (kind != "delete") + [x] * (kind == "insert")
        else:
            out.append(x)
    return out


def test_recall_on_edited_copies(spark):
    """Against Smith-Waterman on all pairs: of copies that keep the threshold, nine in ten or more are found, at each rate of edits."""
    r = random.Random(9)
    bench = [(x.item_id, x.text) for x in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect() if len(words(x.text)) >= 12][:120]
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    filler = [w for x in given.limit(200).collect() for w in words(x.text)][:20_000]
    kinds = [("third", 0), ("change", 0.1), ("change", 0.2), ("change", 0.33), ("insert", 0.3), ("insert", 0.6), ("delete", 0.3), ("mixed", 0.2), ("mixed", 0.4)]
    rows, want = [], {}
    for k, (how, rate) in enumerate(kinds):
        for n, (item_id, text) in enumerate(bench):
            copy, at = edited(words(text), how, rate, r), r.randrange(len(filler) - 200)
            body = filler[at : at + r.randrange(60)] + copy + filler[at + 100 : at + 100 + r.randrange(60)]
            doc_id = 10**6 + k * 1000 + n
            rows.append((doc_id, " ".join(body)))
            if slow_align(words(text), body) >= dc.THRESHOLD * dc.MATCH * len(words(text)):
                want.setdefault((how, rate), set()).add((doc_id, item_id))
    docs = given.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {(x.doc_id, x.item_id) for x in dc.find_leaks(docs, spark.createDataFrame(bench, "item_id long, text string")).collect()}
    recall = {k: len(found & v) / len(v) for k, v in want.items()}
    print(recall, {k: len(v) for k, v in want.items()})
    assert len(recall) >= 6 and all(v >= 0.9 for v in recall.values())


@pytest.mark.parametrize("whole, at_once", [(0, 1 << 22), (1 << 20, 1 << 22), (1 << 20, 8)])
def test_large_and_small_benchmarks_judge_alike(spark, monkeypatch, whole, at_once):
    """Items of one word, of the same words under two ids and without an id, repeated rows: as all pairs, judged in one pass or after a shuffle."""
    monkeypatch.setattr(dc, "WHOLE", whole)
    monkeypatch.setattr(dc, "SORTED", at_once)
    r = random.Random(3)
    vocabulary = ["".join(r.choices("abcdefgh", k=r.randint(2, 5))) for _ in range(300)]
    items = [[r.choice(vocabulary) for _ in range(20)] for _ in range(4)]
    rows = [(i, " ".join([*(r.choice(vocabulary) for _ in range(r.randint(0, 60))), *items[i % 4][i % 9 :], "tail"])) for i in range(40)]
    rows += [(40, "a lone marker here"), (41, " ".join(items[0] + items[1] * 3)), (41, " ".join(items[0] + items[1] * 3)), (42, "marker")]
    bench = [(k, " ".join(v)) for k, v in enumerate(items)] + [(7, " ".join(items[1])), (None, " ".join(items[2])), (8, "marker"), (1, " ".join(items[1]))]
    found = dc.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()
    got = sorted(((x.doc_id, x.item_id, round(x.score, 9)) for x in found), key=str)
    want = [(i, k, round(share, 9)) for i, t in rows for k, b in dict.fromkeys(bench) if (share := score(words(b), words(t)) / (dc.MATCH * len(words(b)))) >= dc.THRESHOLD]
    assert got == sorted(want, key=str)
    texts = dict(rows)
    assert all(x.score == slow_align(words(dict(bench)[x.item_id]), words(texts[x.doc_id])[x.first_word : x.end_word]) / (dc.MATCH * len(words(dict(bench)[x.item_id]))) for x in found)


def test_a_small_benchmark_moves_no_texts(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    plan = dc.find_leaks(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
