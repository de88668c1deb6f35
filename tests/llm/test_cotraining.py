import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from natatio.llm import cotraining

DIR = "/root/testdata/sf0.1"


def test_held_out_labels_and_rounds(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    got = {r.doc_id: r for r in cotraining.quality_scores(docs, labels.where("doc_id % 2 = 0")).collect()}
    assert len(got) == docs.count()
    held = labels.where("doc_id % 2 = 1").collect()
    good = np.array([r.quality == 1 and r.toxic == 0 for r in held])
    keep = np.array([got[r.doc_id].keep for r in held])
    assert keep[good].mean() > 0.95
    assert 1 - keep[~good].mean() > 0.8
    assert all(0 <= r.score <= 1 and 0 <= r.p_text <= 1 and 0 <= r.p_meta <= 1 for r in got.values())


def test_edges(spark):
    rows = [(i, t, "en", f"s{i % 3}", 1.0) for i, t in enumerate(["clean words here"] * 20 + ["BAD!! BAD!!"] * 20)]
    rows += [(50, None, None, None, 0.0), (51, "", "en", "s1", 0.0), (None, "clean words", "en", "s1", 0.0), (52, "x " * 400_000, "en", "s1", 0.0), (3, "clean words here", "en", "s0", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double")
    labels = spark.createDataFrame([(i, int(i < 20), 0) for i in range(0, 40, 2)] + [(0, 1, None), (2, None, None), (None, 0, 0), (900, 1, 0)], "doc_id long, quality int, toxic int")
    got = cotraining.quality_scores(docs, labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].score > by[j].score for i in range(20) for j in range(20, 40) if i != 3)
    assert all(0 <= r.score <= 1 for r in got)
    assert cotraining.quality_scores(docs.limit(0), labels).count() == 0
    assert {r.score for r in cotraining.quality_scores(docs, labels.limit(0)).collect()} == {0.5}


def slow(spark, rows, labels, rounds):
    """The same learning with plain loops: features, counts of examples, exchange of sure labels, scores."""
    ct, ids = cotraining, [r[0] for r in rows]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    bins = [F.pmod(F.xxhash64(F.coalesce(F.col(c), F.lit(""))), F.lit(ct.BINS)) for c in ("lang", "source")]
    known = {r.doc_id: r for r in frame.select("doc_id", (F.pmod(F.pmod(F.xxhash64("doc_id"), F.lit(1009)), F.lit(ct.CALIBRATING)) == 0).alias("aside"), bins[0].alias("a"), bins[1].alias("b")).collect()}
    told = {}
    for i, quality, toxic in labels:
        told.setdefault(i, []).append((quality, toxic))
    label = {i: ct.TOXIC if max(t for _, t in v) == 1 else ct.JUNK if min(q for q, _ in v) == 0 else ct.GOOD for i, v in told.items() if i in known}
    words, pages = {}, {}
    for i, text, _, _ in rows:
        every = text.lower().encode().split()
        words[i] = {x for w in every for x in (w, b"< " + w[:5], b"> " + w[-3:])}
        pages[i] = [n * ct.BINS + v for n, v in enumerate([known[i].a, known[i].b, *ct.layout(text.encode(), len(every), len(set(every)))])]
    fit, aside = [i for i in label if not known[i].aside], sorted(i for i in label if known[i].aside)
    seen = {}
    for i in fit:
        for w in words[i]:
            seen[w] = seen.get(w, 0) + 1
    place = {w: n for n, w in enumerate(sorted(w for w in seen if seen[w] >= ct.LEAST))}
    features = {"content": {i: [place[w] for w in words[i] if w in place] for i in ids}, "page": pages}
    sizes = {"content": max(1, len(place)), "page": (2 + ct.LAYOUT) * ct.BINS}

    def table(view, given):
        counts, n = np.zeros((3, sizes[view])), np.zeros(3)
        for i, k in given.items():
            n[k] += 1
            for f in features[view][i]:
                counts[k, f] += 1
        return counts, n

    def look(view, name, i):
        s = view.prior + sum((view.table[:, f] for f in features[name][i]), np.zeros(3))
        return s[ct.GOOD] - np.logaddexp(s[ct.JUNK], s[ct.TOXIC]), ct.JUNK if s[ct.JUNK] >= s[ct.TOXIC] else ct.TOXIC

    def calibrate(views):
        good = np.array([label[i] == ct.GOOD for i in aside], float)
        for name, view in views.items():
            view.calibrate(np.array([look(view, name, i)[0] for i in aside]), good)
        return good

    given = {v: table(v, {i: label[i] for i in fit}) for v in sizes}
    views = {v: ct.View(*given[v]) for v in sizes}
    good, limit = calibrate(views), np.log(ct.SURE / (1 - ct.SURE))
    for _ in range(rounds):
        handed = {}
        for v, other in (("content", "page"), ("page", "content")):
            handed[v] = {}
            for i in ids:
                if i not in label:
                    raw, worse = look(views[other], other, i)
                    odds = float(views[other].calibrated(np.array(raw)))
                    if abs(odds) >= limit:
                        handed[v][i] = ct.GOOD if odds > 0 else worse
        views = {v: ct.View(*(g + ct.WEIGHT * p for g, p in zip(given[v], table(v, handed[v])))) for v in sizes}
        good = calibrate(views)
    odds = lambda i: np.array([float(views[v].calibrated(np.array(look(views[v], v, i)[0]))) for v in sizes])
    weights = ct.logistic(np.stack([odds(i) for i in aside]), good)
    p = lambda x: 1 / (1 + np.exp(-x))
    return {i: (*p(odds(i)), p(odds(i) @ weights[:-1] + weights[-1])) for i in ids}


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_matches_plain_loops(spark, rounds):
    r = random.Random(rounds)
    clean, junk, toxic = ([f"{k}{n}" for n in range(12)] for k in ("calm", "BUY", "vile"))
    rows, labels = [], []
    for i in range(260):
        kind = r.choice([0, 0, 1, 2])
        own, other = (clean, junk, toxic)[kind], r.choice([clean, junk, toxic])
        text = " ".join(r.choice(own if r.random() < 0.8 else other) for _ in range(r.randint(3, 25))) + ("\n!!! 99" * 3 if kind == 1 else "")
        rows.append((i, text, r.choice(["en", "de"]), f"src{kind if r.random() < 0.7 else 9}"))
        if i % 2:
            labels.append((i, int(kind != 1), int(kind == 2)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = cotraining.quality_scores(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rounds=rounds).collect()
    want = slow(spark, rows, labels, rounds)
    assert len(got) == len(want)
    for x in got:
        assert (x.p_text, x.p_meta, x.score) == pytest.approx(want[x.doc_id], rel=1e-6, abs=1e-9)
