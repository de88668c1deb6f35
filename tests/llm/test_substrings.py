import hashlib
import re

import numpy as np

from natatio.llm.substrings import kept_digests


def slow(rows, length=50):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        for s in range(len(w) - length + 1):
            if i is not None:
                key = tuple(w[s : s + length])
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for s in range(len(w) - length + 1):
            if i is not None and first[tuple(w[s : s + length])] < i:
                gone.update(range(s, s + length))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows):
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, anchor int")
    assert sorted(map(tuple, kept_digests(frame).collect()), key=str) == slow(rows)


def test_matches_brute_force(spark):
    rng = np.random.default_rng(11)
    pool = ["the", "of", "ndea", "Wh.", "é", "*"] + [f"w{k}" for k in range(40)]
    free = lambda n: list(rng.choice(pool, n))
    passages = [free(int(n)) for n in rng.integers(45, 140, 6)]
    rows = []
    for i in rng.permutation(60).tolist():
        text = free(int(rng.integers(0, 90)))
        for p in rng.choice(6, int(rng.integers(0, 4))):
            a = int(rng.integers(0, 20))
            text += passages[p][a : len(passages[p]) - int(rng.integers(0, 20))] + free(int(rng.integers(0, 30)))
        rows.append((i, " ".join(text)))
    rows += [(100 + k, rows[k][1]) for k in range(5)] + [(3000, " ".join(["same"] * 300)), (2000, " ".join(["same"] * 120)), (2001, " ".join(["same"] * 49))]
    check(spark, rows)


def test_edges(spark):
    long = " ".join(f"x{k}" for k in range(60_000))
    body = " ".join(f"y{k}" for k in range(70))
    check(spark, [(1, None), (2, ""), (3, " \t"), (None, body), (4, body), (4, body), (5, body + " z"), (6, long), (7, "a " + long), (4, "other " + body), (9, body.replace(" ", "\n\x0b"))])
    check(spark, [])
