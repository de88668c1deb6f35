import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from natatio.llm import katz

END = object()


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), END]


def slow(rows):
    """A plain Katz model on dictionaries, with its sums checked."""
    train = [tokens(t) for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 5 != 1]
    uni, bi = Counter(w for t in train for w in t), Counter(p for t in train for p in zip([None, *t], t))
    n, v = sum(uni.values()), len(uni)
    by = lambda c: [0, *(sum(x == r for x in c.values()) for r in range(1, 7))]
    d1, d2 = katz.discounts(by(uni)), katz.discounts(by(bi))
    cut = lambda d, c: c * (d[c] if c <= 5 else 1)
    p1 = {w: cut(d1, c) / n for w, c in uni.items()}
    left = 1 - sum(p1.values())
    if left < 1e-12:
        left, p1 = 1 / (n + 1), {w: p * n / (n + 1) for w, p in p1.items()}
    after = defaultdict(dict)
    for (h, w), c in bi.items():
        after[h][w] = c
    cond, alpha = {}, {}
    for h, cs in after.items():
        total = sum(cs.values()) + all(c > 5 for c in cs.values())
        cond[h] = {w: cut(d2, c) / total for w, c in cs.items()}
        alpha[h] = (1 - sum(cond[h].values())) / (1 - sum(p1[w] for w in cs))
        assert math.isclose(1, sum(cond[h].values()) + alpha[h] * (left + sum(p for w, p in p1.items() if w not in cs)))
    out = []
    for i, t in rows:
        w = tokens(t)
        base = sum(math.log10((uni[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        score = sum(math.log10(cond[h][x] if x in cond.get(h, ()) else alpha.get(h, 1) * p1.get(x, left)) for h, x in zip([None, *w], w))
        out.append((i, i is not None and zlib.crc32(str(i).encode()) % 5 == 1, len(w), sum(uni[x] > 0 for x in w), n, base, score))
    return out


def check(spark, rows):
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, held_out string")
    key = lambda r: (str(r[0]), r[2], r[5])
    for got, want in zip(sorted(map(tuple, katz.katz_scores(frame).collect()), key=key), sorted(slow(rows), key=key), strict=True):
        assert got[:5] == want[:5] and got[5] == pytest.approx(want[5], rel=1e-9) and got[6] == pytest.approx(want[6], rel=1e-9)


@pytest.fixture
def few_common(monkeypatch):
    """Most words rare and several packs, so that every route is used."""
    monkeypatch.setattr(katz, "PACK_TOKENS", 700)


@pytest.mark.parametrize("common", [0, 6, 60, 10_000])
def test_matches_dictionaries(spark, few_common, monkeypatch, common):
    rng = np.random.default_rng(2)
    words = [f"W{k}" for k in range(300)] + ["é", "."]
    p = 1 / np.arange(1, len(words) + 1)
    rows = [(i, " ".join(rng.choice(words, int(rng.integers(0, 60)), p=p / p.sum()))) for i in range(120)]
    rows += [(200, None), (201, ""), (None, "no id w1"), (202, "rep " * 40), (203, "rep " * 9), (203, "rep " * 9), (210, "always next " * 30), (211, "always else")]
    monkeypatch.setattr(katz, "_NAMED_LIMIT", common)
    check(spark, rows)


def test_edges(spark):
    check(spark, [])
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    check(spark, [(held, "only held out")])
    check(spark, [(held, "x"), (held + 1, "long " * 200_000 + "tail")])
