import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from natatio.llm import codebooks, queries

AT = "/root/testdata/sf0.01"


def slow(rows, parts, entries, rounds, scale):
    """``{(id, vector): (codes, error)}``, label sums and codebooks, by plain loops."""
    kept = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    own = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * own : (p + 1) * own]
    first = [v for _, v in sorted((i, v) for i, v, _ in kept if i is not None)][:entries]
    books = [[cut(v, p) for v in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda x, p: min((far(x, e), n) for n, e in enumerate(books[p]))
    for _ in range(rounds):
        after = [list(b) for b in books]
        for p in range(parts):
            members = {}
            for _, v, _ in kept:
                members.setdefault(nearest(cut(v, p), p)[1], []).append(cut(v, p))
            for n, m in members.items():
                after[p][n] = [sum(c) // len(m) for c in zip(*m)]
        books = after
    out, sums = [], {}
    for i, v, lab in kept:
        found = [nearest(cut(v, p), p) for p in range(parts)]
        error = sum(d for d, _ in found)
        sums[lab] = sums.get(lab, 0) + error
        out.append((i, lab, [n for _, n in found], error))
    return sorted(((i, lab, c, e, sums[lab]) for i, lab, c, e in out), key=str), books


def test_neighbours_on_the_curve_are_neighbours_in_space():
    for n, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack([x.ravel() for x in np.meshgrid(*[np.arange(1 << bits)] * n)], 1)
        keys = codebooks.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(1 << (n * bits)))
        along = cells[np.argsort(keys)]
        assert (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("spread", [1, 5, 1000, 1 << 27])
def test_shortlists_hold_every_nearest_entry(spread):
    rng = np.random.default_rng(spread)
    for _ in range(40):
        points, entries = rng.integers(-spread, spread + 1, (30, 3)) + rng.integers(-spread, spread + 1, 3), rng.integers(-2 * spread, 2 * spread + 1, (12, 3))
        apart = ((points[:, None, :] - entries[None]) ** 2).sum(2)
        some = codebooks.shortlist(points.min(0), points.max(0), entries)
        best, distance = codebooks.nearest(points, entries[some])
        assert some[best].tolist() == apart.argmin(1).tolist() and distance.tolist() == apart.min(1).tolist()


@pytest.mark.parametrize("entries,block", [(3, 2), (4, 128), (40, 5)])
def test_against_plain_loops(spark, monkeypatch, entries, block):
    monkeypatch.setattr(codebooks, "BLOCK", block)
    rng = np.random.default_rng(entries)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(size=4) * rng.choice([0.1, 1])], int(rng.integers(3)) if i % 5 else None) for i in rng.permutation(30)]
    rows += [(100 + i, [0.5, 0.5, -0.25, 0.0], 1) for i in range(40)]  # a group of copies
    rows += [(3, None, 1), (4, [], 1), (5, [1.0, None, 0.0, 0.0], 1), (6, [float("nan"), 1.0, 1.0, 1.0], 2), (7, [float("inf"), 1.0, 1.0, 1.0], None)]
    rows += [(None, [0.1, 0.2, 0.3, 0.4], None), (8, [0.5, 0.5, -0.25, 0.0], 1), (8, [0.5, 0.5, -0.25, 0.0], 1)]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<float>, label int, code string, `a.b` int").repartition(5)
    coded, books = codebooks.compress_vectors(frame, 2, entries, 3, 64)
    want, learned = slow([(i, v and [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows], 2, entries, 3, 64)
    assert sorted(map(tuple, coded.collect()), key=str) == want
    assert books.entries.tolist() == learned
    assert books.digest() == hashlib.sha256(",".join(str(x) for b in learned for e in b for x in e).encode()).hexdigest()


def test_edges(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    coded, books = codebooks.compress_vectors(empty)
    assert coded.count() == 0 and coded.columns == ["vec_id", "label", "codes", "error", "label_error"]
    assert books.digest() == hashlib.sha256(b"").hexdigest()
    one = spark.createDataFrame([(1, [0.1] * 8, "x"), (2, [0.2] * 4, "x")], "vec_id long, embedding array<double>, label string")
    coded, _ = codebooks.compress_vectors(one.union(one.where("vec_id = 1")))
    assert [(r.vec_id, r.codes, r.error, r.label_error) for r in coded.collect()] == [(1, [0] * 4, 0, 0)] * 2  # the commonest length alone
    with pytest.raises(ValueError, match="equal parts"):
        codebooks.compress_vectors(one.select("vec_id", F.slice("embedding", 1, 3).alias("embedding"), "label"))
    with pytest.raises(ValueError, match="64 bits"):
        codebooks.compress_vectors(spark.createDataFrame([(1, [1e9, 1.0, 1.0, 1.0], 1)], "vec_id long, embedding array<double>, label int"))
    assert one.select(codebooks.hex_codes(F.array(F.lit(0), F.lit(10), F.lit(255)))).first()[0] == "000aff"


def test_oracle_agrees(spark):
    db = duckdb.connect()
    db.execute(f"create view embeddings as select * from '{AT}/embeddings.parquet'")
    want = db.execute(codebooks.compress_sql()).fetchall()
    assert sorted(map(tuple, queries.op12_vector_codes(spark, AT).collect())) == sorted(want) and want
