import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from natatio.llm import negatives, queries

AT = "/root/testdata/sf0.01"


def slow(rows, asked, positives, low, high, k):
    """All scores, by plain loops."""
    whole = {(i, lab, tuple(math.floor(256 * x) for x in v)) for i, lab, v in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a, lab, v in whole:
        if asked(a):
            scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in whole if i != a and len(w) == len(v))
            for p, i, _ in [s for s in scored if s[2] == lab][:positives]:
                inside = [(-n, j) for n, j, other in scored if other != lab and low * -p <= 100 * -n <= high * -p][:k]
                out += [(a, i, rank, j, -p, n) for rank, (n, j) in enumerate(inside, 1)]
    return sorted(out)


@pytest.mark.parametrize("dims,spread", [(1, 3), (5, 2), (64, 60), (70, 1000)])
def test_bounds_hold(dims, spread):
    rng = np.random.default_rng(dims)
    rows = np.vstack([rng.integers(-spread, spread + 1, (300, dims)), np.zeros((1, dims), np.int64), np.full((2, dims), spread), np.eye(1, dims, dtype=np.int64) * spread]).astype(np.int64)
    shard = negatives.Shard(np.arange(len(rows)), np.zeros(len(rows)), rows, *negatives.codes(rows))
    for row in rows[::9].tolist() + rows[-4:].tolist():
        low, high = shard.bounds(negatives.Anchor(np.array(row)))
        scores = rows @ np.array(row)
        assert (low <= scores).all() and (scores <= high).all()
        assert (shard.scores(np.array(row), np.arange(len(rows))) == scores).all()


def test_bounds_leave_some_out():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 64))
    rows = np.floor(256 * (centres[rng.integers(30, size=3000)] + 0.1 * rng.normal(size=(3000, 64)))).astype(np.int64)
    shard, seen = negatives.Shard(np.arange(3000), np.zeros(3000), rows, *negatives.codes(rows)), []
    shard.scores = lambda row, of: seen.append(len(of)) or rows[of] @ row
    for row in rows[:20]:
        ((ids, scores),) = negatives.search(shard, row, negatives.Anchor(row), np.ones(3000, bool), [(negatives.NONE, -negatives.NONE)], 5, [negatives.NONE])
        every = rows @ row
        assert ids.tolist() == np.lexsort((np.arange(3000), -every))[:5].tolist() and scores.tolist() == every[ids].tolist()
    assert sum(seen) < 0.5 * 20 * 3000


@pytest.mark.parametrize("scale", [0.02, 0.3])
def test_against_plain_loops(spark, monkeypatch, scale):
    for name, value in (("SHARD", 7), ("BLOCK", 3), ("CELLS", 2), ("SIDE", 2)):
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(7)
    rows = [(i, int(rng.integers(3)), [float(np.float32(x)) for x in scale * rng.normal(size=3)]) for i in range(60)]
    rows += [(60 + i, i % 2, [0.25, 0.25, -0.5]) for i in range(20)]  # copies: ties go by id
    rows += [(80, None, [0.1, 0.1, 0.1]), (81, 1, None), (82, 1, [0.1, None, 0.2]), (83, 1, [float("nan"), 0.0, 0.0]), (84, 1, [float("-inf"), 0.0, 0.0]), (None, 1, [0.3, 0.3, 0.3])]
    rows += [(90, 1, [0.0, 0.0, 0.0]), (91, 1, [0.0, 0.0, 0.0]), (92, 2, [0.0, 0.0, 0.0]), (93, 2, [0.5]), (94, 2, [0.7]), (95, 1, [0.6]), (96, 1, []), (97, 2, [])]
    rows += [rows[0], rows[5], (3, 2, [0.4, 0.1, 0.0])]  # repeated rows, and another row of an id
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, label int, embedding array<float>, score string, `a.b` int").repartition(3)
    asked = F.col("vec_id") % 3 == 0
    want = slow(rows, lambda i: i % 3 == 0, 5, 50, 95, 3)
    assert sorted(map(tuple, negatives.hard_negatives(frame, asked).collect())) == want and len(want) > 100
    wide = slow(rows, lambda i: i % 3 == 0, 2, 0, 100, 4)
    assert sorted(map(tuple, negatives.hard_negatives(frame, asked, 2, 4, 0, 100).collect())) == wide


def test_edges(spark):
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert negatives.hard_negatives(empty, F.col("vec_id") == 0).count() == 0
    alone = spark.createDataFrame([(0, 1, [1.0])], "vec_id long, label int, embedding array<float>")
    assert negatives.hard_negatives(alone, F.col("vec_id") == 0).count() == 0
    assert negatives.hard_negatives(alone, F.col("vec_id") == 9).count() == 0
    with pytest.raises(Exception, match="64 bits"):
        negatives.hard_negatives(spark.createDataFrame([(0, 1, [1e9]), (1, 1, [1.0])], empty.schema), F.col("vec_id") == 0).collect()


def test_oracle_agrees(spark):
    db = duckdb.connect()
    db.execute(f"create view embeddings as select * from '{AT}/embeddings.parquet'")
    want = db.execute(negatives.NEGATIVES_SQL).fetchall()
    assert sorted(map(tuple, queries.op11_hard_negatives(spark, AT).collect())) == sorted(want) and want
