import math
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from natatio.llm import maxscore

PATH = "/root/testdata/sf0.01/embeddings.parquet"


def slow(rows, asked, k):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in {(q, tuple(v)) for q, v in whole}:
        if asked(q):
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_shard_is_exact(spread):
    rng = np.random.default_rng(4)
    rows = np.floor(256 * spread * rng.normal(size=(400, 12)) * rng.choice([0.05, 1, 3], 12)).astype(np.int64)
    rows[50:60] = rows[49]
    shard = maxscore.Shard(rng.permutation(400), rows)
    at = {int(i): r for i, r in zip(shard.ids, shard.rows)}
    for q in range(0, 400, 7):
        ids, scores = shard.search(q, at[q], 5)
        want = sorted((-int(at[q] @ w), i) for i, w in at.items() if i != q)[:5]
        assert [(-s, i) for i, s in zip(ids.tolist(), scores.tolist())] == want


@settings(max_examples=3000, deadline=None)
@given(st.integers(1, 4), st.integers(1, 12), st.data())
def test_small_whole_numbers_are_exact(dims, n, data):
    """Few dimensions and few values: many ties, many rows that gain exactly what is needed."""
    value = st.integers(-60, 60) if data.draw(st.booleans()) else st.integers(-3, 3)
    rows = np.array(data.draw(st.lists(st.lists(value, min_size=dims, max_size=dims), min_size=n, max_size=n)), np.int64)
    query, k = np.array(data.draw(st.lists(value, min_size=dims, max_size=dims)), np.int64), data.draw(st.integers(1, 5))
    own = data.draw(st.integers(-1, n))
    want = sorted((-int(query @ w), i) for i, w in enumerate(rows) if i != own)[:k]
    for floor in (maxscore.NONE, *([-want[-1][0]] if len(want) == k else [])):
        ids, scores = maxscore.Shard(np.arange(n), rows).search(own, query, k, floor)
        assert [(-s, i) for i, s in zip(ids.tolist(), scores.tolist())] == want


def test_a_row_that_gains_exactly_enough(spark):
    values = [43, 56, 43, 35, 5, 28, 43, 37, -2, 12, 8, 35, 13, 13]
    frame = spark.createDataFrame([(i, [x / 256]) for i, x in enumerate(values)], "vec_id long, embedding array<double>")
    got = maxscore.top_inner_products(frame, F.col("vec_id") == 0, 5).collect()
    assert sorted(map(tuple, got)) == slow([(i, [x / 256]) for i, x in enumerate(values)], lambda i: i == 0, 5)


def test_numbers_of_any_width():
    for width in (1, 2, 4, 8):
        values = np.array([[np.iinfo(f"i{width}").min, 0], [1, np.iinfo(f"i{width}").max]])
        assert maxscore.packed(values)[0] == width and np.array_equal(maxscore.unpacked(maxscore.packed(values), 2), values)
    assert maxscore.unpacked(maxscore.packed(np.empty((3, 0), np.int64)), 3).shape == (3, 0)


def test_too_large_components_are_an_error(spark):
    frame = spark.createDataFrame([(0, [1e9, 1.0]), (1, [1e300, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        maxscore.top_inner_products(frame, F.col("vec_id") == 0).collect()


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD", 3)
    monkeypatch.setattr(maxscore, "BLOCK", 2)
    rows = [(0, [0.5, -0.1]), (1, [0.5, -0.1]), (2, None), (4, [float("nan"), 1.0]), (6, [None, 1.0]), (8, [float("inf"), 0.0]), (10, [0.0, 0.0]), (12, [1.0, 1.0, 1.0]), (14, [0.25, 2.0]), (16, []), (18, [-3.0, 0.2]), (19, [0.5, -0.1]), (None, [1.0, 1.0]), (20, [0.0, 0.0])]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, score string")
    asked = F.col("vec_id") % 2 == 0
    got = sorted(map(tuple, maxscore.top_inner_products(frame, asked, 3).collect()))
    single = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got == slow(single, lambda i: i % 2 == 0, 3)
    assert maxscore.top_inner_products(frame.limit(0), asked, 3).count() == 0
    rows = [(0, [1.0]), (0, [1.0]), (0, [-1.0]), *((i, [float(i)]) for i in range(1, 7))]
    again = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r.rank, r.vec_id) for r in maxscore.top_inner_products(again, F.col("vec_id") == 0, 5).orderBy("rank", "vec_id").collect()]
    assert got == sorted((n, i) for best in ((6, 5, 4, 3, 2), (1, 2, 3, 4, 5)) for n, i in enumerate(best, 1))
    db = duckdb.connect()
    db.execute("create table embeddings (vec_id bigint, embedding float[])")
    db.executemany("insert into embeddings values (?, ?)", rows)
    assert sorted((r[1], r[2]) for r in db.execute(maxscore.TOP_SQL).fetchall()) == got
    twice = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [(r.vec_id, r.rank) for r in maxscore.top_inner_products(twice, F.col("vec_id") == 0, 5).collect()] == [(1, 1), (1, 2)]


def test_oracle_agrees(spark):
    got = maxscore.top_inner_products(spark.read.parquet(PATH), F.col("vec_id") % 50 == 0)
    db = duckdb.connect()
    db.execute(f"create view embeddings as select * from '{PATH}'")
    assert sorted(map(tuple, got.collect())) == sorted(db.execute(maxscore.TOP_SQL).fetchall())
