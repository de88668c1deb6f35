"""Exact top-k inner products by MaxScore over shards of vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natatio.llm.shared import settled

#: Vectors to a shard and queries to a block; tasks that the shards are dealt to, at most.
SHARD, BLOCK, TASKS = 4096, 256, 1 << 14
#: A score that any other one reaches.
NONE = -(1 << 62)


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of each component, as double; null if a component is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


class Shard:
    """Postings of one shard: for each term (dimension) its rows in order of value, with the bounds of its values."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.by_term = np.ascontiguousarray(self.rows.T)
        self.postings = np.argsort(self.by_term, axis=1, kind="stable")
        self.low, self.high = self.by_term.min(axis=1), self.by_term.max(axis=1)

    def search(self, own: int, query: np.ndarray, k: int, floor: int = NONE) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows whose id isn't ``own`` and whose score is ``floor`` at least; ties go to the smaller id.

        A term adds ``query * value``, between its worst and its best in this shard. Scores are counted from
        the worst: a term then adds 0 up to its bound. Terms are taken by falling bound. The last ones,
        whose bounds together give half of what a row must gain at most, are non-essential: a row
        must gain the rest from essential terms to compete. The postings of the essential terms are traversed from their
        best end down to where a row's gain no longer suffices; rows found are then probed term by
        term while what they have and may still gain reaches the threshold. All of this is in whole numbers.
        """
        ends = np.stack([query * self.low, query * self.high])
        base, bound = int(ends.min(axis=0).sum()), ends.max(axis=0) - ends.min(axis=0)
        least = np.minimum(*ends)
        terms = np.argsort(-bound, kind="stable")
        rest = np.append(np.cumsum(bound[terms][::-1])[::-1], 0)
        allowed = self.ids != own
        n = int(allowed.sum())
        if not n:
            return self.ids[:0], np.empty(0, np.int64)
        want = min(k, n)
        start = self._promising(query, terms, allowed, want)
        threshold = int(np.sort(self.rows[start] @ query)[-want]) if len(start) >= want else NONE
        # A row must gain ``gain``. The terms from ``cut`` on give half of that at most, so of the terms before it a row that
        # competes gets, of some term, at least the share ``(gain - rest[cut]) / (rest[0] - rest[cut])`` of its bound.
        gain = max(threshold, floor) - base
        alive = np.flatnonzero(allowed)
        if gain > int(rest[0]):
            return self.ids[:0], np.empty(0, np.int64)
        if gain > 0:
            cut = int(np.searchsorted(-rest, -(gain // 2), side="left"))
            over, under = gain - int(rest[cut]), int(rest[0]) - int(rest[cut])
            met = np.zeros(len(self.ids), bool)
            for t in terms[:cut]:
                order = self.postings[t]
                line, need = self.by_term[t][order] * query[t] - least[t], -(-over * int(bound[t]) // under)
                if query[t] >= 0:
                    met[order[np.searchsorted(line, need, side="left") :]] = True
                else:
                    met[order[: len(line) - np.searchsorted(line[::-1], need, side="left")]] = True
            alive = np.flatnonzero(met & allowed)
        have = np.zeros(len(alive), np.int64)
        for at in range(0, len(terms), 8):
            some = terms[at : at + 8]
            have += query[some] @ self.by_term[np.ix_(some, alive)] - least[some].sum()
            keep = have + rest[min(at + 8, len(terms))] >= gain
            if not keep.all():
                alive, have = alive[keep], have[keep]
        best = np.lexsort((self.ids[alive], -have))[:k]
        return self.ids[alive[best]], have[best] + base

    def _promising(self, query: np.ndarray, terms: np.ndarray, allowed: np.ndarray, want: int) -> np.ndarray:
        """Rows from the best ends of the strongest terms, to set the threshold with."""
        ends = [self.postings[t][-4 * want :] if query[t] >= 0 else self.postings[t][: 4 * want] for t in terms[:4]]
        rows = np.unique(np.concatenate(ends)) if ends else np.arange(min(len(self.ids), 4 * want))
        return rows[allowed[rows]]


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as they all fit in; the first byte says how many."""
    width = next(w for w in (1, 2, 4, 8) if not values.size or (np.iinfo(f"i{w}").min <= values.min() and values.max() <= np.iinfo(f"i{w}").max))
    return bytes([width]) + values.astype(f"<i{width}").tobytes()


def unpacked(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1).astype(np.int64).reshape(rows, -1)


def _blocks(vectors: DataFrame, per_block: int, name: str) -> DataFrame:
    """Vectors in blocks of about so many, with one row of binaries for each block and length."""
    count = max(1, math.ceil(vectors.count() / per_block))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        values = np.array(rows["v"].tolist(), np.int64).reshape(len(rows), -1)
        greatest = max(-int(values.min()), int(values.max())) if values.size else 0
        if greatest**2 * values.shape[1] >= 1 << 61:
            raise ValueError("components too large for whole-number scores of 64 bits")
        return pd.DataFrame({"dims": [values.shape[1]], name: [int(rows["block"].iloc[0])], "ids": [rows["vec_id"].to_numpy(np.int64).tobytes()], "values": [packed(values)]})

    # The rows' own numbers keep equal rows from meeting in one block.
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(count)).cast("int")).withColumn("dims", F.size("v"))
    return settled(dealt.groupBy("dims", "block").applyInPandas(pack, f"dims int, {name} int, ids binary, values binary"))


def top_inner_products(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row that ``queries`` selects, the ``k`` other rows with the highest scores.

    Components become ``floor(256 * x)``, the score is the whole-number inner product, and ties go to the smaller id.
    Vectors are dealt by hash into shards of bounded size; queries, in blocks, go to every shard, where
    MaxScore finds their best rows (see ``Shard.search``), exactly. Each block first meets one shard: the ``k``-th best score there is what a row
    of any shard must reach. The shards' lists are merged by rank. Each pair of a block and a shard is one row, joined by shard number.

    Query rows equal in id and vector are searched once; different vectors of one id each have their own answers. Vectors that are null or hold null or non-finite components take no part. Components so large that a score may not fit in 64 bits (about
    ``sqrt(2**61 / length) / 256``) are an error. Rows score only with vectors of their own
    length. Rows with the query's id are never its answers; other repeated rows answer each for itself. With fewer
    candidates, all are returned. Other columns are ignored. An empty table gives an empty result.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), whole_numbers(F.col(vector_col)).alias("v"), F.coalesce(queries, F.lit(False)).alias("asked")).where("v is not null and vec_id is not null")
    rows = settled(rows)
    shards = _blocks(rows.select("vec_id", "v"), SHARD, "shard")
    asked = _blocks(rows.where("asked").select("vec_id", "v").distinct(), BLOCK, "query_block").withColumnsRenamed({"ids": "query_ids", "values": "query_values"})
    places = shards.groupBy("dims").agg(F.sort_array(F.collect_list("shard")).alias("shards"))
    pairs = asked.join(places, "dims")
    tasks = min(TASKS, max(1, shards.count()) * 4)
    deal = lambda frame: frame.repartition(tasks, "dims", "shard")

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        """Rows, their query ids, and the answers to each query."""
        held, shard = None, None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if held != (row.dims, row.shard):
                    ids = np.frombuffer(row.ids, np.int64)
                    held, shard = (row.dims, row.shard), Shard(ids, unpacked(row.values, len(ids)))
                own = np.frombuffer(row.query_ids, np.int64)
                floors = np.frombuffer(row.floors, np.int64) if row.floors is not None else np.full(len(own), NONE)
                yield row, own, [shard.search(q, v, k, floor) for q, v, floor in zip(own.tolist(), unpacked(row.query_values, len(own)), floors.tolist())]

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row, _, found in searched(batches):
            floors = np.array([s[k - 1] if len(s) >= k else NONE for _, s in found], np.int64)
            yield pd.DataFrame({"dims": [row.dims], "query_block": [row.query_block], "floors": [floors.tobytes()]})

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row, own, found in searched(batches):
            many = [len(i) for i, _ in found]
            yield pd.DataFrame({"dims": row.dims, "query_block": row.query_block, "slot": np.repeat(np.arange(len(own)), many), "query_id": np.repeat(own, many), "vec_id": np.concatenate([i for i, _ in found]), "score": np.concatenate([s for _, s in found])})

    one = pairs.withColumn("shard", F.get("shards", F.expr("query_block % size(shards)"))).drop("shards").withColumn("floors", F.lit(None).cast("binary"))
    floors = settled(deal(shards).join(deal(one), ["dims", "shard"]).mapInPandas(first, "dims int, query_block int, floors binary"))
    every = pairs.join(floors, ["dims", "query_block"]).withColumn("shard", F.explode("shards")).drop("shards")
    answers = deal(shards).join(deal(every), ["dims", "shard"]).mapInPandas(search, "dims int, query_block int, slot int, query_id long, vec_id long, score long")
    # A query has a place of its own in one block.
    rank = F.row_number().over(Window.partitionBy("query_id", "dims", "query_block", "slot").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: DuckDB: the five best other rows of every 50th.
TOP_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT DISTINCT vec_id, v FROM v WHERE vec_id % 50 = 0),
s AS (SELECT q.vec_id AS query_id, q.v, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id, v ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5"""
