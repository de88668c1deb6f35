"""Hard negatives: rotated one-bit codes bound every score, and only what the bounds leave open is scored."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natatio.llm.maxscore import NONE, packed, unpacked, whole_numbers
from natatio.llm.shared import settled, stored

#: Vectors to a shard, anchors to a block, shards and blocks to a cell's side at most, and cells to a side that are aimed at.
SHARD, BLOCK, SIDE, CELLS = 4096, 256, 32, 8
#: Bits of a component of a rotated anchor.
PLANES = 6


def rotation(dims: int) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(0xC0DE).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits in words of 64."""
    data = np.packbits(bits, axis=1, bitorder="little")
    return np.pad(data, ((0, 0), (0, -data.shape[1] % 8))).view(np.uint64)


def codes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One bit for each component of the rotated rows, and how long a row is along its code vector (the signs at length one) and beside it."""
    turned = rows.astype(np.float64) @ rotation(rows.shape[1])
    along = np.abs(turned).sum(1) / math.sqrt(rows.shape[1])
    beside = np.sqrt(np.maximum((turned * turned).sum(1) - along * along, 0))
    return words(turned > 0), along, beside


class Anchor:
    """An anchor's rotated components, rounded to ``2**PLANES`` steps, as planes of bits."""

    def __init__(self, row: np.ndarray):
        turned = row.astype(np.float64) @ rotation(len(row)) if len(row) else row.astype(np.float64)
        self.least = float(turned.min()) if len(row) else 0.0
        self.step = (float(turned.max()) - self.least) / ((1 << PLANES) - 1) if len(row) else 0.0
        steps = np.rint((turned - self.least) / self.step).astype(np.int64) if self.step else np.zeros(len(row), np.int64)
        rounded = self.least + self.step * steps
        self.total, self.off = float(rounded.sum()), float(np.linalg.norm(turned - rounded))
        self.length = float(np.linalg.norm(turned))
        self.planes = words(((steps[None, :] >> np.arange(PLANES)[:, None]) & 1).astype(bool))


class Shard:
    """Rows with their codes: bounds of scores by popcounts, exact scores for those asked for."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, bits: np.ndarray, along: np.ndarray, beside: np.ndarray):
        self.ids, self.labels, self.rows, self.bits, self.along, self.beside = ids, labels, rows, bits, along, beside
        self.ones = np.bitwise_count(bits).sum(1).astype(np.float64)
        self.most = int(np.abs(rows).max()) if rows.size else 0
        self.whole = rows.astype(np.float64) if self.most < 1 << 26 else rows

    def bounds(self, anchor: Anchor) -> tuple[np.ndarray, np.ndarray]:
        """Whole numbers that each row's score lies between.

        A row is ``along`` times its code vector plus a rest at right angles to it, ``beside`` long. The anchor's product with the code vector is
        known by popcounts up to its rounding; with the rest it is at most ``beside`` times what the anchor has at right angles to the code vector (Cauchy and
        Schwarz). A little is added for the rounding of doubles.
        """
        dims = self.rows.shape[1]
        counted = sum(float(1 << j) * np.bitwise_count(self.bits & plane).sum(1) for j, plane in enumerate(anchor.planes))
        product = (2 * (anchor.least * self.ones + anchor.step * counted) - anchor.total) / math.sqrt(dims)
        sure = np.maximum(np.abs(product) - anchor.off, 0)
        across = np.sqrt(np.maximum(anchor.length**2 - sure * sure, 0))
        middle = self.along * product
        half = self.along * anchor.off + self.beside * across + 1e-9 * anchor.length * (self.along + self.beside) + 1e-6
        return np.ceil(middle - half).astype(np.int64), np.floor(middle + half).astype(np.int64)

    def scores(self, row: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Exact scores of some rows."""
        if self.whole is not self.rows and len(row) * self.most * int(np.abs(row).max(initial=0)) < 1 << 52:
            return (self.whole[of] @ row.astype(np.float64)).astype(np.int64)
        return self.rows[of] @ row


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` by score, ties by id."""
    return np.lexsort((ids, -scores))[:k]


def _kth(values: np.ndarray, k: int) -> int:
    return int(np.partition(values, -k)[-k]) if len(values) >= k else NONE


def search(shard: Shard, row: np.ndarray, anchor: Anchor, allowed: np.ndarray, bands: list[tuple[int, int]], k: int, floors: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each band of scores, ids and scores of the first ``k`` allowed rows in it, but for rows under the band's floor.

    ``k`` rows of a band set a floor to it: those that are surely in it, by their lower bounds, and the first of the rows with the highest estimates, which are scored to
    begin with. A row whose upper bound is under the floors of all bands that it may be in isn't scored.
    """
    low, high = shard.bounds(anchor)
    open_, least = np.zeros(len(low), bool), []
    for (bottom, top), floor in zip(bands, floors):
        within = np.flatnonzero(allowed & (low <= top))
        estimate = low[within] + high[within]
        first = shard.scores(row, within[np.argpartition(-estimate, 8 * k)[: 8 * k]] if len(within) > 8 * k else within)
        sure = allowed & (low >= bottom) & (high <= top)
        floor = max(floor, bottom, _kth(low[sure], k), _kth(first[(first >= bottom) & (first <= top)], k))
        least.append(floor)
        open_ |= (high >= floor) & (low <= top)
    of = np.flatnonzero(open_ & allowed)
    scores = shard.scores(row, of)
    out = []
    for (_, top), floor in zip(bands, least):
        some = np.flatnonzero((scores >= floor) & (scores <= top))
        some = some[best(scores[some], shard.ids[of[some]], k)]
        out.append((shard.ids[of[some]], scores[some]))
    return out


def _shards(rows: DataFrame) -> DataFrame:
    """Rows dealt by hash into shards of bounded size, with their codes; a row for each shard and length."""
    count = max(1, math.ceil(rows.count() / SHARD))

    def pack(some: pd.DataFrame) -> pd.DataFrame:
        values = np.array(some["v"].tolist(), np.int64).reshape(len(some), -1)
        most = max(-int(values.min()), int(values.max())) if values.size else 0
        if most**2 * values.shape[1] >= 1 << 61:
            raise ValueError("components too large for whole-number scores of 64 bits")
        bits, along, beside = codes(values) if values.shape[1] else (np.zeros((len(some), 1), np.uint64), np.zeros(len(some)), np.zeros(len(some)))
        column = lambda x: [np.ascontiguousarray(x).tobytes()]
        return pd.DataFrame({"dims": [values.shape[1]], "shard": [int(some["shard"].iloc[0])], "ids": column(some["vec_id"].to_numpy(np.int64)), "labels": column(some["label"].to_numpy(np.int64)), "values": [packed(values)], "bits": column(bits), "along": column(along), "beside": column(beside)})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(count)).cast("int"))
    return stored(dealt.groupBy("dims", "shard").applyInPandas(pack, "dims int, shard int, ids binary, labels binary, values binary, bits binary, along binary, beside binary"), "shards")


def _over_grid(asked: DataFrame, shards: DataFrame, k: int, same: bool) -> DataFrame:
    """``(row, slot, vec_id, score)``: the first ``k`` rows of each of an anchor's bands (``lows``, ``highs``), of its own label or of others, ``k`` for each cell.

    Blocks of anchors and shards are the two sides of a grid of cells of bounded size; a block goes to the cells of its row, a shard to those of its
    column. In a cell, what earlier shards gave is the floor for later ones.
    """
    blocks = max(1, math.ceil(asked.count() / BLOCK))
    columns = (shards.agg(F.max("shard")).first()[0] or 0) + 1
    high, wide = (min(SIDE, max(1, math.ceil(n / CELLS))) for n in (blocks, columns))

    def pack(some: pd.DataFrame) -> pd.DataFrame:
        values = np.array(some["v"].tolist(), np.int64).reshape(len(some), -1)
        column = lambda x: [x.tobytes()]
        return pd.DataFrame({"dims": [values.shape[1]], "block": [int(some["block"].iloc[0])], "rows": column(some["row"].to_numpy(np.int64)), "own": column(some["vec_id"].to_numpy(np.int64)), "kinds": column(some["label"].to_numpy(np.int64)), "vectors": [packed(values)], "lows": [[list(map(int, x)) for x in some["lows"]]], "highs": [[list(map(int, x)) for x in some["highs"]]]})

    dealt = asked.withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int"))
    packs = stored(dealt.groupBy("dims", "block").applyInPandas(pack, "dims int, block int, rows binary, own binary, kinds binary, vectors binary, lows array<array<long>>, highs array<array<long>>"), "anchors")
    sides = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = packs.withColumn("i", F.floor(F.col("block") / high).cast("int")).withColumn("j", sides(math.ceil(columns / wide)))
    right = shards.withColumn("j", F.floor(F.col("shard") / wide).cast("int")).withColumn("i", sides(math.ceil(blocks / high)))

    def cell(anchors: pd.DataFrame, those: pd.DataFrame) -> pd.DataFrame:
        found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        known = []
        for a in anchors.itertuples(index=False):
            rows = np.frombuffer(a.rows, np.int64)
            known += list(zip(rows.tolist(), np.frombuffer(a.own, np.int64).tolist(), np.frombuffer(a.kinds, np.int64).tolist(), unpacked(a.vectors, len(rows)), a.lows, a.highs))
        known = [(row, own, kind, v, Anchor(v), list(zip(map(int, lows), map(int, highs)))) for row, own, kind, v, lows, highs in known]
        for s in those.itertuples(index=False):
            ids = np.frombuffer(s.ids, np.int64)
            shard = Shard(ids, np.frombuffer(s.labels, np.int64), unpacked(s.values, len(ids)), np.frombuffer(s.bits, np.uint64).reshape(len(ids), -1), np.frombuffer(s.along), np.frombuffer(s.beside))
            for row, own, kind, v, anchor, bands in known:
                allowed = (ids != own) & (shard.labels == kind) if same else (ids != own) & (shard.labels != kind)
                empty = (ids[:0], ids[:0])
                floors = [int(x[k - 1]) if len(x := found.get((row, n), empty)[1]) == k else NONE for n in range(len(bands))]
                for n, (i, x) in enumerate(search(shard, v, anchor, allowed, bands, k, floors)):
                    if len(i):
                        i, x = (np.concatenate(pair) for pair in zip(found.get((row, n), empty), (i, x)))
                        first = best(x, i, k)
                        found[row, n] = (i[first], x[first])
        keys = np.array(list(found), np.int64).reshape(-1, 2)
        sizes = [len(i) for i, _ in found.values()]
        joined = lambda n: np.concatenate([x[n] for x in found.values()]) if found else np.empty(0, np.int64)
        return pd.DataFrame({"row": np.repeat(keys[:, 0], sizes), "slot": np.repeat(keys[:, 1], sizes), "vec_id": joined(0), "score": joined(1)})

    keys = ["dims", "i", "j"]
    answers = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(cell, "row long, slot int, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("row", "slot").orderBy(F.desc("score"), "vec_id"))
    return stored(answers.withColumn("rank", rank).where(F.col("rank") <= k), "found")


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for each row that ``anchors`` selects.

    Components become ``floor(256 * x)``; a row's score is its whole-number inner product with the anchor, higher ones first, ties by smaller id. An anchor's
    positives are its first ``positives`` other rows of its label. For each of them the first ``negatives`` rows of other labels are returned whose score is from ``least``
    to ``most`` percent of the positive's: ``least * p <= 100 * n <= most * p``; with a negative ``p`` there are none.

    Every row is bounded by its one-bit code first and scored only if its bounds leave open that it counts (``Shard.bounds``, ``search``); the result is exact.

    Rows with a null label, a null vector or a null or non-finite component take no part, nor do rows without an id. Labels are whole numbers. Rows equal in id, label and vector count once;
    different rows of one id each count, but never as an answer to an anchor of their id. Rows score only with vectors of their own length. Components so large that a score may not
    fit in 64 bits are an error. With fewer rows, all are returned. Other columns are ignored. An empty table gives an empty result.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), whole_numbers(F.col(vector_col)).alias("v"), F.coalesce(anchors, F.lit(False)).alias("asked"))
    rows = rows.where("v is not null and vec_id is not null and label is not null").distinct()
    rows = stored(rows.withColumns({"dims": F.size("v"), "row": F.monotonically_increasing_id()}), "vectors")
    shards = _shards(rows.drop("asked"))
    asked = rows.where("asked").drop("asked")
    bound = lambda x: F.array(F.lit(x).cast("long"))
    near = _over_grid(asked.withColumns({"lows": bound(NONE), "highs": bound(-NONE)}), shards, positives, True)
    # 50 p <= 100 n <= 95 p, in whole numbers; ``floor`` of a quotient of longs would go by way of doubles.
    down = lambda percent: F.expr(f"(score * {percent} - pmod(score * {percent}, 100L)) div 100")
    up = F.expr(f"(score * {least} + pmod(-score * {least}, 100L)) div 100")
    slots = near.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", up.alias("low"), down(most).alias("high")))).alias("x"))
    far = _over_grid(asked.join(slots, "row").select("*", F.col("x.low").alias("lows"), F.col("x.high").alias("highs")).drop("x"), shards, negatives, False)
    told = near.select("row", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = far.join(told, ["row", "slot"]).join(asked.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


#: DuckDB: every 50th row's five positives and the three negatives of each, with every seventh label moved on by one.
NEGATIVES_SQL = """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0 AND len(q.v) = len(c.v)),
p AS (SELECT anchor_id, vec_id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INT) AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON p.anchor_id = n.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score QUALIFY rank <= 3"""
