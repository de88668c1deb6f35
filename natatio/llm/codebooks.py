"""Codes of vectors by codebooks of their parts, learned over Hilbert-sorted blocks with boxes and sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natatio.llm.maxscore import whole_numbers
from natatio.llm.shared import settled, skew_join, stored

#: Rows to a block. A Hilbert key is of so many positions (those that vary most), each cut into two to the power of so many grades. Both change the work, never the result.
BLOCK, AXES, GRADES = 128, 8, 7
#: Rows of points that are compared with a shortlist at once.
AT_ONCE = 1 << 14


def hilbert_keys(grades: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of whole numbers below ``2**bits`` on the Hilbert curve through them all; neighbours on the curve are neighbours in space.

    Axes are turned into the curve's own bits from the highest one down, as Skilling describes it, for all rows at once. ``columns * bits`` is 63 at most.
    """
    x = np.ascontiguousarray(grades.T, np.int64)
    n, top = len(x), 1 << (bits - 1)
    bit = top
    while bit > 1:
        low = bit - 1
        for axis in range(n):
            there = (x[axis] & bit) != 0
            swap = np.where(there, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(there, low, swap)
            x[axis] ^= swap
        bit >>= 1
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    turn, bit = np.zeros(x.shape[1], np.int64), top
    while bit > 1:
        turn ^= np.where(x[n - 1] & bit, bit - 1, 0)
        bit >>= 1
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for axis in range(n):
            key = (key << 1) | ((x[axis] >> b) & 1)
    return key


def shortlist(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The entries that may be nearest to a point of a box: those not farther from its nearest point than some entry is from its farthest one."""
    outside = np.maximum(np.maximum(low - entries, entries - high), 0)
    across = np.maximum(np.abs(entries - low), np.abs(entries - high))
    return np.flatnonzero((outside * outside).sum(1) <= (across * across).sum(1).min())


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each point its nearest entry, the first of equal ones, and the squared distance, in whole numbers."""
    most = max(int(np.abs(points).max()), int(np.abs(entries).max()))
    kind = np.float64 if 4 * points.shape[1] * most * most < 1 << 52 else np.int64  # doubles are whole up to there
    p, c = points.astype(kind), entries.astype(kind)
    apart = (c * c).sum(1) - 2 * (p @ c.T)
    best = apart.argmin(1)
    return best, (apart[np.arange(len(p)), best] + (p * p).sum(1)).astype(np.int64)


def _block_codes(block, entries: np.ndarray, width: int, distances: bool) -> tuple[np.ndarray | int, np.ndarray | None, np.ndarray]:
    """The entries of a block's points (one number if all have the same, found without looking at them), their distances, and the points if they were looked at."""
    low, high = (np.frombuffer(x, np.int64) for x in (block.low, block.high))
    some = shortlist(low, high, entries)
    if len(some) == 1 and not distances:
        return int(some[0]), None, None
    points = np.frombuffer(block.points, f"<i{width}").astype(np.int64).reshape(block.n, -1)
    best, apart = nearest(points, entries[some])
    return some[best], apart, points


class Codebooks:
    """The entries of each part position, ``entries[part, entry, place]``."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries

    def digest(self) -> str:
        """SHA-256 of all components in decimals, parted by commas, by part, entry and place."""
        import hashlib

        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _moments(rows: DataFrame) -> pd.DataFrame:
    """Sum, sum of squares and greatest size of each position, a row for each (tasks send one row for each)."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for at in range(0, len(batch), AT_ONCE):
                v = np.array(batch["v"].iloc[at : at + AT_ONCE].tolist(), np.float64)
                part = np.stack([v.sum(0), (v * v).sum(0), np.abs(v).max(0)])
                total = part if total is None else np.stack([*(total[:2] + part[:2]), np.maximum(total[2], part[2])])
        if total is not None:
            yield pd.DataFrame({"at": np.arange(total.shape[1]), "s": total[0], "q": total[1], "most": total[2]})

    found = rows.select("v").mapInPandas(add, "at int, s double, q double, most double")
    return found.groupBy("at").agg(F.sum("s").alias("s"), F.sum("q").alias("q"), F.max("most").alias("most")).toPandas().sort_values("at", ignore_index=True)


def part_blocks(rows: DataFrame, dims: int, parts: int) -> tuple[DataFrame, int]:
    """The parts of all vectors in blocks along a Hilbert curve for each part position, and the bytes of a component.

    A block has its points, their rows' numbers, the least and greatest of each component (its box) and the sums. Parts are dealt by ranges of curve place and row
    number, so that equal ones, however many, make blocks in many tasks.
    """
    stats, n, own = _moments(rows), rows.count(), dims // parts
    most = int(stats["most"].max())
    if 4 * dims * most**2 >= 1 << 62 or n * most >= 1 << 62:
        raise ValueError("components too large for whole-number distances of 64 bits")
    width = next(w for w in (2, 4, 8) if most < 1 << (8 * w - 1))
    mean = (stats["s"] / n).to_numpy()
    spread = np.sqrt(np.maximum((stats["q"] / n).to_numpy() - mean * mean, 0))
    axes = [p * own + np.sort(np.argsort(-spread[p * own : (p + 1) * own], kind="stable")[:AXES]) for p in range(parts)]

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), AT_ONCE):
                some = batch.iloc[at : at + AT_ONCE]
                v = np.array(some["v"].tolist(), np.int64).reshape(len(some), dims)
                for p in range(parts):
                    x = (v[:, axes[p]] - mean[axes[p]]) / np.maximum(spread[axes[p]], 1e-9)
                    grades = np.clip((x + 3) / 6 * (1 << GRADES), 0, (1 << GRADES) - 1).astype(np.int64)
                    points = v[:, p * own : (p + 1) * own].astype(f"<i{width}")
                    yield pd.DataFrame({"part": p, "place": hilbert_keys(grades, GRADES), "row": some["row"].to_numpy(), "point": [x.tobytes() for x in points]})

    def block(part: int, some: pd.DataFrame) -> dict:
        data = b"".join(some["point"])
        points = np.frombuffer(data, f"<i{width}").astype(np.int64).reshape(len(some), own)
        low, high, sums = (x.astype(np.int64).tobytes() for x in (points.min(0), points.max(0), points.sum(0)))
        return {"part": part, "n": len(some), "rows": some["row"].to_numpy(np.int64).tobytes(), "points": data, "low": low, "high": high, "sums": sums}

    def blocked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held, out = batch if held is None else pd.concat([held, batch], ignore_index=True), []
            last = held["part"].iloc[-1] if len(held) else None
            rest = []
            for part, some in held.groupby("part", sort=False):
                whole = len(some) - len(some) % BLOCK if part == last else len(some)
                out += [block(int(part), some.iloc[a : min(a + BLOCK, whole)]) for a in range(0, whole, BLOCK)]
                rest.append(some.iloc[whole:])
            held = pd.concat(rest, ignore_index=True) if rest else None
            if out:
                yield pd.DataFrame(out)
        if held is not None and len(held):
            yield pd.DataFrame([block(int(held["part"].iloc[0]), held)])

    places = stored(rows.select("row", "v").mapInPandas(keyed, "part int, place long, row long, point binary"), "places")
    order = ["part", "place", "row"]
    dealt = places.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(dealt.mapInPandas(blocked, "part int, n int, rows binary, points binary, low binary, high binary, sums binary"), "blocks"), width


def _refined(blocks: DataFrame, entries: np.ndarray, width: int) -> np.ndarray:
    """The entries after a round: each the mean of its parts, rounded down; entries without parts stay. Tasks send one row for each entry they use."""
    parts, count, own = entries.shape
    sent = blocks.sparkSession.sparkContext.broadcast(entries)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        books = sent.value
        sums, n = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for row in batch.itertuples(index=False):
                code, _, points = _block_codes(row, books[row.part], width, False)
                if points is None:
                    sums[row.part, code] += np.frombuffer(row.sums, np.int64)
                    n[row.part, code] += row.n
                else:
                    np.add.at(sums[row.part], code, points)
                    n[row.part] += np.bincount(code, minlength=books.shape[1])
        part, entry = np.nonzero(n)
        yield pd.DataFrame({"part": part, "entry": entry, "n": n[part, entry], "sums": list(sums[part, entry])})

    found = blocks.drop("rows").mapInPandas(add, "part int, entry int, n long, sums array<long>")
    totals = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[i]) for i in range(own))).alias("sums"))
    after = entries.copy()
    for row in totals.collect():  # parts times entries rows at most
        after[row["part"], row["entry"]] = np.array(row["sums"], np.int64) // row["n"]
    return after


def compress_vectors(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Codebooks]:
    """``(vec_id, label, codes, error, label_error)`` of every vector, and the codebooks.

    Components become ``floor(scale * x)``; vectors are cut into ``parts`` equal consecutive parts. The codebook of a part position starts as that part of the
    ``entries`` rows with the smallest ids. In each round every part goes to its nearest entry (squared distance, ties to the lower index), then each entry becomes
    the mean of its parts, rounded down; an entry without parts stays. At last parts are assigned again: ``codes`` has the entry of each part, ``error`` the
    sum of squared distances, ``label_error`` the sum of errors over rows of equal labels, nulls together. All of it is in whole numbers, so results don't depend on
    how rows are dealt.

    A round reads blocks of parts that lie near each other on a Hilbert curve: by a block's box only a few entries can be nearest to its points;
    where it is one alone, the block's sums are taken as they are.

    Vectors that are null, empty or hold null or non-finite components take no part; nor do those of another length than the commonest (of equally common ones the
    shortest). A length that isn't a multiple of ``parts`` and components too large for distances of 64 bits are an error. Rows without an id are coded but start no
    entry; repeated rows count each, in order of id, then vector. With fewer rows than ``entries``, the codebooks are as small. Other columns are
    ignored. An empty table gives an empty result.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), whole_numbers(F.col(vector_col), scale).alias("v"))
    rows = rows.where("v is not null and size(v) > 0").withColumn("dims", F.size("v")).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "vectors")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    commonest = rows.groupBy("dims").count().orderBy(F.desc("count"), "dims").first()
    if commonest is None:
        empty = rows.sparkSession.createDataFrame([], f"vec_id {kinds['vec_id']}, label {kinds['label']}, codes array<int>, error long, label_error long")
        return empty, Codebooks(np.empty((parts, 0, 0), np.int64))
    dims = commonest["dims"]
    if dims % parts:
        raise ValueError(f"{dims} components can't be cut into {parts} equal parts")
    rows = rows.where(F.col("dims") == dims).drop("dims")
    first = rows.where("vec_id is not null").orderBy("vec_id", "v", "row").select("v").limit(entries).collect()
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, dims // parts).transpose(1, 0, 2)
    if not len(first):
        raise ValueError("no row with an id to start the codebooks with")
    blocks, width = part_blocks(rows, dims, parts)
    for _ in range(rounds):
        books = _refined(blocks, books, width)
    final = rows.sparkSession.sparkContext.broadcast(books)

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                codes, apart, _ = _block_codes(row, final.value[row.part], width, True)
                yield pd.DataFrame({"row": np.frombuffer(row.rows, np.int64), "part": row.part, "code": codes, "apart": apart})

    coded = blocks.mapInPandas(code, "row long, part int, code int, apart long")
    whole = coded.groupBy("row").agg(F.array(*(F.max(F.when(F.col("part") == p, F.col("code"))) for p in range(parts))).alias("codes"), F.sum("apart").alias("error"))
    keyed = rows.select("row", "vec_id", "label", F.col("label").isNull().alias("none"), F.coalesce(F.col("label").cast("string"), F.lit("")).alias("name"))
    whole = stored(keyed.join(whole, "row"), "codes")
    sums = settled(whole.groupBy("none", "name").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")))
    return skew_join(whole, sums.drop("n"), ["none", "name"], sums.drop("label_error")).select("vec_id", "label", "codes", "error", "label_error"), Codebooks(books)


def hex_codes(codes):
    """Codes below 256 as two hexadecimal digits each."""
    return F.array_join(F.transform(codes, lambda x: F.lpad(F.lower(F.hex(x)), 2, "0")), "")


def compress_sql(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, dims: int = 64) -> str:
    """DuckDB: the same, with all distances of each round spelt out."""
    own = dims // parts
    rounds_sql = ""
    for r in range(rounds + 1):
        rounds_sql += f""", a{r} AS (SELECT p.id, p.part, min({{'d': CAST(list_sum(list_transform(range(1, {own + 1}), lambda i: (p.x[i] - c.x[i]) * (p.x[i] - c.x[i]))) AS BIGINT), 'entry': c.entry}}) AS best
    FROM pieces p JOIN c{r} c ON p.part = c.part GROUP BY p.id, p.part)"""
        if r < rounds:
            rounds_sql += f""", m{r} AS (SELECT a.part, a.best.entry AS entry, count(*) AS n, {', '.join(f'CAST(floor(sum(p.x[{i}]) / count(*)) AS BIGINT) AS s{i}' for i in range(1, own + 1))}
    FROM a{r} a JOIN pieces p ON a.id = p.id AND a.part = p.part GROUP BY a.part, a.best.entry),
c{r + 1} AS (SELECT c.part, c.entry, CASE WHEN m.n IS NULL THEN c.x ELSE [{', '.join(f'm.s{i}' for i in range(1, own + 1))}] END AS x FROM c{r} c LEFT JOIN m{r} m ON c.part = m.part AND c.entry = m.entry)"""
    return f"""WITH v AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS id, list_transform(embedding, lambda x: CAST(floor({scale} * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS (SELECT id, part, v[part * {own} + 1 : part * {own} + {own}] AS x FROM v, (SELECT unnest(range({parts})) AS part)),
c0 AS (SELECT part, id - 1 AS entry, x FROM pieces WHERE id <= {entries}){rounds_sql},
books AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS books FROM c{rounds}),
coded AS (SELECT id, string_agg(lpad(lower(to_hex(best.entry)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY id)
SELECT v.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error, b.books AS codebooks_sha256 FROM coded c JOIN v ON c.id = v.id CROSS JOIN books b"""
