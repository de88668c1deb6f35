"""Line dedup: documents that share rare lines are aligned, and common blocks go from the later one."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natatio.llm.shared import skew_join, stored

#: Characters of a block that is deleted, at least.
BLOCK_CHARS = 40


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched places of two line sequences by patience diff, in order.

    Equal lines at both ends of a stretch match. Of the rest, lines that are unique in both sequences' stretches and
    lie in one order are anchors, and the stretches between them are treated likewise; a
    stretch without such a line has no match.
    """
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i == j or k == m:
            continue
        once_a, once_b = Counter(a[i:j]), Counter(b[k:m])
        place = {x: n for n, x in enumerate(a[i:j], i) if once_a[x] == 1}
        both = [(place[x], n) for n, x in enumerate(b[k:m], k) if once_b[x] == 1 and x in place]
        tails: list[int] = []
        ends: list[int] = []
        before: list[int] = []
        for n, (p, _) in enumerate(both):  # the longest run of anchors that rises in both
            at = bisect_left(tails, p)
            before.append(ends[at - 1] if at else -1)
            tails[at : at + 1], ends[at : at + 1] = [p], [n]
        n, anchors = ends[-1] if ends else -1, []
        while n >= 0:
            anchors.append(both[n])
            n = before[n]
        for p, q in [*anchors[::-1], (j, m)] if anchors else []:
            todo.append((i, p, k, q))
            if (p, q) != (j, m):
                out.append((p, q))
                i, k = p + 1, q + 1
    return sorted(out)


def blocks(matches: list[tuple[int, int]], sizes: list[int]) -> list[int]:
    """Places in the second sequence that lie in runs of matches with ``BLOCK_CHARS`` characters at least."""
    out, run, before = [], [], None
    for i, k in [*matches, (-9, -9)]:
        if before is not None and (i, k) != (before[0] + 1, before[1] + 1):
            if sum(sizes[n] for n in run) >= BLOCK_CHARS:
                out += run
            run = []
        run.append(k)
        before = (i, k)
    return out


def stretches(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of the shortest runs of lines with ``BLOCK_CHARS`` characters that start, and that end, at each line.

    Each line of any run with so many characters lies in one of these that is part of the run: one that starts
    or ends at the line, or that starts where the run does. Hashes of runs are differences of one running sum.
    """
    n = len(hashes)
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    first, last = np.arange(n), np.searchsorted(ends, ends[:-1] + BLOCK_CHARS)  # lines first .. last - 1
    back = np.searchsorted(ends, ends[1:] - BLOCK_CHARS, side="right") - 1
    runs = np.concatenate([np.stack([first, last], 1)[last <= n], np.stack([back, first + 1], 1)[back >= 0]])
    # Powers of an odd number and of its inverse, modulo 2**64.
    base = 0x9E3779B97F4A7C15
    power, inverse = (np.cumprod(np.array([1] + [x] * n, np.uint64), dtype=np.uint64) for x in (base, pow(base, -1, 1 << 64)))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes.view(np.uint64) * power[:-1], dtype=np.uint64)])
    out = (sums[runs[:, 1]] - sums[runs[:, 0]]) * inverse[runs[:, 0]] + (runs[:, 1] - runs[:, 0]).astype(np.uint64)
    return np.unique(out.view(np.int64))


def _stretch_seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [stretches(np.asarray(h, np.int64), np.asarray(s, np.int64)) for h, s in zip(batch["hashes"], batch["sizes"])]
        many = [len(x) for x in found]
        yield pd.DataFrame({"kind": np.repeat(batch["kind"].to_numpy(), many), "doc_id": batch["doc_id"].repeat(many).to_numpy(), "line": np.concatenate([np.empty(0, np.int64), *found])})


def common_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, removed)``: numbers of the lines of each text that go, counted from 0; texts that lose some.

    Lines are parted by newlines and compared without white space at their ends. Documents with the same lines
    are one kind, of the smallest id; later ones lose all their lines (if these have ``BLOCK_CHARS``).

    Seeds are ``stretches``: shortest runs of lines with ``BLOCK_CHARS`` characters, however many kinds hold them and however short
    their lines are; so each line of a block that an earlier kind has too is in a seed. A kind is paired with the
    kind of the smallest id that holds the seed; so a seed makes as many pairs as it has kinds, never
    all pairs of a group. Each pair is aligned by patience diff, over all lines; runs of matched lines
    with ``BLOCK_CHARS`` characters are deleted from the later kind. An alignment keeps the order of both; blocks that
    changed places aren't both in one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(x, r"^[\s\x00]+|[\s\x00]+$", "")))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), lines.alias("lines"))
    rows = rows.select("doc_id", "text_key", F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes"), F.transform("lines", lambda x: F.length(x)).alias("sizes"))
    rows = stored(rows.where("doc_id is not null").withColumn("kind", F.xxhash64("hashes")), "lines")
    kinds = stored(rows.groupBy("kind").agg(F.min(F.struct("doc_id", "hashes", "sizes")).alias("one"), F.count("*").alias("n")).select("kind", "n", "one.*"), "kinds")
    seeds = stored(kinds.mapInPandas(_stretch_seeds, kinds.select("kind", "doc_id", F.lit(0).cast("long").alias("line")).schema), "seeds")
    owners = stored(seeds.groupBy("line").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "kind")).alias("owner")).where("n > 1"), "owners")
    met = skew_join(seeds.select("line", "kind"), owners.drop("n"), ["line"], owners.select("line", "n"))
    pairs = stored(met.select("kind", F.col("owner.kind").alias("earlier")).where("kind <> earlier").distinct(), "met")
    own = kinds.select("kind", F.col("hashes").alias("b"), "sizes")
    # Many kinds may have one earlier one, that of a licence, say: its lines go to where theirs are.
    told = kinds.select(F.col("kind").alias("earlier"), F.col("hashes").alias("a"))
    pairs = skew_join(pairs.join(own, "kind"), told, ["earlier"], pairs.groupBy("earlier").agg(F.count("*").alias("n"))).select("kind", "a", "b", "sizes")

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            gone = [blocks(patience(list(a), list(b)), list(sizes)) for a, b, sizes in zip(batch["a"], batch["b"], batch["sizes"])]
            yield pd.DataFrame({"kind": batch["kind"], "gone": gone})

    gone = pairs.mapInPandas(align, "kind long, gone array<int>").where("size(gone) > 0").groupBy("kind").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))
    told = stored(kinds.select("kind", F.col("doc_id").alias("first")).join(gone, "kind", "left"), "told")
    whole = F.expr(f"if(aggregate(sizes, 0, (s, x) -> s + x) >= {BLOCK_CHARS}, sequence(0, size(sizes) - 1), array())")
    judged = skew_join(rows, told, ["kind"], kinds.select("kind", "n"))
    removed = F.when(F.col("doc_id") != F.col("first"), whole).otherwise(F.col("gone"))
    return judged.select("doc_id", "text_key", removed.alias("removed")).where("size(removed) > 0").distinct()


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_lines, n_removed, kept)``: each text without the blocks of lines it has in common with earlier ones.

    Null texts have no lines and keep nothing, empty ones have one empty line. A null id is later than none and
    loses nothing. Repeated rows (one id) lose the same lines. Repeats within a document stay. Other columns are
    ignored. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"), F.col(text_col).alias("text"))
    found = rows.join(common_blocks(docs, id_col, text_col), ["doc_id", "text_key"], "left").select("doc_id", "text", "removed")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, removed in zip(batch["text"], batch["removed"]):
                lines = [] if text is None else text.split("\n")
                gone = () if removed is None else set(removed)
                out.append((len(lines), len(gone) if lines else 0, "\n".join(x for n, x in enumerate(lines) if n not in gone)))
            yield pd.DataFrame(out, columns=["n_lines", "n_removed", "kept"]).assign(doc_id=batch["doc_id"].to_numpy())[["doc_id", "n_lines", "n_removed", "kept"]]

    return found.mapInPandas(cut, f"doc_id {kind}, n_lines long, n_removed long, kept string")
