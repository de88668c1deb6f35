"""SimHash near-duplicates by a self-join of the binary trie of all fingerprints."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natatio.llm.components import connected_components
from natatio.llm.shared import settled, skew_join, word_blocks

_LANES = np.uint64(0x0101010101010101)
#: Fingerprints that a cell of the trie should hold on average, and the depths allowed for cells.
CELL, DEPTHS = 1024, (8, 20)
#: Node pairs looked at together, and pairs of fingerprints compared together.
FRONTIER, PAIRS = 1 << 18, 1 << 20


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits; eight bits at a time in byte lanes."""
    padded = np.concatenate([hashes, np.zeros(-len(hashes) % 255, np.uint64)]).reshape(-1, 255)
    out = np.empty(64, np.int64)
    for bit in range(8):
        lanes = ((padded >> np.uint64(bit)) & _LANES).sum(axis=1)
        out[bit::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out


def fingerprint(data: bytes, ngram: int = 3) -> int:
    """SimHash of a UTF-8 text: a bit is 1 if over half of the shingles' hashes have it."""
    counts, total, tail, digest = np.zeros(64, np.int64), 0, [], xxhash.xxh64_intdigest
    for words in word_blocks(data.lower()):
        words = tail + words
        made = len(words) - ngram + 1
        if made > 0:
            hashes = [digest(b" ".join(s), 42) for s in zip(*(words[i:] for i in range(ngram)))]
            counts += _bit_counts(np.array(hashes, np.uint64))
            total += made
        tail = words[max(0, made) :] if ngram > 1 else []
    if not total and tail:  # fewer words than a shingle
        counts, total = _bit_counts(np.array([digest(b" ".join(tail), 42)], np.uint64)), 1
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > total).tolist()))


def trie_links(a: np.ndarray, b: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of the sorted distinct arrays whose values differ in ``budget`` bits at most.

    A node of the binary trie is a range of a sorted array that shares a prefix. Pairs of nodes
    go down bit by bit together; a step to unlike children adds one differing bit, and a pair
    beyond the budget is dropped with everything below it. Small pairs of nodes are compared
    value by value. With ``a is b`` each unordered pair comes once.
    """
    same = a is b
    if not len(a) or not len(b):
        return
    stack = [(0, np.array([[0, len(a), 0, len(b), 0]], np.int64))]
    while stack:
        depth, nodes = stack.pop()
        if len(nodes) > FRONTIER:
            stack += [(depth, part) for part in np.array_split(nodes, -(-len(nodes) // FRONTIER))]
            continue
        small = ((nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2]) <= 32) | (depth == 64)
        yield from _compare(a, b, nodes[small], budget, same)
        nodes = nodes[~small]
        if not len(nodes):
            continue
        keep = np.uint64(((1 << 64) - 1) ^ ((1 << (64 - depth)) - 1))
        bit = np.uint64(1 << (63 - depth))
        middle = [np.clip(np.searchsorted(x, (x[nodes[:, lo]] & keep) | bit), nodes[:, lo], nodes[:, lo + 1]) for x, lo in ((a, 0), (b, 2))]
        parts = []
        for left in (0, 1):
            for right in (0, 1):
                child = nodes.copy()
                child[:, 1 - left], child[:, 3 - right] = middle[0], middle[1]
                child[:, 4] += left != right
                good = (child[:, 0] < child[:, 1]) & (child[:, 2] < child[:, 3]) & (child[:, 4] <= budget)
                parts.append(child[good & (child[:, 0] <= child[:, 2])] if same else child[good])
        stack.append((depth + 1, np.concatenate(parts)))


def _compare(a: np.ndarray, b: np.ndarray, nodes: np.ndarray, budget: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    sizes = (nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2])
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // PAIRS)) + 1
    for part, size in zip(np.split(nodes, cuts), np.split(sizes, cuts)):
        row = np.repeat(np.arange(len(part)), size)
        k = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        wide = (part[:, 3] - part[:, 2])[row]
        i, j = part[row, 0] + k // np.maximum(wide, 1), part[row, 2] + k % np.maximum(wide, 1)
        near = np.bitwise_count(a[i] ^ b[j]) <= budget
        if same:
            near &= i < j
        if near.any():
            yield i[near], j[near]


def _join_cell(cell: pd.DataFrame, budget: int) -> pd.DataFrame:
    """A spanning forest of the links of one cell: what holds its components together."""
    values = cell["fp"].to_numpy().view(np.uint64)
    home = cell["home"].to_numpy()
    own, guests = np.sort(values[home]), np.sort(values[~home])
    root, n = np.arange(len(own) + len(guests)), len(own)
    src, dst = [], []
    for other, shift in ((own, 0), (guests, n)):
        for i, j in trie_links(own, other, budget):
            j = j + shift
            while True:
                u, v = root[i], root[j]
                apart = u != v
                if not apart.any():
                    break
                i, j, u, v = i[apart], j[apart], u[apart], v[apart]
                high, first = np.unique(np.maximum(u, v), return_index=True)
                root[high] = np.minimum(u, v)[first]
                src.append(i[first])
                dst.append(j[first])
                while not np.array_equal(up := root[root], root):
                    root = up
    everything = np.concatenate([own, guests]).view(np.int64)
    pick = lambda x: everything[np.concatenate(x)] if x else np.empty(0, np.int64)
    return pd.DataFrame({"src": pick(src), "dst": pick(dst)})


def trie_self_join(fingerprints: DataFrame, budget: int = 3) -> DataFrame:
    """``(src, dst)``: links of ``fingerprints(fp)``, distinct bigints, that connect what is near.

    The trie is cut at a depth that leaves about ``CELL`` fingerprints to a cell. A cell meets
    every cell whose prefix is within the budget, each pair of cells once, on a side chosen by a
    parity rule that spreads the work; pairs further apart are pruned before any data move. In a
    task, the two subtries are traversed together (``trie_links``). Only the links of a spanning
    forest leave a task, so a large family costs as many rows as it has members.

    Fingerprints are distinct, and there are 43,745 within three bits of a given one, so near copies of one text don't fill a cell
    without bound, however many they are.
    """
    count = fingerprints.count()
    depth = max(DEPTHS[0], min(DEPTHS[1], math.ceil(math.log2(max(1, count) / CELL))))
    masks = [sum(1 << i for i in bits) for k in range(1, budget + 1) for bits in combinations(range(depth), k)]
    literal = "array(" + ",".join(f"{m}L" for m in masks) + ")"
    own = fingerprints.select("fp", F.expr(f"shiftrightunsigned(fp, {64 - depth})").alias("cell"))
    guests = own.select("fp", F.expr(f"explode(filter({literal}, m -> ((cell & (m & -m)) <> 0) = (bit_count(cell & ~m) % 2 = 1)))").alias("mask"), "cell")
    rows = own.select("cell", "fp", F.lit(True).alias("home")).union(guests.select((F.col("cell").bitwiseXOR(F.col("mask"))).alias("cell"), "fp", F.lit(False)))
    return rows.groupBy("cell").applyInPandas(lambda cell: _join_cell(cell, budget), "src long, dst long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = 3, budget: int = 3) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every document.

    A-Z is lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, shingles are ``ngram`` words joined by
    one space, repeats included; a text with fewer words is one shingle. Shingles hash by XXH64
    with seed 42. Documents whose fingerprints differ in ``budget`` bits at most are linked, and
    ``component_id`` is the smallest id reachable.

    Null and empty texts have fingerprint zero and are linked like any other. Copies share a
    fingerprint and are folded before the join; repeated rows stay. Null ids keep their row and
    never name a component unless it has no other id. Texts of any length are hashed whole. Other columns are ignored. An empty table gives
    an empty result.
    """
    ids = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = np.array([fingerprint(x, ngram) for x in batch["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": values})

    prints = settled(ids.mapInPandas(score, ids.select("doc_id").withColumn("fp", F.lit(0).cast("long")).schema))
    distinct = settled(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    roots = connected_components(trie_self_join(distinct.select("fp"), budget))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = settled(rooted.join(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("fp", "component_id"))
    return skew_join(prints, named, ["fp"], distinct.select("fp", "n")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
