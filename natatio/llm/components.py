"""Connected components of a distributed edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natatio.llm.shared import stored

#: Edges that are left to one task, at most.
FEW = 1 << 14


def _finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``(node, to)`` of all nodes of a few edges: the least node that each reaches."""
    up: dict = {}

    def top(x):
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x

    for batch in batches:
        for a, b in zip(batch["src"], batch["dst"]):
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    yield pd.DataFrame([(x, top(x)) for x in list(up)], columns=["node", "to"])


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node that has an edge in ``edges(src, dst)``.

    Each round, a node joins the neighbour (or itself) with the smallest hash, and the edges
    are contracted; the hash changes with the round, so that chains shrink by a constant
    factor and the number of rounds grows with the logarithm of the longest path. Once ``FEW`` edges
    are left, one task finishes them. Roots are
    arbitrary members. Self links and repeated edges are ignored; an empty table gives an empty
    result. Groups are folded by ``min``, which combines before the shuffle, so a hub is no
    bottleneck. Joins are by merge, so that no table goes through the driver to be broadcast. Each
    round's tables are written and read again: a checkpoint would carry the optimizer's constraints along, which multiply with the rounds.
    """
    edges = stored(edges.select("src", "dst").where("src <> dst").distinct(), "edges")
    kind = edges.schema["src"].dataType.simpleString()
    mapping, turn = edges.select(F.col("src").alias("node"), F.col("src").alias("root")).limit(0), 0
    while left := edges.limit(FEW + 1).count():
        if left <= FEW:
            step = edges.repartition(1).mapInPandas(_finish, f"node {kind}, to {kind}")
        else:
            both = edges.union(edges.select("dst", "src"))
            order = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)), F.col(c).alias("id"))  # noqa: B023,E731
            step = both.groupBy(F.col("src").alias("node")).agg(F.min(F.least(order("src"), order("dst"))).alias("to")).select("node", F.col("to.id").alias("to"))
        step = stored(step, "step")
        known = mapping.join(step.withColumnRenamed("node", "root").hint("merge"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        mapping = stored(known if turn else step.withColumnRenamed("to", "root"), "mapping")
        if left <= FEW:
            break
        one = edges.join(step.select(F.col("node").alias("src"), F.col("to").alias("a")).hint("merge"), "src")
        edges = stored(one.join(step.select(F.col("node").alias("dst"), F.col("to").alias("b")).hint("merge"), "dst").where("a <> b").select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct(), "edges")
        turn += 1
    return mapping
