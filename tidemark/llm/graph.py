"""Connected components of an edge table, by joins alone."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch

#: Nodes that a task holds at once.
HELD = 1 << 19


def connected_components(edges: DataFrame, work: Scratch, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges (a long, b long); component is the smallest node reachable.

    Each task first turns its own edges into trees of depth one; large-star and small-star steps (Kiveris et al., 2014)
    then join those of all tasks. Each round is a table of work; the driver learns whether it was the last.
    Nulls and loops are ignored; an empty table gives an empty result.
    """
    e = work.stored(_own_trees(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))).distinct(), "components")
    for _ in range(max_rounds):
        if _settled(e):
            break
        e = work.stored(_small_star(_large_star(e)), "components")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    own = e.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return work.stored(e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(own.distinct()), "components")


def _own_trees(e: DataFrame) -> DataFrame:
    """Edges that join the same nodes as a task's own, each from a node to the smallest that the task knows it to reach."""

    def run(frames):
        up: dict[int, int] = {}

        def top(x):
            path = []
            while x in up:
                path.append(x)
                x = up[x]
            up.update((y, x) for y in path)
            return x

        def trees():
            return pd.DataFrame([(x, top(x)) for x in list(up)], columns=["u", "v"]).astype("int64")

        for pdf in frames:
            for u, v in zip(pdf["u"].tolist(), pdf["v"].tolist(), strict=True):
                a, b = top(u), top(v)
                if a != b:
                    up[max(a, b)] = min(a, b)
                if len(up) >= HELD:
                    yield trees()
                    up.clear()
        yield trees()

    return e.mapInPandas(run, "u long, v long")


def _settled(e: DataFrame) -> bool:
    """Whether every u has one v, and no v is a u."""
    ends = e.select(F.col("u").alias("x"), "v").union(e.select(F.col("v").alias("x"), F.lit(None).cast("long").alias("v")))
    return ends.groupBy("x").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count_if(F.col("v").isNull()).alias("ends")).where("low <> high OR low IS NOT NULL AND ends > 0").isEmpty()


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of u is tied to the smallest of u and its neighbours."""
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the smallest of them."""
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    inner = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return inner.union(low.select("u", F.col("m").alias("v"))).distinct()
