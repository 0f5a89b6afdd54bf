"""Exact top-k search by inner product with multi-resolution segment statistics.

Vectors are turned into integers, so that scores are exact. At each level a vector is cut into segments; a segment is
known by its mean m and deviation d. By Cauchy-Schwarz, with segments of length L,

    <q, x>  <=  sum over segments of L (m_q m_x + d_q d_x),

which is the same as the lower bound sum of L ((m_q - m_x)**2 + (d_q - d_x)**2) on the squared distance. Levels run from
coarse to fine: equal segments first, then ever more dimensions alone and the others in pairs. A pair goes on while its
bound reaches its query's floor, and what is left after the finest level is scored exactly. A floor is the k-th best exact
score of some rows: those of the highest bounds at some levels, and all that a first round over a part of the cells found.

Queries are a stated set. They are laid out in blocks, candidates in blocks, and each cell of that grid is one group
of bounded size; a cell gives at most k rows a query, and a ranking of those gives the result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch, parallelism

#: Equal segments of the coarse levels, and the shares of the dimensions that stand alone at the fine ones.
COARSE, ALONE = (1, 4, 16), (0.0, 0.5, 0.75, 0.875)
#: Levels whose bounds choose the rows for a floor, and how many times k of them.
SEED_LEVELS, SEEDS = (0, 3, 4), 4
#: Rows of a block of queries and of candidates, queries whose bounds are taken at once, and one in how many cells the first round takes.
QUERY_BLOCK, ROW_BLOCK, TOGETHER, FIRST = 8192, 16384, 128, 16


def quantised(vectors: DataFrame, scale: int = 1024, vector: str = "embedding") -> DataFrame:
    """vec_id, v: floor(scale * component) as long. Null or empty vectors, and those with null or non-finite components, are left out."""
    v = F.col(vector)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & good).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def levels(dim: int) -> list[np.ndarray]:
    """Where the segments of each level start, coarse to fine."""
    coarse = [np.unique(np.arange(n) * dim // n) for n in COARSE if n < dim]
    fine = [np.concatenate((np.arange(int(a * dim)), np.arange(int(a * dim), dim, 2))) for a in ALONE]
    return [x for x in [*coarse, *fine] if len(x) < dim] or [np.zeros(1, dtype=np.int64)]


def statistics(v: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(means, deviations) times the root of the segment's length, a row a vector; only deviations of segments of two or more."""
    x, sizes = v.astype(float), np.diff(np.append(starts, v.shape[1]))
    mean = np.add.reduceat(x, starts, axis=1) / sizes
    spread = np.sqrt(np.add.reduceat((x - np.repeat(mean, sizes, axis=1)) ** 2, starts, axis=1))
    return mean * np.sqrt(sizes), spread[:, sizes > 1]


def best(queries: np.ndarray, names: list, query_ids: np.ndarray, floors: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int, left: list[int] | None = None) -> list[tuple]:
    """(*name, vec_id, score) of each query's k best rows that reach its floor, but for rows of its own id; ties to the smaller vec_id.

    left, if given, gets the number of all pairs and that of the pairs left after each level added.
    """
    order = np.argsort(row_ids, kind="stable")
    rows, row_ids = rows[order], row_ids[order]
    cuts = levels(rows.shape[1])
    known = [statistics(rows, c) for c in cuts]
    norm = np.sqrt((queries.astype(float) ** 2).sum(axis=1).max(initial=0) * (rows.astype(float) ** 2).sum(axis=1).max(initial=0))
    slack, out = 1 + norm * 1e-9, []  # above the rounding of the bounds
    for at in range(0, len(queries), TOGETHER):
        q, ids, floor = queries[at : at + TOGETHER], query_ids[at : at + TOGETHER], floors[at : at + TOGETHER].copy()
        asked = [statistics(q, c) for c in cuts]
        alive = row_ids[None, :] != ids[:, None]
        counts, some = [int(alive.sum())], np.arange(len(rows))
        for level, ((qm, qd), (m, d)) in enumerate(zip(asked, known, strict=True)):
            bound = np.where(alive, qm @ m[some].T + qd @ d[some].T + slack, -np.inf)
            take = min(SEEDS * k, len(some))
            if level in SEED_LEVELS and take:
                for i, near in enumerate(np.argpartition(-bound, take - 1, axis=1)[:, :take]):
                    near = some[near[alive[i, near]]]
                    if len(near) >= k:
                        floor[i] = max(floor[i], np.partition(rows[near] @ q[i], len(near) - k)[len(near) - k])
            alive &= bound >= floor[:, None]
            counts.append(int(alive.sum()))
            used = alive.any(axis=0)
            if not used.all():
                alive, some = alive[:, used], some[used]
        if left is not None:
            left[:] = [a + b for a, b in zip(left or [0] * len(counts), counts, strict=True)]
        for i in range(len(q)):
            own = some[alive[i]]
            score = rows[own] @ q[i]
            top = np.lexsort((row_ids[own], -score))[:k]
            out += [(*names[at + i], r, s) for r, s in zip(row_ids[own[top]].tolist(), score[top].tolist(), strict=True) if s >= floor[i]]
    return out


def _scored(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """query_id, own, vec_id, score of the k best in each cell of queries (query_id, own, v, floor) and rows (vec_id, v)."""

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            q, r = np.array(left["v"].tolist(), dtype=np.int64), np.array(right["v"].tolist(), dtype=np.int64)
            floors = left["floor"].fillna(-np.inf).to_numpy(dtype=float)
            out = best(q, list(zip(left["query_id"], left["own"], strict=True)), left["query_id"].to_numpy(), floors, r, right["vec_id"].to_numpy(), k)
        return pd.DataFrame(out, columns=["query_id", "own", "vec_id", "score"]).astype("int64")

    keys = ["dim", "cell", "block"]
    return queries.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(run, "query_id long, own long, vec_id long, score long")


def distinct_rows(vectors: DataFrame, scale: int, k: int) -> DataFrame:
    """vec_id, v of quantised rows, of which equal ones are there k times at most.

    Equal rows have equal scores and ids, so k of them fill all places that more could take. They are counted with
    partial results, so a row that very many repeat is never one task's work.
    """
    counted = quantised(vectors, scale).groupBy("vec_id", "v").agg(F.least(F.count("*"), F.lit(k)).alias("n"))
    return counted.select("vec_id", "v", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")).drop("copy")


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: int = 1024) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k rows with the highest integer inner product.

    vectors has vec_id and embedding (arrays of one length; rows of another length than the query aren't its
    candidates), and other columns that are ignored. Ties go to the smaller vec_id; a query with fewer candidates gets
    all of them. Rows that repeat a vec_id are candidates each; a query's own rows (same vec_id) are none of its. Query
    rows with one vec_id but other vectors are queries each, ranked by themselves; equal ones are one query. An empty
    table, or one without queries, gives no rows. Components must fit a long after scaling, and scores too (in
    the bounds they are doubles, so that scores of 2**53 and more could be ranked by rounded floors).
    """
    work = Scratch(vectors.sparkSession)
    table = work.stored(distinct_rows(vectors, scale, k), "topk-rows").withColumn("dim", F.size("v"))
    total = table.count()
    groups = max(1, -(-total // ROW_BLOCK), min(parallelism(vectors.sparkSession), total // 256))
    asked = table.where(is_query).dropDuplicates(["vec_id", "v"]).select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("own"), F.col("v").alias("v"), F.col("dim").alias("dim"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    rows = table.withColumn("cell", F.pmod(F.xxhash64("vec_id", "v"), F.lit(groups)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    queries = asked.withColumn("block", F.pmod(F.xxhash64("query_id", "v"), F.lit(blocks)).cast("int"))
    first = lambda c: F.col(c) % FIRST == 0
    cells = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    order = Window.partitionBy("query_id", "own").orderBy(F.desc("score"), "vec_id")

    begun = work.stored(_scored(queries.withColumn("floor", F.lit(None).cast("double")).withColumn("cell", cells).where(first("cell")), rows.where(first("cell")), k), "topk-first")
    floors = begun.withColumn("place", F.row_number().over(order)).where(F.col("place") == k).select("query_id", "own", F.col("score").cast("double").alias("floor"))
    rest = queries.join(floors, ["query_id", "own"], "left").withColumn("cell", cells).where(~first("cell"))
    found = begun.union(_scored(rest, rows.where(~first("cell")), k))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
