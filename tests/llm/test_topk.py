import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk
from tidemark.llm.topk import best, levels, statistics, top_k


def brute(rows, k=10, every=7):
    ok = [(i, [math.floor(x * 1024) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in ok:
        if i % every == 0:
            got = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in ok if j != i and len(v) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(got)]
    return sorted(out)


@pytest.mark.parametrize("dim", [5, 16])
def test_equals_brute_force(spark, dim, monkeypatch):
    monkeypatch.setattr(topk, "ROW_BLOCK", 60)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 10)
    monkeypatch.setattr(topk, "TOGETHER", 4)
    monkeypatch.setattr(topk, "FIRST", 2)
    rng = random.Random(dim)
    rows = [(i, [rng.gauss(0, 1) for _ in range(dim)]) for i in range(300)]
    rows += [(i, rows[3][1]) for i in range(300, 360)]  # ties and copies
    rows += [(400, None), (401, []), (402, [None] * dim), (403, [float("nan")] * dim), (404, [float("inf")] + [0.0] * (dim - 1)), (None, [1.0] * dim), (405, [1.0]), (406, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("dim", F.lit("x")).withColumn("cell", F.lit(0))
    got = top_k(df, F.col("vec_id") % 7 == 0)
    assert sorted(map(tuple, got.collect())) == brute(rows)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]


def test_fewer_candidates_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert top_k(spark.createDataFrame([], schema), F.col("vec_id") % 7 == 0).count() == 0
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 0.5])], schema)
    assert [tuple(r) for r in top_k(df, F.col("vec_id") % 7 == 0).collect()] == [(0, 1, 1, 2 * 1024 * 1024)]


def test_queries_that_share_an_id(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (1, [3.0, 1.0]), (2, [1.0, 2.0])]
    got = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=1, scale=1).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 3), (0, 1, 2, 2)]


def test_bounds_hold_at_every_level():
    rng = np.random.default_rng(1)
    for dim in (1, 2, 5, 20, 64):
        a, b = rng.integers(-500, 500, (40, dim)), rng.integers(-500, 500, (30, dim))
        for s in levels(dim):
            (am, ad), (bm, bd) = statistics(a, s), statistics(b, s)
            assert (am @ bm.T + ad @ bd.T + 1e-3 >= a @ b.T).all()


def pairs_left(rows, queries):
    left = []
    found = best(queries, [(i,) for i in range(len(queries))], np.arange(-len(queries), 0), np.full(len(queries), -np.inf), rows, np.arange(len(rows)), 10, left)
    score = queries @ rows.T
    assert [(x[1], x[2]) for x in found] == [(int(j), int(score[i, j])) for i in range(len(queries)) for j in np.lexsort((np.arange(len(rows)), -score[i]))[:10]]
    return [n / left[0] for n in left]


def test_bounds_prune():
    """Of smooth, clustered vectors the coarse levels leave little; of vectors without structure only the fine levels prune."""
    rng = np.random.default_rng(2)
    centres = np.cumsum(rng.normal(0, 1, (200, 64)), axis=1)
    rows = np.concatenate([np.rint(1024 * (c + rng.normal(0, 0.3, (40, 64)))) for c in centres]).astype(np.int64)
    shares = pairs_left(rows, rows[::100])
    assert shares[len(topk.COARSE)] < 0.05 and shares[-1] < 0.01
    noise = rng.normal(0, 1, (8000, 64))
    noise = np.floor(1024 * noise / np.linalg.norm(noise, axis=1, keepdims=True)).astype(np.int64)
    shares = pairs_left(noise, noise[:40])
    assert shares[-1] < 0.01 and shares[-3] < 0.1


def test_a_row_that_very_many_repeat_is_bounded_and_still_counts_k_times(spark):
    rng = random.Random(4)
    rows = [(i, [float(rng.randint(-3, 3)) for _ in range(6)]) for i in range(40)]
    hot = (500, [4.0] * 6)
    df = spark.createDataFrame([*rows, *[hot] * 3000, *[(7, rows[7][1])] * 4], "vec_id long, embedding array<double>")
    kept = topk.distinct_rows(df, 1024, 10).groupBy("vec_id").count().collect()
    assert {r.vec_id: r["count"] for r in kept} == {**{i: 1 for i in range(40)}, 7: 5, 500: 10}
    # More than k copies of a row can't show; equal query rows are one query.
    want = brute([*rows, *[hot] * 10, *[(7, rows[7][1])] * 4])
    assert sorted(map(tuple, top_k(df, F.col("vec_id") % 7 == 0).collect())) == sorted(set(want))
