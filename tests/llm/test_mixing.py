import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.mixing import mix_sources, poisson_steps, source_rates, uniform
from tidemark.llm.shared import row_keys


def copies(u, rate):
    k, p, total = 0, math.exp(-rate), math.exp(-rate)
    while total <= u:
        k += 1
        p *= rate / k
        total += p
    return k


def brute(rows, shares, seed=0):
    size, total = Counter(), 0
    for _, text, source in rows:
        size[source] += len(text or "")
    mass = {s: shares(s, n) if n else 0 for s, n in size.items()}
    total = sum(size.values())
    out = []
    for i, _, source in rows:
        rate = 1.0 if not size[source] else mass[source] / sum(mass.values()) * total / size[source]
        u = int(hashlib.md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:13], 16) / 2**52
        out += [(-1 if i is None else i, str(source), c + 1) for c in range(copies(u, rate))]
    return sorted(out)


@pytest.fixture(scope="module")
def rows(words, odd_texts):
    texts = [*odd_texts, *(" ".join(words[i % 50 : i % 50 + 9]) for i in range(400))]
    out = [(i, t, "hot" if i % 3 == 0 else None if i % 17 == 1 else f"s{i % 7}") for i, t in enumerate(texts)]
    return [*out, (5, "again", "s5"), (None, "no id", "hot"), (None, "no id", "hot"), (900, None, "empty"), (901, "", "empty")]


@pytest.mark.parametrize("weights", [None, {"hot": 3.0, "s1": 1.0, "absent": 2.0}])
def test_copies_equal_brute_force(make_docs, rows, weights):
    shares = (lambda s, n: n**0.5) if weights is None else (lambda s, n: weights.get(s, 0.0))
    out = mix_sources(make_docs(rows).selectExpr("*", "9 AS copy"), weights)
    got = out.collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, str(r.source), r.copy) for r in got) == brute(rows, shares)
    parts = out.withColumn("p", F.spark_partition_id()).collect()
    assert all(a.shuffle_key <= b.shuffle_key for a, b in zip(parts, parts[1:], strict=False) if a.p == b.p)
    assert [r.doc_id for r in got] != sorted((r.doc_id or -1) for r in got)


def test_shares_come_near_their_targets(make_docs, words):
    rows = [(i, words[i % 300] * 5, "hot" if i % 3 else "rare") for i in range(6000)]
    docs = make_docs(rows)
    rates = {r.source: r.rate for r in source_rates(docs, {"hot": 1.0, "rare": 1.0}).collect()}
    assert rates["hot"] < 1 < rates["rare"]
    size = Counter()
    for r in mix_sources(docs, {"hot": 1.0, "rare": 1.0}).collect():
        size[r.source] += len(r.text)
    assert abs(size["hot"] / sum(size.values()) - 0.5) < 0.03 and abs(sum(size.values()) / sum(len(r[1]) for r in rows) - 1) < 0.05


@pytest.mark.parametrize("rate", [0.0, 0.01, 1.0, 7.5, 900.0])
def test_inversion(spark, rate):
    df = spark.range(4000).select(uniform(3, F.col("id")).alias("u")).withColumn("steps", poisson_steps(F.lit(rate))).select(F.size(F.filter("steps", lambda c: c <= F.col("u"))).alias("k"))
    k = np.array([r.k for r in df.collect()])
    assert abs(k.mean() - rate) <= 4 * math.sqrt(max(rate, 1e-9) / 4000) and abs(k.var() - rate) <= 0.15 * rate + 1e-9


def test_copies_are_dealt_alike_whatever_the_order_and_join(spark, make_docs, rows):
    """The rows of each output partition don't depend on how the input is split, on the join, or on where row keys come from."""
    docs = row_keys(make_docs(rows))

    def dealt(df):
        return sorted((str(r.doc_id), r.text or "", str(r.source), r.copy, r.p) for r in df.withColumn("p", F.spark_partition_id()).collect())

    want = dealt(mix_sources(docs, row=("__file", "__row")))
    assert "__file" not in mix_sources(docs, row=("__file", "__row")).columns
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        joined = mix_sources(docs.repartition(7), row=("__file", "__row"))
        assert dealt(joined) == want and "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    plain = mix_sources(docs.drop("__file", "__row").orderBy(F.rand(1)))
    assert sorted(x[:4] for x in dealt(plain)) == sorted(x[:4] for x in want)
    assert "monotonically" not in plain._jdf.queryExecution().toString().lower()


def test_one_row_repeated_often_spreads(make_docs):
    out = mix_sources(make_docs([(1, "same text", "a")] * 400))
    sizes = Counter(r.p for r in out.withColumn("p", F.spark_partition_id()).collect())
    assert len(sizes) > 1 and max(sizes.values()) < 0.6 * sum(sizes.values())


def test_an_empty_table(make_docs):
    assert mix_sources(make_docs([])).count() == 0
