import re
from collections import Counter, defaultdict
from itertools import permutations

from pyspark.sql import functions as F

from tidemark.llm.filter_audit import Limits, filter_audit, mask_cells

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


def brute(docs, labels):
    """Every order applied to the documents themselves, one step after another."""
    fails = []
    for i, text, source in docs:
        t = text or ""
        w = WORD.findall(t)
        f = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t))}
        f["E"] = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs)
        fails.append((source or "", f, any(k == i and q == 1 for k, q, _ in labels if i is not None), any(k == i and x == 1 for k, _, x in labels if i is not None)))
    out, removed_by = {}, Counter()
    for part in {p for p, *_ in fails}:
        own = [x for x in fails if x[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for k, f in enumerate(order):
                removed, kept = [x for x in left if x[1][f]], [x for x in left if not x[1][f]]
                redundant = sum(x[1][f] for x in own) - len(removed)
                alone = sum(x[1][f] and sum(x[1].values()) == 1 for x in own)
                out[part, order, k + 1] = [len(kept), len(removed), redundant, alone, sum(x[2] for x in removed), sum(x[3] for x in removed)]
                removed_by[part, f] += len(removed)
                left = kept
    return {key: (*v, removed_by[key[0], key[1][key[2] - 1]]) for key, v in out.items()}


def found(df):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in df.collect()}


def test_orders_equal_those_applied_one_by_one(spark, make_docs, words):
    long, few = " ".join(words[:80]), " ".join(words[:5] * 20)
    texts = [long, long, few, long.upper(), f"{long} #", "short", "", None, " \t\n", few + " |", "SHOUT " * 60, "# | *", "é" * 60 + " A B C", long + "\x0b\x0cend", "x" * 200_000, "w " * 50_000]
    rows = [(i, t, ["a", "b", None, ""][i % 4]) for i, t in enumerate(texts)]
    rows += [(20, long, "a"), (3, long, "b"), (3, long, "b"), (None, long, "a"), (None, "fresh text", None), (21, "fresh text", "c"), (-5, few, "d")]
    labels = [(0, 1, 0), (1, 1, 1), (3, 0, 1), (4, 1, None), (6, None, 1), (7, 1, 1), (7, 0, 0), (20, 1, 0), (None, 1, 1), (99, 1, 1)]
    docs = make_docs(rows).withColumns({"mask": F.lit("clash"), "part": F.lit(1), "n": F.lit(2), "digest": F.lit(3)})
    assert found(filter_audit(docs, spark.createDataFrame(labels, LABELS))) == brute(rows, labels)


def test_empty_tables_and_columns(spark, make_docs):
    labels = spark.createDataFrame([], LABELS)
    out = filter_audit(make_docs([]), labels)
    assert out.count() == 0
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    one = found(filter_audit(make_docs([(1, None)]), labels))
    assert len(one) == 600 and one["a", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120) and one["a", "BACDE", 1][0] == 1


def test_limits_are_parameters(spark, make_docs):
    cells = mask_cells(make_docs([(1, "a b c"), (2, "a a a @")]), spark.createDataFrame([], LABELS), Limits(words=2, distinct_percent=50, symbols="[@]"))
    assert {(r["mask"], r["n"]) for r in cells.collect()} == {(0, 1), (8, 1)}


def test_copies_meet_as_counts_and_no_python_runs(spark, make_docs):
    docs = make_docs([(i, "same text here") for i in range(2000)] + [(5000 + i, f"text {i}") for i in range(50)], files=8)
    out = filter_audit(docs, spark.createDataFrame([], LABELS))
    got = defaultdict(int)
    for r in out.where("filter_order = 'EABCD' AND step = 1").collect():
        got[r.part] += r.removed
    assert sum(got.values()) == 1999
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
