import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm import test_line_dedup, test_mixing, test_ngram_join
from tests.llm.test_packing import plain
from tidemark.llm.packing import pack
from tidemark.llm.quality_model import quality_scores


@pytest.fixture(scope="module")
def corpus(spark, words, tmp_path_factory):
    rng = random.Random(11)
    passage = " ".join(rng.choices(words, k=55)) + "."
    rows = []
    for i in range(240):
        own = [" ".join(rng.choices(words, k=rng.randint(8, 30))) + "." for _ in range(rng.randint(1, 4))]
        text = "\n".join(own + [passage] * (i % 9 == 0)) if i % 5 else " ".join(w + "!!" for w in rng.choices(words, k=40)).upper()
        if i % 20 == 3 and i > 20:
            text = rows[i - 2][1]
        if i % 20 == 7:
            text = rows[i - 1][1].replace(".", " extra.", 1)
        rows.append((i, text, "hot" if i % 3 else f"s{i % 4}"))
    rows += [(500, None, "hot"), (501, "", None), (502, "tiny", "hot")]
    path = tmp_path_factory.mktemp("sf")
    frame = spark.createDataFrame([(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(0, 240) if i % 4], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_each_stage_does_its_work(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    names, got = docs.columns, {}
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, corpus)
        path = f"{corpus}/stage-{k}"
        out.write.parquet(path)
        got[k] = (docs, spark.read.parquet(path))
        assert k == len(P.STAGES) - 1 or out.columns == names
        docs = got[k][1]

    before, after = got[0]
    good = {r.doc_id for r in quality_scores(before, spark.read.parquet(f"{corpus}/labels.parquet"), 2000).where("predicted = 1").collect()}
    assert {r.doc_id for r in after.collect()} == good and sum(i < 240 and i % 5 == 0 for i in good) <= 2 and sum(i < 240 and i % 5 != 0 for i in good) >= 185

    before, after = got[1]
    expected = test_line_dedup.brute(sorted((r.doc_id, r.text) for r in before.where("text IS NOT NULL").collect()), 20)
    expected = sorted((i, t) for i, t, _, gone in expected if not gone or t.strip())
    assert sorted((r.doc_id, r.text) for r in after.where("text IS NOT NULL").collect()) == expected

    before, after = got[2]
    groups = test_ngram_join.brute([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == [i for i, n, c in groups if i == c or not n]

    before, after = got[3]
    rows = [(r.doc_id, r.text, r.source) for r in before.collect()]
    assert sorted(r.doc_id for r in after.collect()) == [i for i, _, _ in test_mixing.brute(rows, lambda s, n: n**0.5)]

    before, after = got[4]
    whole = plain()
    want = sorted((r.doc_id, len(x := [*whole(r.text), 0]), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for r in before.collect())
    full = pack(before, length=1 << 30).select("doc_id", "length", "ids_crc32").collect()
    cut = after.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    totals = {}
    for i, n, _ in want:
        totals[i] = totals.get(i, 0) + n
    assert sorted(map(tuple, full)) == want and {r.doc_id: r.n for r in cut} == totals


def test_near_duplicates_keep_one_row_of_each_group(spark, make_docs, words, tmp_path):
    one, two, three, four = (" ".join(words[k : k + 50]) for k in (0, 60, 120, 180))
    # Repeated ids and texts; copies without an id; a clean text that shares the id of a copy; groups with one smallest id.
    rows = [(1, one), (1, one), (1, one), (None, one), (None, two), (None, two), (7, three), (9, three), (9, four), (7, "a b"), (3, None), (3, ""), (None, "")]
    want = [(1, one), (None, two), (7, three), (9, four), (7, "a b"), (3, None), (3, ""), (None, "")]
    got = P.near_duplicates(spark, make_docs(rows), str(tmp_path))
    assert got.columns == P.COLUMNS
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(repr, want))


def test_run_gives_the_last_stage(spark, corpus):
    out = P.run(spark, corpus)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0 and [len(P.STAGES), P.ORACLE_SQL] == [5, None]
