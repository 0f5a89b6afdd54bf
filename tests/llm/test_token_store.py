import zlib
from types import SimpleNamespace

import numpy as np
import pytest

from tidemark.llm import tokens
from tidemark.llm.token_store import build_index, find, lookup, mix, read_store, write_store
from tests.llm.test_packing import plain


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 5000])
def test_the_index_is_minimal_and_perfect(n):
    h = mix(np.arange(n, dtype=np.uint64) * np.uint64(3))
    seeds, slots = build_index(h)
    assert sorted(slots) == list(range(n))
    prints = np.zeros(n, dtype="<u4")
    prints[slots] = (h & np.uint64(0xFFFFFFFF)).astype("<u4")
    assert [find(x, seeds, prints) for x in h.tolist()] == slots.tolist()
    others = mix(np.arange(10**6, 10**6 + 500, dtype=np.uint64))
    assert all(find(x, seeds, prints) is None for x in others.tolist())


def test_round_trip(spark, make_docs, odd_texts, words, tmp_path):
    texts = [*odd_texts, *(" ".join(words[i : i + 50]) for i in range(0, 300, 7))]
    rows = [(7 * i, t) for i, t in enumerate(texts)] + [(14, "a"), (14, "a"), (None, "x y"), (None, None)]
    docs, path, whole = make_docs(rows), str(tmp_path / "store"), plain()
    write_store(docs, path, shard_ids=500)
    got = read_store(spark, path).toPandas().sort_values("start")
    assert len(got) == len(rows) and got.start.tolist() == [0, *got.n_tokens.cumsum()[:-1]]
    ids = got.doc_id.tolist()
    assert [x is None or x != x for x in ids[:3]] == [True, True, False] and ids[2:] == sorted(ids[2:])
    expected = sorted((-1 if i is None else i, len(e := [*whole(t), 2]), zlib.crc32(np.array(e, dtype="<u4").tobytes())) for i, t in rows)
    assert sorted(zip(got.doc_id.fillna(-1).astype(int), got.n_tokens, got.ids_crc32, strict=True)) == expected

    asked = lookup(spark, path, spark.createDataFrame([(14,), (21,), (21,), (22,), (None,)], "doc_id long")).toPandas()
    assert sorted(asked.doc_id.fillna(-1).astype(int)) == [-1, -1, 14, 14, 14, 21]
    assert list(asked[asked.doc_id == 21].ids.iloc[0]) == [*whole(texts[3]), 2]
    every = lookup(spark, path, docs.select("doc_id")).toPandas().sort_values("start")
    assert every.start.tolist() == got.start.tolist() and [len(x) for x in every.ids] == got.n_tokens.tolist()
    assert lookup(spark, path, spark.createDataFrame([(-5,), (22,), (10**9,)], "doc_id long")).count() == 0


def test_an_empty_table(spark, make_docs, tmp_path):
    write_store(make_docs([]), str(tmp_path / "none"))
    assert read_store(spark, str(tmp_path / "none")).count() == 0
    assert lookup(spark, str(tmp_path / "none"), spark.createDataFrame([(1,)], "doc_id long")).count() == 0


def test_a_key_whose_rows_fill_several_parts(spark, make_docs, tmp_path):
    rows = [(5, f"text {i}") for i in range(400)] + [(1, "a"), (9, "b")]
    path = str(tmp_path / "hot")
    write_store(make_docs(rows), path, shard_ids=50)
    assert spark.read.parquet(f"{path}/manifest").where("low <= 5 AND high >= 5").count() > 1
    got = lookup(spark, path, spark.createDataFrame([(5,), (9,)], "doc_id long")).toPandas()
    assert sorted(got.doc_id) == [5] * 400 + [9] and got.start.nunique() == 401


class Counted:
    """A tokenizer whose calls are counted."""

    def __init__(self, tokenizer):
        self.tokenizer, self.calls = tokenizer, 0

    def __getattr__(self, name):
        self.calls += name.startswith("encode")
        return getattr(self.tokenizer, name)


def test_new_pieces_of_a_batch_are_encoded_together(monkeypatch, words):
    whole, load = plain(), tokens.Tokenizer.from_file
    monkeypatch.setattr(tokens, "Tokenizer", SimpleNamespace(from_file=lambda path: Counted(load(path))))
    enc = tokens.Encoder(tokens.default_vocabulary())
    enc.tokenizer.calls = 0
    texts = ["\n".join(words), " ".join(f"{w}{i}," for i, w in enumerate(words)), "\n".join(f"{w.title()}!" for w in words), " ".join(words) + " " + "x" * 100]
    for _ in range(2):
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in enc.encode_many(texts)] == [whole(t) for t in texts]
    assert enc.tokenizer.calls < 10  # not one a piece; the long piece again each time
    # What isn't remembered leaves nothing behind.
    monkeypatch.setattr(tokens, "REMEMBERED", 0)
    size = enc.pool.entries, enc.pool.used, len(enc.known)
    more = [" ".join(w[::-1] + "q" for w in words), "y" * 70]
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in enc.encode_many(more)] == [whole(t) for t in more]
    assert (enc.pool.entries, enc.pool.used, len(enc.known)) == size
