import zlib

import numpy as np
from tokenizers import Tokenizer

from tidemark.llm.packing import pack, sequences
from tidemark.llm.tokens import Encoder, default_vocabulary


def plain():
    t = Tokenizer.from_file(default_vocabulary())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_ids_of_whole_texts(odd_texts, words):
    whole, enc = plain(), Encoder(default_vocabulary())
    for text in [*odd_texts, ", ".join(words), "\n".join(words), " ".join(w.upper() + "!?" for w in words)]:
        assert np.frombuffer(enc.encode(text), dtype="<u4").tolist() == whole(text), text


def test_added_tokens_are_those_of_the_plain_call(words):
    whole, enc, mark = plain(), Encoder(default_vocabulary()), "<|endoftext|>"
    texts = [mark, mark * 3, f"{mark} a", f"a {mark}", f"a{mark}b", f"a {mark} b c", f"\n{mark}\n", f"{mark}\n a", f"one two{mark}. three", f"{mark[:-1]} a", f"a {mark[1:]}", "<|endof text|> x", f"{' '.join(words)} {mark} {' '.join(words)}"]
    for text in [*texts, *reversed(texts)]:
        assert np.frombuffer(enc.encode(text), dtype="<u4").tolist() == whole(text), text
    assert whole(f"{mark} a") == [50256, 257]


def test_every_id_lies_in_one_piece(spark, make_docs, odd_texts, words):
    texts = [*odd_texts, *(" ".join(words[i : i + 60]) for i in range(0, 300, 10))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "again"), (3, "again"), (None, "no id")]
    length, whole = 64, plain()
    pieces = pack(make_docs(rows).selectExpr("*", "doc_id AS place", "1 AS part"), length=length, with_ids=True)
    got = pieces.toPandas()
    sizes = got.groupby("sequence_id").length.sum()
    assert (sizes.sort_index()[:-1] == length).all() and sizes.index.tolist() or len(sizes)
    assert sorted(sizes.index) == list(range(len(sizes)))
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]]
    for i, t in enumerate(texts):
        if i == 3:
            continue
        own = got[got.doc_id == i].sort_values("start")
        ids = [x for p in own.ids for x in p]
        assert ids == [*whole(t), 0] and set(own.doc_tokens) == {len(ids)} and own.start.tolist() == [0, *own.length.cumsum()[:-1]]
        assert own.ids_crc32.tolist() == [zlib.crc32(np.array(p, dtype="<u4").tobytes()) for p in own.ids]
    assert got.doc_id.isna().sum() == 1 and (got.doc_id == 3).sum() >= 3
    packed = sequences(pieces, length).toPandas().sort_values("sequence_id")
    assert all(len(x) == length for x in packed.ids) and packed.n_ids.tolist() == sizes.sort_index().tolist()


def test_an_empty_table_has_no_pieces(make_docs):
    assert pack(make_docs([])).count() == 0
