import zlib

import numpy as np
import pytest

from tests import oracle
from tidemark.llm import queries
from tidemark.llm.language_id import _chain_gradients, fit, labelled, language_scores, marginals, training_sequences, words_of_bytes

SMALL = "/root/testdata/sf0.01"


def slow_marginals(e, transition):
    """All label sequences, weighed one by one."""
    n, size = e.shape
    p = np.zeros((n, size))
    for code in range(size**n):
        y = [code // size**k % size for k in range(n)]
        w = np.exp(sum(e[t, y[t]] for t in range(n)) + sum(transition[a, b] for a, b in zip(y, y[1:], strict=False)))
        for t in range(n):
            p[t, y[t]] += w
    return p / p.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("block", [1, 2, 3, 32])
def test_forward_backward_equals_all_label_sequences(block):
    rng = np.random.default_rng(block)
    lengths = [1, 7, 0, 4, 6]
    e, transition = rng.normal(size=(sum(lengths), 3)) * 2, rng.normal(size=(3, 3))
    ends = np.cumsum(lengths)
    want = np.concatenate([slow_marginals(e[b - n : b], transition) for n, b in zip(lengths, ends, strict=True) if n])
    assert np.allclose(marginals(e, transition, np.array(lengths), block), want)
    # Scores far apart and a long chain keep their sums finite.
    far = marginals(np.where(np.arange(40_000)[:, None] % 2 == np.arange(2), 400.0, -400.0), np.eye(2) * 30, np.array([40_000]))
    assert np.isfinite(far).all() and np.allclose(far.sum(axis=1), 1)


def test_gradients_equal_differences_of_the_likelihood():
    rng = np.random.default_rng(3)
    e, transition, labels = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3)), rng.integers(0, 3, (2, 4))
    there = np.array([[True] * 4, [True, True, False, False]])

    def loss(e, transition):
        out = 0.0
        for s in range(2):
            n = there[s].sum()
            score = lambda y: sum(e[s, t, y[t]] for t in range(n)) + sum(transition[a, b] for a, b in zip(y, y[1:], strict=False))
            out += np.log(sum(np.exp(score([c // 3**k % 3 for k in range(n)])) for c in range(3**n))) - score(list(labels[s, :n]))
        return out

    scores, pairs = _chain_gradients(e, transition, labels, there)
    for at in [(0, 0, 1), (0, 3, 2), (1, 1, 0), (1, 3, 1)]:
        d = np.zeros(e.shape)
        d[at] = 1e-5
        assert abs((loss(e + d, transition) - loss(e - d, transition)) / 2e-5 - scores[at]) < 1e-6
    for at in [(0, 0), (1, 2), (2, 1)]:
        d = np.zeros((3, 3))
        d[at] = 1e-5
        assert abs((loss(e, transition + d) - loss(e, transition - d)) / 2e-5 - pairs[at]) < 1e-6


def test_features_know_words_and_ends():
    w = words_of_bytes(b" Abc ab\t1 \xc3\xa9\n")
    assert len(w) == 4 and w.letters.tolist() == [True, True, False, True] and len(w.grams) == 8
    assert w.affixes[0][0] == words_of_bytes(b"abcd x").affixes[0][0] and w.affixes[1][0] == words_of_bytes(b"xabc").affixes[1][0]
    assert len(words_of_bytes(b"")) == 0 and len(words_of_bytes(b" \n ")) == 0


def test_words_of_a_switching_text_get_their_own_languages():
    rng = np.random.default_rng(5)
    vocabulary = {"aa": ["kata", "kiru", "mano", "tori", "saka", "hano"], "bb": ["strx", "glorb", "vrent", "schtz", "blurn", "drumf"]}
    say = lambda k, n: " ".join(rng.choice(vocabulary[k], n))
    pieces = [(say(k, 30), k, 2 * i + (k == "bb")) for i in range(40) for k in vocabulary]
    m = fit([t.encode() for t, *_ in pieces], [k for _, k, _ in pieces], [i for *_, i in pieces])
    mixed = f"{say('aa', 20)} 17 {say('bb', 20)}".encode()
    (_, p, letters), = labelled(m, [mixed])
    assert p.argmax(axis=1).tolist() == [0] * 20 + [int(p[20].argmax())] + [1] * 20 and letters.sum() == 40
    assert m.transition[0, 0] > m.transition[0, 1] and m.transition[1, 1] > m.transition[1, 0]


def test_held_out_texts_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = queries.op13_language_id(spark, SMALL).collect()
    assert len(got) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    picked = training_sequences(docs, 10, 30).groupBy("lang").count().collect()
    assert {r.lang for r in picked} == set(truth.values()) and all(r["count"] <= 30 for r in picked)


def test_odd_rows_and_columns_that_must_not_matter(spark, make_docs, odd_texts):
    base = spark.read.parquet(f"{oracle.DIR}/documents.parquet").limit(80).collect()
    odd = [*odd_texts, "12 !? 34", "½²", "word " * 100_000, "x" * 300_000]
    rows = [(r.doc_id, r.text) for r in base] + [(10_000 + i, t) for i, t in enumerate(odd)] + [(10_001, "la la"), (10_001, "la la"), (None, "la la")]
    of = {r.doc_id: r.lang for r in base}

    def run(other):
        kind = "doc_id long, text string, lang string, score string, known int"
        docs = spark.createDataFrame([(i, t, of.get(i) if not other or zlib.crc32(str(i).encode()) % 4 != 2 else "zz", "clash", 1) for i, t in rows], kind)
        return sorted(((-1 if r.doc_id is None else r.doc_id, r.lang_pred, r.score) for r in language_scores(docs, 100, 200).collect()))

    got = run(False)
    assert len(got) == len(rows) and got == run(True)  # a held-out row's lang bears on nothing
    none = [None, "", " ", "\n", "12 345.6 -7", "12 !? 34", "½²"]
    for i, t in enumerate(odd):
        pred, score = next(x[1:] for x in got if x[0] == 10_000 + i and (i != 1 or x[1] == "und"))
        assert (pred == "und" and score == 0) if t in none or not any(map(str.isalpha, t)) else pred in set(of.values())


def test_nothing_to_learn_from(spark, make_docs):
    assert language_scores(make_docs([])).count() == 0
    docs = make_docs([(1, "some words"), (2, None)]).selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert [(r.lang_pred, r.score) for r in language_scores(docs).collect()] == [("und", 0.0)] * 2
    alone = {r.doc_id: (r.lang_pred, r.score) for r in language_scores(make_docs([(1, "some words"), (2, "12"), (3, "more")])).collect()}
    assert alone == {1: ("en", 1.0), 2: ("und", 0.0), 3: ("en", 1.0)}


def test_long_texts_are_labelled_in_pieces_and_chains(monkeypatch):
    rng = np.random.default_rng(2)
    say = lambda k, n: " ".join(rng.choice(["kata", "kiru", "mano"] if k == "aa" else ["strx", "glorb", "vrent"], n))
    pieces = [(say(k, 30), k, 2 * i + (k == "bb")) for i in range(30) for k in ("aa", "bb")]
    m = fit([t.encode() for t, *_ in pieces], [k for _, k, _ in pieces], [i for *_, i in pieces])
    texts = [f"{say('aa', 400)}\n{say('bb', 900)}".encode(), b"", say("bb", 7).encode(), b"x" * 3000]
    whole = [p for _, p, _ in labelled(m, texts)]
    monkeypatch.setattr("tidemark.llm.language_id.PIECE", 500)
    monkeypatch.setattr("tidemark.llm.shared.PIECE", 500)
    pieced = list(labelled(m, texts))
    assert [i for i, *_ in pieced] == [0, 1, 2, 3] and all(np.allclose(a, b) for a, (_, b, _) in zip(whole, pieced, strict=True))
    monkeypatch.setattr("tidemark.llm.language_id.CHAIN", 64)
    cut = [p for _, p, _ in labelled(m, texts)]
    assert [len(p) for p in cut] == [1300, 0, 7, 1] and (cut[0].argmax(axis=1) == whole[0].argmax(axis=1)).mean() > 0.99
