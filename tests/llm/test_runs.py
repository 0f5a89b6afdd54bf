import hashlib
import random
import zlib

import numpy as np
import pytest

from tests import oracle
from tidemark.llm import queries
from tidemark.llm.runs import agreement, block_names, maximal_runs, periodic_runs, text_runs, word_numbers


def brute(words, least=12):
    """Runs by comparing words a period apart, period by period; a stretch counts with its smallest."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, n, q) for (s, n), q in out.items())


def left(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def samples(seed):
    rng = random.Random(seed)
    fib = ["a", "ab"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    texts = [["x"] * n for n in (0, 1, 11, 12, 13, 200)] + [list(fib[-1]), list("abc" * 40), list("abcabcabcab" * 6)]
    for _ in range(60):
        k, n = rng.choice([1, 2, 3, 5, 50]), rng.randrange(150)
        words = [str(rng.randrange(k)) for _ in range(n)]
        for _ in range(rng.randrange(4)):
            a = rng.randrange(n + 1)
            p = rng.randint(1, 15)
            words[a:a] = [str(rng.randrange(9)) for _ in range(p)] * rng.randint(2, 5)
        texts.append(words)
    return texts


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_equal_brute_force(least):
    texts = samples(least)
    got = [[tuple(map(int, r)) for r in found] for found in text_runs([[w.encode() for w in t] for t in texts], least)]
    assert got == [brute(t, least) for t in texts]


def test_places_are_extended_in_many_pieces(monkeypatch):
    monkeypatch.setattr("tidemark.llm.runs.PLACES", 7)
    texts = samples(99)
    assert [[tuple(map(int, r)) for r in found] for found in text_runs([[w.encode() for w in t] for t in texts])] == [brute(t) for t in texts]


def test_names_and_agreement():
    words = np.random.default_rng(1).integers(0, 3, 400).astype(np.int32)
    words[200:] = words[:200]
    levels = block_names(words)
    for k, names in enumerate(levels):
        h = 1 << k
        blocks = [tuple(words[i : i + h]) for i in range(len(words) - h + 1)]
        assert all((names[i] == names[j]) == (blocks[i] == blocks[j]) for i in range(0, len(blocks), 3) for j in range(0, len(blocks), 7))
    i, j = np.array([0, 3, 100, 7, 10]), np.array([200, 203, 300, 9, 399])
    def common(a, b, step):
        n = 0
        while 0 <= a + n * step and b + n * step < len(words) and words[a + n * step] == words[b + n * step]:
            n += 1
        return n
    assert agreement(levels, i, j).tolist() == [common(a, b, 1) for a, b in zip(i, j, strict=True)]
    assert agreement(levels, i, j, back=True).tolist() == [common(a - 1, b - 1, -1) for a, b in zip(i, j, strict=True)]


def test_texts_of_a_batch_never_join():
    words, starts = word_numbers([[b"a", b"b"], [], [b"b", b"a"]])
    assert starts.tolist() == [0, 3, 4] and len(set(words.tolist())) == len(words)
    assert len(maximal_runs(word_numbers([[b"a"] * 11, [b"a"] * 11])[0], 11)) == 0


def test_rows_of_a_table(make_docs, odd_texts):
    texts = [*odd_texts, "a b " * 50 + "end", "Ab ab " * 6, "x\x0by\x0cz " * 9, "wörd 日本 " * 20, "w " * 60_000, "a b c " * 20 + "d " + "a b c " * 20]
    rows = list(enumerate(texts)) + [(2, "p q " * 10), (2, "p q " * 10), (None, "p q " * 10)]
    docs = make_docs(rows).selectExpr("*", "1 AS runs", "2 AS n_words", "'z' AS collapsed")
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(docs, 12, "doc_id").collect())
    want = []
    for i, t in rows:
        w = [x.decode() for x in (t or "").encode().split()]
        runs = brute(w) if len(w) < 5000 else [(0, len(w), 1)]
        want.append((-1 if i is None else i, len(w), runs, left(w, runs)))
    assert got == sorted(want)
    out = periodic_runs(make_docs([]))
    assert out.count() == 0 and out.columns == ["n_words", "runs", "collapsed"]


def test_query_equals_the_contract_word_by_word(spark):
    rows = {}
    for r in spark.read.parquet(f"{oracle.DIR}/documents.parquet").collect():
        w = [x.decode() for x in r.text.encode().split()]
        h = zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if len(w) > 1500:
            continue
        runs = brute(w)
        top = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else None
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
        rows[r.doc_id] = (len(runs), *best, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(left(w, runs)))
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_periodic_runs(spark, oracle.DIR).collect() if r.doc_id in rows}
    assert got == rows and any(v[0] for v in rows.values())


def test_periods_leave_other_rows_alone(make_docs):
    rows = [(None, "a b c"), (7, None), (8, ""), (9, "one")]
    docs = make_docs(rows)
    assert sorted(map(str, queries.with_periods(docs).collect())) == sorted(map(str, docs.collect()))
