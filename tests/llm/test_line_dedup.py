import random

import numpy as np
import pytest

from tidemark.llm import line_dedup as L
from tidemark.llm.line_dedup import Lines, line_dedup
from tidemark.llm.shared import mix

SPACE = " \t\n\x0b\x0c\r"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def brute(rows, min_chars):
    """Text of each row without the lines that have an earlier equal or nearly equal one; rows are in order of doc_id."""
    seen, out = [], []
    for i, text in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        kept, lines = [], text.split("\n")
        for line in lines:
            t = line.strip(SPACE)
            if len(t) < min_chars:
                kept.append(line)
                continue
            if not any(one_edit(t, s) for s in seen):
                kept.append(line)
            seen.append(t)
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def edited(rng, line):
    i, c = rng.randrange(len(line)), rng.choice("abcxyzé本🎉")
    return rng.choice([line[:i] + line[i + 1 :], line[:i] + c + line[i:], line[:i] + c + line[i + 1 :]])


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(make_docs, words, odd_texts, seed):
    rng = random.Random(seed)
    base = [" ".join(rng.choices(words, k=rng.randint(2, 14))) for _ in range(40)] + ["aaaaaaaaaaaaaaaa", "é本🎉 é本🎉 é本🎉 é本🎉 é本🎉", "item number 1 of the list"]
    rows = list(enumerate(odd_texts))
    for i in range(100, 220):
        lines = [rng.choice(base) for _ in range(rng.randint(0, 5))]
        lines = [edited(rng, edited(rng, x)) if rng.random() < 0.3 else edited(rng, x) if rng.random() < 0.5 else x for x in lines]
        rows.append((i, "\n".join([*lines, " " + " ".join(rng.choices(words, k=9)) + "\t", "short", ""])))
    rows += [(400 + i, f"item number {i} of the list") for i in range(60)]
    got = line_dedup(make_docs(rows).selectExpr("*", "1 AS n_lines", "2 AS h"), min_chars=10).collect()
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got if r.text is not None) == [x for x in brute(rows, 10) if x[1] is not None]
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in got)
    assert [(r.n_lines, r.n_removed) for r in got if r.text is None] == [(0, 0)]


def test_repeated_rows_and_null_keys(make_docs):
    line = "a line that is long enough to count"
    got = line_dedup(make_docs([(None, line), (2, line), (2, line), (5, line + "!")])).collect()
    assert sorted((r.doc_id is None, r.text) for r in got) == [(False, ""), (False, ""), (False, line), (True, "")]
    assert line_dedup(make_docs([])).count() == 0


def test_rows_keep_their_numbers_when_scans_are_split_anew(spark, make_docs, words, monkeypatch):
    rng = random.Random(3)
    base = [" ".join(rng.choices(words, k=9)) for _ in range(30)]
    rows = [(i, "\n".join([base[i % 30], " ".join(rng.choices(words, k=9))] if i % 3 else [base[i % 30]])) for i in range(90)]
    docs, suspects, key = make_docs(rows, files=6), L._suspects, "spark.sql.files.maxPartitionBytes"

    def split_anew(*args):
        spark.conf.set(key, "600b")
        return suspects(*args)

    monkeypatch.setattr(L, "_suspects", split_anew)
    try:
        got = line_dedup(docs)
        assert sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()) == brute(rows, 20)
    finally:
        spark.conf.unset(key)


def test_variant_hashes_are_those_of_the_texts(words):
    texts = ["\n".join(words[i : i + 7]) + "\n  x" + words[i] + "  " for i in range(0, 60, 7)]
    lines = Lines(texts, 3)
    known = {}
    for i in range(len(lines.a)):
        t = lines.text(i)
        assert texts[lines.owner[i]].split("\n")[lines.place[i]].strip(SPACE) == t
        for k, v in enumerate(lines.variants(i).tolist()):
            s = t if k == len(t) else t[:k] + t[k + 1 :]
            assert known.setdefault(s, v) == v
        assert lines.variants(i)[-1] == lines.hashes()[0][i]
    assert len(set(known.values())) == len(known) and mix(np.zeros(1, dtype=np.uint64))[0] == 0
