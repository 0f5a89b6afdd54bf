import random
import re
from collections import Counter, defaultdict

import pytest

from tidemark.llm import ngram_join
from tidemark.llm.ngram_join import ngram_groups


def brute(rows, percent=80):
    """(n_shingles, smallest doc_id reachable) of each row, by the definition."""
    sets = []
    for _, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    inverted = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            inverted[g].append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        for j, k in Counter(j for g in s for j in inverted[g] if j < i).items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    low = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            low[root(i)] = min(doc_id, low.get(root(i), doc_id))
    return sorted(((-1 if r[0] is None else r[0]), len(sets[i]), low.get(root(i), -1)) for i, r in enumerate(rows))


def got(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in df.collect())


def near_copies(rng, words, count, size, edits, passage=()):
    base = rng.choices(words, k=size)
    for _ in range(count):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(size)] = rng.choice(words) + str(rng.randrange(100))
        yield " ".join([*own, *passage])


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_brute_force(make_docs, words, odd_texts, seed, monkeypatch):
    monkeypatch.setattr(ngram_join, "SKETCH_BITS", (8, 10))  # many shingles share a counter, as at scale
    rng = random.Random(seed)
    passage = rng.choices(words, k=60)
    texts = [*odd_texts, *odd_texts[:8]]
    texts += near_copies(rng, words, 120, 70, 3) if seed == 1 else near_copies(rng, words, 60, 300, 9)
    texts += near_copies(rng, words, 12, 40, 2, passage)
    texts += [" ".join(rng.choices(words, k=rng.randint(1, 25)) + passage) for _ in range(80)]
    texts += [" ".join(rng.choices(words, k=rng.randint(3, 200))) for _ in range(60)]
    texts += [texts[-1].upper(), texts[-1].replace(" ", "\n")] * 10
    rng.shuffle(texts)
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(5, "one two three"), (5, "four five six seven eight nine"), (None, "one two three"), (None, "zero"), (None, None)]
    assert got(ngram_groups(make_docs(rows))) == brute(rows)


def test_extra_columns_and_an_empty_table(make_docs):
    docs = make_docs([(1, "a b c d e f"), (2, "A b c d e f")]).selectExpr("*", "1 AS node", "2 AS n", "'x' AS component_id")
    assert got(ngram_groups(docs)) == [(1, 2, 1), (2, 2, 1)]
    assert ngram_groups(make_docs([])).count() == 0


def test_links_are_counted_whole(make_docs, words, odd_texts):
    rng = random.Random(5)
    texts = [*odd_texts, *near_copies(rng, words, 60, 70, 5), *(" ".join(rng.choices(words, k=30)) for _ in range(20))]
    texts += [texts[-1].upper()] * 3 + [texts[-30]] * 2
    sets = []
    for t in texts:
        w = [x.lower() for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    want = [sum(i != j and 10 * len(s & o) >= 8 * len(s | o) > 0 for j, o in enumerate(sets)) for i, s in enumerate(sets)]
    docs = make_docs(list(enumerate(texts)))
    counted = sorted((r.doc_id, r.n_links) for r in ngram_groups(docs, links=True).collect())
    assert counted == list(enumerate(want)) and max(want) > 10
    assert "n_links" not in ngram_groups(docs).columns
