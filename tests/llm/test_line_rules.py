import re
from collections import Counter

from tidemark.llm.line_rules import line_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    twice = {g for g, n in Counter(windows).items() if n > 1}
    inside = {j for i, g in enumerate(windows) if g in twice for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside), failed


def test_counts_equal_brute_force(make_docs, odd_texts, words):
    texts = [*odd_texts, " ".join(words), " ".join(words[:8] * 3), " ".join(words[:50] + words[5:30]), "a b c d e a b c d e", "a b c d e f", "x " * 9, "Same line.\nSame line.\n \nother", "a # b * c $ | <d>", "\n".join(words[:40] * 2), "éé 日本  x y " * 4]
    texts.append(" ".join(words[i % 37] + str(i % 11) for i in range(5000)))
    rows = list(enumerate(texts)) + [(3, "again"), (None, "no id here")]
    got = line_rules(make_docs(rows).selectExpr("*", "1 AS n_words", "2 AS kept")).collect()
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert found == sorted((-1 if i is None else i, *base(t)) for i, t in rows)
    assert all(not (r.base_failed and r.kept) for r in got)


def test_failing_lines_go_and_poor_documents_are_rejected(make_docs):
    good = "The quick brown fox jumps over the lazy dog today.\nIt was a fine day for everyone in the whole town."
    nav = "Home | News | Sport | Contact | About | Login"
    rows = [(0, good), (1, f"{nav}\n{good}\nRead more"), (2, f"{good[:50]}\n" + "\n".join([nav] * 5)), (3, "THIS!! IS!! NOT!! A!! GOOD!! LINE!! AT!! ALL!! MY!! FRIEND!! SO!!"), (4, f"{good}\n\nAll rights reserved.\n"), (5, None)]
    got = {r.doc_id: r for r in line_rules(make_docs(rows)).collect()}
    assert [got[i].kept for i in range(6)] == [True, True, False, False, True, False]
    assert got[1].clean_text == good and got[1].n_lines_removed == 2 and got[0].clean_text == good
    assert got[4].clean_text == f"{good}\n\n" and got[5].clean_text is None


def test_an_empty_table_and_plan_without_python(make_docs):
    out = line_rules(make_docs([]))
    assert out.count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
