import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark, tmp_path_factory):
    """A stored documents table of (doc_id, text) or (doc_id, text, source) rows."""

    def make(rows, files=3):
        full = [(i, t, "en", (more or ["a"])[0], len(t) if t is not None else None) for i, t, *more in rows]
        path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
        spark.createDataFrame(full, DOCS).repartition(files).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture(scope="session")
def words():
    rng = random.Random(7)
    return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 8))) for _ in range(400)]


@pytest.fixture(scope="session")
def odd_texts():
    """Texts that break naive cutting: nulls, white space of all kinds, long words, symbols, several scripts."""
    return [None, "", " ", "a", "a b", "a  b", " a", "a ", "a\nb", "a\n b", "a \nb", "\n", "\n\nx", "a\tb", "x y", "it's 5 o'clock, isn't it?", "Grüße às öß ñandú", "日本語 テキスト です", "emoji 🎉🎉 x", "z" * 5000, "12 345.6 -7", "<|endoftext|> a", "a\r\nb", "tab\x0bv \x0cf", "word " * 3000]
