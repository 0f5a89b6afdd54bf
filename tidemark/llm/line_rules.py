"""Quality rules, lines first: each line is judged by punctuation, navigation and boilerplate rules, failing lines are
removed, and a document that loses too much of its text is rejected. Plain counts of the whole text are kept beside.

Everything is a column expression over one scan: no shuffle, no Python on the executors. A text's repeated word windows
are found within its row, by sorting the hashes of its windows (xxhash64), so the cost is n log n in its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space, symbols, the ends of a sentence, and phrases of boilerplate.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
SENTENCE_END = r"""[.!?:;…。！？"”»)\]']$"""
BOILERPLATE = r"all rights reserved|copyright|©|cookie|privacy policy|terms of (use|service)|javascript|lorem ipsum|subscribe|newsletter|click here|read more|sign (in|up)|log ?in|powered by"
NAVIGATION = r"^(home|menu|search|next|previous|back|skip to|share|contact|about|sitemap|top)\b"
WINDOW = 5


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(_without(text, characters))


def _trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE))


def _words(text: Column) -> Column:
    return F.when(_trimmed(text) == "", F.array().cast("array<string>")).otherwise(F.split(_trimmed(text), SPACES))


def line_fails(t: Column, n: Column, short: int = 6) -> Column:
    """Whether a trimmed line t of n words breaks a rule (see the constants): a short fragment without the end of a
    sentence, a row of links or a navigation entry, a boilerplate phrase in a line of at most 30 words, symbols on
    three words in ten, or exclamation marks on more than half of the words. A line without words breaks none."""
    fragment = (n < short) & ~t.rlike(SENTENCE_END)
    navigation = (_count(t, "|") >= 2) | ((n <= 4) & F.lower(t).rlike(NAVIGATION))
    boilerplate = (n <= 30) & F.lower(t).rlike(BOILERPLATE)
    noise = (_count(t, SYMBOLS) >= 3) & (_count(t, SYMBOLS) * 10 > n * 3)
    shouting = (n >= 4) & (_count(t, "!") * 2 > n)
    return (n > 0) & (fragment | navigation | boilerplate | noise | shouting)


def judged_lines(text: Column, short: int) -> Column:
    """Array of (x, n, fails): the lines of text, their words and verdicts. Each step is evaluated once a line."""
    trimmed = F.transform(F.split(text, "\n", -1), lambda x: F.struct(x.alias("x"), _trimmed(x).alias("t")))
    counted = F.transform(trimmed, lambda e: F.struct(e["x"].alias("x"), e["t"].alias("t"), F.when(e["t"] == "", 0).otherwise(F.size(F.split(e["t"], SPACES))).alias("n")))
    return F.transform(counted, lambda e: F.struct(e["x"].alias("x"), e["n"].alias("n"), line_fails(e["t"], e["n"], short).alias("fails")))


def line_rules(docs: DataFrame, max_loss_percent: int = 50, short: int = 6) -> DataFrame:
    """docs with the columns n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, kept
    (boolean), n_lines_removed, clean_chars (long) and clean_text, which replace columns of those names.

    base_failed: fewer than 10 words, or over a fifth of them in repeated windows. kept: not base_failed, and the
    failing lines hold at most max_loss_percent of the characters of all lines with words. clean_text is the text
    without its failing lines; lines without words stay. A null text has no words and no lines, and its clean_text is
    null; it and texts without words are base_failed. Other columns, repeated rows and null keys pass through.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.withColumn("__w", _words(text)).withColumn("__h", F.expr("transform(__w, w -> xxhash64(w))"))
    window = ", ".join(f"get(__h, i + {k})" for k in range(WINDOW))
    out = out.withColumn("__g", F.expr(f"CASE WHEN size(__h) > {WINDOW} THEN transform(sequence(0, size(__h) - {WINDOW}), i -> xxhash64({window})) ELSE cast(array() AS array<bigint>) END"))
    # Only texts that hold some window twice are sorted.
    sort = "sort_array(transform(__g, (g, i) -> struct(g AS g, i AS i)))"
    out = out.withColumn("__s", F.expr(f"CASE WHEN size(array_distinct(__g)) < size(__g) THEN {sort} END"))
    twice = "get(__s, j - 1).g <=> get(__s, j).g OR get(__s, j + 1).g <=> get(__s, j).g"
    out = out.withColumn("__at", F.expr(f"CASE WHEN __s IS NOT NULL THEN sort_array(transform(filter(sequence(0, size(__s) - 1), j -> {twice}), j -> get(__s, j).i)) END"))
    covered = f"{WINDOW} + aggregate(__at, struct(0L AS n, element_at(__at, 1) AS last), (a, i) -> struct(a.n + least({WINDOW}, i - a.last) AS n, i AS last), a -> a.n)"
    out = out.withColumn("__l", judged_lines(text, short))
    full = F.transform(F.filter("__l", lambda e: e["n"] > 0), lambda e: e["x"])
    lost = F.transform(F.filter("__l", lambda e: e["fails"]), lambda e: e["x"])
    out = out.withColumns({"__full": full, "__lost": lost})
    length = "aggregate({}, 0L, (n, x) -> n + length(x))"
    out = out.withColumns(
        {
            "n_words": F.size("__w").cast("long"),
            "word_chars": F.length(_without(text, SPACE)).cast("long"),
            "n_symbols": _count(text, SYMBOLS).cast("long"),
            "n_dup_lines": (F.size("__full") - F.size(F.array_distinct("__full"))).cast("long"),
            "n_repeat_words": F.coalesce(F.expr(covered), F.lit(0)).cast("long"),
            "n_lines_removed": F.size("__lost").cast("long"),
            "__all": F.expr(length.format("__full")),
            "clean_chars": F.expr(length.format("__full") + " - " + length.format("__lost")),
            "clean_text": F.when(F.col("text").isNotNull(), F.array_join(F.transform(F.filter("__l", lambda e: ~e["fails"]), lambda e: e["x"]), "\n")),
        }
    )
    out = out.withColumn("base_failed", (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20))
    out = out.withColumn("kept", ~F.col("base_failed") & ((F.col("__all") - F.col("clean_chars")) * 100 <= F.col("__all") * max_loss_percent))
    return out.drop("__w", "__h", "__g", "__s", "__at", "__l", "__full", "__lost", "__all")
