"""Periodic run detection: every maximal repetition among a text's words, by power-of-two names.

Karp, Miller and Rosenberg: a name of level k stands for a block of 2**k words, and equal blocks have equal names. Names of
level k + 1 are the ranks of pairs of names of level k; a block that occurs once in its text has a name of its own and is
never sorted again. How far two positions agree (LCE) is read off by going down the levels, forwards and backwards.

A run of period q, long enough to count, holds two places q apart of a grid as wide as its least length less q. So for each
q only the grid's places that agree with the place q further on are extended, to the run's ends: n / q places a period,
n log n in all. Names come from sorting, not from hashes, so that no result is a matter of chance.

Texts of a batch lie in one array, with a separator of its own after each, so that NumPy handles them together.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import bounded_batches, encoded, slices

#: Words handled together, and grid places extended together; a longer text is handled alone.
WORDS, PLACES = 1 << 18, 1 << 18
#: Rows of which a task holds the words at a time.
ROWS = 256
SCHEMA = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def block_names(words: np.ndarray) -> list[np.ndarray]:
    """Names of the blocks of 1, 2, 4, ... words at each place, up to the longest that occurs twice; words are small numbers.

    Places whose block ends beyond the array have names of their own.
    """
    n, levels = len(words), [words]
    again = np.bincount(words)[words] > 1
    while True:
        h = 1 << (len(levels) - 1)
        at = np.flatnonzero(again[: n - h] & again[h:]) if n > h else np.zeros(0, dtype=np.int64)
        below = levels[-1].astype(np.int64)
        pair = below[at] * (2 * n + 1) + below[at + h]
        order = np.argsort(pair)
        rank = np.cumsum(np.concatenate(([0], np.diff(pair[order]) != 0))) if len(at) else order
        number = np.empty(len(at), dtype=np.int64)
        number[order] = rank
        often = np.bincount(number)[number] > 1 if len(at) else np.zeros(0, dtype=bool)
        if not often.any():
            return levels
        names = np.arange(n, 2 * n, dtype=np.int32)
        names[at[often]] = number[often]
        again = np.zeros(n, dtype=bool)
        again[at[often]] = True
        levels.append(names)


def agreement(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
    """How many words from i on equal those from j on (i < j), or with back, up to i - 1 and j - 1.

    Blocks twice as long as the longest with names never agree, so each level counts once at most.
    """
    n, far = len(levels[0]), np.zeros(len(i), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        h, names = 1 << k, levels[k]
        a, b = (i - far - h, j - far - h) if back else (i + far, j + far)
        inside = (a >= 0) & (b + h <= n)
        same = names[np.where(inside, a, 0)] == names[np.where(inside, b, 0)]
        far += np.where(inside & same, h, 0)
    return far


def maximal_runs(words: np.ndarray, longest: int, least: int = 12) -> np.ndarray:
    """(start, length, period) of every run, sorted by start, then period. longest is the most words of a text.

    A run is a stretch of at least least words, and of two periods, that can't be extended; its period is its smallest.
    """
    levels, n, found = block_names(words), len(words), np.zeros((0, 3), dtype=np.int64)
    pending, size = [], 0

    def extended() -> np.ndarray:
        i, q = (np.concatenate(x) for x in zip(*pending, strict=True))
        ahead, behind = agreement(levels, i, i + q), agreement(levels, i, i + q, back=True)
        length = ahead + behind + q
        ok = length >= np.maximum(least, 2 * q)
        out = np.concatenate((found, np.stack([(i - behind)[ok], length[ok], q[ok]], axis=1)))
        # A stretch is also found with the multiples of its period; the smallest counts.
        out = out[np.lexsort((out[:, 2], out[:, 1], out[:, 0]))]
        first = np.ones(len(out), dtype=bool)
        first[1:] = (np.diff(out[:, :2], axis=0) != 0).any(axis=1)
        return out[first]

    for q in range(1, longest // 2 + 1):
        step = max(least - q, q)
        at = np.flatnonzero(words[: n - q : step] == words[q::step][: len(range(0, n - q, step))]) * step
        if len(at):
            pending.append((at, np.full(len(at), q)))
            size += len(at)
        if size > PLACES:
            found, pending, size = extended(), [], 0
    if pending:
        found = extended()
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def word_numbers(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All words as numbers that are equal for equal words of one text only, a separator after each text; and the texts' starts."""
    numbers = count()
    parts, starts, at = [], [], 0
    for words in texts:
        known = defaultdict(numbers.__next__)
        parts += [np.fromiter(map(known.__getitem__, words), dtype=np.int32, count=len(words)), np.array([next(numbers)], dtype=np.int32)]
        starts.append(at)
        at += len(words) + 1
    return np.concatenate(parts), np.array(starts)


def text_runs(texts: list[list[bytes]], least: int = 12) -> Iterator[np.ndarray]:
    """Each text's runs, as maximal_runs has them, with starts counted in its own words."""
    words, starts = word_numbers(texts)
    found = maximal_runs(words, max(map(len, texts)), least)
    of = np.searchsorted(starts, found[:, 0], side="right") - 1
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    for k in range(len(texts)):
        yield found[cuts[k] : cuts[k + 1]] - [starts[k], 0, 0]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words but those that a run holds after its first period, joined by spaces."""
    if not len(runs):
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)])


def _groups(texts: list[list[bytes]]) -> Iterator[list[int]]:
    """Positions of texts of alike lengths that together have about WORDS words; each text is in one group."""
    now, size = [], 0
    for i in sorted(range(len(texts)), key=lambda i: len(texts[i])):
        if now and size + len(texts[i]) > WORDS:
            yield now
            now, size = [], 0
        now.append(i)
        size += len(texts[i]) + 1
    if now:
        yield now


def periodic_runs(docs: DataFrame, least: int = 12, *keep: str) -> DataFrame:
    """The columns of docs named in keep, and n_words, runs (start, length, period; by start, then period) and collapsed of each row.

    Words are what white space (space, \\t to \\r) separates, compared as they are. collapsed is the text without what its
    runs repeat, its words joined by single spaces. A null or empty text, and one of white space, has no words, no runs and
    an empty collapsed text. Rows are handled one by one, repeated ones too; an empty table gives no rows. Columns that
    aren't named in keep don't matter. One pass, no shuffle; a task holds a batch of texts and, for the longest of them,
    4 bytes a word for each level whose blocks repeat.
    """
    bounded_batches(docs.sparkSession)
    kept = [c for c in keep if c not in ("n_words", "runs", "collapsed", "__text")]
    frame = docs.select(*kept, F.col("text").alias("__text"))
    item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for whole in batches:
            for batch in slices(whole, ROWS):
                texts = [t.split() for t in encoded(batch.column(len(kept)).to_pylist())]
                runs = [np.zeros((0, 3), dtype=np.int64)] * len(texts)
                for group in _groups(texts):
                    for i, r in zip(group, text_runs([texts[i] for i in group], least), strict=True):
                        runs[i] = r
                flat, ends = np.concatenate(runs), np.cumsum([len(r) for r in runs])
                items = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(item))
                found = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), type=pa.int32()), items)
                left = pa.array([collapsed(t, r).decode("utf-8", "replace") for t, r in zip(texts, runs, strict=True)], type=pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array([len(t) for t in texts], type=pa.int64()), found, left], names=[*kept, "n_words", "runs", "collapsed"])

    fields = ", ".join(f"`{c}` {t}" for c, t in frame.drop("__text").dtypes)
    return frame.mapInArrow(run, f"{fields}, {SCHEMA}" if kept else SCHEMA)
