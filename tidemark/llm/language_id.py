"""Language identification: a linear-chain conditional random field that labels every word of a text with a language.

A word's features are its affixes (first and last three bytes, last four), the byte trigrams in it (its ends count as
bytes), and the lexicon of the language that it stands in, where it stands in one. Their weights and those of the
transitions between neighbouring words are learned together, by gradient steps on the likelihood of the labels, where half
of the training sequences switch from one language to another midway. Forward-backward gives each word the probability
of each language; a text's language is the one with the greatest mean probability over its words that hold letters.

Training uses a bounded sample: texts of known language with the smallest hashes of doc_id, cut into sequences, of which
again those with the smallest hashes. One task fits the model. Labelling is one pass over whole texts without a shuffle:
a chain is as long as its text, but is worked out in blocks of words that NumPy handles together. Each block gives the
matrix that takes messages from its one end to the other, and only these follow one another along a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import PIECE, batches, bounded_batches, encoded, slices, word_hashes

UNKNOWN = "und"
#: Bits of the hashed numbers of n-grams and of affixes; the features of the lexicons follow.
GRAM_BITS, AFFIX_BITS = 16, 15
GRAMS, AFFIXES = 1 << GRAM_BITS, 1 << AFFIX_BITS
#: Words of a training sequence, words of a lexicon and the documents that each must stand in, words of a
#: block, and the most words of a chain: a longer text is cut into several.
SEQUENCE, LEXICON, LEAST_TEXTS, BLOCK, CHAIN = 48, 4000, 2, 32, 1 << 18
_SPACED = np.arange(256, dtype=np.uint8)
_SPACED[[9, 10, 11, 12, 13]] = 32
_SPACED[65:91] += 32
_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = _LETTER[128:] = True


def _hashed(code: np.ndarray, bits: int, seed: int) -> np.ndarray:
    return ((code ^ np.uint32(seed)) * np.uint32(2654435761)) >> np.uint32(32 - bits)


@dataclass
class Words:
    """The words of a text: hash and whether it holds a letter, its grams (with the first one's place), three affixes, its first byte."""

    hashes: np.ndarray
    letters: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    affixes: np.ndarray
    byte: np.ndarray

    def __len__(self) -> int:
        return len(self.hashes)


def words_of_bytes(text: bytes) -> Words:
    """Case is folded for A to Z; bytes from 128 on count as letters here."""
    data = np.concatenate((np.full(1, 32, np.uint8), _SPACED[np.frombuffer(text, dtype=np.uint8)], np.full(4, 32, np.uint8)))
    inside = data != 32
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2] + 1, edge[1::2]
    at, size = np.flatnonzero(inside), end - start + 1
    wide = data.astype(np.uint32)
    grams = _hashed(wide[at - 1] << np.uint32(16) | wide[at] << np.uint32(8) | wide[at + 1], GRAM_BITS, 0)
    reach = lambda at, ok: np.where(ok, wide[np.where(ok, at, 0)], 0)
    head = wide[start] | reach(start + 1, size > 1) << np.uint32(8) | reach(start + 2, size > 2) << np.uint32(16)
    tail = wide[end] | reach(end - 1, size > 1) << np.uint32(8) | reach(end - 2, size > 2) << np.uint32(16)
    longer = tail | reach(end - 3, size > 3) << np.uint32(24)
    affixes = np.stack([_hashed(head, AFFIX_BITS, 1), _hashed(tail, AFFIX_BITS, 0x9E3779B1), _hashed(longer, AFFIX_BITS, 0x7F4A7C15)])
    first = np.cumsum(size) - size
    letters = np.bitwise_or.reduceat(_LETTER[data[at]], first) if len(start) else np.zeros(0, dtype=bool)
    return Words(word_hashes(data)[0], letters, grams, first, affixes, start - 1)


@dataclass
class Model:
    """Languages in order; weights of grams, affixes and lexicons (a column a language), of transitions (from, to); the lexicons' words."""

    languages: list[str]
    gram: np.ndarray
    affix: np.ndarray
    lexical: np.ndarray
    transition: np.ndarray
    known: np.ndarray
    of: np.ndarray

    def lexicon_of(self, hashes: np.ndarray) -> np.ndarray:
        """The number of the language in whose lexicon each word stands, or the number of languages."""
        if not len(self.known):
            return np.full(len(hashes), len(self.languages))
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.of[at], len(self.languages))

    def emissions(self, words: Words) -> np.ndarray:
        """A row of scores, one a language, of each word: the mean weight of its grams, and its other features' weights."""
        if not len(words):
            return np.zeros((0, len(self.languages)), dtype=np.float32)
        count = np.diff(np.append(words.first, len(words.grams)))[:, None]
        grams = np.add.reduceat(self.gram[words.grams], words.first, axis=0) / np.sqrt(count, dtype=np.float32)
        return grams + sum(self.affix[a] for a in words.affixes) + self.lexical[self.lexicon_of(words.hashes)]


def _scaled(scores: np.ndarray) -> np.ndarray:
    return np.exp(scores - scores.max(axis=-1, keepdims=True))


def marginals(emissions: np.ndarray, transition: np.ndarray, lengths: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Each word's probabilities (words x languages) from forward-backward along chains of the given lengths, one after another.

    Exact for chains of any length. A message is a row of L numbers, known up to a factor. Blocks of words, all at a time,
    give the products of their steps; then messages pass from block to block, all chains at a time; then each word's
    messages follow from its block's and the products up to it.
    """
    n, size = emissions.shape
    if n == 0:
        return np.zeros((0, size))
    step, e = _scaled(transition.astype(np.float64).ravel()).reshape(size, size), _scaled(emissions.astype(np.float64))
    lengths = np.asarray(lengths, dtype=np.int64)
    lengths = lengths[lengths > 0]
    blocks = -(-lengths // block)
    first_block = np.cumsum(blocks) - blocks
    total = int(blocks.sum())
    in_chain = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    row, col = np.repeat(first_block, lengths) + in_chain // block, in_chain % block
    # Blocks lie along the last axis. ahead: (state at t, state before the block); behind: (state at t, state at its end).
    grid = np.ones((block, size, total))
    grid[col, :, row] = e
    short, held = (first_block + blocks - 1), lengths - (blocks - 1) * block
    ahead, behind = np.empty((block, size, size, total)), np.empty((block, size, size, total))
    one = np.repeat(np.eye(size)[:, :, None], total, axis=2)
    now = one
    for t in range(block):
        now = (step.T @ now.reshape(size, -1)).reshape(now.shape)
        if t == 0:
            now[:, :, first_block] = 1.0  # nothing leads to a chain's first word
        now = now * grid[t][:, None]
        ahead[t] = now = now / now.max(axis=(0, 1))
    now = one
    for t in range(block - 1, -1, -1):
        behind[t] = now
        now = (step @ (grid[t][:, None] * now).reshape(size, -1)).reshape(now.shape)
        now = now / now.max(axis=(0, 1))
        now[:, :, short[held <= t]] = np.eye(size)[:, :, None]  # nothing follows a chain's last word
    # now: from the state before a block to the one at its end. Chains with more than k blocks go on.
    into, out = np.ones((size, total)), np.ones((size, total))
    for k in range(1, int(blocks.max())):
        at = first_block[blocks > k] + k
        m = np.einsum("an,ban->bn", into[:, at - 1], ahead[-1][:, :, at - 1])
        into[:, at] = m / m.max(axis=0)
        at = (first_block + blocks)[blocks > k] - k - 1
        m = np.einsum("abn,bn->an", now[:, :, at + 1], out[:, at + 1])
        out[:, at] = m / m.max(axis=0)
    p = sum(ahead[:, :, a] * into[a] for a in range(size)) * sum(behind[:, :, b] * out[b] for b in range(size))
    p = p[col, :, row]
    return p / p.sum(axis=1, keepdims=True)


def _chain_gradients(e: np.ndarray, transition: np.ndarray, labels: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of minus the log-likelihood of labels (sequences x places) in scores (sequences x places x languages) and transitions."""
    (n, width, size), step = e.shape, _scaled(transition.ravel()).reshape(transition.shape)
    g, a, b = _scaled(e), np.empty(e.shape), np.ones(e.shape)
    now = np.ones((n, size))
    for t in range(width):
        m = (now @ step if t else now) * g[:, t]
        now = np.where(there[:, t, None], m / m.max(axis=1, keepdims=True), now)
        a[:, t] = now
    now = np.ones((n, size))
    for t in range(width - 1, 0, -1):
        m = (now * g[:, t]) @ step.T
        now = np.where(there[:, t, None], m / m.max(axis=1, keepdims=True), now)
        b[:, t - 1] = now
    p = a * b
    p /= p.sum(axis=2, keepdims=True)
    seen = np.eye(size)[labels]
    pairs = a[:, :-1, :, None] * step * (g[:, 1:] * b[:, 1:])[:, :, None, :]
    pairs *= (there[:, 1:] / pairs.sum(axis=(2, 3)))[:, :, None, None]
    observed = np.einsum("nta,ntb->ab", seen[:, :-1], seen[:, 1:] * there[:, 1:, None])
    return (p - seen) * there[:, :, None], pairs.sum(axis=(0, 1)) - observed


def _lexicons(words: list[Words], labels: np.ndarray, texts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Words, sorted, and the language of each: those that stand in LEAST_TEXTS texts of one language and mostly there, LEXICON a language."""
    seen = np.unique(np.concatenate([np.stack([np.unique(w.hashes), np.full(len(np.unique(w.hashes)), (int(t) << 16) | int(y), dtype=np.uint64)], axis=1) for w, t, y in zip(words, texts, labels, strict=True)] or [np.zeros((0, 2), np.uint64)]), axis=0)
    known, number = np.unique(seen[:, 0], return_inverse=True)
    counts = np.zeros((len(known), size))
    np.add.at(counts, (number.ravel(), (seen[:, 1] & np.uint64(0xFFFF)).astype(np.int64)), 1)
    shares = (counts + 0.5) / (counts.sum(axis=0, keepdims=True) + 1)
    best, top = counts.argmax(axis=1), counts.max(axis=1, initial=0)
    weight = np.where((top >= LEAST_TEXTS) & (shares.max(axis=1, initial=0) > 0.8 * shares.sum(axis=1)), top, 0)
    keep = np.zeros(len(known), dtype=bool)
    for y in range(size):
        own = np.flatnonzero((best == y) & (weight > 0))
        keep[own[np.lexsort((known[own], -weight[own]))][:LEXICON]] = True
    return known[keep], best[keep]


def fit(texts: list[bytes], labels: list[str], of_text: list[int], epochs: int = 5, seed: int = 0) -> Model:
    """The model of sequences (at most SEQUENCE words each) with a language and the number of their text, by AdaGrad."""
    languages = sorted(set(labels))
    size, rng = len(languages), np.random.default_rng(seed)
    words, y = [words_of_bytes(t) for t in texts], np.array([languages.index(x) for x in labels], dtype=np.int64)
    # A lexicon is learned from other texts than those that teach its weight, or it would seem surer than it is.
    half = np.array(of_text, dtype=np.int64) % 2 == 0
    learned = [i for i in range(len(words)) if half[i]]
    known, of = _lexicons([words[i] for i in learned], y[half], np.array(of_text)[half], size)
    made = Model(languages, np.zeros((GRAMS, size), np.float32), np.zeros((AFFIXES, size), np.float32), np.zeros((size + 1, size), np.float32), np.zeros((size, size)), known, of)
    if size < 2:
        return made
    sums = {k: np.full(getattr(made, k).shape, 1e-2) for k in ("gram", "affix", "lexical", "transition")}
    for _ in range(epochs):
        order = rng.permutation(len(words))
        for at in range(0, len(order), 96):
            picked = order[at : at + 96]
            # Every second sequence goes on with the second half of another one, often of another language.
            other = np.where(np.arange(len(picked)) % 2 == 0, picked, rng.permutation(order)[: len(picked)])
            cuts = [[(i, slice(0, len(words[i])))] if i == j else [(i, slice(0, len(words[i]) // 2)), (j, slice(len(words[j]) // 2, len(words[j])))] for i, j in zip(picked, other, strict=True)]
            parts = [(words[i], s, y[i]) for c in cuts for i, s in c]
            ends = [np.append(w.first, len(w.grams)) for w, _, _ in parts]
            grams = np.concatenate([w.grams[e[s.start] : e[s.stop]] for (w, s, _), e in zip(parts, ends, strict=True)])
            hashes, letters, byte = (np.concatenate([getattr(w, k)[s] for w, s, _ in parts]) for k in ("hashes", "letters", "byte"))
            per_word = np.concatenate([np.diff(e[s.start : s.stop + 1]) for (_, s, _), e in zip(parts, ends, strict=True)])
            batch = Words(hashes, letters, grams, np.cumsum(per_word) - per_word, np.concatenate([w.affixes[:, s] for w, s, _ in parts], axis=1), byte)
            lengths = np.array([sum(s.stop - s.start for _, s in c) for c in cuts])
            if not len(batch):
                continue
            row = np.repeat(np.arange(len(cuts)), lengths)
            col = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            e, there, truth = np.zeros((len(cuts), lengths.max(), size)), np.zeros((len(cuts), lengths.max()), dtype=bool), np.zeros((len(cuts), lengths.max()), dtype=np.int64)
            e[row, col], there[row, col], truth[row, col] = made.emissions(batch), True, np.concatenate([np.full(s.stop - s.start, v) for _, s, v in parts])
            scores, pairs = _chain_gradients(e, made.transition, truth, there)
            own = scores[row, col] / len(cuts)
            steps = {"transition": pairs / len(cuts) + 1e-3 * made.transition}
            by_gram = np.repeat(own / np.sqrt(per_word)[:, None], per_word, axis=0)
            steps["gram"] = np.stack([np.bincount(batch.grams, weights=by_gram[:, k], minlength=GRAMS) for k in range(size)], axis=1)
            steps["affix"] = np.stack([np.bincount(batch.affixes.ravel(), weights=np.tile(own[:, k], len(batch.affixes)), minlength=AFFIXES) for k in range(size)], axis=1)
            lexicon = made.lexicon_of(batch.hashes)
            steps["lexical"] = np.stack([np.bincount(lexicon, weights=own[:, k], minlength=size + 1) for k in range(size)], axis=1)
            for k, g in steps.items():
                sums[k] += g * g
                setattr(made, k, (getattr(made, k) - 0.2 * g / np.sqrt(sums[k])).astype(getattr(made, k).dtype))
    return made


def is_held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_sequences(docs: DataFrame, texts_per_language: int, sequences_per_language: int) -> DataFrame:
    """lang, text_id, piece: at most sequences_per_language sequences of words from texts_per_language texts of each language.

    Both are picked by the hash of doc_id (and place). Rates come from counts, so that a language's many texts don't meet in
    one task: about twice as many as wanted pass, and of those the first by hash are taken. Only texts with letters count.
    """
    known = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL").where(~is_held_out()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    draw = (F.xxhash64("doc_id", F.lit(13)).bitwiseAND((1 << 53) - 1)) / F.lit(float(1 << 53))
    # A row a language: the labels of a classifier.
    some = known.join(F.broadcast(counts), "lang").where(draw * F.col("n") < 2 * texts_per_language + 20).select("doc_id", "lang").distinct()
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    some = F.broadcast(some.withColumn("__n", F.row_number().over(first)).where(F.col("__n") <= texts_per_language).drop("__n"))  # at most that many rows a language
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text").where(F.col("text").rlike(r"\p{L}")).join(some, ["doc_id", "lang"])
    texts = texts.select("lang", F.col("doc_id").alias("text_id"), words.alias("words")).where("size(words) > 0")
    place = F.explode(F.sequence(F.lit(0), F.floor((F.size("words") - 1) / SEQUENCE).cast("int")))
    pieces = texts.select("lang", "text_id", place.alias("place"), "words").select("lang", "text_id", "place", F.array_join(F.slice("words", F.col("place") * SEQUENCE + 1, F.lit(SEQUENCE)), " ").alias("piece"))
    # A sequence of usual length; whatever holds a word of thousands of letters teaches nothing.
    pieces = pieces.where(F.length("piece") <= 40 * SEQUENCE).distinct()
    first = Window.partitionBy("lang").orderBy(F.xxhash64("text_id", "place", "piece"), "text_id", "place", "piece")
    return pieces.withColumn("__n", F.row_number().over(first)).where(F.col("__n") <= sequences_per_language).select("lang", "text_id", "piece")


def trained(sequences: DataFrame) -> Model | None:
    """The model of training_sequences, fitted in one task: they have a bound. None without any."""
    arrays = {"gram": "<f4", "affix": "<f4", "lexical": "<f4", "transition": "<f8", "known": "<u8", "of": "<i8"}

    def run(pdf):
        pdf = pdf.sort_values(["lang", "text_id", "piece"])
        m = fit(encoded(pdf["piece"]), pdf["lang"].tolist(), pdf["text_id"].tolist())
        return pd.DataFrame({"languages": [m.languages]} | {k: [getattr(m, k).astype(t).tobytes()] for k, t in arrays.items()})

    schema = ", ".join(["languages array<string>", *[f"{k} binary" for k in arrays]])
    got = sequences.groupBy(F.lit(0).alias("all")).applyInPandas(run, schema).collect()  # one row
    if not got:
        return None
    size = len(got[0]["languages"])
    read = {k: np.frombuffer(bytes(got[0][k]), dtype=t) for k, t in arrays.items()}
    return Model(list(got[0]["languages"]), *(read[k].reshape(-1, size) for k in ("gram", "affix", "lexical", "transition")), read["known"], read["of"])


def _pieces(text: bytes) -> Iterator[bytes]:
    """text in parts of about PIECE bytes, cut at white space."""
    at = 0
    while len(text) - at > PIECE:
        cut = max(text.rfind(b, at, at + PIECE) for b in (b" ", b"\n", b"\t"))
        cut = cut if cut > at else min([x for b in (b" ", b"\n", b"\t") if (x := text.find(b, at + PIECE)) >= 0], default=len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def labelled(model: Model, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(position, word probabilities, whether each word holds a letter) of each text, in order; a text is one chain, or one for each CHAIN words."""
    for group in batches(texts):
        if len(group) == 1 and len(texts[group[0]]) > PIECE:
            parts = [words_of_bytes(p) for p in _pieces(texts[group[0]])]
            cuts = np.array([0, sum(map(len, parts))])
            chains = [min(CHAIN, int(cuts[1]) - a) for a in range(0, int(cuts[1]), CHAIN)]
        else:
            parts = [words_of_bytes(b" ".join(texts[i] for i in group))]
            cuts = np.concatenate(([0], np.searchsorted(parts[0].byte, np.cumsum([len(texts[i]) + 1 for i in group]))))
            chains = np.diff(cuts)
        e, letters = np.concatenate([model.emissions(w) for w in parts]), np.concatenate([w.letters for w in parts])
        if len(group) > 1:
            p = marginals(e, model.transition, chains)
        else:  # chain by chain, so that only one's messages are held
            p = np.concatenate([np.zeros((0, e.shape[1])), *[marginals(x, model.transition, [len(x)]) for x in np.split(e, np.cumsum(chains)[:-1])]])
        for k, i in enumerate(group):
            yield i, p[cuts[k] : cuts[k + 1]], letters[cuts[k] : cuts[k + 1]]


def language_scores(docs: DataFrame, texts_per_language: int = 400, sequences_per_language: int = 1500) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the mean probability of lang_pred over words with letters), shares of every row.

    docs has doc_id, text and lang; lang is read of training rows alone. shares maps each learned language to its mean
    probability, so that code-switched texts show more than one. Null texts and texts without a letter (a character of
    Unicode's category L) are `und` with score 0 and null shares, as all texts are if no language can be learned; if one
    can, all others are that one. Of languages with equal means the first in order of name counts. Rows repeat as they are;
    an empty table gives no rows. At most texts_per_language texts and sequences_per_language sequences of SEQUENCE
    words of a language teach; the model is 400 KB a language.
    """
    bounded_batches(docs.sparkSession)
    model = trained(training_sequences(docs, texts_per_language, sequences_per_language))
    known = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    frame = docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out().alias("held_out"), known.alias("known"), F.when(known, F.col("text")).alias("text"))
    if model is None:
        return frame.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("map<string,double>").alias("shares"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.map_(pa.string(), pa.float64())

    def run(frames):
        m = sent.value
        for whole in frames:
            for batch in slices(whole, 256):
                pred, score, shares = [], [], []
                for (_, p, letters), ok in zip(labelled(m, encoded(batch.column(3).to_pylist())), batch.column(2).to_pylist(), strict=True):
                    mean = p[letters].mean(axis=0) if letters.any() else p.mean(axis=0) if len(p) else np.zeros(0)
                    ok = ok and len(mean) > 0
                    pred.append(m.languages[int(mean.argmax())] if ok else UNKNOWN)
                    score.append(float(min(1.0, mean.max())) if ok else 0.0)
                    shares.append(list(zip(m.languages, mean.tolist(), strict=True)) if ok else None)
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(pred), pa.array(score, type=pa.float64()), pa.array(shares, type=kind)], names=["doc_id", "held_out", "lang_pred", "score", "shares"])

    return frame.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, shares map<string,double>")
