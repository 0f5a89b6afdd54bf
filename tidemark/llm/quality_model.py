"""Quality classifier: n-gram indicators scaled by class log-count ratios, and a linear hinge-loss model on them.

The n-grams are a text's byte trigrams (hashed) and its pairs of equal neighbouring words. Naive Bayes gives each n-gram
the ratio r = log((p + a) / |p + a|) - log((q + a) / |q + a|) of its document counts in the two classes. A text is the
vector of r over the n-grams that it holds, scaled to about unit length; a linear support vector machine (squared hinge loss) is fitted to those by dual
coordinate descent. A logistic curve, fitted to margins of rows that the model hasn't seen, turns margins into scores.

Training uses a bounded sample of labelled rows (per_class, a parameter; the rows with the smallest hash of doc_id), of
which each is a bit an n-gram: 8 KB, however long its text. One task fits the model, and only that reaches the driver.
Scoring is one pass over whole texts, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import PIECE, as_batch, bounded_batches, encoded, slices, word_hashes

BITS = 16
#: A word that follows itself is a feature, at each of these shares of all neighbouring pairs.
REPEATS = (0.0, 0.1, 0.3)
FEATURES = (1 << BITS) + len(REPEATS)
#: Added to a text's squared norm, so that a few n-grams don't weigh like many.
DAMPING = 200.0


def features(text: bytes, seen: np.ndarray) -> np.ndarray:
    """Sorted numbers of the n-grams in text. seen is a zeroed scratch array of FEATURES booleans, zeroed again after."""
    pairs = equal = 0
    for at in range(0, max(len(text), 1), PIECE):
        b = np.frombuffer(text[max(0, at - 2) : at + PIECE], dtype=np.uint8).astype(np.uint32)
        if len(b) > 2:
            code = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
            seen[(code * np.uint32(2654435761)) >> np.uint32(32 - BITS)] = True
        words = word_hashes(b.astype(np.uint8), lower=False)[0]
        pairs, equal = pairs + max(len(words) - 1, 0), equal + int((words[1:] == words[:-1]).sum())
    for k, share in enumerate(REPEATS):
        seen[(1 << BITS) + k] = equal > share * pairs
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


@dataclass
class Model:
    """weight (per n-gram, times its ratio), square (of the ratio), bias of the margin; slope and shift of its logistic curve."""

    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        norm = float(self.square[found].sum())
        return self.bias + float(self.weight[found].sum()) / (norm + DAMPING) ** 0.5

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.shift, -50, 50))))


class Packed(Sequence):
    """The n-grams of rows that are held as bits, and with ratios each row's values, of about unit length."""

    def __init__(self, bits: list[bytes], ratios: np.ndarray | None = None):
        self.bits, self.ratios = bits, ratios

    def __len__(self) -> int:
        return len(self.bits)

    def __getitem__(self, i: int) -> np.ndarray:
        found = np.flatnonzero(np.unpackbits(np.frombuffer(self.bits[i], dtype=np.uint8)))
        if self.ratios is None:
            return found
        r = self.ratios[found]
        return r / np.sqrt((r**2).sum() + DAMPING)


def log_count_ratios(rows: Sequence[np.ndarray], labels: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    counts = np.full((2, FEATURES), alpha)
    for found, y in zip(rows, labels, strict=True):
        counts[int(y), found] += 1
    counts /= counts.sum(axis=1, keepdims=True)
    return np.log(counts[1]) - np.log(counts[0])


def dual_coordinate_descent(rows: Sequence[np.ndarray], values: Sequence[np.ndarray], labels: np.ndarray, cost: float, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise |w|^2 / 2 + sum of C_y max(0, 1 - y (w x + b))^2 (Hsieh et al., 2008). Classes weigh alike."""
    y = np.where(labels > 0, 1.0, -1.0)
    share = {s: len(y) / (2 * max(1, (y == s).sum())) for s in (1.0, -1.0)}
    half = np.array([1 / (2 * cost * share[s]) for s in y])
    w, b, dual = np.zeros(FEATURES), 0.0, np.zeros(len(y))
    q = np.array([v @ v + 1 for v in values]) + half
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            found, value = rows[i], values[i]
            gradient = y[i] * (w[found] @ value + b) - 1 + half[i] * dual[i]
            new = max(dual[i] - gradient / q[i], 0.0)
            if new != dual[i]:
                step = (new - dual[i]) * y[i]
                w[found] += step * value
                b += step
                dual[i] = new
    return w, b


def _logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the likeliest logistic curve, with targets drawn in a little as Platt does."""
    up, down = (labels > 0).sum(), (labels == 0).sum()
    if not up or not down:
        return 1.0, 0.0
    t = np.where(labels > 0, (up + 1) / (up + 2), 1 / (down + 2))
    x, beta = np.stack([margins, np.ones(len(margins))], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        beta = beta - np.clip(np.linalg.solve(h, x.T @ (p - t) + 1e-3 * (beta - [1, 0])), -2, 2)
    return float(max(beta[0], 1e-3)), float(beta[1])


def fit(bits: list[bytes], labels: np.ndarray, cost: float = 1.0, epochs: int = 12, seed: int = 0) -> Model:
    """A fifth of the rows sets the logistic curve, the others the model. Without rows of both classes, every score is the same."""
    labels = np.asarray(labels)
    kept = np.arange(len(bits)) % 5 != 0
    if len(set(labels[kept].tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Model(np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 1.0, float(np.log(share / (1 - share))))
    train, rest = ([x for x, k in zip(bits, kept, strict=True) if k == own] for own in (True, False))
    r = log_count_ratios(Packed(train), labels[kept])
    w, b = dual_coordinate_descent(Packed(train), Packed(train, r), labels[kept], cost, epochs, seed)
    model = Model(w * r, r**2, b, 1.0, 0.0)
    model.slope, model.shift = _logistic(np.array([model.margin(x) for x in Packed(rest)]), labels[~kept])
    return model


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """doc_id, quality, bits (binary) of at most per_class labelled rows of each class: one row for each pick, however many rows repeat its doc_id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).distinct()
    picked = [known.where(F.col("quality") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    sample = F.broadcast(picked[0].union(picked[1]))  # at most 2 per_class rows
    schema = "doc_id long, quality int, bits binary"

    def run(batches):
        seen, bits = np.zeros(FEATURES, dtype=bool), np.zeros(FEATURES, dtype=bool)
        for whole in batches:
            for batch in slices(whole, 256):
                rows = []
                for i, q, t in zip(*(c.to_pylist() for c in batch.columns[:2]), encoded(batch.column("text").to_pylist()), strict=True):
                    found = features(t, seen)
                    bits[found] = True
                    rows.append((i, q, np.packbits(bits).tobytes()))
                    bits[found] = False
                yield as_batch(rows, schema)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id").select("doc_id", "quality", "text")
    return texts.mapInArrow(run, schema).groupBy("doc_id", "quality").agg(F.min("bits").alias("bits"))


def trained(rows: DataFrame) -> Model:
    """The model of training_rows, fitted in one task: its rows have a bound."""

    def run(pdf):
        pdf = pdf.sort_values(["doc_id", "quality"])
        pdf = pdf.iloc[np.random.default_rng(0).permutation(len(pdf))]
        m = fit(pdf["bits"].tolist(), pdf["quality"].to_numpy())
        return pd.DataFrame({"weight": [m.weight.tobytes()], "square": [m.square.tobytes()], "bias": [m.bias], "slope": [m.slope], "shift": [m.shift]})

    got = rows.groupBy(F.lit(0).alias("all")).applyInPandas(run, "weight binary, square binary, bias double, slope double, shift double").collect()
    return Model(*(np.frombuffer(bytes(x)) for x in got[0][:2]), *got[0][2:]) if got else fit([], np.zeros(0))


def is_held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = 2000, threshold: float = 0.3, *keep: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs (doc_id, text), and the columns of docs named in keep.

    labels has doc_id and quality (0 or 1; other values and nulls are ignored). Labels of rows with crc32(doc_id) mod 5
    equal to 0 aren't used. Null and empty texts have no n-grams and get the model's bias as their margin. Repeated rows
    are scored each; a null doc_id is scored like any other. An empty docs table gives no rows; without labels of both
    classes every score is the same. No column but text bears on a score.
    """
    bounded_batches(docs.sparkSession)
    model = trained(training_rows(docs, labels.where(~is_held_out()), per_class))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        seen = np.zeros(FEATURES, dtype=bool)
        for whole in batches:
            for batch in slices(whole, 256):
                scores = [sent.value.score(features(t, seen)) for t in encoded(batch.column("text").to_pylist())]
                rest = [batch.column(c) for c in range(batch.num_columns - (not keep_text))]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(scores, type=pa.float64())], schema=None, names=[*batch.schema.names[: len(rest)], "score"])

    keep_text = "text" in keep
    others = [c for c in keep if c not in ("doc_id", "text", "score")]
    frame = docs.select("doc_id", *others, "text")
    kept = frame if keep_text else frame.drop("text")
    schema = kept.withColumn("score", F.lit(0.0)).schema
    out = frame.mapInArrow(run, schema)
    return out.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *[c for c in kept.columns if c != "doc_id"])
