"""Line dedup by a deletion-neighbourhood join: lines within one edit of an earlier line are removed.

A line counts trimmed of ASCII white space; lines of fewer than min_chars characters always stay. A line goes if an earlier
line (by doc_id, row, place) is equal to it or at edit distance 1 (one character inserted, deleted or replaced).

1. *Exact.* Lines with the same 128-bit hash are one; the earliest occurrence stays.
2. *Candidates.* If two lines are one edit apart, three of their four quarters agree. Each distinct line gives eight hashes of
   quarters and length class; a line goes on only if it shares one with another line. This loses no pair.
3. *Neighbourhood.* Each line that goes on emits the hash of every variant with one character deleted, with the place, and
   its own hash, all from prefix sums in linear time. Equal variants meet: a replacement meets at the same place, an
   insertion or deletion meets the other line's own hash. Only the earliest line of each meeting counts, so that a
   meeting of m lines makes m rows, not pairs.
4. *Verify.* A line and the earliest partner found for it are compared as texts; then the line is removed.

Hashes travel packed into blocks by hash range; a filter of fixed size tells each task which of its lines go on.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.membership import maybe_in, member_bits
from tidemark.llm.shared import PIECE, Scratch, as_batch, bounded_batches, mix, parallelism, powers, slices

#: Postings that a block holds before it is handed on, and that a reducer group gets, about.
BLOCK, RANGE = 1 << 19, 1 << 20
LINES = "h long, g long, file long, row long, doc_id long, place int"
KEYS = "range int, keys binary, lines binary"
VARIANTS = "range int, keys binary, places binary, lines binary, h long, g long, line string"
_SALT = np.uint64(0xA24BAED4963EE407)
_values: list[np.ndarray] = []


def _code_values() -> np.ndarray:
    if not _values:
        _values.append(mix(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return _values[0]


class Lines:
    """The long enough lines of some texts: text number, place in it, bounds, and hashes of any part from prefix sums."""

    def __init__(self, texts: list[str], min_chars: int):
        joined = "\n".join(texts) + "\n"
        self.codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.flatnonzero(self.codes == 10)
        starts = np.concatenate(([0], ends[:-1] + 1))
        sizes = np.array([len(t) + 1 for t in texts])
        firsts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        owner = np.searchsorted(firsts, starts, side="right") - 1
        place = np.arange(len(starts)) - np.searchsorted(starts, firsts)[owner]
        ink = np.flatnonzero((self.codes != 32) & ((self.codes < 9) | (self.codes > 13)))
        a, b = np.searchsorted(ink, starts), np.searchsorted(ink, ends)
        ok = b > a
        self.a, self.b = ink[a[ok]] if ok.any() else a[ok], (ink[b[ok] - 1] + 1) if ok.any() else b[ok]
        self.owner, self.place = owner[ok], place[ok]
        long = self.b - self.a >= min_chars
        self.a, self.b, self.owner, self.place = self.a[long], self.b[long], self.owner[long], self.place[long]
        up, self.down = powers(len(self.codes) + 2)
        self.sums = np.zeros(len(self.codes) + 1, dtype=np.uint64)
        np.cumsum(_code_values()[self.codes] * up[: len(self.codes)], out=self.sums[1:])

    def raw(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self.down[a]

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each line; the first is that of its own variant."""
        r, n = self.raw(self.a, self.b), (self.b - self.a).astype(np.uint64)
        return mix(r ^ n), mix((r ^ _SALT) + n * _SALT)

    def quarter_keys(self) -> np.ndarray:
        """Eight hashes a line: for both length classes, the four ways to leave out a quarter."""
        n, out = self.b - self.a, []
        for c in (n, n + 1):  # lengths c - 1 and c are in class c
            q = (c - 1) // 4
            for left in range(4):
                head, tail = self.raw(self.a, self.a + left * q), self.raw(self.b - (3 - left) * q, self.b)
                out.append(mix(mix(head + np.uint64(left)) + tail + c.astype(np.uint64) * _SALT))
        return np.stack(out, axis=1)

    def variants(self, i: int) -> np.ndarray:
        """Hashes of line i with the character at each place deleted, and last its own."""
        a, b = int(self.a[i]), int(self.b[i])
        n = np.uint64(b - a)
        cut = (self.sums[a:b] - self.sums[a]) * self.down[a] + (self.sums[b] - self.sums[a + 1 : b + 1]) * self.down[a + 1]
        return np.append(mix(cut ^ (n - np.uint64(1))), mix(self.raw(self.a[i : i + 1], self.b[i : i + 1]) ^ n))

    def text(self, i: int) -> str:
        return self.codes[self.a[i] : self.b[i]].tobytes().decode("utf-32-le", "surrogatepass")


def _grouped(batches, min_chars):
    """(keys of the rows, doc_ids, Lines) for about PIECE characters at once."""
    for whole in batches:
        for batch in slices(whole, 2048):
            *keys, ids, texts = (c.to_pylist() for c in batch.columns)
            rows = list(zip(*keys, strict=True))
            texts = [t or "" for t in texts]
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= PIECE):
                    size += len(texts[end])
                    end += 1
                yield rows[at:end], ids[at:end], Lines(texts[at:end], min_chars)
                at = end


def _split_by_range(keys: np.ndarray, ranges: int):
    """Sorted order of keys, and (range, from, to) of each range in it."""
    order = np.argsort(keys, kind="stable")
    r = (((keys[order] >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(r)) + 1
    return order, [(int(r[a]), a, b) for a, b in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(r)])), strict=True)] if len(r) else []


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("__file").alias("file"), F.col("__row").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def _line_table(docs: DataFrame, min_chars: int) -> DataFrame:
    def run(batches):
        for rows, ids, lines in _grouped(batches, min_chars):
            h, g = (x.view(np.int64).tolist() for x in lines.hashes())
            yield as_batch([(x, y, *rows[o], ids[o], p) for x, y, o, p in zip(h, g, lines.owner.tolist(), lines.place.tolist(), strict=True)], LINES)

    return _texts(docs).mapInArrow(run, LINES)


def _suspects(docs: DataFrame, min_chars: int, ranges: int) -> DataFrame:
    """h of the lines that share a quarter key with another line."""

    def post(batches):
        keys, owners, held, seen = [], [], 0, set()

        def flush():
            k, o = np.concatenate(keys), np.concatenate(owners)
            order, parts = _split_by_range(k, ranges)
            k, o = k[order], o[order]
            return as_batch([(r, k[a:b].tobytes(), o[a:b].tobytes()) for r, a, b in parts], KEYS)

        for _, _, lines in _grouped(batches, min_chars):
            h = lines.hashes()[0]
            new = []
            for i, x in enumerate(h.tolist()):
                if x not in seen:
                    seen.add(x)
                    new.append(i)
            if new:
                keys.append(lines.quarter_keys()[new].ravel())
                owners.append(np.repeat(h[new], 8))
                held += 8 * len(new)
            if held >= BLOCK:
                yield flush()
                keys, owners, held = [], [], 0
        if held:
            yield flush()

    def meet(pdf):
        import pandas as pd

        k = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in pdf["keys"]])
        o = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in pdf["lines"]])
        order = np.lexsort((o, k))
        k, o = k[order], o[order]
        other = (k[1:] == k[:-1]) & (o[1:] != o[:-1])
        # Any line of a key that two lines hold: the key's first and last line differ.
        first = np.concatenate(([True], k[1:] != k[:-1]))
        group = np.cumsum(first) - 1
        mixed = np.zeros(group[-1] + 1 if len(k) else 0, dtype=bool)
        mixed[group[1:][other]] = True
        return pd.DataFrame({"h": np.unique(o[mixed[group]]).view(np.int64)})

    return _texts(docs).mapInArrow(post, KEYS).groupBy("range").applyInPandas(meet, "h long").distinct()


def _variants(docs: DataFrame, suspects: DataFrame, min_chars: int, ranges: int) -> DataFrame:
    """Blocks of (variant, place, h), and the suspects' texts in rows of their own (range null)."""
    table = docs.sparkSession.sparkContext.broadcast(member_bits(suspects.select(F.col("h").alias("node")), suspects.count()))

    def run(batches):
        keys, places, owners, held, seen = [], [], [], 0, set()

        def flush():
            k, p, o = np.concatenate(keys), np.concatenate(places), np.concatenate(owners)
            order, parts = _split_by_range(k, ranges)
            k, p, o = k[order], p[order], o[order]
            return as_batch([(r, k[a:b].tobytes(), p[a:b].tobytes(), o[a:b].tobytes(), None, None, None) for r, a, b in parts], VARIANTS)

        for _, _, lines in _grouped(batches, min_chars):
            h, g = lines.hashes()
            texts = []
            for i in np.flatnonzero(maybe_in(h, table.value)).tolist():
                x = int(h[i])
                if x in seen:
                    continue
                seen.add(x)
                v = lines.variants(i)
                keys.append(v)
                places.append(np.append(np.arange(len(v) - 1, dtype=np.int32), np.int32(-1)))
                owners.append(np.full(len(v), h[i]))
                held += len(v)
                texts.append((None, None, None, None, int(h.view(np.int64)[i]), int(g.view(np.int64)[i]), lines.text(i)))
                if held >= BLOCK:
                    yield flush()
                    keys, places, owners, held = [], [], [], 0
            if texts:
                yield as_batch(texts, VARIANTS)
        if held:
            yield flush()

    return _texts(docs).mapInArrow(run, VARIANTS)


def _meetings(blocks: DataFrame) -> DataFrame:
    """(variant, place, h) of the variants that two lines hold."""

    def meet(pdf):
        import pandas as pd

        k = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in pdf["keys"]])
        p = np.concatenate([np.frombuffer(x, dtype=np.int32) for x in pdf["places"]])
        o = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in pdf["lines"]])
        order = np.lexsort((o, k))
        k, p, o = k[order], p[order], o[order]
        other = (k[1:] == k[:-1]) & (o[1:] != o[:-1])
        group = np.cumsum(np.concatenate(([True], k[1:] != k[:-1]))) - 1
        mixed = np.zeros(group[-1] + 1 if len(k) else 0, dtype=bool)
        mixed[group[1:][other]] = True
        keep = mixed[group]
        return pd.DataFrame({"v": k[keep].view(np.int64), "place": p[keep], "h": o[keep].view(np.int64)})

    return blocks.where("range IS NOT NULL").select("range", "keys", "places", "lines").groupBy("range").applyInPandas(meet, "v long, place int, h long").distinct()


def _near(work: Scratch, meetings: DataFrame, firsts: DataFrame, texts: DataFrame) -> DataFrame:
    """h, g of the lines that are one edit from an earlier one."""
    m = work.stored(meetings.join(firsts.select("h", "g", "first"), "h"), "line-meetings")
    cuts, own = m.where("place >= 0"), m.where("place = -1")
    low = F.min(F.struct("first", "h", "g")).alias("low")
    found = [
        cuts.join(cuts.groupBy("v", "place").agg(low), ["v", "place"]),  # replaced
        cuts.join(own.groupBy("v").agg(low), "v"),  # this line has one character more
        own.join(cuts.groupBy("v").agg(low), "v"),  # this line has one character less
    ]
    pairs = [p.where("low.first < first").select("h", "g", F.col("low.first").alias("before"), F.col("low.h").alias("h2"), F.col("low.g").alias("g2")) for p in found]
    pairs = pairs[0].union(pairs[1]).union(pairs[2]).distinct()
    line = texts.select("h", "g", "line")
    both = pairs.join(line, ["h", "g"]).join(line.select(F.col("h").alias("h2"), F.col("g").alias("g2"), F.col("line").alias("other")), ["h2", "g2"])
    return both.where(F.levenshtein("line", "other", 1) == 1).select("h", "g").distinct()


def line_dedup(docs: DataFrame, min_chars: int = 20, row: tuple[str, str] | None = None) -> DataFrame:
    """docs with repeated and nearly repeated lines taken out of text, and the columns n_lines and n_removed.

    docs has doc_id, text, and any others (n_lines and n_removed are replaced, n_chars is set to the new text's length where
    it is there). row names two long columns that number its rows alike in every scan (see row_keys); they aren't in the
    result. Without, docs is written once with numbers. Order of lines: doc_id (nulls last), row, place. Null
    texts stay null, empty texts empty (one line); rows that repeat a document lose their long lines; a document all of
    whose lines go has an empty text. An empty table gives no rows.
    """
    spark = docs.sparkSession
    work = Scratch(spark)
    bounded_batches(spark)
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed", *(row or ()))]
    if row:
        docs = docs.select(*names, F.col(row[0]).alias("__file"), F.col(row[1]).alias("__row"))
    else:
        docs = work.stored(docs.select(*names, F.lit(0).cast("long").alias("__file"), F.monotonically_increasing_id().alias("__row")), "line-docs")
    lines = work.stored(_line_table(docs, min_chars), "lines")
    when = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "file", "row", "place")
    firsts = work.stored(lines.groupBy("h", "g").agg(F.min(when).alias("first"), (F.count("*") > 1).alias("several")), "line-firsts")
    distinct = firsts.count()
    suspects = work.stored(_suspects(docs, min_chars, max(parallelism(spark), 8 * distinct // RANGE)), "line-suspects")
    blocks = work.stored(_variants(docs, suspects, min_chars, max(parallelism(spark), 64 * suspects.count() // RANGE)), "line-variants")
    texts = blocks.where("h IS NOT NULL").select("h", "g", "line").dropDuplicates(["h", "g"])
    near = _near(work, _meetings(blocks), firsts, texts).withColumn("near", F.lit(True))
    # Both sides of the next join are shuffled as they are, so that Spark can split the partitions of very common lines.
    known = work.stored(firsts.join(near, ["h", "g"], "left").where("several OR near"), "line-known")
    judged = lines.join(known.hint("merge"), ["h", "g"])
    own = [F.col(c) == F.col(f"first.{c}") for c in ("file", "row", "place")]
    gone = judged.where(F.col("near") | ~(own[0] & own[1] & own[2]))
    gone = work.stored(gone.groupBy(F.col("file").alias("__file"), F.col("row").alias("__row")).agg(F.collect_set("place").alias("__gone")), "line-gone")
    work.release(docs, gone)

    out = docs.join(gone.hint("merge"), ["__file", "__row"], "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("__split") - 1), "__gone")
    kept = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get("__split", i)), "\n"))
    out = out.withColumn("__split", F.split("text", "\n", -1))
    out = out.select(*[c for c in names if c != "text"], F.size("__split").alias("__all"), kept.alias("text"), F.coalesce(F.size("__gone"), F.lit(0)).alias("__n"))
    changed = {"n_lines": F.coalesce(F.when(F.col("text").isNotNull(), F.col("__all")), F.lit(0)).cast("long"), "n_removed": F.greatest("__n", F.lit(0)).cast("long")}
    if "n_chars" in names:
        changed["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.withColumns(changed).select(*names, "n_lines", "n_removed")
