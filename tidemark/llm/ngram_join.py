"""N-gram Jaccard join by vertical partitioning, and the groups of documents that its links form.

A document is the set of its distinct word shingles. All shingles have one global order: (frequency class, hash), rare
ones first. The work, at no point more than a few rows a document or one posting for a fifth of its shingles:

1. *Sets and the order.* One pass gives every document's set size, a 128-bit fingerprint, a 512-bit parity signature, and
   adds its shingles to a count sketch of fixed size (at most 2**22 counters, of which a byte each is broadcast).
   The counts need not be exact: any order that all documents share is valid.
2. *Classes.* Documents with the same set are one class, a node; a fingerprint numbers it (clashes are found, and reseeded).
3. *Candidates.* Two sets that link share one of their first n - ceil(0.8 n) + 1 shingles in the global order. Those are
   posted, packed into blocks by hash range. A shingle that several nodes of a task post goes on with one of them, so
   that a hot one reaches its reducer once a block; one that a single node posts is dropped there. In each remaining
   bucket every member is paired with the smallest one and with one other, in an order that the shingle sets (a star
   and a ring, not all pairs). It goes on with the partners with which it shares the most buckets, of those the ones
   that seem closest by exact bounds on sizes and signatures.
4. *Fragments.* The global order is cut into fragments. For each candidate pair the overlap is counted within each
   fragment separately and summed per pair. Links give components.
5. *The rest.* A bucket whose members are then in one component needs nothing more. In a mixed bucket, the members
   outside its largest component are held against the members of other components, with bounds on sizes and on
   larger signatures, and the same fragment counts, the closest first. So every pair that could join two components is
   decided exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.graph import connected_components
from tidemark.llm.membership import maybe_in, member_bits
from tidemark.llm.shared import Scratch, array_slices, as_batch, bounded_batches, encoded, merged_slices, mix, parallelism, shingle_set, slices, words_of

#: Longs of a signature; its bit k is the parity of the shingles that hash to k. A larger one is kept beside the rows.
SIG, BIG = 8, 32
#: The sketch has a counter for about this many characters, within SKETCH_BITS.
CHARACTERS_PER_COUNTER = 192
SKETCH_BITS = (16, 22)
#: Postings that one reducer group gets, about.
POSTINGS_PER_RANGE = 1 << 19
#: Settled postings that pass through a reducer group.
PASSED = 1 << 14
#: Partners that a node is held against before the rest is taken pair by pair, and rings that the shingles lay through a bucket.
KEPT, RINGS = 4, 3
#: Fragments of the global order, of about equal mass; their bounds lie on these cuts of the hash within a class.
FRAGMENTS, CUTS = 4, 4
#: Texts that are encoded at once.
TEXTS = 256


def _sets(texts):
    for at in range(0, len(texts), TEXTS):
        for i, words in words_of(encoded(texts[at : at + TEXTS])):
            yield at + i, shingle_set(words)


def _signature(s: np.ndarray, longs: int) -> np.ndarray:
    bits = np.bincount((s >> np.uint64(64 - (64 * longs - 1).bit_length())).astype(np.int64), minlength=64 * longs) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _node(s: np.ndarray, seed: int) -> int:
    """A set's number: a 64-bit fingerprint that doesn't depend on the order."""
    return int(mix(s + np.uint64(seed)).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0


def measured(docs: DataFrame, bits: int, seed: int = 0, row: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, file and row (null unless named), n, node, check, big and s0..s7 of every document: a second fingerprint and the
    signatures. Besides, rows of slice and data (null in the others): each task's counters of the sketch, 2**bits."""
    schema = "doc_id long, file long, row long, n long, node long, check long, big array<long>, " + ", ".join(f"s{k} long" for k in range(SIG)) + ", slice int, data binary"

    def run(batches):
        total, held, size = np.zeros(1 << bits, dtype=np.uint64), [], 0

        def add():
            places, counts = np.unique(np.concatenate(held) >> np.uint64(64 - bits), return_counts=True)
            total[places.astype(np.int64)] += counts.astype(np.uint64)

        for whole in batches:
            for batch in slices(whole, 1024):
                rows = [(*k, 0, 0, 0, None, *[0] * SIG, None, None) for k in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "file", "row")), strict=True)]
                for i, s in _sets(batch.column("text").to_pylist()):
                    if not len(s):
                        continue
                    check = np.bitwise_xor.reduce((s ^ (s >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)
                    rows[i] = (*rows[i][:3], len(s), _node(s, seed), int(check), _signature(s, BIG), *_signature(s, SIG).tolist(), None, None)
                    held.append(s)
                    size += len(s)
                    if size >= POSTINGS_PER_RANGE // 2:
                        add()
                        held, size = [], 0
                yield as_batch(rows, schema)
        if held:
            add()
        yield as_batch([(None,) * (7 + SIG) + x for x in array_slices(total)], schema)

    keys = [(F.col(c) if c else F.lit(None)).cast("long").alias(n) for c, n in zip(row or (None, None), ("file", "row"), strict=True)]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keys, "text").mapInArrow(run, schema)


def frequency_classes(table: DataFrame, bits: int) -> np.ndarray:
    """log2 of the count of every counter of the sketch, over all documents; 2**bits bytes."""
    parts = table.where("slice IS NOT NULL").select("slice", "data")
    return merged_slices(parts, 1 << bits, np.uint64, np.add, lambda total: np.log2(1 + total.astype(float)), np.uint8)


def fragment_bounds(classes: np.ndarray) -> np.ndarray:
    """The fragment of each (class, cut), which follow each other in the global order."""
    cells = np.repeat(np.bincount(classes, weights=np.exp2(classes.astype(float)), minlength=64) / CUTS, CUTS)
    before = np.cumsum(cells) - cells
    return np.minimum(before / max(cells.sum(), 1) * FRAGMENTS, FRAGMENTS - 1).astype(np.int64)


def _class_of(s: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return classes[(s >> np.uint64(64 - (len(classes).bit_length() - 1))).astype(np.int64)]


def prefix_length(n, percent: int):
    """A set of n shingles shares one of its first so many with any set that it links with."""
    return n - -(-percent * n // 100) + 1


def _partners(t: np.ndarray, node: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(leader, peer) of postings in order of (tok, node): a bucket's smallest node, and the one before in the tok's ring.

    The node itself stands where the sizes rule a link out.
    """
    if not len(t):
        return node, node
    first = np.concatenate(([True], t[1:] != t[:-1]))
    start = np.maximum.accumulate(np.where(first, np.arange(len(t)), 0))
    ring = np.lexsort((mix(node.view(np.uint64) + t % np.uint64(RINGS)), t))
    before = np.empty(len(t), dtype=np.int64)
    ends = np.append(np.flatnonzero(first)[1:], len(t)) - 1
    before[ring] = np.where(first, ring[np.repeat(ends, np.diff(np.append(np.flatnonzero(first), len(t))))], np.roll(ring, 1))
    return tuple(np.where(100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x]), node[x], node) for x in (start, before))


def _buckets(docs: DataFrame, classes, seed: int, percent: int, ranges: int) -> DataFrame:
    """Postings in buckets of two nodes or more: tok, node, leader, peer (see _partners). A copy of a set may repeat its row."""
    names = ["range", "toks", "nodes", "third", "fourth"]

    def post(frames):
        toks, node, size, held, seen = [], [], [], 0, set()

        def flush():
            counts = [len(t) for t in toks]
            t, ids, n = np.concatenate(toks), np.repeat(np.array(node, dtype=np.int64), counts), np.repeat(np.array(size, dtype=np.int64), counts)
            order = np.lexsort((ids, t))
            t, ids, n = t[order], ids[order], n[order]
            first = np.concatenate(([True], t[1:] != t[:-1]))
            several = np.concatenate((~first[1:], [False])) & first
            # All but a bucket's first are settled here, and only pass through, in a group of their own.
            own = ~first | several
            leader, peer = _partners(t[own], ids[own], n[own], percent)
            settled = [x[~first[own]] for x in (t[own], ids[own], leader, peer)]
            rows = [(-1 - int((ids[0] + at) % (1 << 30)), *(x[at : at + PASSED].tobytes() for x in settled)) for at in range(0, len(settled[0]), PASSED)]
            t, ids, n, several = t[first], ids[first], n[first].astype(np.int32), several[first]
            r = (((t >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(r)) + 1
            for a, b in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(t)])), strict=True):
                rows.append((int(r[a]), *(x[a:b].tobytes() for x in (t, ids, n, several))))
            return pd.DataFrame(rows, columns=names)

        for pdf in frames:
            for _, s in _sets(pdf["text"].tolist()):
                key = _node(s, seed)
                if not len(s) or key in seen:
                    continue
                seen.add(key)
                p = prefix_length(len(s), percent)
                toks.append(s[np.argsort(_class_of(s, classes.value), kind="stable")[:p]])
                node.append(key)
                size.append(len(s))
                held += p
                if held >= POSTINGS_PER_RANGE:
                    yield flush()
                    toks, node, size, held = [], [], [], 0
        if held:
            yield flush()

    def pair(key, pdf):
        def column(name, dtype):
            return np.concatenate([np.frombuffer(x, dtype=dtype) for x in pdf[name]])

        t, node = column("toks", np.uint64), column("nodes", np.int64)
        if key[0] < 0:
            return pd.DataFrame({"tok": t.view(np.int64), "node": node, "leader": column("third", np.int64), "peer": column("fourth", np.int64)})
        n, several = column("third", np.int32).astype(np.int64), column("fourth", bool)
        order = np.lexsort((~several, node, t))
        t, node, n, several = t[order], node[order], n[order], several[order]
        new = np.concatenate(([True], (t[1:] != t[:-1]) | (node[1:] != node[:-1])))  # copies post from several tasks
        t, node, n, several = t[new], node[new], n[new], several[new]
        first = np.concatenate(([True], t[1:] != t[:-1]))
        group = np.cumsum(first) - 1
        kept = ((np.bincount(group) > 1) | (np.bincount(group, weights=several) > 0))[group]
        t, node, n = t[kept], node[kept], n[kept]
        leader, peer = _partners(t, node, n, percent)
        return pd.DataFrame({"tok": t.view(np.int64), "node": node, "leader": leader, "peer": peer})

    blocks = docs.select("text").mapInPandas(post, "range int, toks binary, nodes binary, third binary, fourth binary")
    return blocks.groupBy("range").applyInPandas(pair, "tok long, node long, leader long, peer long")


def _segments(docs: DataFrame, wanted: DataFrame, classes, seed: int) -> DataFrame:
    """(node, fragment, toks) of the wanted nodes: their sets, cut at the bounds of the fragments."""
    table = docs.sparkSession.sparkContext.broadcast(member_bits(wanted, wanted.count()))
    bounds = fragment_bounds(classes.value)

    def cut(frames):
        seen = set()
        for pdf in frames:
            out = []
            for _, s in _sets(pdf["text"].tolist()):
                key = _node(s, seed)
                if not len(s) or key in seen or not maybe_in(np.array([key]).view(np.uint64), table.value)[0]:
                    continue
                seen.add(key)
                frag = bounds[_class_of(s, classes.value).astype(np.int64) * CUTS + (s >> np.uint64(62)).astype(np.int64)]
                order = np.argsort(frag, kind="stable")
                ends = np.flatnonzero(np.diff(frag[order])) + 1
                out += [(key, int(frag[x[0]]), s[x].view(np.int64)) for x in np.split(order, ends)]
            yield pd.DataFrame(out, columns=["node", "fragment", "toks"])

    # Copies come from several tasks. Both steps deal rows by node, so that one shuffle serves them.
    found = docs.select("text").mapInPandas(cut, "node long, fragment int, toks array<long>").join(wanted, "node", "left_semi")
    return found.dropDuplicates(["node", "fragment"])


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """pairs (a, b) that the exact bounds on sizes and signatures leave: a, b, n_a, n_b, gap (how unlike they seem)."""
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), *[F.col(f"s{k}").alias(f"{side}{k}") for k in range(SIG)]), side)
    return pairs.where(_may_link(percent)).select("a", "b", "n_a", "n_b", (_differ() / (F.col("n_a") + F.col("n_b"))).alias("gap"))


def _closest(pairs: DataFrame, keep: int) -> DataFrame:
    """The keep pairs of each a that seem most alike."""
    rank = F.row_number().over(Window.partitionBy("a").orderBy("gap", "b"))
    return pairs.withColumn("place", rank).where(F.col("place") <= keep).select("a", "b", "n_a", "n_b")


def _differ():
    return sum(F.bit_count(F.col(f"a{k}").bitwiseXOR(F.col(f"b{k}"))) for k in range(SIG))


def _contracted(links: DataFrame, comps: DataFrame) -> DataFrame:
    """links and the components so far, as edges."""
    return links.select("a", "b").union(comps.select(F.col("node").alias("a"), F.col("component").alias("b")))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()


def _may_link(percent: int):
    # J >= p/100 needs |A xor B| <= (n_a + n_b) (100 - p) / (100 + p), and |A xor B| >= the bits in which the signatures differ.
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    return sizes & (_differ() * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent))


def _linked(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link: overlaps counted in each fragment and summed."""
    left = segments.select(F.col("node").alias("a"), "fragment", F.col("toks").alias("left"))
    right = segments.select(F.col("node").alias("b"), "fragment", F.col("toks").alias("right"))
    part = pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "n_a", "n_b", F.size(F.array_intersect("left", "right")).alias("shared"))
    total = part.groupBy("a", "b", "n_a", "n_b").agg(F.sum("shared").alias("overlap"))
    return total.where(F.col("overlap") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("overlap")) * percent).select("a", "b")


def _mixed(buckets: DataFrame, comps: DataFrame) -> DataFrame:
    """(tok, node, comp, main) of the nodes outside the largest component, main, of their bucket."""
    member = buckets.join(comps, "node", "left").select("tok", "node", F.coalesce("component", "node").alias("comp"))
    counts = member.groupBy("tok", "comp").agg(F.count("*").alias("members"))
    mixed = counts.groupBy("tok").agg(F.count("*").alias("comps"), F.max(F.struct("members", "comp"))["comp"].alias("main")).where("comps > 1").select("tok", "main")
    return member.join(mixed, "tok").where("comp <> main")


def _most_shared(stars: DataFrame) -> DataFrame:
    """The pairs (a, b) of each a that share the most buckets, 2 * KEPT of them."""
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("shared"), "b"))
    return stars.groupBy("a", "b").agg(F.count("*").alias("shared")).withColumn("place", rank).where(F.col("place") <= 2 * KEPT).select("a", "b")


def _ordered() -> list:
    """a, b, n_a, n_b with the smaller node first."""
    low = F.col("a") < F.col("b")
    return [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(low, F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"), F.when(low, F.col("n_b")).otherwise(F.col("n_a")).alias("n_b")]


def _rest(few: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) across components that sizes and signatures leave, of those that meet in a mixed bucket.

    a lies outside a bucket's largest component. members has every node with its component. A member outside a bucket's largest component is held against that whole
    component once, whatever number of buckets they share; members outside it against each other within the bucket.
    """

    def as_side(x):
        return [F.col("node").alias(x), F.col("comp").alias(f"comp_{x}"), F.col("n").alias(f"n_{x}"), *[F.col(f"s{k}").alias(f"{x}{k}") for k in range(SIG)]]

    attached = few.select("node", "main").distinct().join(members, "node").select("main", *as_side("a"))
    to_main = attached.join(members.select(*as_side("b")), F.col("main") == F.col("comp_b")).where(_may_link(percent))
    several = few.groupBy("tok").agg((F.min("comp") != F.max("comp")).alias("several")).where("several").select("tok")
    outside = few.select("tok", "node").join(several, "tok").join(members, "node")
    among = outside.select("tok", *as_side("a")).join(outside.select("tok", *as_side("b")), "tok").where("a < b AND comp_a <> comp_b").where(_may_link(percent))
    return to_main.select("a", "b", "n_a", "n_b").union(among.select("a", "b", "n_a", "n_b")).distinct()


def _after_big_signatures(pairs: DataFrame, bigs: DataFrame, percent: int) -> DataFrame:
    both = pairs.join(bigs.select(F.col("node").alias("a"), F.col("big").alias("big_a")), "a").join(bigs.select(F.col("node").alias("b"), F.col("big").alias("big_b")), "b")
    differ = F.aggregate(F.zip_with("big_a", "big_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda a, x: a + x)
    total = F.col("n_a") + F.col("n_b")
    return both.where(differ * (100 + percent) <= total * (100 - percent)).select("a", "b", "n_a", "n_b", (differ / total).alias("gap"))


def _degrees(work: Scratch, docs: DataFrame, rows: DataFrame, nodes: DataFrame, buckets: DataFrame, classes, seed: int, percent: int) -> DataFrame:
    """(node, n_links) of every node: all pairs that meet in a bucket, but for those that exact bounds rule out, are counted out."""
    both = buckets.select("tok", F.col("node").alias("a")).join(buckets.select("tok", F.col("node").alias("b")), "tok").where("a < b")
    pairs = work.stored(_likely(both.select("a", "b").distinct(), nodes, percent), "ngram-all")
    segments = work.stored(_segments(docs, work.stored(_ends(pairs), "ngram-wanted"), classes, seed), "ngram-segments")
    links = work.stored(_linked(pairs, segments, percent), "ngram-links")
    size = rows.where("n > 0").groupBy("node").agg(F.count("*").alias("copies"))
    ends = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = ends.join(size.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("others"))
    return size.join(others, "node", "left").select("node", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))


def ngram_groups(docs: DataFrame, percent: int = 80, row: tuple[str, str] | None = None, links: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, and if links is set n_links, of every row of docs (doc_id, text; other columns are ignored).

    component_id is the smallest doc_id that links reach, the row's own included; n_links is the number of other
    rows that the row links with, copies included. It takes every pair of different sets that share a rare shingle, which
    grows with the square of a group of near copies; the groups alone don't need that. Null and empty texts have no shingles and link with nothing. Rows that repeat a doc_id are separate rows; rows with a
    null doc_id take part, and component_id is null only where the whole component has no doc_id. An empty table gives
    no rows. docs is scanned several times: pass a stored table. With row, two columns of docs that number its rows (see
    row_keys), the result has these numbers as file and row too, and component, which unlike component_id differs between any two components
    (null where there are no shingles).
    """
    spark = docs.sparkSession
    work = Scratch(spark)
    bounded_batches(spark)
    characters = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = min(max((characters // CHARACTERS_PER_COUNTER).bit_length(), SKETCH_BITS[0]), SKETCH_BITS[1])
    for seed in range(8):
        table = work.stored(measured(docs, bits, seed, row), "ngram-rows")
        rows = table.where("slice IS NULL").drop("slice", "data")
        kinds = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min("n").alias("n"), (F.min(F.struct("n", "check")) != F.max(F.struct("n", "check"))).alias("clash"), *[F.min(f"s{k}").alias(f"s{k}") for k in range(SIG)])
        nodes = work.stored(kinds, "ngram-nodes")
        clash, postings = nodes.agg(F.max("clash"), F.sum(F.floor(F.col("n") * (100 - percent) / 100) + 1)).first()
        if not clash:
            break  # else two different sets have one number: another seed
    else:
        raise RuntimeError("sets keep sharing fingerprints")
    classes = spark.sparkContext.broadcast(frequency_classes(table, bits))

    ranges = max(4 * parallelism(spark), -(-(postings or 0) // POSTINGS_PER_RANGE))
    buckets = work.stored(_buckets(docs, classes, seed, percent, ranges), "ngram-buckets")
    partners = buckets.select(F.col("node").alias("a"), F.explode(F.array("leader", "peer")).alias("b")).where("a <> b")
    likely = work.stored(_closest(_likely(_most_shared(partners), nodes, percent), KEPT), "ngram-tried")
    work.release(table, nodes, buckets, likely)
    segments = work.stored(_segments(docs, work.stored(_ends(likely), "ngram-wanted"), classes, seed), "ngram-segments")
    comps = connected_components(_linked(likely.select(*_ordered()).distinct(), segments, percent), work)
    work.release(table, nodes, buckets, likely, comps)

    few = work.stored(_mixed(buckets, comps), "ngram-mixed")
    members = nodes.join(comps, "node", "left").withColumn("comp", F.coalesce("component", "node"))
    tried = likely.select("a", "b").union(likely.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = work.stored(_rest(few, members, percent).join(tried, ["a", "b"], "left_anti"), "ngram-pairs")
    rest = work.stored(_after_big_signatures(pairs, rows.where("n > 0").select("node", "big").dropDuplicates(["node"]), percent), "ngram-rest")
    if not rest.isEmpty():
        segments = work.stored(_segments(docs, work.stored(_ends(rest), "ngram-wanted"), classes, seed), "ngram-segments")
        # The closest first: most of the others then lie within one component.
        comps = connected_components(_contracted(_linked(_closest(rest, KEPT), segments, percent), comps), work)
        ends = rest.join(comps.toDF("a", "comp_a"), "a", "left").join(comps.toDF("b", "comp_b"), "b", "left")
        apart = ends.where(F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b")).select("a", "b", "n_a", "n_b")
        last = work.stored(_linked(apart, segments, percent), "ngram-links")
        if not last.isEmpty():
            comps = connected_components(_contracted(last, comps), work)

    classed = nodes.join(comps, "node", "left").select("node", "first_id", F.coalesce("component", "node").alias("component"))
    lowest = classed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    labels = classed.join(lowest, "component").select("node", "component", "component_id")
    if links:
        labels = labels.join(_degrees(work, docs, rows, nodes, buckets, classes, seed, percent), "node")
    labels = work.stored(labels, "ngram-labels")
    classes.unpersist()
    work.release(table, labels)
    out = rows.join(labels, "node", "left")
    own = ["file", "row", F.when(F.col("n") > 0, F.col("component")).alias("component")] if row else []
    counted = [F.when(F.col("n") > 0, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links")] if links else []
    return out.select("doc_id", *own, F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), *counted)
