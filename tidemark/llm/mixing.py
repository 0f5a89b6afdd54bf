"""Mixing sources to target weights by Poisson replication.

Each source has a target share of the characters; its rate is the mean number of copies of one of its documents. A document's
number of copies is a Poisson variate of that mean, found by inverting the distribution at a uniform number that a hash of
the seed and its doc_id gives, so that a retry or another partitioning gives the same copies. Copies are exploded where
the document lies, dealt over all partitions by a hash, and sorted within each: a global shuffle that neither a hot source
nor a doc_id that many rows have skews.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import parallelism, row_keys, stored


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, from the md5 of seed and parts (null as an empty string)."""
    return F.conv(F.substring(_digest(seed, *parts), 1, 13), 16, 10).cast("double") / float(1 << 52)


def _digest(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def poisson_steps(rate: Column) -> Column:
    """The distribution function of a Poisson variate at 0, 1, 2, ..., until it is 1 in a double; a rate of 0 gives none above 0."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    start = F.struct((-rate).alias("log"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("out"))

    def step(a, j):
        log = a["log"] + F.ln(rate) - F.ln(j.cast("double"))
        return F.struct(log.alias("log"), (a["sum"] + F.exp(log)).alias("sum"), F.concat(a["out"], F.array(a["sum"] + F.exp(log))).alias("out"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), last), start, step, lambda a: a["out"])).otherwise(F.array(F.lit(1.0)))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """source, size (characters), rate and steps of every source.

    Target shares are weights (sources that it doesn't name get none) or, without weights, go with size ** power. The
    mixture has epochs times the characters of the input. A source without characters has the rate 1.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.length(F.coalesce("text", F.lit("")))).alias("size"))
    if weights is None:
        mass = F.pow(F.col("size").cast("double"), F.lit(power))
    else:
        mass = F.lit(0.0)
        for name, w in weights.items():
            mass = F.when(F.col("source") == name, F.lit(float(w))).otherwise(mass)
    sizes = sizes.withColumn("mass", F.when(F.col("size") > 0, mass).otherwise(0.0))
    total = sizes.agg(F.sum("mass").alias("all_mass"), F.sum("size").alias("all_size"))
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("all_mass") > 0, F.col("mass") / F.col("all_mass") * F.col("all_size") * F.lit(float(epochs)) / F.col("size")).otherwise(0.0)
    rates = sizes.crossJoin(F.broadcast(total)).withColumn("rate", rate)  # total is one row
    return rates.select("source", "size", "rate", poisson_steps(F.col("rate")).alias("steps"))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, epochs: float = 1.0, seed: int = 0, row: tuple[str, str] | None = None) -> DataFrame:
    """docs with each row repeated by its number of copies, shuffled, with the columns copy (from 1) and shuffle_key.

    docs has doc_id, text and source. row names two long columns that number its rows alike in every scan (see row_keys); they
    aren't in the result. Without, docs is written once, and its rows are known by their place in those files. A null source
    is a source of its own; null texts have no characters. Rows that repeat a doc_id within a source get the same number of
    copies. Other columns pass through (copy and shuffle_key are replaced). An empty table gives no rows. Copies are dealt by
    their shuffle_key and their row, so that null or repeated doc_ids spread too, and lie within an output partition in the
    order of shuffle_key. Nothing that deals them depends on the order in which a task meets rows, so one that runs again
    after a loss deals the same rows to the same places. Spark joins the rates as their size calls for; the rows are the same.
    """
    names = [c for c in docs.columns if c not in ("copy", "shuffle_key", *(row or ()))]
    if row is None:
        docs, row = row_keys(stored(docs.select(*names), "mixing-docs")), ("__file", "__row")
    rates = stored(source_rates(docs, weights, power, epochs).select(F.col("source").alias("__source"), F.col("steps").alias("__steps")), "mixing-rates")
    joined = docs.select(*names, *row).join(rates, F.col("source").eqNullSafe(F.col("__source"))).withColumn("__u", uniform(seed, F.col("doc_id")))
    below = F.filter("__steps", lambda c: c <= F.col("__u"))
    copies = joined.withColumn("__n", F.size(below)).where("__n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    keyed = copies.withColumn("shuffle_key", _digest(seed + 1, F.col("doc_id"), F.col("copy"))).drop("__source", "__steps", "__u", "__n")
    return keyed.repartition(parallelism(docs.sparkSession), "shuffle_key", *row).sortWithinPartitions("shuffle_key", *row).drop(*row)
