"""URL filters: rules by host and path, and a tree of path templates that judges the rest.

A path's segments are generalised within its host. A segment that looks variable (it has a digit, or is very long) becomes a
wildcard at once. The rest is settled level by level, from the host down: a child with few pages, and a child whose share of
bad labels doesn't differ from its siblings' (a two-proportion test) become the wildcard, which merges their branches. What is left are the host's templates. A template is blocked if its purity, the
share of bad among its labelled pages, smoothed towards the share over all, reaches a limit. Paths count to their last
segment; wildcards that end a template after its first DEPTH segments are written "**", whatever their number.

The tree is built on the distinct shapes of paths with their counts, which partial aggregation makes from the pages; the
pages themselves are joined once, with the shapes' verdicts. All steps are native expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch

#: Segments after which a template's last wildcards fold into one.
DEPTH = 4
#: Pages that a child needs, and the square of the test's bound (95 %).
MIN_PAGES, DIFFERENT = 5, 3.84
#: Children beyond which all of a node's become the wildcard; None, as their number grows with the table and says nothing of them.
MAX_CHILDREN: int | None = None
#: Labelled pages that the prior counts for, and the purity that blocks.
PRIOR, LIMIT = 5.0, 0.5
LONG_SEGMENT = 40


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; empty for a null, or without "://"."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null if none does. A rule is "host/path" with its verdict.

    It fits its host and all subdomains of it, where the path starts with the rule's.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[0]), r[0]))

    def fits(rule):
        at = rule.index("/")
        name, start = rule[:at], rule[at:]
        return ((host == name) | host.endswith("." + name)) & path.startswith(start)

    made = [(fits(r), F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict"))) for r, v in ordered]
    if not made:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    return reduce(lambda c, x: c.when(*x), made[1:], F.when(*made[0]))


def segments_of(path: Column) -> Column:
    """All segments, variable ones as "*". Empty segments are left out."""
    segments = F.filter(F.split(path, "/", -1), lambda s: s != "")
    return F.transform(segments, lambda s: F.when(s.rlike("[0-9]") | (F.length(s) > LONG_SEGMENT) | (s == "**"), F.lit("*")).otherwise(s))


def shape_of(path: Column) -> Column:
    """The first DEPTH segments, variable ones as "*", and "**" for what lies deeper. Empty segments are left out."""
    segments = segments_of(path)
    kept = F.slice(segments, 1, DEPTH)
    return F.concat(kept, F.when(F.size(segments) > DEPTH, F.array(F.lit("**"))).otherwise(F.array().cast("array<string>")))


def _levels(tree: DataFrame) -> list[int]:
    """The levels that can have a child that stays: one with enough pages, some of them labelled, in its host. No other level needs a step."""
    segments = tree.select("host", "n", "labelled", F.posexplode("shape").alias("level", "seg")).where("seg NOT IN ('*', '**')")
    children = segments.groupBy("host", "level", "seg").agg(F.sum("n").alias("n"), F.sum("labelled").alias("labelled"))
    return sorted(r["level"] for r in children.where((F.col("n") >= MIN_PAGES) & (F.col("labelled") > 0)).select("level").distinct().collect())


def templates(pages: DataFrame, work: Scratch) -> DataFrame:
    """host, shape, template, labelled, bad: the template of each shape, from counts n of pages of host, shape, bad (boolean or null)."""
    labelled = F.when(F.col("bad").isNotNull(), F.col("n")).otherwise(0)
    counts = pages.groupBy("host", "shape").agg(F.sum("n").alias("n"), F.sum(labelled).alias("labelled"), F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("bad"))
    # template has a segment for each level so far; fixed is how many of them come before its last wildcards.
    tree = work.stored(counts.withColumn("template", F.col("host")).withColumn("fixed", F.lit(0)), "url-shapes")
    done = 0
    for level in _levels(tree):
        skipped = F.greatest(F.least(F.size("shape"), F.lit(level)) - done, F.lit(0))
        here = tree.withColumn("template", F.concat("template", F.repeat(F.lit("/*"), skipped))).withColumn("seg", F.get("shape", F.lit(level)))
        fixed = here.where("seg IS NOT NULL AND seg NOT IN ('*', '**')")
        children = fixed.groupBy("template", "seg").agg(F.sum("n").alias("c_n"), F.sum("labelled").alias("c_l"), F.sum("bad").alias("c_b"))
        parents = children.groupBy("template").agg(F.count("*").alias("kinds"), F.sum("c_l").alias("p_l"), F.sum("c_b").alias("p_b"))
        rest_l, rest_b = F.col("p_l") - F.col("c_l"), F.col("p_b") - F.col("c_b")
        gap = (F.col("c_b") * rest_l - rest_b * F.col("c_l")).cast("double")
        spread = F.col("p_b").cast("double") * (F.col("p_l") - F.col("p_b")) * F.col("c_l") * rest_l
        different = F.when(spread > 0, gap * gap * F.col("p_l") >= spread * DIFFERENT).otherwise(False)
        stays = children.join(parents, "template").where((F.col("c_n") >= MIN_PAGES) & different)
        if MAX_CHILDREN is not None:
            stays = stays.where(F.col("kinds") <= MAX_CHILDREN)
        stays = stays.select("template", "seg", F.lit(True).alias("stays"))
        name = F.when(F.col("seg").isNull(), F.col("template")).otherwise(F.concat_ws("/", "template", F.when(F.col("stays"), F.col("seg")).otherwise("*")))
        last = F.when(F.col("stays"), level + 1).otherwise(F.col("fixed"))
        tree = work.stored(here.join(stays, ["template", "seg"], "left").select("host", "shape", "n", "labelled", "bad", name.alias("template"), last.alias("fixed")), "url-shapes")
        done = level + 1
    size, kept = F.size("shape"), F.greatest("fixed", F.lit(DEPTH))
    whole = F.concat("template", F.repeat(F.lit("/*"), F.greatest(size - done, F.lit(0))))
    folded = F.when(size > kept, F.concat(F.left(whole, F.length(whole) - 2 * (size - kept)), F.lit("/**"))).otherwise(whole)
    return tree.select("host", "shape", folded.alias("template"), "labelled", "bad")


def url_filter(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """keep, host, path, rule, verdict, template, purity of every page (url and the columns in keep).

    labels has a key column `key` (string) and `bad` (boolean); a page's key is the last number in its path. Pages that no rule
    fits get their template's verdict, block or allow; where no labels are known, allow. A null url, or one without
    "://", has an empty host and path and is judged like any other. Repeated pages and labels count each; rows whose keys aren't numbers
    label nothing. An empty table gives no rows.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    numbers = F.filter(F.split(F.col("__path"), "[^0-9]+", -1), lambda x: x != "")
    parsed = pages.select(*keep, host.alias("__host"), path.alias("__path")).withColumn("__shape", segments_of(F.col("__path")))
    known = labels.where("bad IS NOT NULL").where(F.col("key").rlike("^[0-9]+$")).groupBy("key").agg(F.max("bad").alias("bad"))
    work = Scratch(pages.sparkSession)
    # Pages are counted before they meet labels, so that no key is hot; those without a number get keys of their own.
    counts = parsed.select(F.col("__host").alias("host"), F.col("__shape").alias("shape"), numbers.alias("numbers")).withColumn("key", F.coalesce(F.try_element_at("numbers", F.lit(-1)), F.concat(F.lit("-"), F.xxhash64("host", "shape"))))
    counts = counts.groupBy("host", "shape", "key").agg(F.count("*").alias("n"))
    shapes = templates(counts.join(known, "key", "left"), work)
    prior = shapes.agg(F.try_divide(F.sum("bad"), F.sum("labelled")).alias("prior"))  # one row
    sums = shapes.groupBy("template").agg(F.sum("bad").alias("t_b"), F.sum("labelled").alias("t_l"))
    purity = (F.col("t_b") + F.coalesce("prior", F.lit(0.0)) * PRIOR) / (F.col("t_l") + PRIOR)
    judged = work.stored(shapes.join(sums.crossJoin(F.broadcast(prior)), "template").select(F.col("host").alias("h"), F.col("shape").alias("s"), "template", purity.alias("purity")), "url-verdicts")
    work.release(judged)
    out = parsed.join(judged, (F.col("__host") == F.col("h")) & (F.col("__shape") == F.col("s")), "left").withColumn("__r", rule_for(F.col("__host"), F.col("__path"), rules))
    own = F.when(F.col("purity") >= LIMIT, "block").otherwise("allow")
    return out.select(*keep, F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__r.rule").alias("rule"), F.coalesce(F.col("__r.verdict"), own).alias("verdict"), "template", "purity")
