"""Personal data: spans of fixed formats, and candidates that boosted trees judge by their format and context.

Formats (e-mail, IP, card, phone) are matched and validated by rule. For the rest, high-recall generators propose spans that
may overlap: long tokens with digits, digit groups that look like a phone number, and spelt-out addresses. Gradient-boosted
trees score each by its own characters and the characters around it; a kind's threshold is the lowest score that reaches
the wanted precision on held-out training rows. The best-scoring candidate of an overlap stays, unless it touches a format
span. The trees are trained on a fixed number of generated examples (there are no labelled spans) and become plain
column expressions, so that all scoring happens within a text's row: no shuffle, no Python on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The formats. Starts are barred within a run that has failed as a whole, and the quantifiers that nothing
#: follows are possessive: the matches are those of the plain patterns, found in linear time.
FORMATS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a format to be looked for.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
CANDIDATES = {
    "secret": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{16,}+",
    "number": r"(?<![0-9A-Za-z.+-])\(?[0-9]{3,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z-])",
    "spelt": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}+ ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]{1,63}+)++",
}
CANDIDATE_HINTS = {"secret": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{16}", "number": r"[0-9]{3}\)?[\x20.-][0-9]{3}", "spelt": r"[\[(]at[\])]"}
KINDS = [*FORMATS, *CANDIDATES]
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: Characters of context on each side.
AROUND = 24
#: Numbers that are summed up together, a power of two, and the characters of a candidate in which what it is assigned to is looked for.
BLOCK, HEAD = 256, 64
#: Generated examples, trees and their depth.
EXAMPLES, TREES, DEPTH = 6000, 12, 3


def _named(value: Column, use) -> Column:
    """use(value), where value is evaluated once."""
    return F.transform(F.array(value), use)[0]


def _running(sizes: Column) -> Column:
    """Sums of sizes (array of long) up to each place, by blocks: arrays that grow by one are copied at each step, so they stay short."""
    blocks = _named(sizes, lambda v: F.transform(F.sequence(F.lit(0), F.greatest(F.size(v) - 1, F.lit(0)).cast("int").bitwiseAND(F.lit(-BLOCK)), F.lit(BLOCK)), lambda at: F.slice(v, at + 1, F.lit(BLOCK))))
    none = F.array().cast("array<bigint>")

    def along(values, start):
        step = lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"] + x)).alias("out"))
        return F.aggregate(values, F.struct(start.alias("at"), none.alias("out")), step, lambda a: a["out"])

    zero = F.lit(0).cast("long")
    total = lambda v: F.aggregate(v, zero, lambda a, x: a + x)
    return _named(blocks, lambda b: _named(along(F.transform(b, total), zero), lambda ends: F.flatten(F.transform(b, lambda v, i: along(v, F.coalesce(F.get(ends, i - 1), zero))))))


def matches(text: Column, pattern: str, hint: str) -> Column:
    """Array of (s, e, m): start and end in code points and the text of each match, leftmost and without overlaps."""
    found, parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    none = F.array().cast("array<struct<s:bigint,e:bigint,m:string>>")

    def placed(f):
        gaps = F.slice(parts, 1, F.size(f))
        ends = _running(F.zip_with(gaps, f, lambda p, m: (F.length(p) + F.length(m)).cast("long")))
        return F.zip_with(ends, f, lambda e, m: F.struct((e - F.length(m)).cast("long").alias("s"), e.alias("e"), m.alias("m")))

    return F.when(text.rlike(hint), _named(found, lambda f: F.when(F.size(f) > 0, placed(f)).otherwise(none))).otherwise(none)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        digits = F.translate(m, " -", "")
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.translate(m, "+ ().-", "")).between(9, 15)
    return F.lit(True)


def _share(m: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(m, pattern, "")) / F.greatest(F.length(m), F.lit(1))


def features(kind: Column, m: Column, before: Column, after: Column) -> dict[str, Column]:
    """Format and context of a candidate, as doubles, in time that is linear in its length."""
    head = F.substring(m, 1, HEAD)
    flags = {
        "secret": kind == "secret",
        "spelt": kind == "spelt",
        "hex": m.rlike(r"^(?:[0-9a-f]{24,}|[0-9A-F]{24,})$"),
        "known_prefix": m.rlike(r"^(?:AKIA|ASIA|gh[pousr]_|sk[-_]|xox[a-z]-|eyJ)"),
        "assigned": head.rlike(r"(?i)(?:pass(?:word|wd)?|pwd|secret|token|key|auth)[a-z_]*=") | F.concat(before, head).rlike(r"(?i)(?:pass(?:word|wd)?|pwd|secret|token|key|auth)[a-z_]*[\"']?\s*[:=]\s*[\"']?[A-Za-z0-9+/_=-]*$"),
        "called": before.rlike(r"(?i)(?:tel|phone|call|mobile|fax|cell|contact)[a-z]*[.:]?\s*$"),
        "grouped": m.rlike(r"^\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}$"),
        "dated": m.rlike(r"(?:19|20)[0-9]{2}[-_/.]?(?:0[1-9]|1[0-2])[-_/.]?[0-3][0-9]"),
        "wordy": m.rlike(r"(?<![A-Za-z])[A-Za-z]{3,}+[-_/][A-Za-z]{2,}[-_/]"),
        "linked": before.rlike(r"(?:https?:|www\.|/)\S*$") | after.rlike(r"^[./][A-Za-z0-9]"),
    }
    values = {"length": F.length(m), "digits": _share(m, "[^0-9]"), "uppers": _share(m, "[^A-Z]"), "lowers": _share(m, "[^a-z]"), "turns": F.length(F.regexp_replace(F.regexp_replace(m, "[0-9]+", "0"), "[^0]+", "a")) / F.greatest(F.length(m), F.lit(1))}
    return {k: v.cast("double") for k, v in (values | flags).items()}


NAMES = ["length", "digits", "uppers", "lowers", "turns", "secret", "spelt", "hex", "known_prefix", "assigned", "called", "grouped", "dated", "wordy", "linked"]


def examples(spark: SparkSession, count: int = EXAMPLES) -> DataFrame:
    """Generated candidates: kind, m, before, after, label. A row's content follows from its number alone."""
    h = F.sha2(F.col("id").cast("string"), 256)
    alnum = F.translate(F.upper(h), "0123456789ABCDEF", "Q7WE2RT9YU4IOP8A")
    mixed = F.base64(F.unhex(h))
    word = F.translate(h, "0123456789abcdef", "etaoinshrdlucmfw")

    def part(x, start, size):
        return F.substring(x, start, size)

    digits = F.translate(h, "abcdef", "012345")
    forms = [
        ("secret", F.concat(F.lit("AKIA"), part(alnum, 1, 16)), 1), ("secret", part(h, 1, 40), 1), ("secret", part(h, 1, 32), 1), ("secret", h, 1),
        ("secret", F.concat(F.lit("password="), part(h, 3, 18)), 1), ("secret", F.concat(F.lit("api_key="), part(alnum, 3, 24)), 1), ("secret", F.concat(F.lit("ghp_"), part(F.regexp_replace(mixed, "[^A-Za-z0-9]", "x"), 1, 36)), 1), ("secret", part(mixed, 1, 40), 1),
        ("number", F.concat(F.lit("("), part(digits, 1, 3), F.lit(") "), part(digits, 4, 3), F.lit("-"), part(digits, 7, 4)), 1), ("number", F.concat_ws("-", part(digits, 1, 3), part(digits, 4, 3), part(digits, 7, 4)), 1),
        ("spelt", F.concat(part(word, 1, 7), F.lit(" [at] "), part(word, 9, 6), F.lit(" [dot] com")), 1), ("spelt", F.concat(part(word, 1, 7), F.lit("(at)"), part(word, 9, 6), F.lit(".org")), 1),
        ("secret", F.concat(part(word, 1, 7), F.lit("-"), part(word, 9, 5), F.lit("-"), part(word, 15, 6), F.lit("-"), part(digits, 1, 2)), 0), ("secret", F.concat(F.lit("img_2024"), part(F.lit("0112"), 1, 4), F.lit("_"), part(digits, 1, 6)), 0),
        ("secret", F.concat(part(word, 1, 14), part(digits, 1, 2)), 0), ("secret", F.concat(part(word, 1, 6), F.lit("/"), part(word, 7, 7), F.lit("/"), part(digits, 1, 5)), 0), ("secret", F.concat(F.lit("2024-05-1"), part(digits, 1, 1), F.lit("-"), part(word, 1, 9)), 0), ("secret", part(digits, 1, 18), 0), ("secret", F.concat(part(word, 1, 9), F.lit("="), part(digits, 1, 7)), 0), ("secret", F.concat(part(word, 1, 5), F.lit("+"), part(word, 7, 5), F.lit("="), part(digits, 1, 6)), 0), ("secret", F.concat(F.lit("--------"), part(digits, 1, 9)), 0),
        ("number", F.concat_ws(" ", part(digits, 1, 4), part(digits, 5, 4), part(digits, 9, 4)), 0), ("number", F.concat_ws(".", part(digits, 1, 3), part(digits, 4, 3), part(digits, 7, 3)), 0), ("number", F.concat_ws(" ", part(digits, 1, 3), part(digits, 4, 3), part(digits, 7, 3)), 0),
        ("spelt", F.concat(part(word, 1, 4), F.lit(" (at) "), part(word, 9, 3), F.lit(" . "), part(word, 15, 30)), 0),
    ]
    which = F.col("id") % len(forms)
    pick = reduce(lambda c, i: c.when(which == i, F.struct(F.lit(forms[i][0]).alias("kind"), forms[i][1].alias("m"), F.lit(float(forms[i][2])).alias("label"))), range(1, len(forms)), F.when(which == 0, F.struct(F.lit(forms[0][0]).alias("kind"), forms[0][1].alias("m"), F.lit(float(forms[0][2])).alias("label"))))
    turn = F.pmod(F.xxhash64("id"), F.lit(6))
    lead = F.when((turn == 0) & (F.col("x.label") == 1), F.when(F.col("x.kind") == "secret", F.lit("the key: ")).otherwise(F.lit("call us, tel: "))).when(turn == 1, F.lit("see page ")).when((turn == 2) & (F.col("x.label") == 0), F.lit("https://example.org/")).otherwise(F.concat(part(word, 20, 8), F.lit(" ")))
    return spark.range(count).select("id", pick.alias("x")).select("id", "x.*", lead.alias("before"), F.concat(F.lit(" "), part(word, 30, 8)).alias("after"))


def _tree(node, values: dict[str, Column]) -> Column:
    """A decision tree as nested conditions."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    test = values[NAMES[node.split().featureIndex()]] <= float(node.split().threshold())
    return F.when(test, _tree(node.leftChild(), values)).otherwise(_tree(node.rightChild(), values))


class SpanModel:
    """Boosted trees and the threshold of each kind."""

    def __init__(self, spark: SparkSession, precision: float = 0.98):
        from pyspark.ml.classification import GBTClassifier
        from pyspark.ml.feature import VectorAssembler

        rows = examples(spark)
        for name, c in features(F.col("kind"), F.col("m"), F.col("before"), F.col("after")).items():
            rows = rows.withColumn(f"x_{name}", c)
        rows = VectorAssembler(inputCols=[f"x_{n}" for n in NAMES], outputCol="x").transform(rows).coalesce(1)
        held = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)) == 0
        fitted = GBTClassifier(featuresCol="x", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=7).fit(rows.where(~held))
        self.roots, self.weights = [t._call_java("rootNode") for t in fitted.trees], list(fitted.treeWeights)
        scored = rows.where(held).select("kind", "label", self.score({n: F.col(f"x_{n}") for n in NAMES}).alias("score")).collect()  # a quarter of EXAMPLES
        self.thresholds = {k: self._threshold([(r.score, r.label) for r in scored if r.kind == k], precision) for k in CANDIDATES}

    def score(self, values: dict[str, Column]) -> Column:
        margin = sum(w * _tree(r, values) for r, w in zip(self.roots, self.weights, strict=True))
        return 1 / (1 + F.exp(-2 * margin))

    @staticmethod
    def _threshold(rows: list[tuple[float, float]], precision: float) -> float:
        best, right, seen = 1.0, 0.0, 0
        rows = sorted(rows, reverse=True)
        for i, (score, label) in enumerate(rows):
            right, seen = right + label, seen + 1
            if right >= precision * seen and (i + 1 == len(rows) or rows[i + 1][0] < score):
                best = score
        return best


_models: dict[tuple[str, float], SpanModel] = {}


def span_model(spark: SparkSession, precision: float) -> SpanModel:
    """The model of this application, trained when it is first asked for."""
    key = (spark.sparkContext.applicationId, precision)
    if key not in _models:
        _models[key] = SpanModel(spark, precision)
    return _models[key]


def personal_data(docs: DataFrame, precision: float = 0.98) -> DataFrame:
    """docs with the columns base and added, which replace columns of those names: arrays of (k, s, e), the number of the
    kind in KINDS, start and end in code points. base holds the format spans, added the chosen candidates.

    Null and empty texts have no spans. Other columns, repeated rows and null keys pass through; so does an empty table.
    """
    model = span_model(docs.sparkSession, precision)
    text = F.coalesce(F.col("text"), F.lit(""))

    def format_spans(i, kind):
        found = F.filter(matches(text, FORMATS[kind], HINTS[kind]), lambda x: valid(kind, x["m"]))
        return F.transform(found, lambda x: F.struct(F.lit(i).alias("k"), x["s"].alias("s"), x["e"].alias("e")))

    def candidates(i, kind):
        found = matches(text, CANDIDATES[kind], CANDIDATE_HINTS[kind])
        begin = lambda x: F.greatest(x["s"] - AROUND, F.lit(0))
        return F.transform(found, lambda x: F.struct(F.lit(len(FORMATS) + i).alias("k"), x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), F.substring(text, (begin(x) + 1).cast("int"), (x["s"] - begin(x)).cast("int")).alias("b"), F.substring(text, (x["e"] + 1).cast("int"), F.lit(AROUND)).alias("a")))

    out = docs.withColumn("base", F.concat(*[format_spans(i, k) for i, k in enumerate(FORMATS)]))
    out = out.withColumn("__c", F.concat(*[candidates(i, k) for i, k in enumerate(CANDIDATES)]))
    first = len(FORMATS)
    kind = lambda x: F.element_at(F.array(*[F.lit(k) for k in CANDIDATES]), x["k"] - first + 1)
    out = out.withColumn("__f", F.transform("__c", lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e"), *[v.alias(n) for n, v in features(kind(x), x["m"], x["b"], x["a"]).items()])))
    limit = lambda x: F.element_at(F.array(*[F.lit(model.thresholds[k]) for k in CANDIDATES]), x["k"] - first + 1)
    scored = F.transform("__f", lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e"), model.score({n: x[n] for n in NAMES}).alias("p")))
    # Best first; one that overlaps a span taken before is left out.
    ranked = F.transform(F.sort_array(F.transform(F.filter(scored, lambda x: x["p"] >= limit(x)), lambda x: F.struct((-x["p"]).alias("o"), x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k")))), lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e")))
    out = out.withColumn("__r", ranked)
    base = F.col("base")
    taken = F.aggregate("__r", F.array().cast("array<struct<k:int,s:bigint,e:bigint>>"), lambda a, x: F.when(F.exists(F.concat(a, base), lambda y: (y["s"] < x["e"]) & (x["s"] < y["e"])), a).otherwise(F.concat(a, F.array(x))))
    return out.withColumn("added", F.sort_array(taken)).drop("__c", "__f", "__r")


def spans_string(spans: Column) -> Column:
    """kind:start:end, by kind as in KINDS, then start, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(spans), lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"], x["e"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """text with each span replaced by its kind in brackets; overlapping spans are replaced once."""
    names = F.array(*[F.lit(k.upper()) for k in KINDS])
    ordered = F.sort_array(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(a, x):
        put = F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), (x["s"] - a["at"]).cast("int")), F.lit("["), F.element_at(names, x["k"] + 1), F.lit("]"))
        inside = x["s"] < a["at"]
        return F.struct(F.greatest(a["at"], x["e"]).alias("at"), F.when(inside, a["out"]).otherwise(put).alias("out"))

    return F.aggregate(ordered, start, step, lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
