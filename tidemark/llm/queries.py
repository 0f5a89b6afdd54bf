"""The operators' queries over whole tables, and their SQL where SQL can say the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.filter_audit import filter_audit, steps
from tidemark.llm.language_id import language_scores
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.line_rules import BOILERPLATE, NAVIGATION, SENTENCE_END, line_rules
from tidemark.llm.mixing import mix_sources
from tidemark.llm.ngram_join import ngram_groups
from tidemark.llm.packing import pack
from tidemark.llm.personal_data import FORMATS, personal_data, spans_string
from tidemark.llm.quality_model import quality_scores
from tidemark.llm.runs import periodic_runs
from tidemark.llm.shared import row_keys, scratch_dir
from tidemark.llm.token_store import read_store, write_store
from tidemark.llm.topk import top_k
from tidemark.llm.url_templates import url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's set size and the smallest doc_id that its links reach."""
    return ngram_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n FROM s),
p AS (SELECT doc_id, unnest(sh) AS g FROM s),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM p a JOIN p b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT o.a, o.b FROM o JOIN n x ON x.doc_id = o.a JOIN n y ON y.doc_id = o.b WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.c)
SELECT n.doc_id, n.n AS n_shingles, min(r.c) AS component_id FROM n JOIN r ON r.doc_id = n.doc_id GROUP BY 1, 2
"""


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best rows of every vector whose vec_id is divisible by 100."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


OP2_SQL = """
WITH ok AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
flat AS (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS i FROM ok),
score AS (SELECT q.vec_id AS query_id, r.vec_id, CAST(sum(q.x * r.x) AS BIGINT) AS score FROM flat q JOIN flat r ON q.i = r.i AND q.vec_id <> r.vec_id
  WHERE q.vec_id % 100 = 0 GROUP BY 1, 2),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM score)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


URL_RULES = [("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block")]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict by rule or template; a page is labelled bad if its document is of low quality or toxic."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("key"), F.expr("quality = 0 OR toxic = 1").alias("bad"))
    return url_filter(table(spark, sf_dir, "pages"), labels, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def _op3_level(k: int) -> str:
    """SQL for the tree's next level: t<k> to t<k + 1>."""
    return f"""
e{k} AS (SELECT *, shape[{k + 1}] AS seg FROM t{k}),
c{k} AS (SELECT template, seg, count(*) AS n, count(bad) AS l, coalesce(sum(CAST(bad AS INTEGER)), 0) AS b FROM e{k} WHERE seg IS NOT NULL AND seg NOT IN ('*', '**') GROUP BY 1, 2),
p{k} AS (SELECT *, sum(l) OVER (PARTITION BY template) AS pl, sum(b) OVER (PARTITION BY template) AS pb FROM c{k}),
s{k} AS (SELECT template, seg FROM p{k} WHERE n >= 5 AND CAST(pb AS DOUBLE) * (pl - pb) * l * (pl - l) > 0
  AND CAST(b * (pl - l) - (pb - b) * l AS DOUBLE) * CAST(b * (pl - l) - (pb - b) * l AS DOUBLE) * pl >= CAST(pb AS DOUBLE) * (pl - pb) * l * (pl - l) * 3.84),
t{k + 1} AS (SELECT e.page_id, e.host, e.path, e.shape, e.bad, CASE WHEN e.seg IS NULL THEN e.template
  WHEN s.seg IS NOT NULL OR e.seg = '**' THEN e.template || '/' || e.seg ELSE e.template || '/*' END AS template
  FROM e{k} e LEFT JOIN s{k} s ON s.template = e.template AND s.seg = e.seg),"""


OP3_SQL = rf"""
WITH k AS (SELECT CAST(doc_id AS VARCHAR) AS key, bool_or(quality = 0 OR toxic = 1) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
g AS (SELECT u.*, list_filter(string_split(path, '/'), lambda s: s <> '') AS segs, nullif(regexp_extract(path, '([0-9]+)[^0-9]*$', 1), '') AS key FROM u),
t0 AS (SELECT page_id, host, path, list_concat(list_transform(segs[1:4], lambda s: CASE WHEN regexp_matches(s, '[0-9]') OR length(s) > 40 OR s = '**' THEN '*' ELSE s END),
  CASE WHEN len(segs) > 4 THEN ['**'] ELSE [] END) AS shape, bad, host AS template FROM g LEFT JOIN k ON k.key = g.key),
{"".join(_op3_level(k) for k in range(5)).strip()}
q AS (SELECT template, (coalesce(sum(CAST(bad AS INTEGER)), 0) + 5.0 * coalesce((SELECT avg(CAST(bad AS INTEGER)) FROM t0), 0)) / (count(bad) + 5.0) AS purity FROM t5 GROUP BY 1),
r(rule, verdict) AS (VALUES {", ".join(f"('{r}', '{v}')" for r, v in URL_RULES)}),
f AS (SELECT t.page_id, t.host, t.path, q.purity, r.rule, r.verdict, row_number() OVER (PARTITION BY t.page_id ORDER BY length(r.rule) DESC NULLS LAST) AS n
  FROM t5 t JOIN q ON q.template = t.template LEFT JOIN r ON (t.host = string_split(r.rule, '/')[1] OR t.host LIKE '%.' || string_split(r.rule, '/')[1])
  AND starts_with(t.path, substr(r.rule, strpos(r.rule, '/'))))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN purity >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict FROM f WHERE n = 1
"""


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed so that each source's share goes with the root of its size, as large as the input."""
    return mix_sources(row_keys(table(spark, sf_dir, "documents")), power=0.5, epochs=1.0, seed=0, row=("__file", "__row"))


OP4_SQL = """
WITH s AS (SELECT source, CAST(sum(length(coalesce(text, ''))) AS DOUBLE) AS z FROM documents GROUP BY 1),
p AS (SELECT source, CASE WHEN z = 0 THEN 1.0 ELSE sqrt(z) / sum(sqrt(z)) OVER () * sum(z) OVER () / z END AS rate FROM s),
c AS (SELECT source, j, sum(exp(-rate + j * ln(rate) - lgamma(j + 1))) OVER (PARTITION BY source ORDER BY j) AS f FROM p, (SELECT unnest(range(0, 60)) AS j)),
d AS (SELECT *, CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0 AS u FROM documents),
k AS (SELECT c.source, c.f, lead(c.f) OVER (PARTITION BY c.source ORDER BY j) AS g, j + 1 AS copies FROM c)
SELECT doc_id, text, lang, d.source, n_chars, CAST(copy AS INTEGER) AS copy, md5('1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(copy AS VARCHAR)) AS shuffle_key
FROM (SELECT d.*, unnest(range(1, k.copies + 1)) AS copy FROM d JOIN k ON k.source IS NOT DISTINCT FROM d.source AND k.f <= d.u AND (k.g > d.u OR k.g IS NULL)) d
"""


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of 1024 ids."""
    return pack(table(spark, sf_dir, "documents"), length=1024, end_id=0)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that repeat an earlier line, up to one edit."""
    return line_dedup(row_keys(table(spark, sf_dir, "documents")), min_chars=20, row=("__file", "__row")).select("doc_id", "n_lines", "n_removed", "text")


def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, and whether it stays once its failing lines are removed."""
    out = line_rules(table(spark, sf_dir, "documents"), max_loss_percent=50)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


OP7_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) > 5)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
step AS (SELECT doc_id, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM twice),
rep AS (SELECT doc_id, CAST(sum(least(5, coalesce(s, 5))) AS BIGINT) AS n FROM step GROUP BY 1),
l AS (SELECT doc_id, length(x) AS c, regexp_replace(regexp_replace(x, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS x FROM (SELECT doc_id, unnest(ls) AS x FROM w)),
r AS (SELECT doc_id, c, x, len(string_split_regex(x, '[\x20\x09-\x0D]+')) AS n, length(x) - length(translate(x, '#*$%&|<>', '')) AS sym FROM l),
f AS (SELECT doc_id, sum(c) AS whole, sum(CASE WHEN (n < 6 AND NOT regexp_matches(x, {_quoted(SENTENCE_END)}))
    OR length(x) - length(replace(x, '|', '')) >= 2 OR (n <= 4 AND regexp_matches(lower(x), {_quoted(NAVIGATION)}))
    OR (n <= 30 AND regexp_matches(lower(x), {_quoted(BOILERPLATE)})) OR (sym >= 3 AND sym * 10 > n * 3)
    OR (n >= 4 AND (length(x) - length(replace(x, '!', ''))) * 2 > n) THEN c ELSE 0 END) AS lost FROM r GROUP BY 1),
b AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  coalesce(rep.n, 0) AS n_repeat_words, coalesce(whole, 0) AS whole, coalesce(lost, 0) AS lost
  FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id LEFT JOIN f ON f.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR n_repeat_words * 100 > n_words * 20 AS base_failed,
  NOT (n_words < 10 OR n_repeat_words * 100 > n_words * 20) AND lost * 100 <= whole * 50 AS kept FROM b
"""


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and a digest of every document's format spans, and all its spans."""
    out = personal_data(table(spark, sf_dir, "documents"))

    def count(i):  # a lambda with a second argument would be given the place in the array
        return F.size(F.filter("base", lambda x: x["k"] == i)).cast("long")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(FORMATS)]
    return out.select("doc_id", *counts, F.sha2(spans_string(F.col("base")), 256).alias("base_sha256"), spans_string(F.concat("base", "added")).alias("spans"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every document; the model is fitted to at most 2000 labelled rows of each class."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), per_class=2000, threshold=0.3)


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token-id files in doc_id order, and read back through the index."""
    path = f"{scratch_dir(spark).rstrip('/')}/tidemark/token-store-{uuid.uuid4().hex}"
    write_store(table(spark, sf_dir, "documents"), path, end_id=2)
    return read_store(spark, path)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from every source's documents, at each step of all 120 orders."""
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
m AS (SELECT doc_id, part, len(ws) < 50 AS a, 100 * len(list_distinct(ws)) < 65 * len(ws) AS b, 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS c,
  regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > least, false) AS e FROM w),
k AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY 1),
f AS (SELECT part, CASE WHEN a THEN 1 ELSE 0 END + CASE WHEN b THEN 2 ELSE 0 END + CASE WHEN c THEN 4 ELSE 0 END + CASE WHEN d THEN 8 ELSE 0 END + CASE WHEN e THEN 16 ELSE 0 END AS mask,
  coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM m LEFT JOIN k USING (doc_id)),
o(filter_order, step, own, earlier) AS (VALUES {", ".join(f"('{x['filter_order']}', {x['step']}, {x['own']}, {x['earlier']})" for x in steps())}),
r AS (SELECT part, filter_order, step, own, count(*) FILTER (mask & (own | earlier) = 0) AS kept, count(*) FILTER (mask & earlier = 0 AND mask & own > 0) AS removed,
  count(*) FILTER (mask & earlier > 0 AND mask & own > 0) AS redundant, count(*) FILTER (mask = own) AS unique_fails,
  count(*) FILTER (mask & earlier = 0 AND mask & own > 0 AND good) AS good_lost, count(*) FILTER (mask & earlier = 0 AND mask & own > 0 AND toxic) AS toxic_lost
  FROM f CROSS JOIN o GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
"""


def with_periods(docs: DataFrame) -> DataFrame:
    """docs with a tail made periodic in the texts whose doc_id has a CRC-32 divisible by 10; a null doc_id changes nothing."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    out = docs.select("*", words.alias("__w"), F.floor(h / 10).alias("__g")).withColumn("__n", F.size("__w"))
    out = out.withColumn("__a", F.when(F.col("__n") > 0, F.col("__g") % F.col("__n")).cast("int"))
    out = out.withColumn("__p", F.expr("CAST(1 + (__n - __a) DIV (3 + __g % 8) AS INT)"))
    tail = "array_join(concat(slice(__w, 1, __a), transform(sequence(__a, __n - 1), i -> element_at(__w, 1 + __a + (i - __a) % __p))), ' ')"
    return out.withColumn("text", F.expr(f"CASE WHEN __n > 0 THEN {tail} ELSE text END")).drop("__w", "__g", "__n", "__a", "__p")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document, a tenth of which are made periodic first: their number, the longest one, and digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    most = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("period"))))
    out = periodic_runs(with_periods(docs), 12, "doc_id").withColumn("most", most)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("most.back")).alias("start"), F.col("most.length").alias("length"), (-F.col("most.period")).alias("period"),
        F.expr("1000 * most.length DIV -most.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


OP12_SQL = r"""
WITH b AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
  flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_transform(range(8), lambda i: (ascii(c) >> CAST(i AS INTEGER)) & 1))) AS bits FROM documents),
h AS (SELECT doc_id, ws, len(ws) AS n, xor(list_reduce(list_prepend(4294967295, list_transform(bits, lambda x: CAST(x AS BIGINT))), lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295) AS h FROM b),
g AS (SELECT *, h // 10 AS g, (h // 10) % nullif(n, 0) AS a FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM g),
r AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE ws END AS ws FROM p),
x AS (SELECT doc_id, unnest(ws) AS w, unnest(range(n)) AS i FROM r),
e AS (SELECT u.doc_id, u.i, v.i - u.i AS q FROM x u JOIN x v ON u.doc_id = v.doc_id AND u.w = v.w AND u.i < v.i),
k AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e),
s AS (SELECT doc_id, min(i) AS start, count(*) + q AS length, q FROM k GROUP BY doc_id, q, island HAVING count(*) >= greatest(q, 12 - q)),
f AS (SELECT doc_id, start, length, min(q) AS period FROM s GROUP BY 1, 2, 3),
t AS (SELECT doc_id, count(*) AS n_runs, arg_min(f, (-length, start, period)) AS most, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM f GROUP BY 1),
c AS (SELECT x.doc_id, string_agg(w, ' ' ORDER BY i) AS kept FROM x WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.doc_id = x.doc_id AND x.i >= f.start + f.period AND x.i < f.start + f.length) GROUP BY 1)
SELECT r.doc_id, coalesce(n_runs, 0) AS n_runs, most.start AS start, most.length AS length, most.period AS period, 1000 * most.length // most.period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256 FROM r LEFT JOIN t ON t.doc_id = r.doc_id LEFT JOIN c ON c.doc_id = r.doc_id
"""


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by a model of at most 400 texts a language."""
    return language_scores(table(spark, sf_dir, "documents"), 400, 1500).drop("shares")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
        "op2_exact_topk": op2_exact_topk,
        "op3_url_filter": op3_url_filter,
        "op4_source_mixing": op4_source_mixing,
        "op5_packing": op5_packing,
        "op6_line_dedup": op6_line_dedup,
        "op7_line_rules": op7_line_rules,
        "op8_personal_data": op8_personal_data,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_token_store": op10_token_store,
        "op11_filter_audit": op11_filter_audit,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_language_id": op13_language_id,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_jaccard_join": OP1_SQL, "op2_exact_topk": OP2_SQL, "op3_url_filter": OP3_SQL, "op4_source_mixing": OP4_SQL, "op7_line_rules": OP7_SQL, "op11_filter_audit": OP11_SQL, "op12_periodic_runs": OP12_SQL}
