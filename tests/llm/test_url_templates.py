import pytest
from pyspark.sql import functions as F

from tidemark.llm import url_templates as U
from tidemark.llm.url_templates import host_of, path_of, rule_for, shape_of, url_filter

RULES = [("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"), ("net/", "allow")]
URLS = [None, "", "no scheme", "http://A.Example.COM/en/7x?q#f", "https://example.com/en/8", "x://com/en/", "http://xcom/en/1", "http://a.net/de/8", "http://b.example.net/de/88#x", "http://example.net", "http://example.org?x=/es/", "http://é.ORG/ES/ß", "a://b://c/d", "http://h/a/b/c/d/e/f/g", "http://h//a///2", "http://h/" + "y" * 5000, "http://u:p@H.com:80/en/#", "http://h\n/x\ny", "://"]


def parse(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    return host, tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]


def rule(host, path):
    fit = [r for r in RULES if (host == (h := r[0].split("/", 1)[0]) or host.endswith("." + h)) and path.startswith("/" + r[0].split("/", 1)[1])]
    return max(fit, key=lambda r: len(r[0]), default=None)


def test_parts_and_rules(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    got = df.select("url", host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p")).withColumn("r", rule_for(F.col("h"), F.col("p"), RULES)).collect()
    for r in got:
        assert (r.h, r.p) == parse(r.url), r.url
        assert (tuple(r.r) if r.r else None) == rule(r.h, r.p), r.url
    shapes = [r.s for r in df.select(shape_of(path_of(F.col("url"))).alias("s")).collect()]
    assert shapes[13] == ["a", "b", "c", "d", "**"] and shapes[14] == ["a", "*"] and shapes[15] == ["*"] and shapes[0] == []


def brute(pages, labels):
    """template and purity of each page, by the definition."""
    parsed = []
    for _, url in pages:
        host, path = parse(url)
        segs = [s for s in path.split("/") if s]
        shape = ["*" if any(c.isdigit() for c in s) or len(s) > U.LONG_SEGMENT else s for s in segs[: U.DEPTH]] + ["**"] * (len(segs) > U.DEPTH)
        digits = "".join(c if c.isdigit() else " " for c in path).split()
        parsed.append((host, shape, labels.get(digits[-1]) if digits else None))
    names = [h for h, _, _ in parsed]
    for level in range(U.DEPTH + 1):
        kids = {}
        for (_, shape, bad), name in zip(parsed, names, strict=True):
            if level < len(shape) and shape[level] not in ("*", "**"):
                c = kids.setdefault(name, {}).setdefault(shape[level], [0, 0, 0])
                c[0], c[1], c[2] = c[0] + 1, c[1] + (bad is not None), c[2] + (bad is True)
        stays = set()
        for name, own in kids.items():
            pl, pb = sum(c[1] for c in own.values()), sum(c[2] for c in own.values())
            for seg, (n, cl, cb) in own.items():
                rl, rb = pl - cl, pb - cb
                if len(own) <= U.MAX_CHILDREN and n >= U.MIN_PAGES and 0 < pb < pl and cl and rl and (cb / cl - rb / rl) ** 2 >= U.DIFFERENT * pb * (pl - pb) / pl**2 * (1 / cl + 1 / rl):
                    stays.add((name, seg))
        names = [name if level >= len(shape) else f"{name}/{shape[level] if shape[level] == '**' or (name, shape[level]) in stays else '*'}" for (_, shape, _), name in zip(parsed, names, strict=True)]
    known = [b for _, _, b in parsed if b is not None]
    prior = sum(known) / len(known) if known else 0
    out = {}
    for t in set(names):
        own = [b for (_, _, b), n in zip(parsed, names, strict=True) if n == t and b is not None]
        out[t] = (sum(own) + prior * U.PRIOR) / (len(own) + U.PRIOR)
    return [(n, round(out[n], 9)) for n in names]


@pytest.mark.parametrize("children", [50, 3])
def test_templates_equal_brute_force(spark, monkeypatch, children):
    monkeypatch.setattr(U, "MAX_CHILDREN", children)
    kinds = ["spam", "news", "blog", "shop", "rare"]
    pages = [(i, f"http://h{i % 3}.org/{kinds[i % 5 if i % 50 else 4]}/{'a' if i % 2 else 'b'}/{i}.html") for i in range(600)] + [(1000 + i, u) for i, u in enumerate(URLS)] + [(7, "http://h1.org/spam/a/7.html")]
    labels = {str(i): (i % 5 == 0) if i % 3 else (i % 7 == 0) for i in range(600) if i % 4}
    known = spark.createDataFrame([*labels.items(), (None, True), ("5000", None)], "key string, bad boolean")
    got = url_filter(spark.createDataFrame(pages, "page_id long, url string").selectExpr("*", "1 AS host", "2 AS bad"), known, []).collect()
    want = sorted((i, *x) for (i, _), x in zip(pages, brute(pages, labels), strict=True))
    assert sorted((r.page_id, r.template, round(r.purity, 9)) for r in got) == want
    assert all(r.verdict == ("block" if r.purity >= U.LIMIT else "allow") and r.rule is None for r in got)
    assert children == 3 or any(r.verdict == "block" for r in got)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "key string, bad boolean")
    assert url_filter(spark.createDataFrame([], "page_id long, url string"), none, RULES).count() == 0
    assert {r.verdict for r in url_filter(spark.createDataFrame([(1, "http://x/y"), (2, None)], "page_id long, url string"), none, RULES).collect()} == {"allow"}


def verdicts(spark, pages, labels):
    known = spark.createDataFrame(list(labels.items()), "key string, bad boolean")
    return {r.page_id: r for r in url_filter(spark.createDataFrame(pages, "page_id long, url string"), known, []).collect()}


@pytest.mark.parametrize("sections", [50, 51, 120])
def test_any_number_of_sections_leaves_a_bad_one_blocked(spark, sections):
    pages = [(i, f"http://h/{'casino' if i < 300 else 's' + ''.join(chr(97 + int(d)) for d in str(i % (sections - 1)))}/{i}") for i in range(300 + 6 * sections)]
    got = verdicts(spark, pages, {str(i): i < 300 for i, _ in pages})
    assert len({u.split("/")[3] for _, u in pages}) == sections
    assert {got[i].template for i in range(300)} == {"h/casino/*"}
    assert all(got[i].verdict == ("block" if i < 300 else "allow") for i, _ in pages)


@pytest.mark.parametrize("above", ["", "2024/05/12/news", "2024/05/12/news/x/y/7/8"])
def test_sections_are_told_apart_at_any_depth(spark, above):
    pages = [(i, f"http://h/{above}/{'casino' if i % 2 else 'science'}/{i}/{i}/{i}") for i in range(200)]
    got = verdicts(spark, pages, {str(i): bool(i % 2) for i, _ in pages})
    assert all(r.verdict == ("block" if i % 2 else "allow") for i, r in got.items())
    start = "h" + "/*" * len([s for s in above.split("/") if s])
    assert {r.template for r in got.values()} == {f"{start}/{s}/{'**' if above else '*/*/*'}" for s in ("casino", "science")}


def test_deep_wildcards_fold_whatever_their_number(spark):
    pages = [(i, "http://h/1/2/3/4" + f"/{i}" * (i % 40)) for i in range(80)] + [(99, "http://h/" + "a/" * 900 + "99")]
    got = verdicts(spark, pages, {"5": True})
    assert {r.template for r in got.values()} == {"h/*/*/*/*", "h/*/*/*/*/**"}
