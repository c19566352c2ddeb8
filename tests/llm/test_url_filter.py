import pytest
from pyspark.sql import functions as F

from scorekit.llm import url_filter
from scorekit.llm.queries import URL_RULES
from scorekit.llm.url_filter import Rule, build_cascade, judge_urls

URLS = [
    (1, "http://a.net/x", "a.net", "/x", "net/", "block"),
    (2, "http://a.net", "a.net", "", None, "allow"),
    (3, "HTTP://A.Example.NET/en/1?q=/#f", "a.example.net", "/en/1", "example.net/en/", "allow"),
    (4, "http://badexample.net/en/", "badexample.net", "/en/", "net/", "block"),
    (5, "https://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
    (6, "https://example.com/DE/", "example.com", "/DE/", None, "allow"),
    (7, "https://x.org/fr/a b", "x.org", "/fr/a b", "org/fr/", "allow"),
    (8, "https://org?x=/fr/", "org", "", None, "allow"),
    (9, None, "", "", None, "allow"),
    (10, "no scheme.net/", "", "", None, "allow"),
    (11, "", "", "", None, "allow"),
    (12, "x://ÄB.net/é", "Äb.net", "/é", "net/", "block"),
    (13, "a://b://c.net/", "b:", "//c.net/", None, "allow"),
    (14, "http://.net/", ".net", "/", "net/", "block"),
    (15, "http://" + "a." * 20000 + "net/" + "p" * 50000, "a." * 20000 + "net", "/" + "p" * 50000, "net/", "block"),
    (1, "http://a.net/x", "a.net", "/x", "net/", "block"),
    (None, "http://b.net:80/", "b.net:80", "/", None, "allow"),
    (16, "line\nbreak://c.net/\nd", "c.net", "/\nd", "net/", "block"),
]
NAMES = ["page_id", "host", "path", "rule", "verdict"]


def pages(spark, rows):
    schema = "page_id long, url string, host string, key string, length int"
    return spark.createDataFrame([(r[0], r[1], "old", "k", 1) for r in rows], schema)


def test_verdicts(spark):
    found = judge_urls(pages(spark, URLS), URL_RULES).select(*NAMES).collect()
    expected = [(r[0], *r[2:]) for r in URLS]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_empty_tables_and_no_rules(spark):
    assert judge_urls(pages(spark, []), URL_RULES).collect() == []
    row = judge_urls(pages(spark, URLS[:1]), [], default="block").select(*NAMES).first()
    assert tuple(row) == (1, "a.net", "/x", None, "block")


@pytest.mark.parametrize("listed", [1, 40, 900])
def test_a_cascade_is_exact_over_its_keys(spark, listed):
    keys = [f"k{i}" for i in range(3000)]
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    names = [*keys[:listed], "not in the corpus"]
    cascade = build_cascade(universe, names)
    assert len(cascade.levels) > 1 or listed == 1
    found = {r.key for r in universe.where(cascade.has(universe["key"])).collect()}
    assert found == set(keys[:listed])


def test_longest_rule_wins(spark):
    rules = [Rule("block", "net", "/"), Rule("allow", "a.net", "/"), Rule("block", "net", "/long/")]
    urls = [(1, "http://a.net/long/x"), (2, "http://a.net/y"), (3, "http://b.net/y")]
    found = judge_urls(spark.createDataFrame(urls, "page_id int, url string"), rules).collect()
    assert [(r.page_id, r.rule) for r in found] == [(1, "net/long/"), (2, "a.net/"), (3, "net/")]


def test_long_lists_are_tables(spark):
    """Hosts by the hundred thousand, of which the pages show some, and every verdict is exact."""
    host = F.concat(F.lit("h"), F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(".net")).otherwise(F.lit(".a.org")))
    action = F.when(F.col("id") % 2 == 0, F.lit("block")).otherwise(F.lit("allow"))
    path = F.when(F.col("id") % 5 == 0, F.lit("/x/")).otherwise(F.lit("/"))
    rules = spark.range(200_000).select(action.alias("action"), host.alias("host"), path.alias("path"))
    rules = rules.union(rules.limit(10)).union(spark.sql("SELECT 'block', NULL, '/'"))
    known = {r.host + r.path: r.action for r in rules.collect() if r.host}
    rows = []
    for i in range(0, 400_000, 997):
        name = f"h{i}{'.net' if i % 3 == 0 else '.a.org'}"
        rows += [(i, f"http://{name}/x/y", name), (i + 1, f"http://www.{name}/", name)]
    pages_ = spark.createDataFrame([(i, url) for i, url, _ in rows], "page_id long, url string")
    found = {r.url: (r.rule, r.verdict) for r in judge_urls(pages_, rules, default="none").collect()}
    for _, url, name in rows:
        path = url.split("/", 3)[3]
        keys = [name + p for p in ("/x/", "/") if ("/" + path).startswith(p)]
        rule = next((k for k in keys if k in known), None)
        assert found[url] == (rule, known[rule] if rule else "none")


def test_lists_beyond_the_bits_are_refused(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MOST_BITS", 10)
    universe = spark.range(50).selectExpr("cast(id AS string) AS key")
    with pytest.raises(ValueError, match="listed keys take"):
        build_cascade(universe, [str(i) for i in range(40)])
