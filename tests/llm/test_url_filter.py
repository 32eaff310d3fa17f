import pytest
from pyspark.sql import functions as F

from newsflow.llm.queries import URL_RULES
from newsflow.llm.url_filter import filter_urls, host_and_path, matching_rule, suffix_and_domain

PAGES = "page_id long, url string, host string, suffix string, n int"


@pytest.mark.parametrize(
    ("url", "host", "path", "rule"),
    [
        (None, "", "", None),
        ("", "", "", None),
        ("no scheme/at all", "", "", None),
        ("https://WWW.Example.COM/en/x?q=1#f", "www.example.com", "/en/x", "www.example.com/en/"),
        ("http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/"),
        ("http://badexample.com/en/", "badexample.com", "/en/", "com/"),
        ("http://example.com", "example.com", "", None),
        ("http://example.com?/en/", "example.com", "", None),
        ("http://example.com/EN/", "example.com", "/EN/", "com/"),
        ("x://b.net/fr/1?u=://c.com/", "b.net", "/fr/1", "net/fr/"),
        ("http://b.net/es", "b.net", "/es", None),
        ("http://com/x", "com", "/x", "com/"),
        ("http://ÄB.com:80/", "Äb.com:80", "/", None),
        ("://", "", "", None),
        ("http://h.net\n/es/", "h.net\n", "/es/", None),
    ],
)
def test_rules(spark, url, host, path, rule):
    one = spark.createDataFrame([(url,)], "url string").select(*[c.alias(n) for n, c in zip("hp", host_and_path(F.col("url")), strict=True)])
    row = one.select("h", "p", matching_rule(F.col("h"), F.col("p"), URL_RULES)[0].alias("rule")).first()
    assert (row.h, row.p, row.rule) == (host, path, rule)


def test_domains(spark):
    hosts = spark.createDataFrame([("a.b.example.co.uk",), ("x.example.com:81",), ("localhost",), ("",)], "h string")
    suffix, domain = suffix_and_domain(F.col("h"))
    assert [tuple(r) for r in hosts.select(suffix, domain).collect()] == [("co.uk", "example.co.uk"), ("com", "example.com"), ("localhost", "localhost"), ("", "")]


def test_reputation_shrinks(spark):
    rows = [(k, f"http://good{k % 20}.fine.org/{k}") for k in range(400)] + [(k, f"http://bad.awful.org/{k}") for k in range(400, 440)]
    rows += [(900, "http://once.awful.org/"), (901, "http://new.fine.org/"), (902, None), (902, None)]
    pages = spark.createDataFrame([(*r, "c", "c", 1) for r in rows], PAGES)
    outcomes = spark.createDataFrame([(k, int(k < 400)) for k in range(440)] + [(900, 1), (901, None), (5000, 0)], "page_id long, good int")
    got = {r.page_id: r for r in filter_urls(pages, outcomes).collect()}
    assert len(got) == len({r[0] for r in rows}) and got[0].verdict == "allow" and got[410].verdict == "block"
    # one good page does not lift a host to its own rate: it stays between the domain's and 1
    assert got[410].rate < got[900].rate < 1 and got[0].lower < got[0].rate < got[0].upper
    assert got[901].rate is None and got[902].host == ""


def test_no_labels_and_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, good int")
    pages = spark.createDataFrame([(1, "http://a.org/", "", "", 1)], PAGES)
    assert [r.verdict for r in filter_urls(pages, none).collect()] == ["allow"]
    assert filter_urls(pages.filter("false"), none, URL_RULES).collect() == []


def test_plan_has_no_python(spark):
    from newsflow.llm.queries import op1_url_filters

    plan = op1_url_filters(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
