"""URL filters against their SQL, the parsing rules and hand-made posteriors."""

import pytest
from pyspark.sql import functions as F

from fixtures_llm import agrees, tables  # noqa: F401

from candlewick.llm.queries import URL_RULES
from candlewick.llm.url_reputation import domain_levels, host_reputation, judge_urls, matching_rule, url_host, url_path

URLS = [("https://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/"),
        ("http://example.net/de/", "example.net", "/de/", "net/"), ("http://example.net", "example.net", "", None),
        ("http://notexample.net/en/", "notexample.net", "/en/", "net/"), ("x://b.org/fr/?", "b.org", "/fr/", "org/fr/"),
        ("http://example.com/de", "example.com", "/de", None), ("http://w.example.com/de/1", "w.example.com", "/de/1", "example.com/de/"),
        ("a://b://c/d", "b:", "//c/d", None), (None, "", "", None), ("no scheme", "", "", None), ("", "", "", None),
        ("://h.org?x=/fr/", "h.org", "", None), ("http://h.ÉÄ.net/p", "h.ÉÄ.net", "/p", "net/"), ("http://", "", "", None),
        ("http://u.net#/a", "u.net", "", None), ("http://x.org/fr/\n/y", "x.org", "/fr/\n/y", "org/fr/")]


def test_parsing_and_rules(spark):
    df = spark.createDataFrame([(i, u) for i, (u, *_) in enumerate(URLS)], "i int, url string")
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    got = df.select("i", host.alias("h"), path.alias("p"), matching_rule(host, path, URL_RULES)["rule"].alias("r")).collect()
    for r in got:
        assert (r["h"], r["p"], r["r"]) == URLS[r["i"]][1:]


def pages():
    rows = [(i, u, None) for i, (u, *_) in enumerate(URLS)]
    hosts = ["good.one.com"] * 30 + ["bad.one.com"] * 30 + ["new.one.com"] * 3 + ["bad.two.info"] * 40 + ["new.two.info"] * 2
    return rows + [(100 + i, f"http://{h}/p{i}", "h") for i, h in enumerate(hosts)] + [(100, "http://good.one.com/again", None)]


def labels():
    return [(100 + i, 1 if i < 30 or i % 9 == 0 else 0, 0) for i in range(103)] + [(None, 1, 0), (3, None, 1), (5, 0, None), (5, 1, None)]


def test_verdicts_equal_sql(agrees, tables):
    rows = {r["page_id"]: r for r in agrees("op7_url_filters", tables(pages=pages(), labels=labels()), "pages", "labels")}
    assert rows[101]["verdict"] == "allow" and rows[131]["verdict"] == "block" and rows[170]["verdict"] == "block"


def test_shrinkage_pulls_small_hosts_to_their_domain(spark):
    rows = [("a.x.com", 1)] * 50 + [("b.x.com", 1)] * 50 + [("c.x.com", 0)] + [("new.x.com", None)] * 4 + [("d.y.com", 0)] * 60 \
        + [("e.y.com", 0)]
    got = {r["host"]: r for r in host_reputation(spark.createDataFrame(rows, "host string, good int")).collect()}
    assert got["a.x.com"]["good_share"] > 0.9 and got["c.x.com"]["good_share"] < got["new.x.com"]["good_share"]
    assert got["new.x.com"]["good_share"] > 0.8 > 0.2 > got["e.y.com"]["good_share"]
    assert got["new.x.com"]["good_bound"] < got["a.x.com"]["good_bound"]


def test_levels_and_edges(spark):
    df = spark.createDataFrame([("a.b.co.uk",), ("co.uk",), ("x.org",), ("org",), ("",), ("s.t.u.com",)], "h string")
    got = {r["h"]: (r["d"], r["s"]) for r in df.select("h", *[c.alias(n) for c, n in zip(domain_levels(F.col("h"), ["co.uk"]), "ds")]).collect()}
    assert got == {"a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.org": ("x.org", "org"),
                   "org": ("org", "org"), "": ("", ""), "s.t.u.com": ("u.com", "com")}
    p, m = spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], "doc_id long, quality int")
    assert judge_urls(p, m).collect() == []
    one = spark.createDataFrame([(None, "http://q.com/", "x"), (None, "http://q.com/", "x")], "page_id long, url string, host string")
    assert [r["verdict"] for r in judge_urls(one, m).collect()] == ["block", "block"]  # nothing is known, so nothing is shown


def test_a_wider_bound_is_stricter(spark, tables):
    folder = tables(pages=pages(), labels=labels())
    p, m = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("pages", "labels"))
    allowed = [{r["page_id"] for r in judge_urls(p, m, z=z).filter("verdict = 'allow'").collect()} for z in (0.0, 1.645, 3.0, 50.0)]
    assert all(b <= a for a, b in zip(allowed, allowed[1:])) and len(allowed[0]) >= 30 and len(allowed[-1]) < len(allowed[0])
