import duckdb
import pytest
from pyspark.sql import functions as F

from panelrisk.llm import urls
from panelrisk.llm.oracle import OP13


def table(spark, found):
    rows = [(i, u, "<p>", 1, "h") for i, u in enumerate(found)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, n long, host string")


def parts(spark, *found):
    host, path = urls.host_and_path(F.col("url"))
    rows = table(spark, found).select("page_id", host.alias("h"), path.alias("p")).orderBy("page_id").collect()
    return [(r["h"], r["p"]) for r in rows]


def test_host_and_path(spark):
    assert parts(
        spark, "HTTP://WWW.Example.COM/A/b?x=/y#z", "a://b", "a://b?c", "a://b#/c", "no scheme", None, "", "x://y://z/w", "://É.com/É\n/#"
    ) == [("www.example.com", "/A/b"), ("b", ""), ("b", ""), ("b", ""), ("", ""), ("", ""), ("", ""), ("y:", "//z/w"), ("É.com", "/É\n/")]


def test_rules(spark):
    found = ["http://a.example.com/en/1", "http://www.example.com/en/", "http://x.www.example.com/en/q", "http://example.com/de/",
             "http://example.com", "http://notexample.com/en/", "http://net/es/", "http://a.b.net/fr/x", "http://b.net/FR/x", "http://com/"]
    rows = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(table(spark, found)).collect()}
    block, allow = ("example.com/en/", "block"), ("www.example.com/en/", "allow")
    assert [rows[i] for i in (0, 1, 2, 3)] == [block, allow, allow, ("com/", "allow")]
    assert [rows[i][0] for i in (4, 5, 6, 7, 8, 9)] == [None, "com/", "net/es/", "net/fr/", None, "com/"]


@pytest.mark.parametrize("host, domain, suffix", [
    ("a.b.example.co.uk", "example.co.uk", "co.uk"), ("example.com", "example.com", "com"), ("me@x.example.com:80", "example.com", "com"),
    ("10.0.0.1:8", "10.0.0.1", "10.0.0.1"), ("localhost", "localhost", "localhost"), ("", "", ""), ("x.org.", "x.org", "org")])
def test_domain(spark, host, domain, suffix):
    d, s = urls.domain_and_suffix(F.col("h"))
    assert tuple(spark.createDataFrame([(host,)], "h string").select(d, s).first()) == (domain, suffix)


def test_reputation_is_shrunk(spark):
    rows = [("bad.spam.net", 50, 49), ("new.spam.net", 0, 0), ("one.spam.net", 1, 0), ("fine.org", 60, 0), ("new.org", 1, 1), ("x.dev", 0, 0),
            ("also.org", 90, 2), ("ok.com", 40, 1)]
    found = {r["host"]: r for r in urls.host_bounds(spark.createDataFrame(rows, "host string, n long, bad long")).collect()}
    assert found["bad.spam.net"]["bound"] > 0.9 > found["one.spam.net"]["bad_rate"] > 0.2
    assert found["new.spam.net"]["bad_rate"] > 0.5 > found["x.dev"]["bad_rate"]
    assert found["new.org"]["bound"] < 0.5 and found["new.org"]["bad_rate"] < 0.8
    assert all(0 < r["bad_rate"] < 1 and r["bound"] < r["bad_rate"] for r in found.values())


def test_outcomes_given_from_outside(spark):
    pages = table(spark, ["http://a.org/1", "http://b.org/1", "http://c.org/"])
    good = spark.createDataFrame([("http://b.org/x", False)] * 30 + [("http://a.org/y", True)] * 30, "url string, bad boolean")
    verdict = {r["host"]: r["verdict"] for r in urls.judge(pages, rules=(), outcomes=good).collect()}
    assert verdict["a.org"] == "block" and verdict["b.org"] == "allow"


@pytest.mark.parametrize("found", [
    [], [None, "", "x"], ["http://a.net/en/"],
    ["http://hot.net/fr/1"] * 60 + ["http://hot.net/en/1"] * 60 + ["http://a.b.net/en/2", "http://a.org/", "http://b.co.uk/?", "http://x.co.uk/es/",
     "http://9.9.9.9/", "http://c.com", "https://c.com/en/", None, "ftp://Example.com/en/" + "z" * 100_000] * 2])
def test_against_sql(spark, found):
    rows = urls.judge(table(spark, found)).select("page_id", "host", "path", "rule", "verdict").collect()
    pages = table(spark, found).toPandas()  # noqa: F841
    with duckdb.connect() as db:
        db.register("pages", pages)
        expected = db.execute(OP13).fetchall()
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)
