import duckdb

from devmetrics.llm import url_filter
from tests.conftest import SF_SMALL


def judge(spark, urls, **kw):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    return [r for r in url_filter.judge_urls(pages, **kw).orderBy("page_id").collect()]


def test_rules(spark):
    urls = ["http://A.example.ORG/es/x", "http://example.org/en/12", "http://example.org/en/2", "http://xexample.org/es/", "http://org/", "http://org",
            "http://h.com/fr/1?q", "http://h.com/de/", "http://h.com/DE/", "no scheme", None, "", "http://u@h.com:80/de/#f", "ftp://a.b.example.org/es/?x"]
    got = [(r.host, r.path, r.rule, r.verdict) for r in judge(spark, urls)]
    assert got == [
        ("a.example.org", "/es/x", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"),
        ("example.org", "/en/2", "org/", "allow"), ("xexample.org", "/es/", "org/", "allow"), ("org", "/", "org/", "allow"),
        ("org", "", None, "allow"), ("h.com", "/fr/1", "com/fr/", "allow"), ("h.com", "/de/", "com/de/", "block"), ("h.com", "/DE/", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("u@h.com:80", "/de/", None, "allow"),
        ("a.b.example.org", "/es/", "example.org/es/", "block")]


def test_vocabulary(spark):
    urls = ["http://casino.net/", "http://casinos.net/", "http://my-CASINO-1.net/", "http://free.net/x", "http://free.net/free", "http://free-pills.net/",
            "http://x.net/?a=win&b=bet", "http://é" + "casino" + "é.net/", "http://free2pills.net/"]
    got = judge(spark, urls)
    assert [r.verdict for r in got] == ["block", "allow", "block", "allow", "allow", "block", "block", "block", "allow"]
    assert (got[4].n_soft, got[4].n_distinct_soft) == (2, 1)


def test_own_rules_and_ties(spark):
    got = judge(spark, ["http://b.a.net/xy"], rules=(("allow", "a.net/x"), ("block", "net/xy"), ("block", "a.net/xyz")))
    assert (got[0].rule, got[0].verdict) == ("a.net/x", "allow")


def test_oracle_and_empty(spark):
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{SF_SMALL}/pages.parquet'")
    want = con.sql(url_filter.oracle_sql() + " ORDER BY page_id").fetchall()
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = url_filter.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict").orderBy("page_id").collect()
    assert [tuple(r) for r in got] == want
    assert url_filter.judge_urls(pages.limit(0)).collect() == []
