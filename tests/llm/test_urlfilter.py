from skytally.llm import urlfilter
from skytally.llm.urlfilter import filter_urls, spelling
from pyspark.sql import functions as F

RULES = [("com", "/", "allow"), ("bad.org", "/", "block"), ("ok.bad.org", "/a/", "allow"), (None, "/", "block")]


def judge(spark, pages, redirects=None):
    frame = spark.createDataFrame([(*p, "h") for p in pages], "page_id long, url string, html string, host string")
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    if redirects is not None:
        redirects = spark.createDataFrame(redirects, "url string, target string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(frame, rules, redirects).collect()}


def test_rules(spark):
    found = judge(spark, [
        (1, "http://X.Bad.ORG/a?x#y", None), (2, "https://ok.bad.org/a/b", ""), (3, "https://ok.bad.org", None),
        (4, "https://notbad.org/", None), (5, None, None), (6, "mailto:a@b", None), (7, "http://bad.org/", None),
        (7, "http://bad.org/", None), (None, "http://a.com/", None),
    ])
    assert found[1] == ("x.bad.org", "/a", "bad.org/", "block")
    assert found[2] == ("ok.bad.org", "/a/b", "ok.bad.org/a/", "allow")
    assert found[3] == ("ok.bad.org", "", None, "allow")
    assert found[4][2:] == (None, "allow")
    assert found[5] == found[6] == ("", "", None, "allow")
    assert found[7][3] == "block" and found[None][2] == "com/"


def test_decisions_reach_aliases_and_allow_comes_first(spark):
    canonical = '<LINK class=x rel="canonical" href="http://bad.org/x">'
    chain = [(f"http://n{i}.net/", f"http://n{i + 1}.net/") for i in range(9)]
    found = judge(
        spark,
        [
            (1, "http://a.net/1", canonical), (2, "https://a.net/1#top", None), (3, "http://b.net/", None),
            (4, "http://c.net/", '<meta http-equiv="refresh" content="0; url=//bad.org/">'),
            (5, "http://d.net/", None), (6, "http://e.net/", None), (7, "http://n0.net/", None),
        ],
        [("http://d.net/", "http://bad.org/y"), ("http://d.net/", "http://x.com/"), (None, "http://bad.org/"),
         ("http://n9.net/", "http://bad.org/z"), *chain],
    )
    assert [found[i][3] for i in (1, 2, 3, 4, 5, 6, 7)] == ["block", "block", "allow", "block", "allow", "allow", "block"]


def test_spelling_and_empty(spark):
    urls = ["HTTP://A.net/P?utm_source=x&b=1#f", "https://a.net/P?b=1", "http://a.net/p?gclid=1"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in frame.select(spelling(F.col("url"))).collect()] == [urls[1], urls[1], "https://a.net/p"]
    assert judge(spark, []) == {}


def test_links_of_odd_and_very_long_pages(spark):
    import time

    pages = [
        ("http://a.com/x", '<link rel="canonical" href="/y"><LINK HREF=//b.com/z REL=canonical >'),
        ("http://c.com/x", "<link href=/no rel=alternate><meta http-equiv=refresh content='3; url=/next'><link <link rel=canonical"),
        ("http://d.com/x", "<link " * 170_000), ("http://e.com/x", "<link rel=canonical " + "rel = " * 170_000 + ">"),
        ("http://f.com/x", "<meta http-equiv" + " " * 1_000_000 + ">"), ("http://g.com/x", "<link rel=canonical" * 60_000 + " href=/end>"),
    ]
    df = spark.createDataFrame(pages, "url string, html string")
    start = time.perf_counter()
    found = sorted(map(tuple, urlfilter.links(df).collect()))
    assert time.perf_counter() - start < 10
    assert found == [
        ("http://a.com/x", "http://a.com/y"), ("http://a.com/x", "http://b.com/z"), ("http://c.com/x", "http://c.com/next"), ("http://g.com/x", "http://g.com/end"),
    ]
