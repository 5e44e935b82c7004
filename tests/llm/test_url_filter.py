import pytest
from pyspark.sql import functions as F

from certflow.llm.url_filter import filter_urls, host_of, node_of, path_of, resolved


def page(link="", refresh=""):
    return (f'<html><head><link rel="stylesheet" href="/x.css"><LINK href="{link}" REL=canonical>' if link else "<html><head>") + (
        f"<meta http-equiv='Refresh' content='0; url={refresh}'>" if refresh else "") + "</head></html>"


PAGES = [
    (1, "http://A.example.com/de/1#top", page(), "block", "example.com/de/", False),
    (2, "http://b.example.com/fr/1", page("http://a.EXAMPLE.com/de/1"), "block", None, True),       # alias of a blocked page
    (3, "http://c.example.org/x", page("", "http://b.example.com/fr/1#a"), "block", None, True),      # over two steps
    (4, "http://d.example.org/fr/x", page("http://c.example.org/x"), "allow", "org/fr/", True),      # an explicit allow holds
    (5, "http://e.example.net/en/", page("//gone.net/x"), "allow", "example.net/en/", True),
    (6, "http://f.example.org/q?u=http://x.net/", page("//gone.net/x"), "block", None, True),         # target without a page
    (7, "http://g.example.org/", page(), "allow", None, False),
    (8, "http://h.net", page(), "allow", None, False),                                                # an empty path has no rule
    (9, None, page("http://a.example.com/de/1"), "allow", None, False),
    (10, "no address", page("http://a.example.com/de/1"), "allow", None, False),
    (11, "http://h.net/", None, "block", "net/", False),
    (11, "http://h.net/", None, "block", "net/", False),
    (None, "http://i.example.com/a/b", page("c"), "allow", None, False),
    (13, "http://i.example.com/a/c", page(), "allow", None, False),
    (14, "http://xnet/", page(), "allow", None, False),
    (15, "", "", "allow", None, False),
]


def test_pages(spark):
    frame = spark.createDataFrame([(i, u, h, "own") for i, u, h, *_ in PAGES], "page_id long, url string, html string, rule string")
    got = sorted(((r["page_id"], r["verdict"], r["rule"], r["alias_blocked"]) for r in filter_urls(frame).collect()), key=repr)
    # a page with a rule of its own that is in a blocked component also has alias_blocked
    want = [(i, v, r, a or i == 1) for i, _, _, v, r, a in PAGES]
    assert got == sorted(want, key=repr)
    assert filter_urls(frame.limit(0)).collect() == []


def test_redirect_table_with_a_hot_target(spark):
    frame = spark.createDataFrame([(k, f"http://p{k}.example.org/") for k in range(300)], "page_id long, url string")
    links = spark.createDataFrame([(f"http://p{k}.example.org/", "http://hub.net/") for k in range(299)], "source string, target string")
    got = {r["page_id"]: r["verdict"] for r in filter_urls(frame, links, html=None).collect()}
    assert got == {k: "block" if k < 299 else "allow" for k in range(300)}


@pytest.mark.parametrize(("url", "host", "path"), [
    ("HTTP://A.b/C?d#e", "a.b", "/C"), ("x://y", "y", ""), ("x://y?z/q", "y", ""), ("a://b://c/d", "b:", "//c/d"), ("none", "", ""), (None, "", ""),
    ("://h/p\nq", "h", "/p\nq"),
])
def test_parts(spark, url, host, path):
    row = spark.createDataFrame([(url,)], "u string").select(host_of(F.col("u")), path_of(F.col("u"))).first()
    assert tuple(row) == (host, path)


@pytest.mark.parametrize(("target", "want"), [
    ("http://z/y", "http://z/y"), ("//z/y", "http://z/y"), ("/y", "http://a/y"), ("y", "http://a/b/y"), ("mailto:x@y", None), ("", None),
])
def test_resolved(spark, target, want):
    row = spark.createDataFrame([(target, "http://a/b/c?d=/e/f")], "t string, b string").select(resolved(F.col("t"), F.col("b"))).first()
    assert row[0] == want


def test_node_keeps_query_and_drops_fragment(spark):
    assert spark.createDataFrame([("HTTP://A/B?c#d",)], "u string").select(node_of(F.col("u"))).first()[0] == "http://a/B?c"


def test_all_links_and_hidden_ones(spark):
    refresh = "<meta http-equiv=refresh content='0; url={}'>"
    rows = [
        (1, "http://a.example.com/x", refresh.format("http://ok.example.com/") + refresh.format("http://bad.net/y")),
        (2, "http://b.example.com/x", "<link rel=canonical href=http://ok.example.com/2><link rel=canonical href=http://bad.net/z>"),
        (3, "http://c.example.com/x", "<!-- " + refresh.format("http://bad.net/y") + " -->"),
        (4, "http://d.example.com/x", "<script>var x = \"" + refresh.format("http://bad.net/y") + "\"</SCRIPT >"),
        (5, "http://e.example.com/x", "<!-- never closed " + refresh.format("http://bad.net/y")),
        (6, "http://f.example.com/x", "<!-- one --><!-- two -->" + refresh.format("http://bad.net/y")),
    ]
    made = filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.page_id: r.verdict for r in made.collect()} == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "block"}
