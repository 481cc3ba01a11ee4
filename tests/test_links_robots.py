"""Anchors, links, robots."""

from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from conftest import SF_BIG, SF_MID, SF_SMALL
from linkloom.operators import links as L
from linkloom.operators import robots as R
from linkloom.operators.responses import crawlable_reason
from linkloom.plans.queries import REGISTRY
from linkloom.sources.tables import read_pages


class _A(HTMLParser):
    def __init__(self):
        super().__init__()
        self.h = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            for k, v in attrs:
                if k == "href":
                    self.h.append(v)
                    break


def test_anchor_regex_equals_html_parser_on_all_pages(spark):
    for sf in (SF_SMALL, SF_MID, SF_BIG):
        pages = read_pages(spark, sf)
        got = {}
        for r in L.extract_raw_links(pages).collect():
            got.setdefault(r.page_id, []).append((r.pos, r.href))
        for r in pages.collect():
            p = _A()
            p.feed(r.html)
            mine = [h for _, h in sorted(got.get(r.page_id, []))]
            assert mine == p.h, r.page_id


def test_anchor_edge_cases(spark):
    html = ('<!-- <a href="/c1"> --><script>var x=\'<a href="/s">\'</script>'
            '<a data-href="/no" href="/yes">x</a><A HREF=/unq>y</A>'
            "<a title='t' href='/single'>z</a><a href=\"/q?a=1&amp;b=2\">w</a>"
            '<style>a{}</style><a class="x"\n href = "/nl">v</a>')
    df = spark.createDataFrame([(1, "http://h.com/", html)], "page_id long, url string, html string")
    hrefs = [r.href for r in L.extract_raw_links(df).orderBy("pos").collect()]
    assert hrefs == ["/yes", "/unq", "/single", "/q?a=1&b=2", "/nl"]


def test_parser_mode_matches_regex(spark):
    pages = read_pages(spark, SF_SMALL)
    a = sorted(tuple(r) for r in L.extract_raw_links(pages).select("page_id", "pos", "href").collect())
    b = sorted(tuple(r) for r in L.extract_raw_links(pages, extract="parser")
               .select("page_id", "pos", "href").collect())
    assert a == b


@pytest.mark.parametrize("sf,raw,distinct,targets,sources", [
    (SF_SMALL, 281, 279, 279, 49), (SF_MID, 1413, 1404, 1327, 250),
    (SF_BIG, 14123, 14081, 8756, 2497)])
def test_fixture_link_counts(spark, sf, raw, distinct, targets, sources):
    pages = read_pages(spark, sf)
    assert L.extract_raw_links(pages).count() == raw
    pl = L.page_links(pages).cache()
    assert pl.count() == distinct
    assert pl.select("target").distinct().count() == targets
    assert pl.select("source").distinct().count() == sources


def test_groups_flatten_round_trip(spark):
    pl = L.page_links(read_pages(spark, SF_SMALL))
    back = L.flatten_groups(L.link_groups(pl))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, pl.collect()))


def test_insert_links_twice_is_once(spark):
    pl = L.page_links(read_pages(spark, SF_SMALL)).cache()
    first = L.insert_links(spark.createDataFrame([], "source string, target string"), pl)
    table = first.cache()
    assert table.count() == pl.count()
    assert L.insert_links(table, pl).count() == 0


def test_replace_links_keeps_other_sources(spark):
    links = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "source string, target string")
    re_read = spark.createDataFrame([("a", "w"), ("c", None)], "source string, target string")
    got = sorted(map(tuple, L.replace_links(links, re_read).collect()))
    assert got == [("a", "w"), ("b", "z")]


def test_backlink_counts(spark):
    links = spark.createDataFrame(
        [("http://a.com/1", "http://t.com/"), ("http://a.com/2", "http://t.com/"),
         ("https://b.com/1", "http://t.com/"), ("http://a.com/1", "http://u.com/")],
        "source string, target string")
    got = {r.target: (r.backlinks, r.referring_hosts) for r in L.backlink_counts(links).collect()}
    assert got == {"http://t.com/": (3, 2), "http://u.com/": (1, 1)}


ROBOTS_CASES = [
    ("/", "", True),
    ("/", "User-agent: *\nDisallow: /", False),
    ("/", "User-agent: BacklinksBot\nDisallow: /", False),
    ("/foo/thing.html", "User-agent: *\nDisallow: /foo/", False),
    ("/thing.html", "User-agent: *\nDisallow: /thing.html", False),
    ("/thing.html", "User-agent: *\nDisallow: /thing*", False),
    ("/bar/thing.html", "User-agent: *\nDisallow: /foo/", True),
    ("/not-thing.html", "User-agent: *\nDisallow: /thing.*", True),
    # own cases
    ("/x", "User-agent: BacklinksBot\nAllow: /\n\nUser-agent: *\nDisallow: /", True),
    ("/x", "User-agent: BacklinksBot\nDisallow: /y\n\nUser-agent: *\nDisallow: /", True),
    ("/x", "User-agent: other\nUser-agent: BacklinksBot/1.0\nDisallow: /x", False),
    ("/page", "User-agent: *\nDisallow: /page\nAllow: /page", True),  # allow wins ties
    ("/page.html", "User-agent: *\nDisallow: /*.html$", False),
    ("/page.html?x", "User-agent: *\nDisallow: /*.html$", True),
    ("/a", "# c\r\nUser-agent: *  # all\r\nDisallow: /a # no", False),
    ("/a", "\t\tUser-agent: *\n\t\tDisallow: /a*", False),
    ("/a", "User-agent: *\nDisallow:", True),
    ("/a", "User-agent: *\nDisallow: /b\nUser-agent: BacklinksBot\nDisallow: /c", True),
    ("/b", "User-agent: *\nDisallow: /b\n\nUser-agent: *\nDisallow: /a", False),  # merged groups
]


def test_robots_cases(spark):
    rows = [(f"h{i}.com", path, txt, exp) for i, (path, txt, exp) in enumerate(ROBOTS_CASES)]
    df = spark.createDataFrame(rows, "host string, path string, robot string, exp boolean")
    folded = R.fold_rules(R.robots_rules(df.select("host", "robot")))
    pages = df.select("host", F.col("path").alias("path_escaped"), "exp", "robot")
    got = R.robots_allowed(pages, folded).collect()
    for r in got:
        assert r.allowed == r.exp, (r.path_escaped, r.robot)


def test_robots_text_fallback(spark):
    statuses = [400, 401, 403, 404, 429, 500, 503]
    rows = [(f"s{s}.com", s, "text/plain", "User-agent: *\nDisallow: /") for s in statuses]
    rows += [("ok.com", 200, "Text/Plain; charset=utf-8", "User-agent: *\nDisallow: /nope*"),
             ("html.com", 200, "text/html", "x"), ("json.com", 200, "application/json", "x")]
    resp = spark.createDataFrame(rows, "host string, status int, content_type string, body string")
    hosts = resp.select("host").unionByName(spark.createDataFrame([("missing.com",)], "host string"))
    got = {r.host: r.robot for r in R.robots_text(hosts, resp).collect()}
    assert got["ok.com"] == "User-agent: *\nDisallow: /nope*"
    for h, t in got.items():
        if h != "ok.com":
            assert t == R.FALLBACK, h


@pytest.mark.parametrize("sf,expected", [(SF_SMALL, (41, 9)), (SF_MID, (204, 46)), (SF_BIG, (2024, 476))])
def test_robots_fixture_counts(spark, sf, expected):
    a = REGISTRY["robots_allowed"](spark, sf).cache()
    allowed = a.where("allowed").count()
    assert (allowed, a.count() - allowed) == expected


def test_crawlable_reasons(spark):
    rows = [(200, "text/html", ""), (204, "text/html", ""), (404, "text/html", ""),
            (200, "application/pdf", ""), (200, "text/html", "noindex"), (200, "text/html", None),
            (299, "TEXT/HTML", ""), (200, "text/html", "NOFOLLOW")]
    df = spark.createDataFrame(rows, "status int, content_type string, x_robots_tag string")
    got = [r.r for r in df.select(crawlable_reason().alias("r")).collect()]
    assert got == [None, "status", "status", "content_type", "robots_header", None,
                   "content_type", None]


def test_drop_reasons_cover_all_pages(spark):
    d = REGISTRY["drop_reasons"](spark, SF_MID)
    assert d.where("stage = 'page'").agg(F.sum("n")).first()[0] == 250


def test_final_url_is_resolution_base(spark):
    df = spark.createDataFrame(
        [(1, "http://a.com/x", "https://b.com/dir/y", '<a href="z">1</a><a href="//c.com/w">2</a>')],
        "page_id long, url string, final_url string, html string")
    got = sorted((r.source, r.target) for r in L.page_links(df).collect())
    assert got == [("http://a.com/x", "https://b.com/dir/z"), ("http://a.com/x", "https://c.com/w")]


def test_numeric_character_references_match_html_unescape(spark):
    import html as pyhtml

    from linkloom.functions.html import decode_entities
    cases = ["/a&#47;b", "/&#x2F;x&#X41;", "/&#65", "&#128;&#0;&#xD800;&#1114112;&#99999999999;",
             "&#x1F600;z", "&amp;#65;", "/q?a=1&amp;b=2&lt;", "plain"]
    df = spark.createDataFrame([(c,) for c in cases], "v string")
    for r in df.select("v", decode_entities(F.col("v")).alias("d")).collect():
        assert r.d == pyhtml.unescape(r.v), r.v


@pytest.mark.parametrize("sf,expected", [
    (SF_SMALL, {"kept": 28, "status": 15, "content_type": 5, "robots_header": 2}),
    (SF_MID, {"kept": 137, "status": 75, "content_type": 25, "robots_header": 13}),
    (SF_BIG, {"kept": 1375, "status": 750, "content_type": 250, "robots_header": 125})])
def test_response_reason_fixture_counts(spark, sf, expected):
    from linkloom.sources import derived as D
    r = D.responses(spark, sf).select(F.coalesce(crawlable_reason(), F.lit("kept")).alias("r"))
    assert {x.r: x["count"] for x in r.groupBy("r").count().collect()} == expected


@pytest.mark.parametrize("sf,pages,hosts", [(SF_SMALL, 49, 32), (SF_MID, 250, 58), (SF_BIG, 2493, 60)])
def test_page_key_fixture_counts(spark, sf, pages, hosts):
    c = L.canonical_pages(read_pages(spark, sf).select("page_id", "url")).cache()
    assert c.select("host_reversed", "path").distinct().count() == pages
    assert c.select("host").distinct().count() == hosts
