"""Rules of markup, robots files, seeds and counters, with literal expectations."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from linkloom.functions.html import href_value, raw_anchor_values
from linkloom.operators import frontier as FR
from linkloom.operators import robots as R
from linkloom.operators.metrics import histogram

ANCHORS = [
    ("<a href>x</a>", [""]), ("<a href=>", [""]), ('<a class="x"href="/y">', ["/y"]), ("<a href=/it's>", ["/it's"]),
    ('<a href="/caf&eacute;">', ["/café"]), ('<a href="/a&#38;lt;b">', ["/a&lt;b"]),
    ('<a href="/&#0000000065;&#x00000041;&#99999999;">', ["/AA�"]), ('<!-- open <a href="/c">', []),
    ('<noscript><a href="/n"></noscript><a href=/k>', ["/k"]), ('<a data-href="/d" href="/e">', ["/e"]),
    ("<iframe><a href=\"/n\"></iframe ><A HREF = '/q'>", ["/q"]), ('<abbr href="/z">', []),
    ('<a href="/x?a=1&copy=2&amp;b&amp">', ["/x?a=1&copy=2&b&"]), ('<a hrefx="/1" href="/2" href="/3">', ["/2"]),
    ('<a title = "a>b" href=/u/>', ["/u/"]), ('<a disabled href="&lt;&#x80;&#0;&notit;&copy">', ["<€�&notit;©"]),
    ('<a\nhref="/nl"/><a href/>', ["/nl", ""]), ("<a/href=/s>", ["/s"]),
]


def test_anchor_rules(spark):
    df = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(ANCHORS)], "i int, html string")
    got = {r.i: r.v for r in df.select("i", F.transform(raw_anchor_values(F.col("html")), href_value).alias("v")).collect()}
    assert [got[i] for i in range(len(ANCHORS))] == [w for _, w in ANCHORS]


@pytest.mark.parametrize("text, path, allowed", [
    ("﻿User-agent: *\nDisallow: /x", "/x", False), ("User-agent: *\nDisallowed: /x", "/x", False),
    ("User-agents: BacklinksBot\nDisallow: /x", "/x/y", False), ("User-agent: *\nDisallow: /%c3%bc", "/%C3%BC", False),
    ("User-agent: *\nDisallow: /ü", "/%C3%BC", False), ("User-agent: *\nDisallow: /100%", "/100", True),
    ("User-agent: *\nDisallow: /x\nAllowed: /x/y", "/x/y", True), ("User-agent: *\nDisallow: /x\nAllow: /x", "/x", True),
])
def test_robots_rules(spark, text, path, allowed):
    rules = R.fold_rules(R.robots_rules(spark.createDataFrame([("h", text)], "host string, robot string")))
    pages = spark.createDataFrame([("h", path)], "host string, path_escaped string")
    assert [r.allowed for r in R.robots_allowed(pages, rules).collect()] == [allowed]


@pytest.mark.parametrize("text", ["aé" * 5, "€uro€€", "x𝄞𝄞", "plain text", "", "éé"])
@pytest.mark.parametrize("limit", [4, 5, 6, 7, 8])
def test_a_cut_splits_no_character(spark, text, limit):
    got = spark.createDataFrame([(text,)], "t string").select(R.cut_bytes(F.col("t"), limit)).first()[0]
    assert got == text.encode()[:limit].decode(errors="ignore")


def test_seeds_keep_the_order_of_the_arguments(spark, tmp_path):
    for name, url in (("z.txt", "https://a.com/1"), ("a.txt", "http://a.com/1 http://b.com/2")):
        (tmp_path / name).write_text(url)
    args = [str(tmp_path / "z.txt"), "https://b.com/2", f"file://{tmp_path / 'a.txt'}"]
    seeded = FR.seed_frontier(FR.empty_frontier(spark), FR.seeds_from_args(spark, args))
    assert {(r.host_reversed, r.scheme) for r in seeded.collect()} == {("com.a", "https"), ("com.b", "https")}


def test_unmeasured_durations_are_in_no_bucket(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", None), ("a", 3.0)], "m string, d double")
    got = {r.le: (r.cum_count, r["count"]) for r in histogram(df, "m", "d", [0.5, 5.0]).collect()}
    assert got == {"0.5": (1, 2), "5.0": (2, 2), "+Inf": (2, 2)}


def test_a_replayed_batch_counts_once(spark, tmp_path):
    from linkloom.streaming.ingest import ingest_batch, read_metrics, start_ingest
    pages = spark.createDataFrame([(1, "http://a.com/", '<a href="/x"><a href="/y">', dt.datetime(2024, 1, 1))],
                                  "page_id long, url string, html string, at timestamp").drop("at")
    for _ in range(2):
        ingest_batch(pages, 0, str(tmp_path / "t"), "r1")
    assert [tuple(r) for r in read_metrics(spark, str(tmp_path / "t")).collect()] == [("r1", 0, 2)]
    pages.write.parquet(str(tmp_path / "in"))
    runs = set()
    for _ in range(2):  # a restart on the same checkpoint goes on with the same run
        start_ingest(spark, str(tmp_path / "in"), str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination()
        runs |= {r.run_id for r in read_metrics(spark, str(tmp_path / "s")).collect()}
    assert len(runs) == 1 and os.path.isdir(tmp_path / "s" / "metrics")


def test_redirected_pages_with_equal_ids_keep_their_own_links(spark):
    from linkloom.operators import links as L
    df = spark.createDataFrame([(1, "http://a.com/", "http://b.com/d/", '<a href="x">'), (1, "http://c.com/", None, '<a href="y">')],
                               "page_id long, url string, final_url string, html string")
    got = {(r.source, r.target) for r in L.page_links(df).collect()}
    assert got == {("http://a.com", "http://b.com/d/x"), ("http://c.com", "http://c.com/y")}
