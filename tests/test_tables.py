"""Sources and sinks: seed files (A1), table layouts, point lookups."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from linkloom.operators import frontier as FR
from linkloom.operators import links as L
from linkloom.session import ensure_checkpoint_dir
from linkloom.sources import tables as T
from linkloom.sources.tables import read_pages


def _scratch(spark):
    return tempfile.mkdtemp(dir=ensure_checkpoint_dir(spark).replace("file:", ""))


def test_seed_files(spark):
    d = _scratch(spark)
    with open(os.path.join(d, "a.txt"), "w") as f:
        f.write("http://a.com/x\n  https://a.com/x http://b.com/\n")
    lines = FR.read_seed_files(spark, [os.path.join(d, "a.txt")])
    seeds = FR.parse_seeds(lines, urls=["https://c.com/p"])
    front = FR.seed_frontier(FR.empty_frontier(spark), seeds)
    got = sorted((r.scheme, r.host_reversed, r.path) for r in front.collect())
    assert got == [("http", "com.a", "/x"), ("http", "com.b", ""), ("https", "com.c", "/p")]


def test_links_sorted_by_target_lookup_pushes_filter(spark):
    d = _scratch(spark)
    pl = L.page_links(read_pages(spark, SF_SMALL)).cache()
    T.write_links_by_target(pl, d + "/by_target")
    T.write_links_by_source(pl, d + "/by_source")
    one = pl.orderBy("target").first().target
    hit = T.lookup_sorted(spark, d + "/by_target", "target", one)
    assert hit.count() == pl.where(F.col("target") == one).count()
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(target), EqualTo(target," in plan
    assert spark.read.parquet(d + "/by_source").count() == pl.count()


def test_frontier_layout_round_trip(spark):
    from linkloom.plans.queries import REGISTRY
    d = _scratch(spark)
    f = REGISTRY["seed_frontier"](spark, SF_SMALL)
    T.write_frontier(f, d + "/frontier")
    back = spark.read.parquet(d + "/frontier")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, f.collect()))
    todo = back.where(F.col("latest_visit").isNull())
    assert "IsNull(latest_visit)" in todo._jdf.queryExecution().executedPlan().toString()


def test_seeds_from_args_and_hosts_table(spark):
    from linkloom.operators import robots as R
    d = _scratch(spark)
    path = os.path.join(d, "seeds.txt")
    with open(path, "w") as f:
        f.write("http://a.com/x http://b.com\n")
    s = FR.seeds_from_args(spark, [path, "https://c.com/y"])
    assert sorted(r.url for r in s.collect()) == ["http://a.com/x", "http://b.com", "https://c.com/y"]
    hosts = spark.createDataFrame([("a.b.com",), ("c.com",)], "host string")
    texts = R.robots_text(hosts, spark.createDataFrame([], "host string, status int, content_type string, body string"))
    T.write_hosts(texts, d + "/hosts")
    assert sorted(r.host_reversed for r in spark.read.parquet(d + "/hosts").collect()) == ["com.b.a", "com.c"]


def test_crawl_rounds_custom_policy(spark):
    from linkloom.plans.crawl import crawl_rounds
    from linkloom.sources import derived as D
    resp = D.graph_responses(spark, SF_SMALL).where("page_id < 0")  # empty archive
    seeds = spark.createDataFrame([(0, "http://s1.example.com/p/1")], "line_no long, value string")
    deny_all = lambda req: req.select("*", F.lit(False).alias("allowed"))
    frontier, links, report = crawl_rounds(seeds, resp, allow=deny_all)
    assert links.count() == 0 and report.count() == 1
    assert frontier.where(F.col("latest_visit").isNotNull()).count() == 1


def _tables_left(spark):
    folder = ensure_checkpoint_dir(spark).replace("file:", "") + "/tables"
    return {f for f in os.listdir(folder)} if os.path.isdir(folder) else set()


def test_segments_append_compact_and_keep_their_layout(spark):
    from linkloom.sources import segments
    before = _tables_left(spark)
    t = segments.SegmentTable(spark, "t", "k string, v int", ["k"], 4)
    for i in range(segments.COMPACT_EVERY + 3):
        assert t.append(spark.createDataFrame([(f"k{i % 7}", i), (None, i)], "k string, v int")) == 2
    assert sorted(r.v for r in t.read().collect()) == sorted(2 * list(range(segments.COMPACT_EVERY + 3)))
    assert t.rows == 2 * (segments.COMPACT_EVERY + 3) and t.written == t.rows + 2 * segments.COMPACT_EVERY
    left = _tables_left(spark) - before
    assert len(left) == 1, left  # the superseded folder is gone
    path = os.path.join(ensure_checkpoint_dir(spark).replace("file:", ""), "tables", left.pop())
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) <= 4 * 4 + 1
    other = spark.createDataFrame([("k1", 1)], "k string, w int").hint("merge")
    plan = t.read().hint("merge").join(other, "k", "left_anti")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan.collect()
        text = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert text.count("Exchange hashpartitioning") == 1, text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    t.drop()
    assert _tables_left(spark) == before


def test_crawl_rounds_write_what_they_add(spark):
    """Rows written in a round are its batch, its new pages and its new links, and no old table is left."""
    from linkloom.plans.crawl import crawl_rounds
    before = _tables_left(spark)
    n = 30  # a chain of pages, each linking to the next and to the first
    html = [f'<a href="http://h{i % 3}.com/p{i + 1}">n</a><a href="http://h0.com/p0">f</a>' for i in range(n)]
    resp = spark.createDataFrame(
        [(i, f"http://h{(i - 1) % 3 if i else 0}.com/p{i}", 200, "text/html", None, h) for i, h in enumerate(html)],
        "page_id long, url string, status int, content_type string, x_robots_tag string, html string")
    seeds = spark.createDataFrame([(0, "http://h0.com/p0")], "line_no long, value string")
    allow = lambda req: req.select("*", F.lit(True).alias("allowed"))
    frontier, links, report = crawl_rounds(seeds, resp, allow=allow, max_rounds=12)
    rows = report.orderBy("round").collect()
    assert [r.batch for r in rows] == [1] * 12 and [r.pages for r in rows] == [1] * 12
    assert [r.links for r in rows] == [2] * 12
    assert [r.written for r in rows] == [4] * 12
    assert links.count() == 24 and frontier.count() == 13
    assert frontier.where(F.col("latest_visit").isNotNull()).count() == 12
    assert len(_tables_left(spark) - before) == 3


def test_crawl_rounds_match_a_simulation(spark):
    """Frontier, links and report of a crawl page by page: both schemes, several responses of a page, robots, refusals."""
    import random
    from linkloom.operators.robots import fold_rules, robots_rules, robots_text
    from linkloom.plans.crawl import crawl_rounds
    rng = random.Random(4)
    urls = [f"{s}://h{h}.com/{'x' if i % 4 == 0 else 'p'}{i}" for h in range(3) for i in range(14) for s in ("http", "https")]
    archive = []
    for i, url in enumerate(rng.choices(urls, k=120)):  # some pages several times, some never
        targets = rng.sample(urls, 5)
        archive.append((i, url, rng.choice([200, 200, 200, 404]), "text/html", rng.choice([None, None, "nofollow"]),
                        "".join(f'<a href="{t}">x</a>' for t in targets + targets[:1]), targets))
    hosts = spark.createDataFrame([("h0.com",), ("h1.com",), ("h2.com",)], "host string")
    files = spark.createDataFrame([("h1.com", 200, "text/plain", "User-agent: *\nDisallow: /x\n")],
                                  "host string, status int, content_type string, body string")
    folded = fold_rules(robots_rules(robots_text(hosts, files)))
    resp = spark.createDataFrame([a[:6] for a in archive],
                                 "page_id long, url string, status int, content_type string, x_robots_tag string, html string")
    first = urls[1::9]
    seeds = spark.createDataFrame(list(enumerate(first)), "line_no long, value string")

    def key(url):
        scheme, rest = url.split("://")
        host, path = rest.split("/", 1)
        return scheme, (".".join(reversed(host.split("."))), "/" + path)

    queue, visited, links, report = {}, {}, set(), []
    for url in first:
        queue.setdefault(key(url)[1], key(url)[0])
    while True:
        batch = []
        for host in {h for h, _ in queue}:
            batch += sorted(k for k in queue if k[0] == host and k not in visited)[:3]
        if not batch:
            break
        before = len(links), len(queue)
        arrivals = []
        for k in batch:
            visited[k] = len(report) + 1
            here = [a for a in archive if key(a[1])[1] == k]
            if not here or (k[0] == "com.h1" and k[1].startswith("/x")):
                continue
            best = min(here, key=lambda a: (key(a[1])[0] != queue[k], a[0]))
            if best[2] == 200 and best[4] is None:
                source = f"{queue[k]}://{'.'.join(reversed(k[0].split('.')))}{k[1]}"
                arrivals += [(best[0], pos, source, t) for pos, t in enumerate(best[6])]
        for _, _, source, t in sorted(arrivals):
            links.add((source, t))
            queue.setdefault(key(t)[1], key(t)[0])
        report.append((len(report) + 1, len(batch), len(queue) - before[1], len(links) - before[0]))
    assert len(report) > 4 and len(links) > 60
    frontier, got, rows = crawl_rounds(seeds, resp, folded, per_host=3)
    assert sorted((r.source, r.target) for r in got.collect()) == sorted(links)
    assert {(r.host_reversed, r.path): (r.scheme, r.latest_visit.second) for r in frontier.collect()} == \
        {k: (s, visited[k]) for k, s in queue.items()}
    assert [(r.round, r.batch, r.pages, r.links) for r in rows.orderBy("round").collect()] == report


def test_crawl_rounds_move_the_round_only(spark):
    """A round's joins shuffle no archive table, and links are compared within the round: no earlier page has its URL."""
    from linkloom.functions.urls import page_url
    from linkloom.plans import crawl
    from linkloom.sources.segments import table_of
    keys = table_of(spark.createDataFrame([("com.a", "/", "http", 1, True, True)],
                    "host_reversed string, path string, a_scheme string, page_id long, crawlable boolean, allowed boolean"),
                    "archive_keys", ["host_reversed", "path"], 8)
    archived = table_of(spark.createDataFrame([("com.a", "/", 1, [(1, "http://b.com", "http", "com.b", "")])],
                        "host_reversed string, path string, page_id long, links array<struct<pos:int,target:string,"
                        "t_scheme:string,t_host_reversed:string,t_path:string>>"),
                        "archive_links", ["host_reversed", "path", "page_id"], 8)
    req = spark.createDataFrame([("i", "https", "com.a", "/", "https://a.com/")],
                                "id string, scheme string, host_reversed string, path string, url string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = crawl.fetched_links(req, keys.read(), archived.read())
        assert [r.target for r in plan.collect()] == ["http://b.com"]
        text = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert text.count("Exchange hashpartitioning") == 3, text  # the requests by key, by id, and by key and response
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys.drop(), archived.drop()
    paths = ["", "/", "/a b", "/a+b", "/a%20b", "/a%2520b", "/a*b", "/a%2Ab", "/~", "/%7E", "/ü", "/%C3%BC", "/u\u0308", "/?", "/%3F"]
    df = spark.createDataFrame([(h, p) for h in ("com.a", "com.b.a", "com.\u00fc") for p in paths], "host_reversed string, path string")
    assert df.select(page_url(F.lit("http"), F.col("host_reversed"), F.col("path"))).distinct().count() == 3 * len(paths)


def test_table_read_once_is_rewritten_when_it_doubles(spark):
    from linkloom.sources import segments
    t = segments.SegmentTable(spark, "t", "k int", ["k"], 2, read_once=True)
    n = segments.COMPACT_EVERY
    for _ in range(2 * n - 1):
        t.append(spark.createDataFrame([(1,), (2,)], "k int"))
    assert (t.rows, t.written, t.segments) == (4 * n - 2, 6 * n - 2, n)
    t.append(spark.createDataFrame([(1,), (2,)], "k int"))
    assert (t.rows, t.written, t.segments, t.read().count()) == (4 * n, 10 * n, 1, 4 * n)
    t.drop()


def test_crawl_depth_splits_hubs(spark):
    from linkloom.plans import crawl
    edges = [("hub", f"n{i}") for i in range(90)] + [(f"n{i}", f"m{i % 5}") for i in range(90)] + [("m1", "hub"), ("x", "y")]
    links = spark.createDataFrame(edges + edges[:9], "source string, target string")
    seeds = spark.createDataFrame([("hub",), ("hub",)], "node string")
    for most in (10, 1000):
        got = {r.node: r.depth for r in crawl.crawl_depth(links, seeds, hub_edges=most).collect()}
        assert got == {"hub": 0} | {f"n{i}": 1 for i in range(90)} | {f"m{i}": 2 for i in range(5)}
    assert {r.node for r in crawl.crawl_depth(links, seeds, max_depth=1).collect()} == {"hub"} | {f"n{i}" for i in range(90)}


def test_crawl_depth_levels_shuffle_the_level_only(spark):
    from linkloom.plans import crawl
    from linkloom.sources.segments import SegmentTable, table_of
    edges = table_of(spark.createDataFrame([("a", 0, "b")], "source string, salt int, target string"), "edges", ["source", "salt"], 8)
    found = SegmentTable(spark, "found", "node string, depth int", ["node"], 8)
    level = spark.createDataFrame([("a", 0)], "node string, depth int")
    hubs = spark.createDataFrame([("h", 3)], "hub string, salts int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = crawl.next_level(level, edges.read(), hubs, found.read(), 1)
        assert [tuple(r) for r in plan.collect()] == [("b", 1)]
        text = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    depth = [max(line.find("+- "), line.find(":- ")) for line in text]
    scans = [i for i, line in enumerate(text) if "FileScan parquet" in line]
    assert len(scans) == 2
    for at in scans:  # no exchange between a stored table and its join
        while "Join" not in text[at]:
            assert "Exchange" not in text[at], "\n".join(text)
            at = max(i for i in range(at) if depth[i] < depth[at])
    edges.drop()
    found.drop()


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def _leaf_metric(df, name):
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply(name).value()


def test_backlink_lookup_opens_its_buckets_only(spark):
    d = _scratch(spark)
    links = spark.range(4000).select(F.concat(F.lit("http://s/"), F.col("id")).alias("source"),
                                     F.concat(F.lit("http://t/"), F.col("id") % 500).alias("target"))
    T.write_links_by_target(links, d + "/t", 16)
    assert T.stored_buckets(spark, d + "/t") == 16
    hit = T.lookup_links(spark, d + "/t", "target", ["http://t/7", "http://t/499"])
    assert sorted(r.source for r in hit.collect()) == sorted(f"http://s/{i}" for i in range(4000) if i % 500 in (7, 499))
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "In(target, [" in plan
    files = len(_files(d + "/t"))
    assert _leaf_metric(hit, "numFiles") <= 2 < 8 < files
    # an unknown target between known ones: its bucket's row groups are skipped
    absent = T.lookup_links(spark, d + "/t", "target", ["http://t/250x"])
    assert absent.count() == 0 and _leaf_metric(absent, "numOutputRows") == 0
    many = T.lookup_many(spark, d + "/t", spark.createDataFrame([("http://t/7",), ("http://t/7",), ("x",)], "target string"), "target")
    assert many.count() == 8
    T.write_links_by_target(links.limit(0), d + "/none", 4)


def test_link_refresh_leaves_other_buckets_alone(spark):
    d = _scratch(spark) + "/s"
    rows = [(f"s{i % 60}", f"t{i}") for i in range(600)]
    links = spark.createDataFrame(rows, "source string, target string")
    T.write_links_by_source(links, d, 8)
    before = _files(d)
    # s1 gets one link, s2 none; every page of one bucket loses its links
    bucket = {r.source: r.b for r in links.select("source", T.bucket_of("source", 8).alias("b")).distinct().collect()}
    gone = [s for s, b in bucket.items() if b == bucket["s2"]]
    re_read = spark.createDataFrame([("s1", "new"), ("s1", "new")] + [(s, None) for s in gone], "source string, target string")
    want = sorted({(s, t) for s, t in rows if s != "s1" and s not in gone} | ({("s1", "new")} if "s1" not in gone else set()))
    touched = T.replace_stored_links(spark, d, re_read)
    assert set(touched) == {bucket["s1"], bucket["s2"]}
    assert sorted((r.source, r.target) for r in spark.read.parquet(d).collect()) == want
    after = _files(d)
    old = {f: m for f, m in before.items() if not any(f"bucket={b}/" in f for b in touched)}
    assert old and all(after.get(f) == m for f, m in old.items())
    assert not any(f in after for f in before if f not in old)


def test_rules_are_stored_by_host(spark):
    from linkloom.operators import robots as R
    hosts = spark.createDataFrame([("com.a", "User-agent: *\nDisallow: /x"), ("com.b", "")], "host_reversed string, robot string")
    rules = R.compiled_rules(hosts, 4)
    pages = spark.createDataFrame([(1, "a.com", "/x/1"), (2, "a.com", "/y"), (3, "b.com", "/x"), (4, "c.com", "")],
                                  "page_id int, host string, path_escaped string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = R.robots_allowed(pages, rules.read())
        assert {r.page_id: r.allowed for r in got.collect()} == {1: False, 2: True, 3: True, 4: True}
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    rules.drop()


def test_referrers_grow_by_deltas(spark):
    table = FR.referrers_table(spark, 4)
    first = spark.createDataFrame([("http://a.com/1", "http://x.com/p"), ("http://a.com/2", "http://x.com/p"),
                                   ("http://b.com/", "http://x.com/q")], "source string, target string")
    assert FR.add_referrers(table, first) == 2
    assert FR.add_referrers(table, first) == 0
    assert FR.add_referrers(table, spark.createDataFrame([("https://c.com/", "http://x.com/p")], "source string, target string")) == 1
    got = {(r.path, r.weight) for r in FR.referring_hosts(table.read()).collect()}
    assert got == {("/p", 2), ("/q", 1)}
    table.drop()


def test_ranking_scans_bodies_once(spark):
    from linkloom.plans.queries import REGISTRY
    for name in ("frontier_ranked", "frontier_top", "host_stats"):
        plan = REGISTRY[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "html" not in plan, name  # links come from the table made of the one scan
