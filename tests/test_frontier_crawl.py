"""Frontier, crawl rounds, pacing, metrics, streaming (A1-A5, C, D, E, F, I)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from linkloom.operators import frontier as FR
from linkloom.operators.metrics import histogram
from linkloom.operators.pacing import adaptive_rate, adaptive_schedule, politeness_schedule
from linkloom.plans.crawl import crawl_depth
from linkloom.plans.queries import REGISTRY
from linkloom.sources import derived as D


def test_seeds_first_wins(spark):
    lines = spark.createDataFrame(
        [(0, "http://a.com/x  https://a.com/x"), (1, "\thttps://b.com/ http://b.com")],
        "line_no long, value string")
    f = FR.seed_frontier(FR.empty_frontier(spark), FR.parse_seeds(lines))
    got = sorted((r.host_reversed, r.path, r.scheme) for r in f.collect())
    assert got == [("com.a", "/x", "http"), ("com.b", "", "https")]


def test_bad_seed_aborts(spark):
    lines = spark.createDataFrame([(0, "http://a.com ftp://b.com")], "line_no long, value string")
    with pytest.raises(Exception, match="invalid seed ftp://b.com"):
        FR.parse_seeds(lines).collect()


def test_insert_pages_existing_wins_and_idempotent(spark):
    existing = spark.createDataFrame(
        [("id1", "https", "com.a", "/x", None)], FR.FRONTIER)
    new = spark.createDataFrame([(1, 1, "http", "com.a", "/x"), (2, 1, "http", "com.a", "/y"),
                                 (1, 2, "https", "com.a", "/y")],
                                "page_id long, pos long, scheme string, host_reversed string, path string")
    add = FR.insert_pages(existing, new, ["page_id", "pos"]).collect()
    assert [(r.scheme, r.path) for r in add] == [("https", "/y")]
    table = existing.unionByName(spark.createDataFrame(add, FR.FRONTIER))
    assert FR.insert_pages(table, new, ["page_id", "pos"]).count() == 0


def test_frontier_next_and_mark(spark):
    f = REGISTRY["seed_frontier"](spark, SF_SMALL).cache()
    batch = FR.frontier_next(f, "s1").cache()
    assert 0 < batch.count() <= FR.BATCH_SIZE
    assert batch.select("host_reversed").distinct().count() == 1
    marked = FR.mark_visited(f, batch, "2024-03-01 00:00:00")
    assert marked.where(F.col("latest_visit").isNotNull()).count() == batch.count()
    assert marked.count() == f.count()


def test_all_hosts_limit(spark):
    f = REGISTRY["seed_frontier"](spark, SF_MID)
    b = FR.frontier_all_hosts(f, per_host=2)
    assert b.groupBy("host_reversed").count().agg(F.max("count")).first()[0] <= 2


def test_all_hosts_plans_window_group_limit(spark):
    f = REGISTRY["seed_frontier"](spark, SF_MID)
    plan = FR.frontier_all_hosts(f)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("sf,depths", [(SF_SMALL, [1, 33, 166, 0, 0]), (SF_MID, [1, 29, 677, 1293, 0]),
                                       ("/root/testdata/sf0.1", [1, 30, 878, 13903, 5188])])
def test_crawl_depth_fixture(spark, sf, depths):
    e = D.graph_edges(spark, sf)
    seed = e.where("s_node = 1").select(F.col("source").alias("node")).limit(1)
    d = crawl_depth(e.select("source", "target"), seed, max_depth=4)
    got = {r.depth: r["count"] for r in d.groupBy("depth").count().collect()}
    assert [got.get(i, 0) for i in range(5)] == depths


def _simulate(arrivals, d):
    out, prev = [], None
    for a in arrivals:
        s = a if prev is None else max(a, prev + d)
        out.append(s)
        prev = s
    return out


def test_politeness_closed_form_equals_simulation(spark):
    log = D.request_log(spark, SF_SMALL)
    sched = politeness_schedule(log, 3600.0).collect()
    by = {}
    for r in sorted(sched, key=lambda r: (r.ts, r.event_id)):
        by.setdefault((r.method, r.host), []).append(r)
    for rows in by.values():
        sim = _simulate([r.ts for r in rows], dt.timedelta(seconds=3600))
        assert [r.slot_ts for r in rows] == sim
    assert sum(r.delayed for r in sched) == 63


def test_adaptive_rate_halves_on_429(spark):
    log = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, 0, 0, 0), "h", "HEAD", 429),
         (2, dt.datetime(2024, 1, 1, 0, 0, 1), "h", "GET", 200),
         (3, dt.datetime(2024, 1, 1, 0, 0, 2), "h", "GET", 429),
         (4, dt.datetime(2024, 1, 1, 2, 0, 0), "h", "HEAD", 200)],
        "event_id long, ts timestamp_ntz, host string, method string, code int")
    got = [r.interval_s for r in adaptive_rate(log, 0.1).orderBy("event_id").collect()]
    assert got == [0.1, 0.2, 0.2, 0.2]  # a GET's 429 halves nothing


def test_histogram_cumulative(spark):
    df = spark.createDataFrame([("a", 0.001), ("a", 0.3), ("a", 20.0)], "l string, v double")
    rows = {r.le: r.cum_count for r in histogram(df, "l", "v").collect()}
    assert rows["0.005"] == 1 and rows["0.25"] == 1 and rows["0.5"] == 2 and rows["+Inf"] == 3


def test_in_flight_peak(spark):
    log = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, 0, 0, 0), 10.0), (2, dt.datetime(2024, 1, 1, 0, 0, 5), 1.0),
         (3, dt.datetime(2024, 1, 1, 0, 0, 10), 1.0)],
        "event_id long, ts timestamp_ntz, duration_s double")
    from linkloom.operators.metrics import in_flight
    assert in_flight(log).agg(F.max("peak_in_flight")).first()[0] == 2


def test_stream_equals_batch_and_replay_adds_nothing(spark):
    s = REGISTRY["stream_ingest"](spark, SF_SMALL)
    b = REGISTRY["page_links"](spark, SF_SMALL)
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, b.collect()))


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_link_distinct_is_partially_aggregated(spark):
    from linkloom.operators import links as L
    from linkloom.sources.tables import read_pages
    p = _plan(L.page_links(read_pages(spark, SF_SMALL)))
    assert p.count("HashAggregate(keys=[source") >= 2  # partial + final around the exchange
    assert "SortMergeJoin" not in p and "CartesianProduct" not in p


def test_robots_join_has_no_rule_explosion(spark):
    p = _plan(REGISTRY["robots_allowed"](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_insert_pages_uses_hash_aggregation(spark):
    p = _plan(REGISTRY["insert_pages"](spark, SF_SMALL))
    assert "partial_min_by" in p


def _skewed_log(spark, n=3000):
    """One host holds a third of the log, and one second of it half of these; some hosts are null."""
    return spark.range(n).select(
        F.col("id").alias("event_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                              F.when(F.col("id") % 6 == 0, 7200).otherwise(F.col("id") * 37 % 86400).cast("decimal(18,6)")))
        .alias("ts"),
        F.when(F.col("id") % 3 == 0, F.lit("hot.example.com")).when(F.col("id") % 5 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("h"), (F.col("id") % 97).cast("string"), F.lit(".example.com"))).alias("host"),
        F.when(F.col("id") % 4 == 0, "HEAD").otherwise("GET").alias("method"),
        F.when(F.col("id") % 211 == 0, 429).otherwise(200).alias("code"),
        (F.col("id") * 7919 % 1000).alias("v"))


def test_prefix_scan_equals_single_window_under_skew(spark):
    from pyspark.sql import Window

    from linkloom.operators.scan import ranged, running
    log = _skewed_log(spark)
    dealt = ranged(log, ["host"], ["ts", "event_id"], parts=11)
    got = running(dealt, ["host"], ["ts", "event_id"], F.col("v"), "max", "m")
    got_sum = running(dealt, ["host"], ["ts", "event_id"], F.col("v"), "sum", "s", inclusive=False)
    w = Window.partitionBy("host").orderBy("ts", "event_id")
    ref = log.select("event_id", F.max("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("m"),
                     F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("s"))
    a = {r.event_id: r.m for r in got.select("event_id", "m").collect()}
    b = {r.event_id: r.s for r in got_sum.select("event_id", "s").collect()}
    assert len(a) == len(b) == 3000
    for r in ref.collect():
        assert a[r.event_id] == r.m and b[r.event_id] == r.s, r.event_id


def test_prefix_scan_splits_one_host_hour(spark):
    """All rows in one hour of one host: no task has over twice the mean number of rows, in the range exchange as
    well as under the windows, and no exchange on the host moves the rows again."""
    from linkloom.operators.scan import ranged, running
    log = _skewed_log(spark, 40_000).select(
        "event_id", F.lit("h").alias("host"), F.lit("2024-01-01 00:00:01").cast("timestamp_ntz").alias("ts"), "v")
    dealt = ranged(log, ["host"], ["ts", "event_id"], parts=16)
    sizes = [r.n for r in dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()]
    tasks = [r.n for r in dealt.groupBy(F.spark_partition_id().alias("t")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == len(tasks) == 16 and sum(sizes) == sum(tasks) == 40_000
    assert max(sizes) <= 2 * 2500 and max(tasks) <= 2 * 2500
    got = running(dealt, ["host"], ["ts", "event_id"], F.col("v"), "sum", "s")
    assert got.agg(F.max("s")).first()[0] == log.agg(F.sum("v")).first()[0]
    moved = [x for x in _plan(got).splitlines() if "Exchange hashpartitioning(" in x]
    assert all("_part" not in x or "_on_" in x or "_tot" in x for x in moved), moved


def test_adaptive_schedule_equals_simulation(spark):
    log = _skewed_log(spark)
    for most in (None, 40.0):
        got = {r.event_id: r for r in adaptive_schedule(log, 3.5, most).collect()}
        slot, halved, delayed = {}, {}, 0
        for r in sorted(log.collect(), key=lambda r: (r.ts, r.event_id)):
            a = (r.ts - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
            h = halved.get(r.host, 0)
            d = 3_500_000 * 2 ** h if most is None else min(3_500_000 * 2 ** h, 40_000_000)
            key = r.method, r.host
            s = slot[key] = max(a, slot[key] + d) if key in slot else a
            g = got[r.event_id]
            assert (g.halvings, g.slot_us, g.wait_us, g.delayed) == (h, s, s - a, s > a), r
            delayed += s > a
            halved[r.host] = h + (r.method == "HEAD" and r.code == 429)
        assert delayed > 500


def test_adaptive_schedule_beyond_the_clock(spark):
    rows = [(i, dt.datetime(2024, 1, 1, 0, 0, 0), "h", "HEAD", 429) for i in range(90)]
    log = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, host string, method string, code int")
    got = adaptive_schedule(log, 5.0).orderBy("event_id").collect()
    assert got[0].wait_us == 0 and got[1].wait_us == 10_000_000 and got[2].wait_us == 30_000_000
    assert got[-1].slot_us is None and got[-1].wait_us is None and got[-1].delayed
    assert adaptive_schedule(log.limit(0)).count() == 0


def test_stream_batch_replay_is_idempotent(spark):
    """Re-running one micro-batch (same run and batch id, as after a
    failure) rewrites its folder and leaves the tables unchanged."""
    import tempfile

    from linkloom.session import ensure_checkpoint_dir
    from linkloom.sources.tables import read_pages
    from linkloom.streaming.ingest import ingest_batch, read_links
    table = tempfile.mkdtemp(dir=ensure_checkpoint_dir(spark).replace("file:", ""))
    pages = read_pages(spark, SF_SMALL)
    first, second = pages.where("page_id < 25"), pages.where("page_id >= 25")
    ingest_batch(first, 0, table, "r1")
    ingest_batch(second, 1, table, "r1")
    once = sorted(map(tuple, read_links(spark, table).collect()))
    ingest_batch(second, 1, table, "r1")  # replay
    ingest_batch(first, 0, table, "r1")   # replay
    assert sorted(map(tuple, read_links(spark, table).collect())) == once
    assert len(once) == len(set(once)) == 279
    from linkloom.streaming.ingest import read_progress
    rows = read_progress(spark, table).orderBy("batch_id").collect()
    assert [r.pages for r in rows] == [25, second.count()] and rows[-1].processed == pages.count()
    assert rows[-1].link_pairs == 279 == sum(r.links_added for r in rows)
    assert rows[-1].queue_size == spark.read.parquet(table + "/frontier").count()
    fr = spark.read.parquet(table + "/frontier")
    assert fr.count() == fr.select("host_reversed", "path").distinct().count()


@pytest.mark.parametrize("sf,delayed", [(SF_SMALL, 63), (SF_MID, 609), ("/root/testdata/sf0.1", 6180)])
def test_politeness_fixture_counts(spark, sf, delayed):
    s = REGISTRY["politeness_schedule"](spark, sf)
    assert s.where("delayed").count() == delayed


@pytest.mark.parametrize("sf,edges,selfs,srcs,tgts", [
    (SF_SMALL, 5584, 27, 200, 200), (SF_MID, 59571, 34, 2000, 2000),
    ("/root/testdata/sf0.1", 599529, 35, 20000, 20000)])
def test_graph_fixture_counts(spark, sf, edges, selfs, srcs, tgts):
    e = D.graph_edges(spark, sf).cache()
    assert e.count() == edges
    assert e.where("source = target").count() == selfs
    assert e.select("source").distinct().count() == srcs
    assert e.select("target").distinct().count() == tgts
