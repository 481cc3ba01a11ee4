"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each one reads the given Parquet tables (or tables derived from them by
``linkloom.sources.derived``) in full, so its work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import normalize_urls, page_url, reverse_hostname
from ..operators import links as L
from ..sources import derived as D
from ..sources.tables import read_pages

REGISTRY: dict = {}


def query(fn=None, *, name: str | None = None):
    def reg(f):
        REGISTRY[name or f.__name__] = f
        return f
    return reg(fn) if fn is not None else reg


# --- B: URL and page jobs ----------------------------------------------------

@query
def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = normalize_urls(D.url_variants(spark, sf_dir), "input")
    return v.select("page_id", "kind", "input", "url", "scheme", "host", "host_reversed", "path",
                    "path_escaped", "reject_reason")


@query
def url_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = normalize_urls(D.url_variants(spark, sf_dir), "input")
    kind = F.regexp_extract(F.col("reject_reason"), r"^([^:]*)", 1).alias("reason")
    return (v.where(F.col("reject_reason").isNotNull())
            .groupBy(kind).agg(F.count(F.lit(1)).alias("n")))


@query(name="reverse_hostname")
def reverse_hostname_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = (L.canonical_pages(read_pages(spark, sf_dir).select("url"))
             .select("host").distinct())
    return hosts.select("host", reverse_hostname(F.col("host")).alias("host_reversed"),
                        reverse_hostname(reverse_hostname(F.col("host"))).alias("round_trip"))


@query
def page_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = L.canonical_pages(read_pages(spark, sf_dir).select("page_id", "url"))
    return p.select("page_id", "source", "scheme", "host_reversed", "path",
                    page_url(F.col("scheme"), F.col("host_reversed"), F.col("path")).alias("rebuilt"))


@query
def anchor_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of every page's hard cases, which the SQL lists by hand."""
    return L.extract_raw_links(D.anchor_cases(spark, sf_dir)).select("page_id", "pos", "href")


@query
def page_links_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.extract_raw_links(read_pages(spark, sf_dir))


@query
def resolve_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.resolve_links(read_pages(spark, sf_dir))


@query
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.page_links(read_pages(spark, sf_dir))


@query
def link_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = L.link_groups(L.page_links(read_pages(spark, sf_dir)))
    return g.select("source", F.size("targets").alias("n_targets"),
                    F.array_join("targets", "\n").alias("targets"))


@query
def flatten_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.flatten_groups(L.link_groups(L.page_links(read_pages(spark, sf_dir))))


@query
def backlink_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.backlink_counts(L.page_links(read_pages(spark, sf_dir)))


def _folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint folder."""
    import uuid
    from ..session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:10]}"


def _links_by_target(spark: SparkSession, links: DataFrame) -> str:
    from ..sources.tables import write_links_by_target
    path = _folder(spark, "links-by-target")
    write_links_by_target(links, path)
    return path


@query
def backlinks_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backlinks of every known page of the link graph G1, looked up in the copy of the
    extracted edge table that is stored by target."""
    from ..sources.tables import lookup_many
    gp = D.graph_pages(spark, sf_dir)
    known = L.canonical_pages(gp.select("url")).select(F.col("source").alias("target"))
    return lookup_many(spark, _links_by_target(spark, L.page_links(gp)), known, "target")


@query
def backlink_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request for the 20 first pages of G1: only their buckets of the copy stored by target are opened."""
    from ..sources.tables import lookup_links
    path = _links_by_target(spark, D.graph_edges(spark, sf_dir).select("source", "target"))
    asked = D.graph_edges(spark, sf_dir).select("s_node", "source").distinct().orderBy("s_node").limit(20)
    return lookup_links(spark, path, "target", [r.source for r in asked.collect()])


# --- A/B: robots and responses ---------------------------------------------

def _robots_texts(spark, sf_dir, pages=None):
    from ..operators.robots import robots_text
    if pages is None:
        pages = L.canonical_pages(read_pages(spark, sf_dir).select("url"))
    hosts = pages.select("host").distinct()
    return robots_text(hosts, D.robots_responses(spark, sf_dir, hosts))


@query
def robots_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _robots_texts(spark, sf_dir)


@query
def hosts_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored hosts table, written in the shared folder and read back."""
    return _stored_hosts(spark, _robots_texts(spark, sf_dir)).select("host_reversed", "robot")


def _stored_hosts(spark, texts):
    from ..sources.tables import write_hosts
    path = _folder(spark, "hosts")
    write_hosts(texts, path)
    return spark.read.parquet(path)


@query
def robots_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.robots import robots_rules as rules
    return rules(_robots_texts(spark, sf_dir))


def _allowed(spark, sf_dir, pages=None):
    """Pages with ``allowed``, through the stored hosts table and the rules compiled from it, which are stored once by
    host: the join moves the pages only."""
    from ..operators.robots import compiled_rules, robots_allowed
    from ..session import cut_lineage
    if pages is None:
        pages = cut_lineage(L.canonical_pages(read_pages(spark, sf_dir).select("page_id", "url")))
    hosts = _stored_hosts(spark, _robots_texts(spark, sf_dir, pages))
    return robots_allowed(pages, compiled_rules(hosts).read())


@query
def robots_allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _allowed(spark, sf_dir).select("page_id", "source", "host", "allowed")


@query
def crawlable_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.responses import crawlable_pages as crawlable
    return crawlable(D.responses(spark, sf_dir)).select(
        "page_id", "url", "status", "content_type", "x_robots_tag")


@query
def drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages lost per stage (robots, status, type, robots header) and the
    refused links of the kept pages, by reason."""
    from ..operators.responses import page_drop_reasons
    resp = D.responses(spark, sf_dir)
    per_page = page_drop_reasons(resp, _allowed(spark, sf_dir))
    pages = per_page.groupBy("reason").agg(F.count(F.lit(1)).alias("n")) \
        .select(F.lit("page").alias("stage"), "reason", "n")
    kept = resp.join(per_page.where(F.col("reason") == "kept").select("page_id"), "page_id", "left_semi")
    rej = (L.resolve_links(kept.select("page_id", "url", "html"))
           .where(F.col("reject_reason").isNotNull())
           .groupBy(F.regexp_extract("reject_reason", r"^([^:]*)", 1).alias("reason"))
           .agg(F.count(F.lit(1)).alias("n"))
           .select(F.lit("link").alias("stage"), "reason", "n"))
    return pages.unionByName(rej)


# --- D/H: frontier -------------------------------------------------------------

AS_OF = "2024-03-01 00:00:00"
SAMPLE_SEED = "round-1"


def _seed_frontier(spark, sf_dir):
    from ..operators import frontier as FR
    seeds = FR.parse_seeds(D.seed_lines(spark, sf_dir))
    return FR.seed_frontier(FR.empty_frontier(spark), seeds)


def _keyed_links(spark, sf_dir):
    """The archive's links with their targets' keys, from one scan of the bodies."""
    from ..session import cut_lineage
    return cut_lineage(L.link_keys(read_pages(spark, sf_dir)))


def _crawl_frontier(spark, sf_dir, keys=None):
    """Seeds plus every link target of the archive."""
    from ..operators import frontier as FR
    sf = _seed_frontier(spark, sf_dir)
    keys = L.link_keys(read_pages(spark, sf_dir)) if keys is None else keys
    return sf.unionByName(FR.insert_pages(sf, keys, ["page_id", "pos"]))


def _referrers(spark, keys):
    """The stored referrers table after one delta: all of the archive's links."""
    from ..operators import frontier as FR
    from .crawl import _parts
    table = FR.referrers_table(spark, _parts(keys))
    FR.add_referrers(table, keys)
    return table.read()


def _visited_frontier(spark, sf_dir, keys=None):
    """Crawl frontier with visit times derived from the key lengths."""
    f = _crawl_frontier(spark, sf_dir, keys)
    h = F.length("path") * 7 + F.length("host_reversed")
    lv = (F.when(h % 3 == 0, F.lit(None).cast("timestamp_ntz"))
          .otherwise(F.lit(AS_OF).cast("timestamp_ntz") - F.make_dt_interval(h % 60)))
    return f.select("id", "scheme", "host_reversed", "path", lv.alias("latest_visit"))


@query
def seed_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seed_frontier(spark, sf_dir)


@query
def insert_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import frontier as FR
    sf = _seed_frontier(spark, sf_dir)
    return FR.insert_pages(sf, L.link_keys(read_pages(spark, sf_dir)), ["page_id", "pos"])


@query
def insert_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the archive and of G1 pages, inserted into a table that
    already holds the G1 edges: only the archive's links are new."""
    pages = read_pages(spark, sf_dir).unionByName(D.graph_pages(spark, sf_dir))
    existing = D.graph_edges(spark, sf_dir).select("source", "target")
    return L.insert_links(existing, L.page_links(pages))


@query
def frontier_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import frontier as FR
    return FR.frontier_next(_crawl_frontier(spark, sf_dir), SAMPLE_SEED)


@query
def mark_visited(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import frontier as FR
    from ..session import cut_lineage
    f = cut_lineage(_crawl_frontier(spark, sf_dir))
    return FR.mark_visited(f, cut_lineage(FR.frontier_next(f, SAMPLE_SEED)), AS_OF)


@query
def frontier_all_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import frontier as FR
    return FR.frontier_all_hosts(_crawl_frontier(spark, sf_dir))


@query
def refresh_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import frontier as FR
    return FR.refresh_due(_visited_frontier(spark, sf_dir), AS_OF)


@query
def frontier_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import frontier as FR
    keys = _keyed_links(spark, sf_dir)
    return FR.frontier_ranked(_crawl_frontier(spark, sf_dir, keys), _referrers(spark, keys), per_host=FR.BATCH_SIZE)


@query
def frontier_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 128 most useful unvisited pages of all hosts (a top-k report)."""
    from ..operators import frontier as FR
    keys = _keyed_links(spark, sf_dir)
    return FR.frontier_top(_crawl_frontier(spark, sf_dir, keys), _referrers(spark, keys), k=FR.BATCH_SIZE)


@query
def host_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import frontier as FR
    keys = _keyed_links(spark, sf_dir)
    return FR.host_stats(_visited_frontier(spark, sf_dir, keys), keys.select("source", "target").distinct())


# --- D5/D6: crawl over the link graph G1 --------------------------------------

def _graph_seed(spark, sf_dir):
    """The G1 source node with the smallest number."""
    first = D.graph_nodes(spark, sf_dir).orderBy("s").limit(1)
    return first.select(D.node_url(F.col("s")).alias("node"))


@query
def crawl_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .crawl import crawl_depth as depth
    e = D.graph_edges(spark, sf_dir).select("source", "target")
    return depth(e, _graph_seed(spark, sf_dir))


@query
def crawl_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl the G1 pages from the first node until the frontier is empty,
    through the robots filter (G1 robots files) and the response tests
    (derived statuses); returns the discovered edge table."""
    from ..operators.robots import fold_rules, robots_rules, robots_text
    from .crawl import crawl_rounds as rounds
    from ..session import cut_lineage
    # the derived archive is built once (a stored archive would be scanned)
    resp = cut_lineage(D.graph_responses(spark, sf_dir))
    rr = cut_lineage(D.graph_robots_responses(spark, sf_dir))  # a row per host, read several times
    folded = fold_rules(robots_rules(robots_text(rr.select("host"), rr)))
    seeds = _graph_seed(spark, sf_dir).select(F.lit(0).cast("long").alias("line_no"),
                                              F.col("node").alias("value"))
    _, links, _ = rounds(seeds, resp, folded)
    return links


# --- D7/D8, E2-E8, F1: pacing and metrics over the request log ---------------

PACING_INTERVAL_S = 3600.0


@query
def politeness_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.pacing import politeness_schedule as sched
    return sched(D.request_log(spark, sf_dir), PACING_INTERVAL_S)


@query
def adaptive_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.pacing import adaptive_rate as rate
    return rate(D.request_log(spark, sf_dir))


@query
def adaptive_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.pacing import adaptive_schedule as sched
    return sched(D.request_log(spark, sf_dir), PACING_INTERVAL_S)


@query
def crawl_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.metrics import crawl_counters as counters
    return counters(spark, D.request_log(spark, sf_dir), _visited_frontier(spark, sf_dir),
                    L.page_links(read_pages(spark, sf_dir)), _allowed(spark, sf_dir))


@query
def log_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.metrics import log_levels as levels
    return levels(D.request_log(spark, sf_dir))


@query
def requests_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.metrics import requests_by_code as by_code
    return by_code(D.request_log(spark, sf_dir))


@query
def duration_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.metrics import histogram
    return histogram(D.request_log(spark, sf_dir), "method", "duration_s")


@query
def labelled_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.metrics import TLS_BUCKETS, histogram
    return histogram(D.request_log(spark, sf_dir), "level", "duration_s", TLS_BUCKETS)


@query
def in_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.metrics import in_flight as flight
    return flight(D.request_log(spark, sf_dir))


@query
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.metrics import throughput as tp
    return tp(D.request_log(spark, sf_dir))


@query
def progress_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.metrics import progress_report as progress
    keys = _keyed_links(spark, sf_dir)
    pages = L.canonical_pages(read_pages(spark, sf_dir).select("page_id", "url"))
    links = (keys.select("page_id", "source", "target").join(pages.select("page_id", "host_reversed", "path"), "page_id")
             .groupBy("source", "target").agg(F.min("host_reversed").alias("host_reversed"), F.min("path").alias("path")))
    return progress(D.request_log(spark, sf_dir), _visited_frontier(spark, sf_dir, keys), links)


# --- I: streaming ingest ------------------------------------------------------

def _stream_run(spark, sf_dir, runs: int = 1):
    """Re-write ``pages`` as several files under the shared checkpoint
    folder, stream them one file per trigger, and return the table folder."""
    import uuid
    from ..session import ensure_checkpoint_dir
    from ..streaming.ingest import start_ingest
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/stream-{uuid.uuid4().hex[:10]}"
    src, table = f"{base}/source", f"{base}/tables"
    read_pages(spark, sf_dir).write.parquet(src)
    for r in range(runs):
        q = start_ingest(spark, src, table, f"{base}/checkpoint-{r}")
        q.awaitTermination()
    return table


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edge table built by the stream (compared with the batch result);
    the input is streamed twice with separate checkpoints, the second run
    must add nothing."""
    from ..streaming.ingest import read_links
    return read_links(spark, _stream_run(spark, sf_dir, runs=2))


@query
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters and running totals of four micro-batches, each the pages of one remainder of the page number: what
    arrives between two runs of one stream is one batch."""
    from ..streaming.ingest import read_progress, start_ingest
    base = _folder(spark, "stream")
    for part in range(4):
        (read_pages(spark, sf_dir).where(F.pmod("page_id", F.lit(4)) == part)
         .write.mode("append").parquet(f"{base}/source"))
        start_ingest(spark, f"{base}/source", f"{base}/tables", f"{base}/checkpoint",
                     files_per_trigger=2**31 - 1).awaitTermination()
    return read_progress(spark, f"{base}/tables").drop("run_id")


@query
def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream's counters add up to over its micro-batches: the links of all pages, once each."""
    from ..streaming.ingest import read_metrics
    return read_metrics(spark, _stream_run(spark, sf_dir, runs=2)).agg(
        F.sum("links_added").alias("links_added"), F.countDistinct("run_id").alias("runs"))


# --- remaining table operators ---------------------------------------------------

@query
def archive_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every crawl-frontier page looked up in the archive of responses."""
    from ..operators.responses import archive_fetch as fetch
    return fetch(_crawl_frontier(spark, sf_dir), D.responses(spark, sf_dir))


@query
def replace_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link refresh: every third of the archive's pages is read again and now
    shows the links of the G1 graph page with the same node number; their old
    links go, the new ones come in, and the other pages' links stay.  Read from the table stored by source, of which
    only the re-read pages' buckets were written anew."""
    from ..sources.tables import replace_stored_links, write_links_by_source
    path = _folder(spark, "links-by-source")
    write_links_by_source(L.page_links(read_pages(spark, sf_dir)), path)
    pages = L.canonical_pages(read_pages(spark, sf_dir).select("page_id", "url")).select("page_id", "source")
    g = D.graph_edges(spark, sf_dir).select(F.col("s_node").alias("page_id"), F.col("target").alias("g_target"))
    re_read = pages.where(F.col("page_id") % 3 == 0).join(g, "page_id", "left").select("source", F.col("g_target").alias("target"))
    replace_stored_links(spark, path, re_read)
    return spark.read.parquet(path).select("source", "target")
