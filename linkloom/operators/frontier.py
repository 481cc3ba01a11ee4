"""The frontier (visit queue) as a table (A1, A2, A5, C1-C3, D1-D4, D9,
D10, H1, H2, E10).

``frontier(id, scheme, host_reversed, path, latest_visit)`` is keyed by
``(host_reversed, path)``: the scheme is not part of the key, the first
arrival wins.  Upserts are ``anti-join + append``; selection is ordinary
filter / limit / window plans so Catalyst pushes ``latest_visit IS NULL``
into the scan and plans per-host limits as ``WindowGroupLimit`` (a partial
top-k before the shuffle, so a host owning a third of the queue still
sends at most k rows per map task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.urls import escape_path, normalize_urls, page_url
from ..schemas import FRONTIER

# --- fixed values -----------------------------------------------------------
BATCH_SIZE = 128          # pages handed out per host and round
REVISIT_AGE = "30 days"   # data age goal
# ---------------------------------------------------------------------------


def page_id_of(host_reversed: Column, path: Column) -> Column:
    """Deterministic frontier id of a page key."""
    return F.md5(F.concat_ws("\n", host_reversed, path))


def empty_frontier(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], FRONTIER)


def read_seed_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Seed text files as ``(line_no, value)``; arrival order is the file
    name then the position in the file."""
    df = spark.read.text(paths)
    return df.select(F.monotonically_increasing_id().alias("line_no"), "value",
                     F.input_file_name().alias("file"))


def seeds_from_args(spark: SparkSession, args: list[str]) -> DataFrame:
    """Command-line style seeds (A1): an argument naming an existing file, on any
    file system that Spark reads, is read as whitespace-separated URLs, any other
    argument is a URL.  Arrival order is the order of the arguments."""
    urls = [(i, "", 0, a) for i, a in enumerate(args) if not _is_file(spark, a)]
    lines = spark.createDataFrame(urls, "arg int, file string, line_no long, value string")
    for i in sorted(set(range(len(args))) - {u[0] for u in urls}):
        lines = lines.unionByName(read_seed_files(spark, [args[i]]).withColumn("arg", F.lit(i)))
    return parse_seeds(lines)


def _is_file(spark: SparkSession, name: str) -> bool:
    if name.lower().startswith(("http:", "https:")):
        return False
    from py4j.protocol import Py4JJavaError
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return files.exists(path) and files.getFileStatus(path).isFile()
    except Py4JJavaError:  # no path, or of no known file system
        return False


def parse_seeds(lines: DataFrame, urls: list[str] | None = None) -> DataFrame:
    """Seed URLs from text lines (whitespace separated) and from literal
    arguments (A1).  Returns ``(arrival, input, scheme, host_reversed, path,
    url)``; evaluating it fails on the first refused seed, naming it."""
    order = [F.col(c) for c in ("arg", "file") if c in lines.columns]
    toks = lines.select(*order, "line_no",
                        F.posexplode(F.split(F.trim(F.col("value")), r"\s+")).alias("pos", "input"))
    toks = toks.where(F.col("input") != "")
    if urls:
        spark = lines.sparkSession
        lit = spark.createDataFrame([(-1 - i, u) for i, u in enumerate(reversed(urls))],
                                    "line_no long, input string").select(
            *([F.lit(-1).alias("arg")] if "arg" in lines.columns else []),
            *([F.lit("").alias("file")] if "file" in lines.columns else []), "line_no", F.lit(0).alias("pos"), "input")
        toks = lit.unionByName(toks)
    w_order = [*order, "line_no", "pos"]
    toks = toks.select(F.struct(*w_order).alias("arrival"), "input")
    n = normalize_urls(toks, "input")
    # the check sits inside the key column, which every consumer reads, so
    # column pruning cannot drop it
    fail = F.raise_error(F.concat(F.lit("invalid seed "), F.col("input"), F.lit(": "),
                                  F.col("reject_reason")))
    return n.select(
        "arrival", "input", "scheme",
        F.when(F.col("reject_reason").isNotNull(), fail).otherwise(F.col("host_reversed"))
        .alias("host_reversed"),
        "path", "url")


def insert_pages(existing: DataFrame, new: DataFrame, order: list[str]) -> DataFrame:
    """Frontier rows to append for pages of ``new`` not yet in ``existing``
    (A5, C3, H2).  ``new`` has ``scheme, host_reversed, path`` and the
    arrival-order columns ``order``; per key the earliest arrival wins
    (then ``http`` before ``https``); rows already stored always win.

    The pick combines map-side, so a key arriving from a third of all rows
    still ships one row per map task.  With a two-column integral order
    such as ``(page_id, pos)`` it is two hash aggregations over fixed-width
    buffers: ``min(pos*2 + https)`` per ``(key, page_id)``, then
    ``min_by(code, page_id)`` per key.  Other orders use ``min`` over a
    struct (a sort-based aggregate).
    """
    key = ["host_reversed", "path"]
    integral = ("bigint", "int", "smallint", "tinyint")
    types = dict(new.dtypes)
    if len(order) == 2 and all(types.get(c) in integral for c in order):
        first_col, second_col = order
        https = (F.col("scheme") == "https").cast("long")
        lvl1 = (new.groupBy(*key, first_col)
                .agg(F.min(F.col(second_col).cast("long") * 2 + https).alias("_code")))
        lvl2 = lvl1.groupBy(*key).agg(F.min_by("_code", first_col).alias("_code"))
        fresh = lvl2.select(*key, F.when(F.col("_code") % 2 == 1, F.lit("https"))
                            .otherwise(F.lit("http")).alias("scheme"))
    else:
        first = (new.select("scheme", *key, *order).groupBy(*key)
                 .agg(F.min(F.struct(*[F.col(c) for c in order], F.col("scheme"))).alias("_first")))
        fresh = first.select(*key, F.col("_first.scheme").alias("scheme"))
    fresh = fresh.join(existing.select(*key), key, "left_anti")
    return fresh.select(page_id_of(F.col("host_reversed"), F.col("path")).alias("id"),
                        "scheme", "host_reversed", "path",
                        F.lit(None).cast("timestamp_ntz").alias("latest_visit"))


def seed_frontier(existing: DataFrame, seeds: DataFrame) -> DataFrame:
    """Frontier after seeding (A2, H1): ``existing`` plus new seed pages."""
    add = insert_pages(existing, seeds.select("arrival", "scheme", "host_reversed", "path"), ["arrival"])
    return existing.unionByName(add)


def sample_host(frontier: DataFrame, seed: str, strict: bool = False) -> DataFrame:
    """One host picked by sampling one frontier row (D1, G2); a host with
    more rows is more likely.  ``strict`` samples among all rows (visited
    too) and may pick a host with nothing left to visit; the default
    samples among unvisited rows.  Deterministic per ``seed``: a top-1
    over a hash (``TakeOrderedAndProject``), never a full sort."""
    rows = frontier if strict else frontier.where(F.col("latest_visit").isNull())
    return (rows.select("host_reversed", F.md5(F.concat(F.col("id"), F.lit(seed))).alias("_h"))
            .orderBy("_h").limit(1).select("host_reversed"))


def frontier_next(frontier: DataFrame, seed: str, batch: int = BATCH_SIZE,
                  strict: bool = False) -> DataFrame:
    """Next batch: up to ``batch`` unvisited pages of the sampled host,
    ordered by path (C1, D2, G1).  The sampled host is one row, so the
    broadcast side is bounded."""
    host = sample_host(frontier, seed, strict)
    todo = frontier.where(F.col("latest_visit").isNull())
    return (todo.join(F.broadcast(host), "host_reversed")
            .orderBy("path").limit(batch)
            .select("id", "scheme", "host_reversed", "path",
                    page_url(F.col("scheme"), F.col("host_reversed"), F.col("path")).alias("url")))


def mark_visited(frontier: DataFrame, batch: DataFrame, as_of) -> DataFrame:
    """New frontier snapshot with the batch, of any size, stamped ``as_of``."""
    b = batch.select(F.col("id").alias("_bid")).distinct()
    j = frontier.join(b, frontier["id"] == b["_bid"], "left")
    stamp = F.lit(as_of).cast("timestamp_ntz")
    return j.select("id", "scheme", "host_reversed", "path",
                    F.when(F.col("_bid").isNotNull(), stamp).otherwise(F.col("latest_visit"))
                    .alias("latest_visit"))


def mark_visited_many(frontier: DataFrame, batch: DataFrame, as_of) -> DataFrame:
    """``mark_visited`` for a batch of any size (one batch per host per
    round): a key equi-join, left to AQE to broadcast when small."""
    b = batch.select("host_reversed", "path", F.lit(True).alias("_in"))
    stamp = F.lit(as_of).cast("timestamp_ntz")
    return (frontier.join(b, ["host_reversed", "path"], "left")
            .select("id", "scheme", "host_reversed", "path",
                    F.when(F.col("_in"), stamp).otherwise(F.col("latest_visit")).alias("latest_visit")))


def escaped_path_of(path: str) -> Column:
    return escape_path(F.col(path))


def frontier_all_hosts(frontier: DataFrame, per_host: int = BATCH_SIZE) -> DataFrame:
    """Up to ``per_host`` unvisited pages of every host in one job."""
    w = Window.partitionBy("host_reversed").orderBy("path")
    return (frontier.where(F.col("latest_visit").isNull())
            .select("id", "scheme", "host_reversed", "path", F.row_number().over(w).alias("rank"))
            .where(F.col("rank") <= per_host)
            .select("id", "scheme", "host_reversed", "path", "rank",
                    page_url(F.col("scheme"), F.col("host_reversed"), F.col("path")).alias("url")))


def refresh_due(frontier: DataFrame, as_of, max_age: str = REVISIT_AGE) -> DataFrame:
    """Pages never visited or visited longer ago than ``max_age``."""
    limit = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {max_age}")
    lv = F.col("latest_visit")
    return frontier.where(lv.isNull() | (lv < limit))


def link_target_keys(links: DataFrame) -> DataFrame:
    """``(source, target, host_reversed, path)``: link targets turned into
    frontier keys (decoded path, no scheme)."""
    n = normalize_urls(links.select("source", "target"), "target", "k_")
    return n.where(F.col("k_reject_reason").isNull()).select(
        "source", "target", F.col("k_scheme").alias("scheme"),
        F.col("k_host_reversed").alias("host_reversed"), F.col("k_path").alias("path"))


REFERRERS = "host_reversed string, path string, src_host string"


def referrer_keys(links: DataFrame) -> DataFrame:
    """Distinct ``(host_reversed, path, src_host)``: the hosts that link to a page key.  Links
    that already carry the target key (``host_reversed, path``, as from ``link_keys``) are not parsed again."""
    keyed = links if {"host_reversed", "path"} <= set(links.columns) else link_target_keys(links)
    return keyed.select(
        "host_reversed", "path",
        F.regexp_extract("source", r"^[^:]+://(?:[^@/]*@)?([^/]*)", 1).alias("src_host")).distinct()


def referrers_table(spark: SparkSession, buckets: int):
    """An empty stored table of ``referrer_keys``, bucketed by the page key."""
    from ..sources.segments import SegmentTable
    return SegmentTable(spark, "referrers", REFERRERS, ["host_reversed", "path"], buckets)


def add_referrers(table, new_links: DataFrame) -> int:
    """Keep a referrers table up to date: add what a delta of links brings that it does not hold.  Only the delta
    is shuffled; bodies are not read again."""
    key = ["host_reversed", "path", "src_host"]
    return table.append(referrer_keys(new_links).join(table.read(), key, "left_anti"))


def weights(referrers: DataFrame) -> DataFrame:
    """Number of referring hosts per page key."""
    return referrers.groupBy("host_reversed", "path").agg(F.count(F.lit(1)).alias("weight"))


def referring_hosts(links: DataFrame) -> DataFrame:
    """Distinct referring hosts per page key, in two aggregation levels
    (``(key, host)`` first) so a hot target is combined map-side.  ``links`` may be a referrers
    table (``host_reversed, path, src_host``) as well, which is counted without another exchange."""
    return weights(links if "src_host" in links.columns else referrer_keys(links))


def frontier_ranked(frontier: DataFrame, links: DataFrame, per_host: int) -> DataFrame:
    """Useful-first selection (D10): unvisited pages ranked per host by the
    number of distinct hosts linking to them, then by path."""
    w = referring_hosts(links)
    todo = frontier.where(F.col("latest_visit").isNull()).join(w, ["host_reversed", "path"], "left")
    win = Window.partitionBy("host_reversed").orderBy(F.desc("weight_"), F.asc("path"))
    return (todo.select("id", "scheme", "host_reversed", "path",
                        F.coalesce("weight", F.lit(0)).alias("weight_"))
            .select("*", F.row_number().over(win).alias("rank"))
            .where(F.col("rank") <= per_host)
            .select("id", "scheme", "host_reversed", "path", F.col("weight_").alias("weight"), "rank"))


def frontier_top(frontier: DataFrame, links: DataFrame, k: int) -> DataFrame:
    """The ``k`` unvisited pages that most distinct hosts link to, of all
    hosts; ties by host, then path.  Each task keeps its best ``k`` only."""
    todo = frontier.where(F.col("latest_visit").isNull()).join(
        referring_hosts(links), ["host_reversed", "path"], "left")
    return (todo.select("id", "scheme", "host_reversed", "path", F.coalesce("weight", F.lit(0)).alias("weight"))
            .orderBy(F.desc("weight"), "host_reversed", "path").limit(k))


def host_stats(frontier: DataFrame, links: DataFrame) -> DataFrame:
    """Per host: pages, visited, unvisited, links out, links in.
    Three partial+final aggregations on the host key, full outer joined."""
    hs = lambda c: F.array_join(F.reverse(F.split(
        F.regexp_extract(F.col(c), r"^[^:]+://(?:[^@/]*@)?([^/]*)", 1), r"\.")), ".")
    pages = frontier.groupBy("host_reversed").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count("latest_visit").alias("visited"))
    out = links.groupBy(hs("source").alias("host_reversed")).agg(F.count(F.lit(1)).alias("links_out"))
    inn = links.groupBy(hs("target").alias("host_reversed")).agg(F.count(F.lit(1)).alias("links_in"))
    j = pages.join(out, "host_reversed", "full").join(inn, "host_reversed", "full")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return j.select("host_reversed", z("pages"), z("visited"),
                    (F.coalesce(F.col("pages"), F.lit(0)) - F.coalesce(F.col("visited"), F.lit(0)))
                    .alias("unvisited"), z("links_out"), z("links_in"))
