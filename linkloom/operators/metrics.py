"""Crawl metrics computed from tables.

Counters are global aggregates (one output row, partial aggregation on
every task).  Histograms bucket each value with an array expression and
aggregate per (label, bucket) in one scan; the cumulative ``le`` counts are taken
from that small result, never from raw rows.  Time series first aggregate
per time bucket; running totals then run on the bucketed rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timecols import epoch_micros, ntz_from_micros, truncate_micros
from .scan import ranged, running

# --- fixed values -----------------------------------------------------------
DEFAULT_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]
DNS_BUCKETS = [0.005, 0.01, 0.025, 0.05]
TLS_BUCKETS = [0.05, 0.1, 0.25, 0.5]
LEVELS = ["ERROR", "WARN"]
# ---------------------------------------------------------------------------


def crawl_counters(spark: SparkSession, request_log: DataFrame, frontier: DataFrame,
                   links: DataFrame, allowed: DataFrame) -> DataFrame:
    """One row: processed, errors, warnings, queue size, links, robots
    allowed / disallowed.  One global aggregate per source table (a scalar
    subquery returning a struct), combined in a one-row projection."""
    lv = F.col("level")
    log = request_log.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(lv == "ERROR").alias("e"),
                                   F.count_if(lv == "WARN").alias("w"))).scalar()
    queue = frontier.agg(F.count_if(F.col("latest_visit").isNull())).scalar()
    n_links = links.agg(F.count(F.lit(1))).scalar()
    rob = allowed.agg(F.struct(F.count_if(F.col("allowed")).alias("ok"),
                               F.count_if(~F.col("allowed")).alias("ko"))).scalar()
    return spark.range(1).select(log.getField("n").alias("processed"), log.getField("e").alias("errors"),
                                 log.getField("w").alias("warnings"), queue.alias("queue_size"),
                                 n_links.alias("links"), rob.getField("ok").alias("robots_allowed"),
                                 rob.getField("ko").alias("robots_disallowed"))


def log_levels(log: DataFrame) -> DataFrame:
    """Log records by level, error and warning only."""
    return log.where(F.col("level").isin(*LEVELS)).groupBy("level").agg(F.count(F.lit(1)).alias("n"))


def requests_by_code(log: DataFrame) -> DataFrame:
    """Requests by (code, method)."""
    return log.groupBy("code", "method").agg(F.count(F.lit(1)).alias("n"))


def _labels(bounds: list[float]) -> list[str]:
    return [repr(b) for b in bounds] + ["+Inf"]


def histogram(df: DataFrame, label: str, value: str, buckets: list[float] = DEFAULT_BUCKETS) -> DataFrame:
    """Cumulative histogram per ``label``: ``(label, le, cum_count, sum,
    count)`` with one row per bucket bound plus ``+Inf`` (E5, E6)."""
    df = df.where(F.col(value).isNotNull())  # what was not measured is in no bucket
    bounds = F.array(*[F.lit(b) for b in buckets])
    idx = F.size(F.filter(bounds, lambda b: b < F.col(value)))  # first bound >= value
    per = df.groupBy(F.col(label).alias("label"), idx.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("s"))
    # one row per label, from the one scan; it holds as many entries as there are buckets
    tot = per.groupBy("label").agg(F.map_from_entries(F.collect_list(F.struct("b", "n"))).alias("by"),
                                   F.sum("s").alias("sum"), F.sum("n").alias("count"))
    names = F.array(*[F.lit(x) for x in _labels(buckets)])
    cum = F.aggregate(F.sequence(F.lit(0), F.col("b")), F.lit(0).cast("long"),
                      lambda acc, b: acc + F.coalesce(F.element_at("by", b), F.lit(0)))
    return (tot.select("label", "by", "sum", "count", F.posexplode(names).alias("b", "le"))
            .select("label", "le", cum.alias("cum_count"), "sum", "count"))


def in_flight(log: DataFrame, bucket: str = "hour") -> DataFrame:
    """Requests in flight (E7): +1 at start, -1 at end (start + duration);
    per time bucket the peak of the running total, with ends before starts
    at equal times.  The running total is a prefix scan over the whole log, in parts of
    about as many events each."""
    start = epoch_micros(F.col("ts"))
    end = start + (F.col("duration_s") * 1_000_000).cast("long")
    ev = log.select(F.explode(F.array(
        F.struct(start.alias("t"), F.lit(1).alias("d"), F.col("event_id").alias("id")),
        F.struct(end.alias("t"), F.lit(-1).alias("d"), F.col("event_id").alias("id")))).alias("e")) \
        .select("e.*")
    order = ["t", "d", "id"]
    r = running(ranged(ev, [], order), [], order, F.col("d"), "sum", "in_flight")
    return (r.groupBy(ntz_from_micros(truncate_micros(F.col("t"), bucket)).alias("bucket"))
            .agg(F.max("in_flight").alias("peak_in_flight")))


def throughput(log: DataFrame, bucket: str = "1 day") -> DataFrame:
    """Requests per second (E8): per time bucket, and overall (bucket
    null) as count / (last - first)."""
    b = F.window("ts", bucket)
    per = log.groupBy(b.alias("w")).agg(F.count(F.lit(1)).alias("requests"),
                                        F.min("ts").alias("first"), F.max("ts").alias("last"))
    secs = (epoch_micros(F.col("last")) - epoch_micros(F.col("first"))) / 1e6
    per = per.select(F.col("w.start").cast("timestamp_ntz").alias("bucket"), "requests",
                     secs.alias("seconds"))
    allr = log.agg(F.count(F.lit(1)).alias("requests"), F.min("ts").alias("first"), F.max("ts").alias("last")) \
        .select(F.lit(None).cast("timestamp_ntz").alias("bucket"), "requests", secs.alias("seconds"))
    out = per.unionByName(allr)
    return out.select("bucket", "requests", "seconds",
                      F.when(F.col("seconds") > 0, F.col("requests") / F.col("seconds")).alias("rate"))


def progress_report(log: DataFrame, frontier: DataFrame | None = None, links: DataFrame | None = None,
                    bucket: str = "1 day") -> DataFrame:
    """Cumulative processed / errors / warnings per time bucket of the log (F1).

    With a ``frontier`` also ``queue``, its pages not visited by the end of the bucket, and with ``links``
    (``host_reversed, path`` of the source, one row per pair) ``links``, the pairs whose source
    was visited by then.  Everything is counted per bucket first; the global running window runs on these
    rows only."""
    def by_bucket(df: DataFrame, ts: str, *counts) -> DataFrame:
        per = df.where(F.col(ts).isNotNull()).groupBy(F.window(ts, bucket).alias("w")).agg(*counts)
        return per.withColumn("bucket", F.col("w.start").cast("timestamp_ntz")).drop("w")

    lv, one = F.col("level"), F.count(F.lit(1))
    rows = by_bucket(log, "ts", one.alias("n"), F.count_if(lv == "ERROR").alias("e"), F.count_if(lv == "WARN").alias("wn"))
    totals = {"processed": "n", "errors": "e", "warnings": "wn"}
    if frontier is not None:
        rows = rows.unionByName(by_bucket(frontier, "latest_visit", one.alias("visited")), allowMissingColumns=True)
        totals["visited"] = "visited"
    if links is not None:
        when = frontier.select("host_reversed", "path", "latest_visit")
        rows = rows.unionByName(by_bucket(links.join(when, ["host_reversed", "path"]), "latest_visit", one.alias("found")),
                                allowMissingColumns=True)
        totals["links"] = "found"
    counts = list(totals.values())
    rows = rows.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in counts])
    w = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    out = rows.select("bucket", "n", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(t) for t, c in totals.items()])
    out = out.where(F.col("n").isNotNull()).withColumnRenamed("n", "requests")
    if frontier is None:
        return out
    return out.withColumn("queue", frontier.agg(one).scalar() - F.col("visited")).drop("visited")
