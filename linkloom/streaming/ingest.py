"""Structured Streaming link ingest.

``readStream`` over a folder of archived pages (or responses) ->
``foreachBatch``: extract and resolve links (B5-B10), add edges absent
from the edge table (A6) and pages absent from the frontier (A5).

Exactly-once by construction: the edge table and the frontier are keyed logs (``sources/keyed_log.py``), in
which each micro-batch overwrites a segment of its own, and the anti-join that decides
what is new reads the log *without* that segment.  A batch replayed after
a failure therefore rewrites the same rows, and a second run over the same
input (new checkpoint, new ``run_id``) adds nothing.  De-duplication is by
key against the log, never with unbounded streaming state.

A micro-batch writes one file for each million rows of a table and reads the buckets its hosts (of a hot
host: its pages) fall in, by path; older segments are merged level by level.  A batch's counters are counted from what
it wrote and overwrite the batch's own metrics folder, so a replay writes them again; the queue size and the
number of link pairs are running totals over these rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import frontier as FR
from ..operators import links as L
from ..operators.responses import crawlable_reason
from ..schemas import PAGES, RESPONSES
from ..sources.keyed_log import KeyedLog

METRICS = "pages long, links_seen long, links_added long, pages_added long"


def links_log(spark: SparkSession, table_dir: str, **size) -> KeyedLog:
    return KeyedLog(spark, f"{table_dir}/links", "source string, target string", L.host_of("source"), ["source"], **size)


def pages_log(spark: SparkSession, table_dir: str, **size) -> KeyedLog:
    return KeyedLog(spark, f"{table_dir}/frontier",
                    "id string, scheme string, host_reversed string, path string, latest_visit timestamp_ntz",
                    F.col("host_reversed"), ["host_reversed", "path"], **size)


def ingest_batch(batch: DataFrame, batch_id: int, table_dir: str, run_id: str, **size) -> None:
    """One micro-batch: links and pages of the batch, upserted by key.  ``size``: ``rows`` and ``fan_in`` of the logs."""
    spark = batch.sparkSession
    links, pages = links_log(spark, table_dir, **size), pages_log(spark, table_dir, **size)
    if links.merged(run_id, batch_id):  # complete long since
        return
    if "status" in batch.columns:
        batch = batch.where(crawlable_reason().isNull())
    # a file's splits are many, but its pages lie in one row group or a few: they are dealt to all cores
    pages_ = batch.select("page_id", "url", "html")
    cores = max(pages_.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
    keys = L.link_keys(pages_.repartition(cores, "page_id")).persist()
    try:
        found = keys.select("source", "target").distinct()
        new_links = found.join(links.holding(keys, run_id, batch_id), ["source", "target"], "left_anti")
        n_links = links.append(new_links, run_id, batch_id)
        new_pages = FR.insert_pages(pages.holding(keys, run_id, batch_id), keys, ["page_id", "pos"])
        n_pages = pages.append(new_pages, run_id, batch_id)
        counts = (batch.count(), keys.count(), n_links, n_pages)
        (spark.createDataFrame([counts], METRICS).write.mode("overwrite")
         .parquet(f"{table_dir}/metrics/run_id={run_id}/batch_id={batch_id}"))
    finally:
        keys.unpersist()


def start_ingest(spark: SparkSession, source_dir: str, table_dir: str, checkpoint_dir: str,
                 files_per_trigger: int = 1, available_now: bool = True, run_id: str | None = None,
                 responses: bool = False):
    """Start the ingest stream; returns the ``StreamingQuery``.  The run id belongs to
    the checkpoint, so a restart goes on with the same one."""
    run_id = run_id or "r" + hashlib.md5(checkpoint_dir.rstrip("/").encode()).hexdigest()[:12]
    schema = RESPONSES if responses else PAGES
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
           .parquet(source_dir))
    w = (src.writeStream.option("checkpointLocation", checkpoint_dir)
         .foreachBatch(lambda df, bid: ingest_batch(df, bid, table_dir, run_id)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


def read_links(spark: SparkSession, table_dir: str) -> DataFrame:
    return links_log(spark, table_dir).read()


def read_frontier(spark: SparkSession, table_dir: str) -> DataFrame:
    return pages_log(spark, table_dir).read()


def read_counters(spark: SparkSession, table_dir: str) -> DataFrame:
    """Counters of each micro-batch: pages read, links seen, links and pages added."""
    return (spark.read.schema(f"{METRICS}, run_id string, batch_id long").parquet(f"{table_dir}/metrics")
            .select("run_id", "batch_id", "pages", "links_seen", "links_added", "pages_added"))


def read_metrics(spark: SparkSession, table_dir: str) -> DataFrame:
    return read_counters(spark, table_dir).select("run_id", "batch_id", "links_added")


def read_progress(spark: SparkSession, table_dir: str) -> DataFrame:
    """``read_counters`` of one run after another with running totals: ``processed`` pages, ``link_pairs`` in the edge
    table and ``queue_size``, the pages found and not yet visited.  One row per micro-batch, so the window is small."""
    w = Window.orderBy("run_id", "batch_id").rowsBetween(Window.unboundedPreceding, 0)
    return read_counters(spark, table_dir).select(
        "*", F.sum("pages").over(w).alias("processed"), F.sum("links_added").over(w).alias("link_pairs"),
        F.sum("pages_added").over(w).alias("queue_size"))
