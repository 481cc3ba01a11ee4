"""Parquet sources and sinks.

Reads always go through ``spark.read.parquet`` so Catalyst can prune
columns and push filters into the scan; callers ``select`` what they need.
Writes lay tables out for the access paths of the engine:

* ``frontier``: range-partitioned and sorted by ``(host_reversed, path)``
  so Parquet min/max statistics prune by host (reversed host keeps the
  sub-domains of a domain together);
* ``links``: stored twice, one folder for each bucket of ``source`` (which is what the
  link refresh rewrites) and one for each bucket of ``target``, sorted by that key and with a
  Bloom filter on it, so that a lookup opens the folders of its keys only and skips the row
  groups without them.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


_SPLITS: dict = {}


def _splits(df: DataFrame, path: str) -> int:
    """Number of scan partitions of a table (memoized per session/path)."""
    k = (df.sparkSession.sparkContext.applicationId, path)
    if k not in _SPLITS:
        _SPLITS[k] = df.rdd.getNumPartitions()
    return _SPLITS[k]


def spread(df: DataFrame, key: str, path: str | None = None) -> DataFrame:
    """Hash-spread an under-split scan over the cluster's cores.

    Large inputs arrive in many splits and pass through untouched; a file
    with a single row group is read by one task, which would leave the
    per-page regex work on one core.  Hashing on a key (not round-robin)
    keeps the assignment deterministic when a task is retried.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    have = _splits(df, path) if path else df.rdd.getNumPartitions()
    if have >= want:
        return df
    return df.repartition(want, key)


def read_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archived fetched pages ``(page_id, url, html)`` (A3 source)."""
    return spread(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"), "page_id",
                  table_path(sf_dir, "pages"))


def write_frontier(frontier: DataFrame, path: str, partitions: int | None = None) -> None:
    n = partitions or frontier.sparkSession.conf.get("spark.sql.shuffle.partitions")
    (frontier.repartitionByRange(int(n), "host_reversed", "path")
     .sortWithinPartitions("host_reversed", "path")
     .write.mode("overwrite").parquet(path))


def write_hosts(texts: DataFrame, path: str, partitions: int | None = None) -> None:
    """Host robots table ``(host_reversed, robot)`` (A7), sorted by the
    reversed host so one domain's hosts share files."""
    n = partitions or frontier_partitions(texts)
    (texts.select("host_reversed", "robot").repartitionByRange(int(n), "host_reversed")
     .sortWithinPartitions("host_reversed").write.mode("overwrite").parquet(path))


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _write_links(links: DataFrame, path: str, key: str, buckets: int, mode: str = "errorifexists") -> None:
    """``path/buckets=N/bucket=k`` by hash of ``key``.  Spark splits the bucket of a key that owns a large share of
    the links into several files, and joins small buckets in one task."""
    other = {"source": "target", "target": "source"}[key]
    rows = links.select("source", "target", F.lit(buckets).alias("buckets"), bucket_of(key, buckets).alias("bucket"))
    (rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", key, other)
     .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("buckets", "bucket")
     .option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(path))


def write_links_by_source(links: DataFrame, path: str, partitions: int | None = None) -> None:
    _write_links(links, path, "source", partitions or frontier_partitions(links))


def write_links_by_target(links: DataFrame, path: str, partitions: int | None = None) -> None:
    _write_links(links, path, "target", partitions or frontier_partitions(links))


def stored_buckets(spark: SparkSession, path: str) -> int:
    """Number of buckets of a stored link table (told by its folders' names); 0 if it is empty."""
    first = spark.read.parquet(path).select("buckets").first()
    return first.buckets if first else 0


def lookup_links(spark: SparkSession, path: str, key: str, values: list[str]) -> DataFrame:
    """Links whose ``key`` (that the copy in ``path`` is stored by) is one of ``values``, a request's list.
    Only the folders of their buckets are listed in the scan; the pushed filter skips row groups."""
    n = stored_buckets(spark, path)
    asked = spark.createDataFrame([(v,) for v in values], f"{key} string")
    hit = sorted(r.b for r in asked.select(bucket_of(key, n or 1).alias("b")).distinct().collect())
    return (spark.read.parquet(path).where((F.col("buckets") == n) & F.col("bucket").isin(hit) & F.col(key).isin(values))
            .select("source", "target"))


def lookup_sorted(spark: SparkSession, path: str, column: str, value: str) -> DataFrame:
    """Point lookup in a link table stored by ``column``."""
    return lookup_links(spark, path, column, [value])


def lookup_many(spark: SparkSession, path: str, keys: DataFrame, key: str) -> DataFrame:
    """Links whose ``key`` is in the table ``keys``: a semi-join that also names the bucket, so that a scan for few
    keys is pruned at run time to their folders."""
    asked = keys.select(key).distinct().select(key, bucket_of(key, stored_buckets(spark, path) or 1).alias("bucket"))
    return spark.read.parquet(path).join(asked, ["bucket", key], "left_semi").select("source", "target")


def replace_stored_links(spark: SparkSession, path: str, recrawled: DataFrame) -> list[int]:
    """Link refresh (H3) of a table stored by source: only the buckets of re-read pages are read and written
    anew, files of other buckets stay as they are.  ``recrawled`` as in ``operators.links.replace_links``.
    Returns the buckets written."""
    from ..operators.links import replace_links
    from ..session import cut_lineage
    recrawled = cut_lineage(recrawled.select("source", "target"))
    n = stored_buckets(spark, path) or frontier_partitions(recrawled)
    touched = sorted(r.b for r in recrawled.select(bucket_of("source", n).alias("b")).distinct().collect())
    stored = spark.read.parquet(path).where(F.col("bucket").isin(touched)).select("source", "target")
    # the new content is stored before the old is replaced
    new = cut_lineage(replace_links(stored, recrawled))
    _write_links(new, path, "source", n, mode="overwrite")
    left = {r.b for r in new.select(bucket_of("source", n).alias("b")).distinct().collect()}
    for b in set(touched) - left:  # all links of the bucket are gone
        delete_folder(spark, f"{path}/buckets={n}/bucket={b}")
    return touched


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def frontier_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
