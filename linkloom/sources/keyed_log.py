"""Keyed logs: append-only Parquet tables in which a stream finds the keys of a batch again.

A batch appends one segment, the folder ``segment=<name>/bucket=<b>``.  A segment has as many buckets as its
rows ask for (``ROWS`` each, so a usual batch is one file), by hash of the host; a host with more rows than
that takes several buckets, by hash of the page, which the segment records.  A lookup lists the bucket folders
that its keys fall in, by path, and opens nothing else.

A segment counts once its ``_segment`` file is there, which is written last.  Once ``FAN_IN`` segments
of a level have come together, the next batch merges them into one of the level above, so a log of n batches
has at most ``FAN_IN`` segments on each of its log(n) levels and a row is rewritten once a level.  The merged
segment names those it replaces (readers skip them from then on; they are deleted at the next merge) and the last
batch of each run that it holds.  A batch written again overwrites its own segment; one that has been merged is
complete and is left alone.  One writer at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import delete_folder

#: Rows in a bucket of a segment.
ROWS = 1_000_000
#: Segments of a level that are merged into one.
FAN_IN = 16


class KeyedLog:
    """Rows ``schema`` under ``path``; ``host`` (a column) names the host of a row, ``page`` the columns of its page."""

    def __init__(self, spark: SparkSession, path: str, schema: str, host: Column, page: list[str],
                 rows: int = ROWS, fan_in: int = FAN_IN):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.columns = spark.createDataFrame([], schema).columns
        self.host, self.page, self.rows, self.fan_in = host, page, rows, fan_in
        jvm = spark.sparkContext._jvm
        self._path, self._text = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # --- segments ----------------------------------------------------------------

    def _names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def _folder(self, name: str) -> str:
        return f"{self.path}/segment={name}"

    def _segments(self) -> tuple[dict[str, dict], list[str]]:
        """Finished segments that none replaces, with what they record, and the names of all others."""
        found, other = {}, []
        for name in (n.removeprefix("segment=") for n in self._names(self.path) if n.startswith("segment=")):
            mark = self._path(f"{self._folder(name)}/_segment")
            if self._fs.exists(mark):
                stream = self._fs.open(mark)
                found[name] = json.loads(self._text.toString(stream, "UTF-8"))
                stream.close()
            else:
                other.append(name)
        gone = {n for meta in found.values() for n in meta["replaces"]} & set(found)
        return {n: m for n, m in found.items() if n not in gone}, other + sorted(gone)

    def _bucketed(self, df: DataFrame, buckets: int, hot: dict[str, int]) -> DataFrame:
        """``df`` with the ``bucket`` of each row in a segment of so many buckets."""
        spread: Column = F.lit(1)
        if hot:
            hosts = self.spark.createDataFrame(sorted(hot.items()), "_host string, _spread int")
            df = df.withColumn("_host", self.host).join(hosts, "_host", "left")
            spread = F.coalesce("_spread", F.lit(1))
        first = F.pmod(F.xxhash64(self.host), F.lit(buckets))
        bucket = F.pmod(first + F.pmod(F.xxhash64(*self.page, F.lit(1)), spread), F.lit(buckets))
        return df.withColumn("bucket", bucket.cast("int")).drop("_host", "_spread")

    def _write(self, name: str, df: DataFrame, level: int, upto: dict[str, int], replaces: list[str]) -> int:
        """Write a segment; how many rows it has.  The hosts beyond a bucket's rows number at most rows / ``rows``."""
        counts = df.groupBy(self.host.alias("host")).agg(F.count(F.lit(1)).alias("n"))
        total = counts.agg(F.sum("n").alias("n"), F.collect_list(
            F.when(F.col("n") > self.rows, F.struct("host", "n"))).alias("hot")).first()
        n = total.n or 0
        buckets = max(1, -(-n // self.rows))
        hot = {r.host: min(buckets, -(-r.n // self.rows)) for r in total.hot}
        (self._bucketed(df.select(*self.columns), buckets, hot).hint("rebalance", "bucket")
         .sortWithinPartitions("bucket", *self.columns)
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket")
         .parquet(self._folder(name)))
        meta = {"level": level, "rows": n, "buckets": buckets, "hot": hot, "upto": upto, "replaces": replaces}
        out = self._fs.create(self._path(f"{self._folder(name)}/_segment"), True)
        out.write(json.dumps(meta).encode())
        out.close()
        return n

    def _merge(self, but: str) -> None:
        live, other = self._segments()
        levels: dict[int, list[str]] = {}
        for name, meta in live.items():
            if name != but:
                levels.setdefault(meta["level"], []).append(name)
        full = {lv: sorted(names) for lv, names in levels.items() if len(names) >= self.fan_in}
        if not full:
            return
        for name in other:  # replaced before the last merge, or a merge that was cut short
            if name != but:
                delete_folder(self.spark, self._folder(name))
        for level, names in full.items():
            upto: dict[str, int] = {}
            for name in names:
                for run, batch in live[name]["upto"].items():
                    upto[run] = max(batch, upto.get(run, batch))
            self._write(f"m{level + 1}-{uuid.uuid4().hex[:12]}", self._read([self._folder(n) for n in names]),
                        level + 1, upto, names)

    # --- use ---------------------------------------------------------------------

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return (self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*folders)
                .select(*self.columns))

    def read(self) -> DataFrame:
        return self._read([self._folder(n) for n in sorted(self._segments()[0])])

    @staticmethod
    def segment_of(run: str, batch: int) -> str:
        return f"s-{run}-{batch}"

    def merged(self, run: str, batch: int) -> bool:
        """Whether the batch is complete and part of a merged segment."""
        return any(m["level"] and m["upto"].get(run, -1) >= batch for m in self._segments()[0].values())

    def holding(self, keys: DataFrame, run: str, batch: int) -> DataFrame:
        """Rows of the buckets in which a row with the host and page of one of ``keys`` can be, without the
        batch's own segment."""
        folders = []
        for name, meta in sorted(self._segments()[0].items()):
            if name == self.segment_of(run, batch):
                continue
            if meta["buckets"] == 1:
                folders.append(self._folder(name))
                continue
            # at most as many as the segment has buckets
            hit = {f"bucket={r.bucket}" for r in
                   self._bucketed(keys, meta["buckets"], meta["hot"]).select("bucket").distinct().collect()}
            folders += [f"{self._folder(name)}/{b}" for b in sorted(hit & set(self._names(self._folder(name))))]
        return self._read(folders)

    def append(self, df: DataFrame, run: str, batch: int) -> int:
        """Write the batch's segment (again, if it is there); how many rows it has."""
        self._merge(self.segment_of(run, batch))
        df = df.select(*self.columns).persist()
        try:
            return self._write(self.segment_of(run, batch), df, 0, {run: batch}, [])
        finally:
            df.unpersist()
