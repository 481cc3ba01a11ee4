"""Keyed logs and the stream on them (I1, I2): bounded files, hot hosts, lookups by path, merges, replays."""

from __future__ import annotations

import glob
import os
import random

from pyspark.sql import functions as F

from linkloom.sources.keyed_log import KeyedLog
from linkloom.streaming.ingest import ingest_batch, links_log, pages_log, read_frontier, read_links, read_progress


def _files(path) -> list[str]:
    return glob.glob(f"{path}/**/*.parquet", recursive=True)


def _log(spark, path, **size) -> KeyedLog:
    return KeyedLog(spark, str(path), "host string, page long, target string", F.col("host"), ["page"], **size)


def test_a_hot_host_takes_several_buckets_and_a_lookup_opens_those_of_its_pages(spark, tmp_path):
    rows = [("hot", i, "t") for i in range(800)] + [(f"h{i}", i, "t") for i in range(200)]
    df = spark.createDataFrame(rows, "host string, page long, target string")
    log = _log(spark, tmp_path / "log", rows=50)
    assert log.append(df, "r", 0) == 1000
    assert sorted(map(tuple, log.read().collect())) == sorted(rows)
    folders = glob.glob(f"{tmp_path}/log/segment=s-r-0/bucket=*")
    assert 15 <= len(folders) <= 20 and len(_files(tmp_path / "log")) <= 20 + 8
    sizes = [spark.read.parquet(f).where("host = 'hot'").count() for f in folders]
    assert max(sizes) < 2 * 800 / len(folders) + 30  # no bucket has most of the host

    for asked in ([("hot", 5)], [("h7", 7)], [("hot", 5), ("hot", 6), ("h9", 9)]):
        keys = spark.createDataFrame(asked, "host string, page long")
        got = log.holding(keys, "r", 1)
        assert len(got.inputFiles()) <= 2 * len(asked)
        assert {(r.host, r.page) for r in got.collect()} >= set(asked)
    assert log.holding(keys, "r", 0).count() == 0  # a batch does not see its own segment
    assert log.holding(keys.limit(0), "r", 1).count() == 0


def test_merges_keep_every_row_once_and_their_number_stays_logarithmic(spark, tmp_path):
    log = _log(spark, tmp_path / "log", rows=20, fan_in=3)
    made = []
    for batch in range(11):
        rows = [("hot", batch * 10 + i, "t") for i in range(10)]
        made += rows
        assert log.append(spark.createDataFrame(rows, "host string, page long, target string"), "r", batch) == 10
        assert sorted(map(tuple, log.read().collect())) == made
    live, _ = log._segments()
    assert max(m["level"] for m in live.values()) == 2 and len(live) <= 3 * 3
    assert log.merged("r", 5) and not log.merged("r", 10) and not log.merged("other", 0)
    assert log.append(spark.createDataFrame([], "host string, page long, target string"), "r", 11) == 0


def test_a_merge_or_a_batch_that_was_cut_short_is_not_read(spark, tmp_path):
    log = _log(spark, tmp_path / "log", fan_in=2)
    row = spark.createDataFrame([("a", 1, "t")], "host string, page long, target string")
    log.append(row, "r", 0)
    for left in ("m1-dead", "s-r-1"):  # data without the closing file
        row.withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(log._folder(left))
    assert log.read().count() == 1 and log.holding(row, "r", 2).count() == 1
    log.append(row, "r", 1)  # the batch again
    log.append(row, "r", 2)  # merges 0 and 1; what is left of the other merge goes
    assert log.read().count() == 3 and not os.path.exists(log._folder("m1-dead"))


def test_stream_batches_against_a_set_with_merges_and_late_replays(spark, tmp_path):
    rng = random.Random(5)
    table, size, sources = str(tmp_path / "t"), {"rows": 15, "fan_in": 2}, {}
    batches = []
    for batch in range(5):
        pages = []
        for i in range(6):
            host, page = rng.choice(["hot", "hot", "a", "b"]), rng.randrange(12)
            targets = [f"/{rng.randrange(30)}" for _ in range(3)]
            pages.append((batch * 10 + i, f"http://{host}.com/p{page}", "".join(f'<a href="{t}">' for t in targets)))
            for t in targets:
                sources.setdefault((f"http://{host}.com/p{page}", f"http://{host}.com{t}"), batch)
        batches.append(spark.createDataFrame(pages, "page_id long, url string, html string"))
        ingest_batch(batches[-1], batch, table, "r", **size)
    expected = sorted(sources)
    for replay in (4, 0, 2):
        ingest_batch(batches[replay], replay, table, "r", **size)
    assert sorted(map(tuple, read_links(spark, table).collect())) == expected
    keys = [(r.host_reversed, r.path) for r in read_frontier(spark, table).collect()]
    assert len(keys) == len(set(keys)) == len({t for _, t in expected})
    added = {r.batch_id: (r.links_added, r.link_pairs, r.queue_size) for r in read_progress(spark, table).collect()}
    assert [added[b][0] for b in range(5)] == [sum(x == b for x in sources.values()) for b in range(5)]
    assert added[4][1:] == (len(expected), len(keys))


def test_a_usual_batch_is_one_file_a_table(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h{i % 40}.com/{i}", f'<a href="/{i + 1}">') for i in range(400)],
                                  "page_id long, url string, html string").repartition(6)
    for batch in range(2):
        ingest_batch(pages.where(F.col("page_id") % 2 == batch), batch, str(tmp_path), "r")
    assert len(_files(tmp_path / "links")) == len(_files(tmp_path / "frontier")) == 2
    assert links_log(spark, str(tmp_path)).read().count() == pages_log(spark, str(tmp_path)).read().count() == 400


def test_a_batch_of_one_row_group_is_read_by_all_cores(spark, tmp_path, monkeypatch):
    from linkloom.streaming import ingest
    d = str(tmp_path)
    rows = [(i, f"http://h{i % 7}.com/p{i}", f'<a href="/q{i}">x</a>') for i in range(400)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(d + "/in")
    busy, link_keys = [], ingest.L.link_keys

    def seen(pages):
        busy.append(pages.groupBy(F.spark_partition_id()).count().count())
        return link_keys(pages)

    monkeypatch.setattr(ingest.L, "link_keys", seen)
    ingest.ingest_batch(spark.read.parquet(d + "/in"), 0, d + "/t", "r")
    assert busy == [spark.sparkContext.defaultParallelism]
    assert ingest.read_links(spark, d + "/t").count() == 400
