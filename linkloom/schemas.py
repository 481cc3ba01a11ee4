"""Explicit schemas of the tables this library reads and writes."""

from pyspark.sql import types as T

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

RESPONSES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("x_robots_tag", T.StringType()),
    T.StructField("html", T.StringType()),
])

FRONTIER = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("scheme", T.StringType(), False),
    T.StructField("host_reversed", T.StringType(), False),
    T.StructField("path", T.StringType(), False),
    T.StructField("latest_visit", T.TimestampNTZType(), True),
])

LINKS = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("target", T.StringType(), False),
])

HOSTS = T.StructType([
    T.StructField("host_reversed", T.StringType(), False),
    T.StructField("robot", T.StringType(), False),
])

ROBOTS_RESPONSES = T.StructType([
    T.StructField("host", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("body", T.StringType()),
])

REQUEST_LOG = T.StructType([
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("host", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("code", T.IntegerType()),
    T.StructField("duration_s", T.DoubleType()),
    T.StructField("level", T.StringType()),
])
