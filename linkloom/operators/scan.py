"""Running (prefix) aggregates that stay parallel whatever the keys.

A running sum or max ``over (partition by key order by t)`` puts every row of a
key into one task; when one host owns a third of the log, that task owns
a third of the data.  Here the rows are dealt by range of ``(keys, order)`` at sampled split
points, so a part holds about as many rows as any other, be they of one host
and one second or of many.  Each part runs the window by itself; what a key's earlier
parts add up to is computed on one row per (part, key) and comes back as an
offset.  The result equals the single window's.

Rows with equal keys and order stay together, so ``order`` should end in a unique
column.  A null key is a key like any other.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Columns of a table dealt by range: the part's number in the order, and the number by which it
#: gets a task of its own.
PART, TASK = "_part", "_task"


def _task_numbers(spark: SparkSession, n: int) -> list[int]:
    """For each of ``n`` parts a number that the exchange's hash deals to a task of its own."""
    tried = spark.range(int(n * (math.log(n) + 16))).select(F.col("id").cast("int").alias("i"))
    got = tried.groupBy(F.pmod(F.hash("i"), F.lit(n)).alias("t")).agg(F.min("i").alias("i")).collect()
    found = sorted(r.i for r in got)
    return [found[i % len(found)] for i in range(n)]  # all n are found but by a freak of the hash


def ranged(df: DataFrame, keys: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """The rows dealt by range of ``(keys, order)`` into ``parts`` (by default
    ``spark.sql.shuffle.partitions``), with ``_part`` and ``_task``.

    The dealt rows are checkpointed: split points are sampled, and a second run of
    the plan could choose others."""
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbers = _task_numbers(spark, parts)
    dealt = df.repartitionByRange(parts, *keys, *order).select("*", F.spark_partition_id().alias(PART))
    task = F.element_at(F.array(*map(F.lit, numbers)), F.col(PART) + 1)
    return cut_lineage(dealt.select("*", task.alias(TASK))).repartition(parts, TASK)


def _join_carry(rows: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the offsets of their part and key, null in a key's first part."""
    on = [TASK, PART, *keys]
    carry = carry.select(*[F.col(c).alias(f"_on_{c}") for c in on], *[c for c in carry.columns if c not in on])
    same = [F.col(c).eqNullSafe(F.col(f"_on_{c}")) if c in keys else F.col(c) == F.col(f"_on_{c}") for c in on]
    return rows.join(carry, reduce(lambda a, b: a & b, same), "left").drop(*[f"_on_{c}" for c in on])


def running(dealt: DataFrame, keys: list[str], order: list[str], value: Column, how: str, out: str,
            inclusive: bool = True) -> DataFrame:
    """Add ``out`` = running ``how`` (``sum`` or ``max``) of ``value`` per ``keys`` in ``order`` over
    rows that ``ranged`` dealt by these or fewer keys.  ``inclusive=False`` leaves the row itself out (sum only)."""
    agg = F.sum if how == "sum" else F.max
    d = dealt.select("*", value.alias("_v"))
    w = Window.partitionBy(TASK, PART, *keys).orderBy(*order)
    local = d.select("*", agg("_v").over(w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)).alias("_local"))
    per = d.groupBy(TASK, PART, *keys).agg(agg("_v").alias("_tot"))
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carry = (per.select(TASK, PART, *keys, agg("_tot").over(before).alias("_carry"))
             .where(F.col("_carry").isNotNull()))
    j = _join_carry(local, carry, keys)
    if how == "sum":
        res = F.coalesce("_local", F.lit(0)) + F.coalesce("_carry", F.lit(0))
    else:
        res = F.greatest("_local", "_carry")  # nulls are passed over
    return j.select(*dealt.columns, res.alias(out))


def earliest_slots(dealt: DataFrame, keys: list[str], order: list[str], arrival: Column, interval: Column,
                   out: str) -> DataFrame:
    """Add ``out`` = the slot of each row when ``slot = max(arrival, slot before + interval)`` per ``keys`` in
    ``order`` (the first: its arrival); ``interval`` is the row's own and may vary.

    With S the running sum of the intervals it is ``S + running max(arrival - S)``.  A part's offset is
    the sum of the intervals before it and the max over the parts before it."""
    d = dealt.select("*", arrival.alias("_a"), interval.alias("_d"))
    w = Window.partitionBy(TASK, PART, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = d.select("*", F.sum("_d").over(w).alias("_s"))
    local = local.select("*", F.max(F.col("_a") - F.col("_s")).over(w).alias("_m"))
    per = local.groupBy(TASK, PART, *keys).agg(F.sum("_d").alias("_sum"), F.max(F.col("_a") - F.col("_s")).alias("_max"))
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("*", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_s0"))
    carry = (per.select(TASK, PART, *keys, "_s0", F.max(F.col("_max") - F.col("_s0")).over(before).alias("_m0"))
             .where(F.col("_m0").isNotNull()))
    j = _join_carry(local, carry, keys)
    s0 = F.coalesce("_s0", F.lit(0))
    return j.select(*dealt.columns, (F.col("_s") + s0 + F.greatest(F.col("_m") - s0, F.col("_m0"))).alias(out))
