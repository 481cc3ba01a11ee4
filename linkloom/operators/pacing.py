"""Per-host pacing over a request log.

* ``politeness_schedule``: a token bucket with burst 1 and one token per
  ``interval_s`` per (method, host): ``slot_i = max(a_i, slot_{i-1} + d)`` for arrivals a.
* ``adaptive_rate``: every earlier 429 that a HEAD request got halves the host's
  rate for HEAD and GET alike, i.e. ``interval = base * 2^(earlier HEAD 429s)``.
* ``adaptive_schedule``: both together, the slots under the interval in force.

All are prefix scans (:mod:`linkloom.operators.scan`), so a host, or an hour, with a third of
the log is processed in as many tasks as its rows need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import epoch_micros, ntz_from_micros
from .scan import earliest_slots, ranged, running

# --- fixed values -----------------------------------------------------------
DEFAULT_INTERVAL_S = 5.0   # one request per 5000 ms per (method, host)
# ---------------------------------------------------------------------------
#: Halvings after which no request fits the clock any more (base * 2^60 s); more count as these.
MOST_HALVINGS = 60


def politeness_schedule(log: DataFrame, interval_s: float = DEFAULT_INTERVAL_S,
                        keys: tuple[str, ...] = ("method", "host"),
                        order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """Earliest allowed time of each request: ``(event_id, ts, method,
    host, slot_ts, wait_s, delayed)``.  ``interval_s = 0`` means no limit."""
    keys, order = list(keys), list(order)
    base = log.select("event_id", "ts", "method", "host")
    if interval_s <= 0:
        return base.select("*", F.col("ts").alias("slot_ts"), F.lit(0.0).alias("wait_s"),
                           F.lit(False).alias("delayed"))
    # integer micro-seconds keep the running max exact
    arrival = epoch_micros(F.col("ts"))
    interval = F.lit(int(round(interval_s * 1_000_000))).cast("long")
    wait = F.col("slot") - arrival
    return earliest_slots(ranged(base, keys, order), keys, order, arrival, interval, "slot").select(
        "event_id", "ts", "method", "host", ntz_from_micros(F.col("slot")).alias("slot_ts"),
        (wait / 1_000_000.0).alias("wait_s"), (wait > 0).alias("delayed"))


def _halvings(log: DataFrame, *columns: str) -> DataFrame:
    """The log, dealt by host, with the number of earlier 429s to a HEAD request of the host."""
    dealt = ranged(log.select("event_id", "ts", "host", "method", "code", *columns), ["host"], ["ts", "event_id"])
    refused = ((F.col("code") == 429) & (F.col("method") == "HEAD")).cast("long")
    return running(dealt, ["host"], ["ts", "event_id"], F.coalesce(refused, F.lit(0)), "sum", "halvings", inclusive=False)


def adaptive_rate(log: DataFrame, base_interval_s: float = DEFAULT_INTERVAL_S,
                  max_interval_s: float | None = None) -> DataFrame:
    """Interval in force for each request after halving the host's rate on
    every earlier 429 to a HEAD request: ``(event_id, ts, host, method, halvings,
    interval_s)``.  No floor and no recovery, as specified; an optional
    ``max_interval_s`` caps it."""
    iv = F.lit(base_interval_s) * F.pow(F.lit(2.0), F.col("halvings"))
    if max_interval_s is not None:
        iv = F.least(iv, F.lit(max_interval_s))
    return _halvings(log).select("event_id", "ts", "host", "method", "halvings", iv.alias("interval_s"))


def adaptive_schedule(log: DataFrame, base_interval_s: float = DEFAULT_INTERVAL_S,
                      max_interval_s: float | None = None) -> DataFrame:
    """Earliest allowed time of each request of a (method, host) under the interval that is in force
    when it arrives: ``(event_id, ts, method, host, halvings, slot_us, wait_us, delayed)``.

    ``slot_us`` (micro-seconds since 1970) and ``wait_us`` are exact integers; a slot that no 64-bit clock
    holds, after very many halvings, is null with its wait, and the request is delayed."""
    wide = "decimal(38,0)"
    interval = (F.lit(int(round(base_interval_s * 1_000_000))).cast(wide)
                * F.expr(f"shiftleft(1L, cast(least(halvings, {MOST_HALVINGS}) AS int))").cast("decimal(19,0)")).cast(wide)
    if max_interval_s is not None:
        interval = F.least(interval, F.lit(int(round(max_interval_s * 1_000_000))).cast(wide))
    arrival = epoch_micros(F.col("ts"))
    timed = earliest_slots(_halvings(log), ["method", "host"], ["ts", "event_id"], arrival.cast(wide), interval, "slot")
    slot = F.col("slot").try_cast("long")
    return timed.select("event_id", "ts", "method", "host", "halvings", slot.alias("slot_us"),
                        (slot - arrival).alias("wait_us"), (F.col("slot") > arrival).alias("delayed"))
