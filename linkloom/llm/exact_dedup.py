"""Exact dedup with DataFrame functions only: skew-safe combining.

Three stages, each grouping by digest *and* full normalised text: copies are
combined inside each map task (the partial aggregate), then within salted
digest groups, then the salts' winners globally.  A text that a third of all
rows share crosses each exchange once per task and salt.  The winners go back
to the rows by (digest, salt), so that join is spread as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE

#: Beyond every id; stands for a null id.
_NO_ID = "9223372036854775808BD"
#: More code points first, then the smaller id, as one number.
_RANK = "CAST(n AS DECIMAL(38,0)) * 100000000000000000000BD - coalesce(CAST(id AS DECIMAL(38,0)), " + _NO_ID + ")"
_RANK_N = "(best + 50000000000000000000BD) div 100000000000000000000BD"


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                salts: int = 16, keep_rows: bool = False) -> DataFrame:
    """Label each row with the row of its text group that stays.

    Texts are equal when identical after deleting every ``[\\x20\\x09-\\x0D]``;
    null counts as empty, so all empty texts are one group.  The row with the
    most code points stays, of those the one with the smallest id (a null id
    comes last); rows that also share this id are the same document and all
    count as kept.  Returns one row per input row: ``doc_id, keep_id,
    group_size, kept, text_sha256``; with ``keep_rows`` the kept input rows with
    their own columns instead, whatever these are called.  An empty table
    gives an empty result.  ``salts`` is at most 62.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    norm = F.translate(text, ASCII_SPACE, "")
    rows = docs.select(
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep_rows else []),
        F.col(id_col).cast("long").alias("id"), norm.alias("norm"), F.char_length(text).alias("n"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int").alias("salt"))
    rows = (rows.withColumn("digest", F.sha2("norm", 256))
            .withColumn("check", F.xxhash64("norm")).withColumn("rank", F.expr(_RANK)))
    salted = rows.groupBy("digest", "norm", "salt").agg(
        F.max("rank").alias("best"), F.count(F.lit(1)).alias("size"))
    groups = salted.groupBy("digest", "norm").agg(
        F.max("best").alias("best"), F.sum("size").alias("group_size"),
        F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts"))
    winners = (groups.select(
        "digest", F.xxhash64("norm").alias("check"), "best", "group_size",
        F.expr(f"nullif(CAST({_RANK_N} AS DECIMAL(38,0)) * 100000000000000000000BD - best, {_NO_ID})")
        .cast("long").alias("keep_id"),
        F.explode(F.expr(f"filter(sequence(0, {salts - 1}), s -> shiftright(salts, s) % 2 = 1)")).alias("salt")))
    found = rows.drop("norm", "n").join(winners, ["digest", "check", "salt"])
    kept = F.col("rank") == F.col("best")
    if keep_rows:
        return found.where(kept).select("row.*")
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", kept.alias("kept"),
                        F.col("digest").alias("text_sha256"))
