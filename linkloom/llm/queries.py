"""The registered queries of this subpackage: one per operator, over its whole
table, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources.tables import read_table
from . import (chat_format, decontaminate, exact_dedup, html_extract, lang_id, line_dedup, lm_score, packing,
               periodic_runs, quality, simhash, substring_dedup, token_align)

#: Windows of words, shingles and bits of the production queries.
BENCHMARK_WINDOW, PASSAGE_WINDOW, SHINGLE, MAX_BITS, SEQUENCE = 10, 13, 3, 2, 1024
#: Least score of a predicted label 1.
QUALITY = 0.3
#: A chat text that is all control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


@cache
def tokenizer_json(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


@cache
def piece_model(path: str | None = None) -> bytes:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


def language_model(docs: DataFrame) -> dict:
    """Learned from the labelled rows that are not held out."""
    return lang_id.train(docs, F.crc32(F.col("doc_id").cast("string")) % 4 != 2)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return lang_id.predict(docs, language_model(docs)).select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"),
        "lang_pred", "score")


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.read_back(chat_format.format_chats(turns)).select(
        "conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                                        window=BENCHMARK_WINDOW)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents"), window=PASSAGE_WINDOW).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(read_table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_json(), capacity=SEQUENCE)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=SHINGLE, max_bits=MAX_BITS)


def with_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in the texts of a tenth of the ids the words from a place on repeat with a period, both
    taken from the id's hash."""
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("w", F.when(
        F.col("h") % 10 == 0, F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")))
    rows = rows.withColumn("n", F.size("w").cast("long")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    left = F.col("n") - F.col("a")
    period = 1 + F.floor(left / (3 + F.col("g") % 8))
    head, cycle = F.slice("w", F.lit(1), F.col("a").cast("int")), F.slice("w", (F.col("a") + 1).cast("int"), period.cast("int"))
    again = F.slice(F.flatten(F.array_repeat(cycle, F.ceil(left / period).cast("int"))), F.lit(1), left.cast("int"))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(F.concat(head, again), " "))
                       .otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.detect(with_runs(read_table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align(read_table(spark, sf_dir, "documents"), tokenizer_json(), piece_model())


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.measured(read_table(spark, sf_dir, "documents"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    rows = cut_lineage(rows)
    model = quality.train(rows, read_table(spark, sf_dir, "labels"), ~held_out)
    return quality.score(rows, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= QUALITY).cast("int").alias("predicted"))


REGISTRY = {f.__name__: f for f in (
    op1_html_extraction, op2_line_dedup, op3_exact_dedup, op4_language_id, op5_chat_formatting,
    op6_benchmark_decontamination, op7_substring_dedup, op8_lm_scoring, op9_packing, op10_simhash_near_dedup,
    op11_periodic_runs, op12_token_alignment, op13_quality_classifier)}

_SPACE = r"[\x20\x09-\x0D]"

ORACLE = {
    "op2_line_dedup": rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^{_SPACE}+', ''), '{_SPACE}+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
firsts AS (SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1),
judged AS (SELECT doc_id, pos, line, coalesce(doc_id > first, false) AS gone FROM keyed LEFT JOIN firsts USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op3_exact_dedup": rf"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g') AS norm
  FROM documents),
w AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY norm) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM w""",
    "op5_chat_formatting": None,
    "op6_benchmark_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + 9], ' ') AS s
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS s
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, p, dw.n FROM dw JOIN iw USING (n, s)),
words AS (SELECT doc_id, count(DISTINCT p + k) AS n_hit FROM (SELECT DISTINCT doc_id, p, n FROM hits), range(10) t(k)
          WHERE k < n GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d WHERE len(w) >= 13)),
firsts AS (SELECT s, min(doc_id) AS first FROM win GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, p + k AS pos FROM win JOIN firsts USING (s), range(13) t(k) WHERE doc_id > first),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
judged AS (SELECT words.*, gone.pos IS NOT NULL AS removed FROM words LEFT JOIN gone USING (doc_id, pos)),
kept AS (SELECT doc_id, count(*) FILTER (removed) AS n_removed,
                string_agg(word, ' ' ORDER BY pos) FILTER (NOT removed) AS t FROM judged GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
}
ORACLE = {k: v for k, v in ORACLE.items() if v}
