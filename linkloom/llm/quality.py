"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

A text becomes a short row of statistics (shares of kinds of characters, words and
lines; no word itself).  Standardized, they go through random Fourier features, whose
inner products approximate a Gaussian kernel.  Each partition sums its labelled rows'
normal equations; the sums are added up in rounds of tasks, and one small system gives the
ridge weights.  Labelled rows that the weights have not seen then make a histogram of
raw scores, from which the pool-adjacent-violators rule makes a rising step
function: the share of label 1 at a raw score.

What reaches the driver is bounded by ``features`` squared and by ``STEPS``.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import as_array, owner, portions, split_words

#: Random features, kernel width (in standard deviations of one statistic), ridge penalty per labelled row.
FEATURES, WIDTH, PENALTY = 256, 4.0, 1e-4
#: Bins of the raw score for calibration.
STEPS = 2048
#: Partitions' sums added up in one task, and numbers of a sum in one row.
FAN_IN, SLICE = 64, 1 << 13
BATCH_BYTES = 4 << 20

#: Kinds of bytes whose shares count.
_KINDS = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": bytes(range(97, 123)), "digit": b"0123456789",
          "space": b" \t\n\x0b\x0c\r", "stop": b".,;:'\"-?", "shout": b"!", "bar": b"|", "mark": b"#$%&*@^~_=+`\\",
          "bracket": b"<>{}[]()/", "high": bytes(range(128, 256))}
STATISTICS = (*_KINDS, "words", "word_length", "same_as_before", "distinct", "most_frequent", "capital_words",
              "signed_words", "long_words", "line_words", "same_lines", "per_stop")


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of ``STATISTICS`` for each text (null or empty: zeros)."""
    texts = pc.fill_null(texts, "")
    n = len(texts)
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    edge = np.concatenate([[0], np.cumsum(size)])
    data = np.frombuffer(b"".join(texts.cast(pa.binary()).to_pylist()), np.uint8)
    kind = np.full(256, len(_KINDS), np.uint8)
    for k, members in enumerate(_KINDS.values()):
        kind[list(members)] = k
    kinds = kind[data]
    at_least_one = np.maximum(size, 1)
    out = [np.diff(np.concatenate([[0], np.cumsum(kinds == k)])[edge]) / at_least_one for k in range(len(_KINDS))]

    words, starts = split_words(texts)
    count, of = np.diff(starts), owner(starts)
    some = np.maximum(count, 1)

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=flags, minlength=n) / some

    coded = words.dictionary_encode()
    code, entries = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    length = pc.binary_length(entries).to_numpy(zero_copy_only=False) if len(entries) else np.empty(0, np.int64)
    same = np.zeros(len(code), bool)
    same[1:] = (code[1:] == code[:-1]) & (of[1:] == of[:-1])
    seen, times = np.unique(of * max(len(entries), 1) + code, return_counts=True)
    text_of = seen // max(len(entries), 1)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, text_of, times)

    def by_word(pattern: str) -> np.ndarray:
        found = pc.match_substring_regex(entries, pattern).to_numpy(zero_copy_only=False)
        return share(found[code])

    lines = pc.split_pattern(texts, "\n")
    line_starts = lines.offsets.to_numpy().astype(np.int64) - lines.offsets[0].as_py()
    line, line_of = lines.flatten().dictionary_encode().indices.to_numpy().astype(np.int64), owner(line_starts)
    n_lines = np.maximum(np.diff(line_starts), 1)
    kept = np.unique(line_of * (len(line) + 1) + line) // (len(line) + 1)
    stops = np.diff(np.concatenate([[0], np.cumsum((data == 46) | (data == 33) | (data == 63))])[edge])
    out += [np.log1p(count), share(length[code]), share(same), np.bincount(text_of, minlength=n) / some ** 0.9,
            most / some, by_word(r"^[A-Z][^a-z]*[A-Z][^a-z]*$"), by_word(r"[#$%&*|!]"), share(length[code] > 20),
            np.log1p(count / n_lines), 1 - np.bincount(kept, minlength=n) / n_lines, np.log1p(count / (stops + 1))]
    return np.where(size[:, None] > 0, np.column_stack(out), 0.0)


def random_features(x: np.ndarray, model: dict) -> np.ndarray:
    """Cosines whose inner products approximate a Gaussian kernel of standardized statistics."""
    z = np.clip((x - model["mean"]) / model["deviation"], -12, 12)
    return np.cos(z @ model["directions"] + model["shifts"]) * np.sqrt(2 / len(model["shifts"]))


def rising(weight: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The rising step function nearest to the means ``total / weight`` (squared, weighted), by pooling adjacent
    violators, drawn as a line from pool to pool, so that scores keep their order."""
    pools: list[list[float]] = []  # weight, total, weighted place
    for place in np.flatnonzero(weight).tolist():
        pools.append([weight[place], total[place], weight[place] * place])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last)]
    w, t, place = np.array(pools).T
    return np.interp(np.arange(len(weight)), place / w, t / w)


def _sums(of):
    """Each partition's sum of the vectors that ``of`` makes of its batches ``(x, y)``, a row for each ``SLICE`` of it."""
    def run(batches):
        total = None
        for batch in batches:
            made = of(_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False))
            total = made if total is None else total + made
        if total is not None:
            part = TaskContext.get().partitionId()
            cut = range(0, len(total), SLICE)
            yield pa.RecordBatch.from_pydict({"part": pa.array([part] * len(cut), pa.int64()),
                                              "slice": pa.array([a // SLICE for a in cut], pa.int64()),
                                              "sums": pa.array([total[a:a + SLICE].tobytes() for a in cut], pa.binary())})
    return run


def _summed(rows: DataFrame, of, size: int) -> np.ndarray:
    """The sum over all rows ``x, y`` of the vectors of ``of``, slices by themselves, in rounds of ``FAN_IN``."""
    schema, n = "part long, slice long, sums binary", rows.rdd.getNumPartitions()

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x) for x in table["sums"].to_pylist())
        return pa.table({"part": pa.array([table["part"][0].as_py() // FAN_IN], pa.int64()),
                         "slice": table["slice"][:1], "sums": pa.array([total.tobytes()], pa.binary())})

    parts = rows.mapInArrow(_sums(of), schema)
    while n > 1:
        parts = (parts.withColumn("group", F.floor(F.col("part") / FAN_IN))
                 .groupBy("group", "slice").applyInArrow(add, schema))
        n = -(-n // FAN_IN)
    total = np.zeros(size)
    for r in parts.toLocalIterator():
        total[r.slice * SLICE:(r.slice + 1) * SLICE] += np.frombuffer(r.sums)
    return total


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``x`` (float64 statistics of the whole text, as bytes), one row per input row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in chain.from_iterable(portions(b, 1, BATCH_BYTES) for b in batches):
            x = statistics(as_array(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())],
                                             names=["doc_id", "x"])
    return rows.mapInArrow(run, "doc_id long, x binary")


def _matrix(column) -> np.ndarray:
    data = as_array(column).to_pylist()
    return np.frombuffer(b"".join(data)).reshape(len(data), len(STATISTICS))


def train(rows: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", label_col: str = "quality",
          features: int = FEATURES, width: float = WIDTH, penalty: float = PENALTY, seed: int = 0) -> dict:
    """Fit to ``rows`` (from ``measured``) where ``training`` (over their ``doc_id``) holds and ``labels`` has a label
    0 or 1 for the id.  All labelled rows count; an id with several labels counts with their mean,
    a row with a null id not at all.  Three quarters, by a hash of the statistics, fit the weights, the rest the
    calibration.  Without labelled rows every score is 1."""
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.avg(label_col).alias("y")))
    rows = cut_lineage(rows.where(training).join(known, "doc_id")
                       .select("x", "y", (F.pmod(F.xxhash64("x"), F.lit(4)) == 0).alias("calibrates")))
    d = len(STATISTICS)

    def moments(x, y):
        return np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0), [y.sum()]])

    every, fits = rows.select("x", "y"), rows.where(~F.col("calibrates")).select("x", "y")
    total = _summed(every, moments, 2 * d + 2)
    n = total[0]
    if not n:
        return {"steps": np.ones(STEPS), "weights": None}
    mean = total[1:d + 1] / n
    deviation = np.sqrt(np.maximum(total[d + 1:2 * d + 1] / n - mean ** 2, 0))
    rng = np.random.default_rng(seed)
    model = {"mean": mean, "deviation": np.maximum(deviation, 1e-3), "base": total[-1] / n,
             "directions": rng.normal(size=(d, features)) / width, "shifts": rng.uniform(0, 2 * np.pi, features)}

    def normal(x, y):
        z = random_features(x, model)
        return np.concatenate([(z.T @ z).ravel(), z.T @ (y - model["base"]), [len(z)]])

    total = _summed(fits, normal, features * features + features + 1)
    left = total[:features * features].reshape(features, features) + (penalty * total[-1] + 1e-9) * np.eye(features)
    model["weights"] = np.linalg.solve(left, total[features * features:-1])

    def histogram(x, y):
        at = step_of(raw(x, model))
        return np.concatenate([np.bincount(at, minlength=STEPS), np.bincount(at, weights=y, minlength=STEPS)])

    held = rows.where(F.col("calibrates")).select("x", "y")
    total = _summed(held, histogram, 2 * STEPS)
    if not total[:STEPS].any():  # too few rows to hold any back
        total = _summed(every, histogram, 2 * STEPS)
    model["steps"] = rising(total[:STEPS], total[STEPS:])
    return model


def raw(x: np.ndarray, model: dict) -> np.ndarray:
    """The ridge score; far from all labelled rows it falls back to their mean label."""
    return model["base"] + random_features(x, model) @ model["weights"]


def step_of(score: np.ndarray) -> np.ndarray:
    """Bin of a raw score; the bins cover -0.5 to 1.5."""
    return np.clip((score + 0.5) / 2 * STEPS, 0, STEPS - 1).astype(np.int64)


def scores(x: np.ndarray, model: dict) -> np.ndarray:
    return model["steps"][step_of(raw(x, model))] if model["weights"] is not None else np.ones(len(x))


def score(rows: DataFrame, model: dict) -> DataFrame:
    """``doc_id, score`` (0 to 1) of each row of ``measured``: null and empty texts too, rows with equal ids
    each by itself; an empty table gives an empty result."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores(_matrix(batch.column(1)), shared.value), pa.float64())],
                names=["doc_id", "score"])
    return rows.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")
