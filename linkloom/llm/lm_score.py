"""LM scoring: logistic context mixing over bits.

A text is scored as its words with A-Z lower-cased, joined by one space.  The
model reads these UTF-8 bytes and a closing zero byte bit by bit, the highest
bit first.  One predictor per context length (1 to 4 bytes) looks up, in
a hashed table, how often a zero and a one followed this context and the byte's
bits so far; the tables count all training texts.  A mixer adds the
predictors' logits with weights from a set that is gated by the bit's place
and by how much the two longest contexts have seen, and a final map refines its
probability by the byte's bits so far.  Mixer and map learn online from every place of every training text, whose own
bits are taken out of the counts.  A byte's probability depends on the four bytes before it alone, so each distinct
group of five bytes is scored once per slice of text, and places with the same five bytes are learned together: the
corpus is counted by these codes, and a code that is more frequent than the mean is learned in several portions, which
makes at most twice as many portions as codes.  The portions are dealt into groups, each group's mixer learns in a task
of its own, and the mixers are averaged by the places they saw.

For the unigram word model chunks ask the corpus about their distinct words.  Its
exact counts also have a fixed share in the score: a word's probability is
``SHARE`` of its frequency and the rest of what the bits say.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import (bucket_of, chunk_count, dealt, edges_of, id_or_null, ids_of, mix, owner,
                     received, split_words, squeeze, unsqueeze, word_hashes)

#: Table size (as a power of two) of each context length.
BITS = (16, 19, 20, 22)
#: Slots of the tables in one shard.
SHARD = 1 << 17
#: Shards of counts added up in one task.
FAN_IN = 64
#: Portions of places of one group, so of one mixer.
GROUP = 1 << 20
#: Training places whose codes one task adds up, and distinct codes that a scan task holds.
PLACES, HELD = 32 << 20, 4 << 20
#: Share of whole-word frequencies in a word's probability.
SHARE = 0.25
#: Bytes of text in a chunk, and positions scored at once.
CHUNK, SLICE = 8 << 20, 2 << 20
_ORDERS = len(BITS)
_SLOTS = sum(1 << b for b in BITS)
_RATE, _MAP_RATE, _BATCH = 0.1, 0.05, 512


def held_out(ids: np.ndarray, modulus: int = 7, remainder: int = 2) -> np.ndarray:
    """Whether crc32 of the id as text leaves the remainder (a null id: no)."""
    return np.array([zlib.crc32(str(i).encode()) % modulus == remainder for i in ids.tolist()], bool)


def layout(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes as they are scored, each text closed by its end byte
    and three zeros of padding, after four zeros; and where each text begins."""
    data = [b" ".join((t or "").encode().lower().split()) for t in texts]
    buffer = np.frombuffer(b"\0" * 4 + b"".join(d + b"\0" * 4 for d in data), np.uint8)
    sizes = np.array([len(d) + 4 for d in data], np.int64)
    return buffer, 4 + np.cumsum(sizes) - sizes


def codes(buffer: np.ndarray, begin: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Scored places among ``first..last`` and the five bytes that end there."""
    at = np.arange(first, last)
    of = np.searchsorted(begin, at, side="right") - 1
    stop = np.append(begin[1:], len(buffer)) - 3  # after the end byte
    at = at[(of >= 0) & (at < stop[of])]
    return at, code_at(buffer, at)


def code_at(buffer: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The five bytes that end at each place."""
    code = np.zeros(len(at), np.uint64)
    for k in range(4, -1, -1):
        code = (code << np.uint64(8)) | buffer[at - k]
    return code


def spread_places(buffer: np.ndarray, begin: np.ndarray, ids: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Places at even distances in every text, ``rate`` of its scored places on average, and a number drawn for
    each.  They depend on the text and its id alone, not on the texts beside it.  For trials: the model learns from all
    places and does not use it."""
    stop = np.append(begin[1:], len(buffer)) - 3
    crc = np.array([zlib.crc32(buffer[b:e]) for b, e in zip(begin, stop)], np.uint64)
    seed = mix(crc + mix(ids.astype(np.uint64)))
    start = (seed >> np.uint64(11)).astype(float) * 2.0 ** -53
    size = stop - begin
    n = np.minimum(np.floor(size * rate + start).astype(np.int64), size)
    of = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    place = np.minimum(((place + start[of]) * size[of] / n[of]).astype(np.int64), size[of] - 1)
    return begin[of] + place, mix(seed[of] + place.astype(np.uint64))


def distinct(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    coded = pa.array(code).dictionary_encode()
    return coded.dictionary.to_numpy(), coded.indices.to_numpy()


def slots(code: np.ndarray, order: int, prefix: np.ndarray) -> np.ndarray:
    """Table slot of a context of ``order`` bytes and the byte's bits so far."""
    context = (code >> np.uint64(8)) & np.uint64((1 << 8 * order) - 1)
    base = sum(1 << b for b in BITS[:order - 1])
    node = (context << np.uint64(8)) | prefix.astype(np.uint64)
    if 8 * order + 8 <= BITS[order - 1]:
        return node.astype(np.int64) + base
    return (mix(node + np.uint64(order)) >> np.uint64(64 - BITS[order - 1])).astype(np.int64) + base


def count_bits(code: np.ndarray, times: np.ndarray, counts: np.ndarray) -> None:
    """Add the bits of each code's last byte to ``counts (2, slots)``."""
    byte = (code & np.uint64(255)).astype(np.int64)
    for j in range(8):
        prefix, bit = (1 << j) | (byte >> (8 - j)), (byte >> (7 - j)) & 1
        for order in range(1, _ORDERS + 1):
            np.add.at(counts, (bit, slots(code, order, prefix)), times)


class Mixer:
    """Weights of the mixer and the final map."""

    def __init__(self, state: dict | None = None):
        state = state or {}
        self.weights = state.get("weights", np.full((8 * 25, _ORDERS + 1), 0.3))
        grid = np.linspace(-8, 8, 33)
        self.map = state.get("map", np.tile(1 / (1 + np.exp(-grid)), (256, 1)))

    def state(self) -> dict:
        return {"weights": self.weights, "map": self.map}

    def bit(self, counts: np.ndarray, code: np.ndarray, j: int, own: int,
            times: np.ndarray | None = None) -> np.ndarray:
        """Probability of the code's actual bit ``j``; with ``own`` its own
        occurrence is taken out of the counts.  With ``times`` mixer and map learn from so many occurrences of each."""
        byte = (code & np.uint64(255)).astype(np.int64)
        prefix, bit = (1 << j) | (byte >> (8 - j)), (byte >> (7 - j)) & 1
        inputs, seen = np.empty((len(code), _ORDERS + 1)), []
        for order in range(1, _ORDERS + 1):
            at = slots(code, order, prefix)
            zero, one = counts[0][at].astype(float), counts[1][at].astype(float)
            if own:
                zero, one = np.maximum(zero - (bit == 0), 0), np.maximum(one - bit, 0)
            inputs[:, order - 1] = np.log((one + 0.3) / (zero + 0.3))
            seen.append(zero + one)
        np.clip(inputs, -8, 8, out=inputs)
        inputs[:, _ORDERS] = 0.3
        gate = [np.digitize(s, (1, 4, 16, 128)) for s in seen[-2:]]
        chosen = 25 * j + 5 * gate[0] + gate[1]
        w = self.weights[chosen]
        logit = np.clip((w * inputs).sum(axis=1), -8, 7.999)
        p = 1 / (1 + np.exp(-logit))
        place = (logit + 8) * 2
        low = place.astype(np.int64)
        part = place - low
        mapped = self.map[prefix, low] * (1 - part) + self.map[prefix, low + 1] * part
        if times is not None:
            step = np.zeros_like(self.weights)
            np.add.at(step, chosen, (times * (bit - p))[:, None] * inputs)
            seen_ = np.bincount(chosen, weights=times, minlength=len(step))[:, None]
            self.weights += _RATE * step / np.maximum(seen_, 16)
            step, seen_ = np.zeros_like(self.map), np.zeros_like(self.map)
            for column, share in ((low, 1 - part), (low + 1, part)):
                np.add.at(step, (prefix, column), times * share * (bit - mapped))
                np.add.at(seen_, (prefix, column), times * share)
            self.map += _MAP_RATE * step / np.maximum(seen_, 16)
            np.clip(self.map, 1e-4, 1 - 1e-4, out=self.map)
        p = np.clip((p + mapped) / 2, 1e-6, 1 - 1e-6)
        return np.where(bit == 1, p, 1 - p)

    def learn(self, counts: np.ndarray, code: np.ndarray, times: np.ndarray | None = None) -> None:
        times = np.ones(len(code)) if times is None else times.astype(float)
        for i in range(0, len(code), _BATCH):
            for j in range(8):
                self.bit(counts, code[i:i + _BATCH], j, own=1, times=times[i:i + _BATCH])

    def log10(self, counts: np.ndarray, code: np.ndarray) -> np.ndarray:
        """log10 probability of each code's last byte after the others."""
        return sum(np.log10(self.bit(counts, code, j, own=0)) for j in range(8))


def word_logs(mixer: Mixer, counts: np.ndarray, texts: list[str | None], sizes: np.ndarray) -> np.ndarray:
    """log10 probability of each word of the texts together with the space or
    end after it (in an empty text: of the end).  ``sizes``: their bytes."""
    buffer, begin = layout(texts)
    stop, done, out = np.cumsum(sizes), 0, np.zeros(len(sizes))
    for first in range(4, len(buffer), SLICE):
        _, code = codes(buffer, begin, first, min(first + SLICE, len(buffer)))
        if len(code):
            each, index = distinct(code)
            of = np.searchsorted(stop, np.arange(done, done + len(code)), side="right")
            part = np.bincount(of - of[0], weights=mixer.log10(counts, each)[index])
            out[of[0]:of[0] + len(part)] += part
            done += len(code)
    return out


def _added(code: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and how often each occurs."""
    order = np.argsort(code, kind="stable")
    code = code[order]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))[:len(code)]
    return code[first], np.add.reduceat(times[order], first) if len(first) else times


def _places(rows: DataFrame, places: int) -> DataFrame:
    """All training places of ``rows (id, text)``, of which there are about so many, by their codes: ``bucket, code,
    times, n`` with ``n`` distinct codes of the whole corpus and how often each occurs."""
    buckets = max(1, -(-places // PLACES))
    schema = "bucket int, code binary, times binary, n int"

    def packets(code: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
        bucket = bucket_of(mix(code), buckets)
        order = np.argsort(bucket, kind="stable")
        edges = edges_of(bucket[order], buckets)
        full = np.flatnonzero(np.diff(edges))
        cut = [order[edges[x]:edges[x + 1]] for x in full]
        return pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array([squeeze(code[c].astype(np.int64)) for c in cut], pa.binary()),
             pa.array([squeeze(times[c]) for c in cut], pa.binary()), pa.array([len(c) for c in cut], pa.int32())],
            names=["bucket", "code", "times", "n"])

    def count(batches):
        held: list = []

        def drained():
            code, times = _added(*(np.concatenate(x) for x in zip(*held)))
            held.clear()
            return code, times

        for batch in batches:
            learn = ~held_out(ids_of(batch.column(0)))
            buffer, begin = layout(batch.column(1).filter(pa.array(learn)).to_pylist())
            for first in range(4, len(buffer), SLICE):
                _, code = codes(buffer, begin, first, min(first + SLICE, len(buffer)))
                if len(code):
                    each, index = distinct(code)
                    held.append((each, np.bincount(index)))
                if sum(len(c) for c, _ in held) > HELD:
                    held.append(drained())
                    if len(held[0][0]) > HELD // 2:
                        yield packets(*drained())
        if held:
            yield packets(*drained())

    def add(table: pa.Table) -> pa.Table:
        n = table["n"].to_pylist()
        code, times = _added(*(np.concatenate([unsqueeze(x, k) for x, k in zip(table[c].to_pylist(), n)])
                               for c in ("code", "times")))
        return pa.table({"bucket": table["bucket"][:1], "code": pa.array([squeeze(code)], pa.binary()),
                         "times": pa.array([squeeze(times)], pa.binary()), "n": pa.array([len(code)], pa.int32())})

    return cut_lineage(rows.mapInArrow(count, schema).groupBy("bucket").applyInArrow(add, schema))


def _codes_of(batch) -> list[tuple[np.ndarray, np.ndarray]]:
    """Codes and times of each row of ``_places``."""
    return [(unsqueeze(c, n).astype(np.uint64), unsqueeze(t, n)) for c, t, n in
            zip(*(batch.column(x).to_pylist() for x in (1, 2, 3)))]


def _training_places(rows: DataFrame) -> int:
    """Bytes of the training texts of ``rows (id, text)``, and an end each."""
    learning = F.coalesce(F.crc32(F.col("id").cast("string")) % 7 != 2, F.lit(True))
    return rows.where(learning).agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(1))).first()[0] or 0


def _tables(rows: DataFrame, placed: DataFrame | None = None) -> np.ndarray:
    """Counts of all training texts of ``rows (id, text)``, or of their ``_places``, added up in rounds of
    ``FAN_IN`` tasks; their size is fixed by ``BITS``."""
    placed = _places(rows, _training_places(rows)) if placed is None else placed
    schema = "part long, shard int, slot binary, zero binary, one binary, n int"

    def rows_of(part: int, counts: np.ndarray) -> pa.Table:
        at = np.flatnonzero(counts.any(axis=0))
        edges = np.searchsorted(at, np.arange(0, counts.shape[1] + SHARD, SHARD))
        full = np.flatnonzero(np.diff(edges))
        cut = [at[edges[s]:edges[s + 1]] for s in full]
        return pa.table({
            "part": pa.array([part] * len(full), pa.int64()), "shard": pa.array(full, pa.int32()),
            "slot": pa.array([squeeze(c) for c in cut], pa.binary()),
            "zero": pa.array([squeeze(counts[0][c]) for c in cut], pa.binary()),
            "one": pa.array([squeeze(counts[1][c]) for c in cut], pa.binary()),
            "n": pa.array([len(c) for c in cut], pa.int32())})

    def gather(batches):
        counts = np.zeros((2, _SLOTS), np.int64)
        for batch in batches:
            for code, times in _codes_of(batch):
                for first in range(0, len(code), SLICE):
                    count_bits(code[first:first + SLICE], times[first:first + SLICE], counts)
        yield from rows_of(TaskContext.get().partitionId(), counts).to_batches()

    def add(table: pa.Table) -> pa.Table:
        counts, shard = np.zeros((2, SHARD), np.int64), table["shard"][0].as_py()
        for slot, zero, one, n in zip(*(table[c].to_pylist() for c in ("slot", "zero", "one", "n"))):
            at = unsqueeze(slot, n) - shard * SHARD
            counts[0][at] += unsqueeze(zero, n)
            counts[1][at] += unsqueeze(one, n)
        at = np.flatnonzero(counts.any(axis=0))
        return pa.table({
            "part": pa.array([table["part"][0].as_py() // FAN_IN], pa.int64()), "shard": pa.array([shard], pa.int32()),
            "slot": pa.array([squeeze(at + shard * SHARD)], pa.binary()),
            "zero": pa.array([squeeze(counts[0][at])], pa.binary()),
            "one": pa.array([squeeze(counts[1][at])], pa.binary()), "n": pa.array([len(at)], pa.int32())})

    made, parts = placed.mapInArrow(gather, schema), placed.rdd.getNumPartitions()
    while parts > 1:
        made = (made.withColumn("group", F.floor(F.col("part") / FAN_IN))
                .groupBy("shard", "group").applyInArrow(add, schema))
        parts = -(-parts // FAN_IN)
    counts = np.zeros((2, _SLOTS), np.int64)
    for r in made.toLocalIterator():
        at = unsqueeze(r.slot, r.n)
        counts[0][at] += unsqueeze(r.zero, r.n)
        counts[1][at] += unsqueeze(r.one, r.n)
    # large counts are scaled down to 16 bits together, none to zero
    scale = np.maximum(1, -(-counts.max(axis=0) // 65_535))
    return (-(-counts // scale)).astype(np.uint16)


def _fitted(rows: DataFrame, counts, places: int, placed: DataFrame | None = None) -> dict:
    """The mixer learned from every training place of ``rows (id, text)``, of which there are about so many, or of their
    ``_places``; ``counts`` is a broadcast."""
    placed = _places(rows, places) if placed is None else placed
    n_codes = placed.agg(F.sum("n")).first()[0] or 0
    portion = max(1, places // max(n_codes, 1))
    groups = max(1, -(-2 * n_codes // GROUP))
    blank = Mixer().state()

    def deal(batches):
        for batch in batches:
            for code, times in _codes_of(batch):
                parts = -(-times // portion)
                of = np.repeat(np.arange(len(code)), parts)
                nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
                share = times[of] // parts[of] + (nth < times[of] % parts[of])
                drawn = mix(mix(code[of]) + nth.astype(np.uint64))
                group = (drawn % np.uint64(groups)).astype(np.int64)
                order = np.argsort(group, kind="stable")
                edges = np.searchsorted(group[order], np.arange(groups + 1))
                full = np.flatnonzero(np.diff(edges))
                cut = [order[edges[g]:edges[g + 1]] for g in full]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int64()), *(pa.array([x[c].tobytes() for c in cut], pa.binary())
                                                   for x in (code[of], share, drawn))],
                    names=["part", "code", "times", "drawn"])

    schema = "part long, n long, weights binary, map binary"

    def row(part: int, n: int, state: dict) -> pa.Table:
        return pa.table({"part": pa.array([part], pa.int64()), "n": pa.array([n], pa.int64()),
                         **{k: pa.array([v.tobytes()], pa.binary()) for k, v in state.items()}})

    def fit(table: pa.Table) -> pa.Table:
        code, times, drawn = (np.frombuffer(b"".join(table[c].to_pylist()), kind) for c, kind in
                              (("code", np.uint64), ("times", np.int64), ("drawn", np.uint64)))
        order = np.lexsort((code, drawn))  # the order of learning does not depend on how rows arrive
        mixer = Mixer()
        mixer.learn(counts.value, code[order], times[order])
        return row(table["part"][0].as_py(), int(times.sum()), mixer.state())

    def average(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        n = table["n"].to_numpy().astype(float)
        state = {k: sum(w * np.frombuffer(x).reshape(v.shape) for w, x in zip(n, table[k].to_pylist())) / n.sum()
                 for k, v in blank.items()}
        return row(table["part"][0].as_py() // FAN_IN, int(n.sum()), state)

    made = placed.mapInArrow(deal, "part long, code binary, times binary, drawn binary").groupBy("part").applyInArrow(fit, schema)
    while groups > 1:
        made = made.groupBy(F.floor(F.col("part") / FAN_IN).alias("group")).applyInArrow(average, schema)
        groups = -(-groups // FAN_IN)
    got = made.select(*blank).collect()
    return {k: np.frombuffer(got[0][k]).reshape(v.shape) for k, v in blank.items()} if got else blank


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score each whole text by two models learned from the rows whose
    crc32(id as text) mod 7 is not 2.

    Returns one row per input row: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score`` (add-one unigram words, A-Z lower-cased, words
    ``[^\\x20\\x09-\\x0D]+`` and one end), ``score`` (log10 probability under the
    mixing model of the same words, joined by one space, and the end),
    ``n_bytes`` (of these) and ``bits_per_byte``.  Null text: empty, which is an end alone.  A row with a
    null id is a training row; rows with equal ids each count.  Without
    training rows the base score is 0.  Other columns are ignored; an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    n = chunk_count(docs, text_col, each=CHUNK)
    flat = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = dealt(docs, id_col, text_col, n)

    def words_of(texts: pa.Array):
        """Distinct words in the order asked, each word's place among these."""
        words, starts = split_words(pc.ascii_lower(texts))
        coded = words.dictionary_encode()
        hashes = word_hashes(coded.dictionary)
        order = np.lexsort((hashes[:, 1], hashes[:, 0]))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        a, b = hashes[order, 0], (hashes[order, 1] >> np.uint64(32)).astype(np.uint32)
        return (starts, place[coded.indices.to_numpy()], a, b, edges_of(bucket_of(a, n), n),
                pc.binary_length(words).to_numpy(zero_copy_only=False))

    def ask(table: pa.Table) -> pa.Table:
        ids, texts = received(table)
        starts, place, a, b, edges, _ = words_of(texts)
        learn = ~held_out(ids)
        count = np.bincount(place[learn[owner(starts)]], minlength=len(a))
        full = np.flatnonzero(np.diff(edges))
        cut = [slice(edges[x], edges[x + 1]) for x in full]
        return pa.table({
            "chunk": pa.array([table["chunk"][0].as_py()] * len(full), pa.int32()),
            "bucket": pa.array(full, pa.int32()),
            "a": pa.array([a[c].tobytes() for c in cut], pa.binary()),
            "b": pa.array([b[c].tobytes() for c in cut], pa.binary()),
            "n": pa.array([squeeze(count[c]) for c in cut], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        a = [np.frombuffer(x, np.uint64) for x in table["a"].to_pylist()]
        count = np.concatenate([unsqueeze(x, len(y)) for x, y in zip(table["n"].to_pylist(), a)])
        edges = np.cumsum([0, *map(len, a)])
        a = np.concatenate(a)
        b = np.concatenate([np.frombuffer(x, np.uint32) for x in table["b"].to_pylist()])
        order = np.lexsort((b, a))
        new = np.ones(len(a), bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        key = np.empty(len(a), np.int64)
        key[order] = np.cumsum(new) - 1
        total = np.bincount(key, weights=count).astype(np.int64)
        said = [squeeze(total[key[x:y]]) for x, y in zip(edges, edges[1:])]
        only = np.arange(len(said)) == 0
        return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "answer": pa.array(said, pa.binary()),
                         "tokens": pa.array(only * int(total.sum()), pa.int64()),
                         "words": pa.array(only * int((total > 0).sum()), pa.int64())})

    answers = cut_lineage(
        rows.applyInArrow(ask, "chunk int, bucket int, a binary, b binary, n binary").groupBy("bucket")
        .applyInArrow(answer, "chunk int, bucket int, answer binary, tokens long, words long"))
    learning = F.coalesce(F.crc32(F.col("id").cast("string")) % 7 != 2, F.lit(True))
    ends, size = flat.where(learning).agg(
        F.count(F.lit(1)), F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(1))).first()
    tokens, words = (x or 0 for x in answers.agg(F.sum("tokens"), F.sum("words")).first())
    tokens, words = tokens + ends, words + (ends > 0)
    end_share = min(max(ends / max(tokens - ends, 1), 1e-9), 0.5)

    placed = _places(flat, size or 0)
    counts = spark.sparkContext.broadcast(_tables(flat, placed))

    shared = spark.sparkContext.broadcast(_fitted(flat, counts, size or 0, placed))

    def finish(table: pa.Table, said: pa.Table) -> pa.Table:
        ids, texts = received(table)
        starts, place, a, _, edges, word_size = words_of(texts)
        seen = np.zeros(len(a), np.int64)
        for b, data in zip(said["bucket"].to_pylist(), said["answer"].to_pylist()):
            seen[edges[b]:edges[b + 1]] = unsqueeze(data, edges[b + 1] - edges[b])
        of, rows_ = owner(starts), len(ids)
        n_tokens = np.diff(starts) + 1
        known = np.bincount(of, weights=seen[place] > 0, minlength=rows_).astype(np.int64) + (ends > 0)
        logs = np.bincount(of, weights=np.log10(seen + 1.0)[place], minlength=rows_)
        base = logs + np.log10(ends + 1.0) - n_tokens * np.log10(tokens + words + 1.0)
        # an empty text has one place, for its end; else the end goes with the last word
        none = np.flatnonzero(n_tokens == 1)
        sizes = np.insert(word_size, starts[none], 0) + 1
        count = np.insert(seen[place], starts[none], 0)
        text_of = np.sort(np.concatenate([of, none]))
        logs = word_logs(Mixer(shared.value), counts.value, texts.to_pylist(), sizes)
        last = np.append(text_of[1:] != text_of[:-1], True)
        follows = np.where(last, end_share, 1 - end_share)
        with np.errstate(divide="ignore"):
            whole = np.log(SHARE * count / max(tokens - ends, 1) * follows)
        logs = np.logaddexp(whole, logs * np.log(10) + np.log(1 - SHARE)) / np.log(10)
        total = np.bincount(text_of, weights=logs, minlength=rows_)
        size = np.bincount(text_of, weights=sizes, minlength=rows_).astype(np.int64)
        return pa.table({
            "doc_id": id_or_null(ids), "held_out": pa.array(held_out(ids)), "n_tokens": pa.array(n_tokens, pa.int64()),
            "n_known": pa.array(known), "train_tokens": pa.array([tokens] * rows_, pa.int64()),
            "base_score": pa.array(base), "score": pa.array(total), "n_bytes": pa.array(size),
            "bits_per_byte": pa.array(-total * np.log2(10) / size)})

    return rows.cogroup(answers.select("chunk", "bucket", "answer").groupBy("chunk")).applyInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double, n_bytes long, bits_per_byte double")
