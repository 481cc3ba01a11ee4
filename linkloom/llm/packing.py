"""Packing: cost-balanced sequences.

A text's ids, with the end id, are cut into full sequences and a rest.  The
rests are dealt into groups by document id; in each group they go, in
descending order of cost, to the sequence of least cost so far that has room.
A piece's cost is linear in its length (dense layers) plus quadratic (attention
within the piece).  A group opens as many sequences as its ids need; a rest for
which none has enough room is cut where room ends, so a group's padding is
less than one sequence.
"""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, as_array, chunk_of, id_or_null, ids_of, portions
from .tokens import ByteTokens

#: Bytes of text encoded at once.
_SPLIT_BYTES = 2 << 20


class Encoder(ByteTokens):
    """Ids of whole texts by a tokenizer file, as little-endian uint32 bytes."""

    def ids(self, text: str) -> bytes:
        """By the tokenizer itself."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        return [x.astype("<u4").tobytes() for x in super().encode(texts)]


def cost(length, linear: float, quadratic: float):
    return linear * length + quadratic * length * length


def assign(lengths: np.ndarray, capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(item, start, length, sequence, offset)`` of the items, which
    are shorter than ``capacity``; ties keep the items' order."""
    count = -(-int(lengths.sum()) // capacity)
    room, paid = np.full(count, capacity), np.zeros(count)
    pieces: list[tuple[int, int, int, int, int]] = []

    def place(item: int, start: int, length: int, fits: np.ndarray) -> int:
        s = int(np.where(fits, paid, np.inf).argmin())
        part = min(length, int(room[s]))
        pieces.append((item, start, part, s, capacity - int(room[s])))
        room[s] -= part
        paid[s] += cost(part, linear, quadratic)
        return part

    cut: list[int] = []
    for item in np.argsort(-cost(lengths, linear, quadratic), kind="stable").tolist():
        fits = room >= lengths[item]
        if fits.any():
            place(item, 0, int(lengths[item]), fits)
        else:
            cut.append(item)
    for item in cut:  # no sequence has room for it whole
        start, length = 0, int(lengths[item])
        while start < length:
            start += place(item, start, length - start, room > 0)
    return pieces


def pack(docs: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = 1024, end_id: int = 0, linear: float = 1.0, quadratic: float = 1 / 1024,
         ids: bool = False) -> DataFrame:
    """Pack all texts into sequences of at most ``capacity`` tokens.

    ``tokenizer_json`` is the content of a tokenizer file.  A document is its
    text's ids, without special tokens, then ``end_id``; null or empty text:
    ``end_id`` alone.  Returns one row per piece: ``doc_id, start, length,
    ids_crc32`` (of the piece's ids as little-endian uint32), ``doc_tokens,
    sequence_id, offset``, and with ``ids`` the piece's ids as ``tokens
    array<int>``.  Each id of each input row is in exactly one piece.  A null id
    stays null; rows with equal ids are packed each by itself.  Other columns
    are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast({"json": tokenizer_json})
    # from the bytes alone, so that the sequences are the same on every cluster
    size = F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long")
    groups = max(1, -(-(docs.agg(F.sum(size)).first()[0] or 0) // CHUNK_BYTES))
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"),
                       chunk_of(F.col(id_col), groups).alias("part"))
    end = np.array([end_id], "<u4").tobytes()
    piece = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    made = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                      ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])

    def cut(batches):
        # the process keeps its copy of what is broadcast from task to task, and the encoder with it
        encoder = shared.value.setdefault("encoder", None) or Encoder(shared.value["json"])
        shared.value["encoder"] = encoder
        for portion in chain.from_iterable(portions(b, 1, _SPLIT_BYTES) for b in batches):
            out: list[tuple] = []
            coded = encoder.encode([t or "" for t in portion.column(1).to_pylist()])
            for id_, part, data in zip(portion.column(0).to_pylist(), portion.column(2).to_pylist(), coded):
                data += end
                n = len(data) // 4
                for start in range(0, n, capacity):
                    own = data[4 * start:4 * (start + capacity)]
                    size = len(own) // 4
                    # a full piece needs its ids no more, unless they are asked for
                    out.append((part, id_, start, size, zlib.crc32(own), n,
                                own if size < capacity or ids else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), made)], schema=made)

    def place(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        doc = ids_of(table["doc_id"])
        start, length, crc, total = (as_array(table[c]).to_numpy() for c in ("start", "length", "ids_crc32", "doc_tokens"))
        data = table["ids"].to_pylist()
        order = np.lexsort((crc, start, doc))
        full = order[length[order] == capacity]
        rest = order[length[order] < capacity]
        out = [(i, 0, capacity, s, 0) for s, i in enumerate(full.tolist())]
        out += [(int(rest[i]), a, n, s + len(full), o)
                for i, a, n, s, o in assign(length[rest], capacity, linear, quadratic)]
        at = np.array([x[0] for x in out], np.int64)
        sums = [int(crc[i]) if n == length[i] else zlib.crc32(data[i][4 * a:4 * (a + n)]) for i, a, n, _, _ in out]
        columns = {
            "doc_id": id_or_null(doc[at]), "start": pa.array(start[at] + [x[1] for x in out], pa.int64()),
            "length": pa.array([x[2] for x in out], pa.int64()), "ids_crc32": pa.array(sums, pa.int64()),
            "doc_tokens": pa.array(total[at], pa.int64()),
            "sequence_id": pa.array([(part << 32) + x[3] for x in out], pa.int64()),
            "offset": pa.array([x[4] for x in out], pa.int64())}
        if ids:
            columns["tokens"] = pa.array([np.frombuffer(data[i], "<u4")[a:a + n].astype(np.int32)
                                          for i, a, n, _, _ in out], pa.list_(pa.int32()))
        return pa.table(columns)

    return (rows.mapInArrow(cut, "part int, " + piece + ", ids binary").groupBy("part")
            .applyInArrow(place, piece + ", sequence_id long, offset long" + (", tokens array<int>" if ids else "")))
