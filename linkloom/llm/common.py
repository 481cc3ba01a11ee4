"""Helpers of the operators that ask the whole corpus about hashed keys.

The shape is the same in each.  Rows are dealt into *chunks* by a hash of
their id (``CHUNK_BYTES`` of text each, so the number of chunks follows the
input).  A chunk sends each of its distinct keys once, packed per *bucket* of
the key space; a bucket sees all chunks' keys and sends one answer per key
back to the chunk that asked, in the order asked.  A key that a third of all
rows hold is one entry per chunk, so no hot key reaches a task more often
than there are chunks, and no row-sized record is exchanged per key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text in a chunk (bounds the memory of a Python task).
CHUNK_BYTES = 12 << 20
#: Id given to rows whose id is null: after every real id.
NO_ID = np.int64(2**63 - 1)
#: [\x20\x09-\x0D]
ASCII_SPACE = " \t\n\x0b\x0c\r"


def chunk_count(docs: DataFrame, *texts: str, each: int = CHUNK_BYTES) -> int:
    """How many chunks of ``each`` bytes the texts make, and at least one per core."""
    size = sum((F.coalesce(F.octet_length(F.col(t)), F.lit(0)) for t in texts), F.lit(0)).cast("long")
    total = docs.agg(F.sum(size)).first()[0] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-total // each))


def chunk_of(key: Column, chunks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(chunks)).cast("int")


def dealt(docs: DataFrame, id_col: str, text_col: str, chunks: int):
    """Ids and texts grouped by chunk.  A scan task sends one compressed packet per
    chunk and batch instead of a row per text, which halves the exchange."""
    rows = docs.select(chunk_of(F.col(id_col), chunks), F.col(id_col).cast("long").alias("id"),
                       F.col(text_col).cast("string").alias("text"))

    def send(batches):
        for batch in batches:
            chunk, body = batch.column(0).to_numpy(), pa.Table.from_batches([batch.select([1, 2])])
            order = np.argsort(chunk, kind="stable")
            numbers, begin = np.unique(chunk[order], return_index=True)
            packets = []
            for rows_ in np.split(order, begin[1:]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, body.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_table(body.take(pa.array(rows_)))
                packets.append(sink.getvalue().to_pybytes())
            if len(numbers):
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(packets, pa.binary())],
                                                 names=["chunk", "packet"])

    return rows.mapInArrow(send, "chunk int, packet binary").groupBy("chunk")


def received(table: pa.Table) -> tuple[np.ndarray, pa.Array]:
    """The ids and texts of a chunk, in the order of the ids."""
    body = pa.concat_tables([pa.ipc.open_stream(p.as_buffer()).read_all() for p in as_array(table["packet"])])
    ids = ids_of(body["id"])
    order = np.argsort(ids, kind="stable")
    return ids[order], as_array(body["text"].take(pa.array(order)))


def portions(batch: pa.RecordBatch, column: int, size: int = 6 << 20):
    """The batch in slices of rows whose strings in a column have ``size`` bytes, or one goes
    beyond."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin = np.unique(np.cumsum(lengths.astype(np.int64)) // size, return_index=True)[1].tolist()
    for a, b in zip(begin, begin[1:] + [batch.num_rows]):
        yield batch.slice(a, b - a)


def as_array(column) -> pa.Array:
    """One contiguous array of a table's column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return column


def ids_of(column) -> np.ndarray:
    return pc.fill_null(as_array(column).cast(pa.int64()), int(NO_ID)).to_numpy(zero_copy_only=False)


def id_or_null(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NO_ID)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of all texts in one array, and the
    place of each text's first word in it (with the end as last entry)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    starts = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(full)])
    return flat.filter(pa.array(full)), before[starts]


def digests(values: pa.Array) -> np.ndarray:
    """128-bit hashes of the strings, as two columns of uint64."""
    data = values.cast(pa.binary()).to_pylist()
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, data)), np.uint64).reshape(-1, 2)


def word_hashes(words: pa.Array) -> np.ndarray:
    """Two independent uint64 hashes of each word (each distinct word is
    hashed once)."""
    if not len(words):
        return np.empty((0, 2), np.uint64)
    coded = words.dictionary_encode()
    return digests(coded.dictionary)[coded.indices.to_numpy()]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of uint64 values (a bijection)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def window_hash(word: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words that start at each place."""
    acc = np.zeros(len(at), np.uint64)
    for j in range(length):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + word[at + j]
    return mix(acc)


def full_windows(starts: np.ndarray, length: int) -> np.ndarray:
    """Places at which ``length`` words of one text begin."""
    n = np.diff(starts)
    left = np.repeat(starts[1:], n) - np.arange(starts[-1])
    return np.flatnonzero(left >= length)


def owner(starts: np.ndarray) -> np.ndarray:
    """Index of the text that each word belongs to."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the upper 32 bits; ascending hashes have ascending buckets."""
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def edges_of(bucket: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in an array sorted by bucket."""
    return np.searchsorted(bucket, np.arange(buckets + 1, dtype=bucket.dtype))


def squeeze(values: np.ndarray) -> bytes:
    """int64 values, compressed as differences (small if sorted or even)."""
    return pa.compress(np.diff(values, prepend=np.int64(0)).tobytes(), "zstd", asbytes=True)


def unsqueeze(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(pa.decompress(data, 8 * n, "zstd", asbytes=True), np.int64))


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending distinct uint32 keys: lower halves as they are, upper halves
    in unary."""
    high = (keys >> 16).astype(np.int64)
    bits = np.zeros(len(keys) + 65536, np.uint8)
    bits[high + np.arange(len(keys))] = 1
    return (keys & 0xFFFF).astype(np.uint16).tobytes() + np.packbits(bits).tobytes()


def unpack_keys(data: bytes, n: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(data, np.uint8, offset=2 * n))
    high = np.flatnonzero(bits)[:n] - np.arange(n)
    return (high.astype(np.uint32) << np.uint32(16)) | np.frombuffer(data, np.uint16, n)


def pack_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def replies_of(table: pa.Table, edges: np.ndarray) -> np.ndarray:
    """Put the buckets' answers, one bit per key, in the order of the keys."""
    out = np.zeros(edges[-1], bool)
    for b, answer in zip(table["bucket"].to_pylist(), table["answer"].to_pylist()):
        out[edges[b]:edges[b + 1]] = unpack_bits(answer, edges[b + 1] - edges[b])
    return out


def join_words(words: pa.Array, starts: np.ndarray, keep: np.ndarray) -> list[str]:
    """Each text's kept words, joined by one space."""
    before = np.concatenate([[0], np.cumsum(keep)])
    lists = pa.LargeListArray.from_arrays(before[starts], words.filter(pa.array(keep)))
    return pc.binary_join(lists, " ").to_pylist()
