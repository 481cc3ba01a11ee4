"""Line dedup: a sharded minimal perfect hash over distinct line keys.

Every chunk of documents sends its distinct line keys (128-bit digests) to
shards of the key space.  A shard builds a minimal perfect hash over its
distinct keys, and with it compact arrays: a 32-bit fingerprint, the number of
documents and the smallest document id, each at the key's slot.  The chunks'
packed keys then probe these arrays; lines themselves are never joined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import (ASCII_SPACE, bucket_of, chunk_count, dealt, digests, edges_of, id_or_null,
                     mix, owner, pack_bits, received, replies_of, squeeze, unsqueeze)

#: Bits per key still without a slot, at each level of the hash.
SPACE = 1.5


def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64(0x9E3779B97F4A7C15 * (2 * level + 1) % 2**64)
    return (mix(mix(keys[:, 0] + seed) ^ keys[:, 1]) % np.uint64(size)).astype(np.int64)


def build_hash(keys: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Minimal perfect hash over distinct keys ``(n, 2) uint64``: on each
    level a key that has a bit to itself gets it, the others go on to the next
    level.  Returns the levels' sizes (multiples of 8) and all their bits."""
    sizes, bits = [], []
    while len(keys):
        sizes.append(8 * -(-int(SPACE * len(keys) + 64) // 8))
        slot = _slots(keys, len(sizes), sizes[-1])
        alone = np.bincount(slot, minlength=sizes[-1]) == 1
        bits.append(np.packbits(alone).tobytes())
        keys = keys[~alone[slot]]
    return np.array(sizes, np.int64), b"".join(bits)


def look_up(keys: np.ndarray, sizes: np.ndarray, bits: bytes) -> np.ndarray:
    """Slot of each key, 0 to n - 1 without gaps over the hash's own keys; -1
    for some of the keys that it wasn't built over."""
    taken = np.unpackbits(np.frombuffer(bits, np.uint8))
    rank = np.cumsum(taken, dtype=np.int64) - 1
    out, rest, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, size in enumerate(sizes, 1):
        slot = _slots(keys[rest], level, size) + base
        here = taken[slot] == 1
        out[rest[here]] = rank[slot[here]]
        rest, base = rest[~here], base + size
    return out


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys[:, 1]) >> np.uint64(32)).astype(np.uint32)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order by key, and which of the ordered are the first of theirs."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    new = np.ones(len(keys), bool)
    new[1:] = (keys[order][1:] != keys[order][:-1]).any(axis=1)
    return order, new


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 10) -> DataFrame:
    """Drop lines that an earlier document has too.

    A text is split at ``\\n``; null or empty text is one empty line.  A
    line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and
    with A-Z lower-cased.  Keys of at least ``min_chars`` code points found in
    two or more documents lose all their lines except in the smallest id that
    holds them (there all of them stay).  Returns one row per input row:
    ``doc_id, n_lines, n_dropped, kept_text``.  A null id counts as larger
    than any other; rows with equal ids count as one document.  Other columns
    are ignored, whatever their names; an empty table gives an empty result.
    """
    n = chunk_count(docs, text_col)
    rows = dealt(docs, id_col, text_col, n)

    def read(table: pa.Table):
        ids, texts = received(table)
        lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
        return ids, lists.flatten(), lists.offsets.to_numpy().astype(np.int64)

    def keyed(ids, lines, starts):
        """The chunk's distinct keys in the order asked, and for each line that
        has a key its place, its document and its key's place in that order."""
        trimmed = pc.ascii_lower(pc.utf8_trim(lines, characters=ASCII_SPACE))
        at = np.flatnonzero(pc.greater_equal(pc.utf8_length(trimmed), min_chars).to_numpy(zero_copy_only=False))
        coded = trimmed.take(pa.array(at)).dictionary_encode()
        hashes = digests(coded.dictionary)[coded.indices.to_numpy()] if len(at) else np.empty((0, 2), np.uint64)
        doc = ids[owner(starts)[at]]
        order, new = _distinct(hashes)
        key, doc = np.cumsum(new) - 1, doc[order]
        fresh = new.copy()  # also the first of its document
        fresh[1:] |= doc[1:] != doc[:-1]
        holders = np.bincount(key, weights=fresh).astype(np.int64)
        return hashes[order][new], doc[new], holders, at[order], doc, key

    def ask(table: pa.Table) -> pa.Table:
        keys, first, holders, *_ = keyed(*read(table))
        edges = edges_of(bucket_of(keys[:, 0], n), n)
        full = np.flatnonzero(np.diff(edges))
        cut = [slice(edges[x], edges[x + 1]) for x in full]
        return pa.table({
            "chunk": pa.array([table["chunk"][0].as_py()] * len(full), pa.int32()),
            "bucket": pa.array(full, pa.int32()),
            "keys": pa.array([keys[c].tobytes() for c in cut], pa.binary()),
            "first": pa.array([squeeze(first[c]) for c in cut], pa.binary()),
            "holders": pa.array([squeeze(holders[c]) for c in cut], pa.binary())})

    def asked_of(table: pa.Table):
        keys = [np.frombuffer(x, np.uint64).reshape(-1, 2) for x in table["keys"].to_pylist()]
        first = [unsqueeze(x, len(k)) for x, k in zip(table["first"].to_pylist(), keys)]
        return keys, first

    def index(table: pa.Table) -> pa.Table:
        keys, first = asked_of(table)
        holders = np.concatenate([unsqueeze(x, len(k)) for x, k in zip(table["holders"].to_pylist(), keys)])
        keys, first = np.concatenate(keys), np.concatenate(first)
        order, new = _distinct(keys)
        begin = np.flatnonzero(new)
        keys = keys[order][new]
        sizes, bits = build_hash(keys)
        slot = look_up(keys, sizes, bits)
        fingerprints, count = np.empty(len(keys), np.uint32), np.empty(len(keys), np.int64)
        least = np.empty(len(keys), np.int64)
        fingerprints[slot] = _fingerprint(keys)
        count[slot] = np.add.reduceat(holders[order], begin)
        least[slot] = np.minimum.reduceat(first[order], begin)
        return pa.table({
            "bucket": table["bucket"].slice(0, 1), "sizes": pa.array([sizes.tobytes()], pa.binary()),
            "bits": pa.array([bits], pa.binary()), "fingerprints": pa.array([fingerprints.tobytes()], pa.binary()),
            "count": pa.array([squeeze(count)], pa.binary()), "least": pa.array([squeeze(least)], pa.binary())})

    def probe(table: pa.Table, shard: pa.Table) -> pa.Table:
        keys, first = asked_of(table)
        sizes = np.frombuffer(shard["sizes"][0].as_py(), np.int64)
        bits = shard["bits"][0].as_py()
        fingerprints = np.frombuffer(shard["fingerprints"][0].as_py(), np.uint32)
        count = unsqueeze(shard["count"][0].as_py(), len(fingerprints))
        least = unsqueeze(shard["least"][0].as_py(), len(fingerprints))
        slot = look_up(np.concatenate(keys), sizes, bits)
        if not (fingerprints[slot] == _fingerprint(np.concatenate(keys))).all():
            raise ValueError("a line key is not in its shard's index")
        drop = (count[slot] > 1) & (least[slot] < np.concatenate(first))
        edges = np.cumsum([0, *map(len, keys)])
        return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "answer": pa.array(
            [pack_bits(drop[x:y]) for x, y in zip(edges, edges[1:])], pa.binary())})

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        ids, lines, starts = read(table)
        keys, first, _, at, doc, key = keyed(ids, lines, starts)
        later = replies_of(answers, edges_of(bucket_of(keys[:, 0], n), n))  # an earlier id in another chunk
        keep = np.ones(len(lines), bool)
        keep[at[(doc > first[key]) | later[key]]] = False
        before = np.concatenate([[0], np.cumsum(keep)])
        kept = pa.LargeListArray.from_arrays(before[starts], lines.filter(pa.array(keep)))
        return pa.table({"doc_id": id_or_null(ids), "n_lines": pa.array(np.diff(starts), pa.int64()),
                         "n_dropped": pa.array(np.diff(starts) - np.diff(before[starts]), pa.int64()),
                         "kept_text": pc.binary_join(kept, "\n").cast(pa.string())})

    asked = rows.applyInArrow(ask, "chunk int, bucket int, keys binary, first binary, holders binary")
    shards = asked.groupBy("bucket").applyInArrow(
        index, "bucket int, sizes binary, bits binary, fingerprints binary, count binary, least binary")
    answers = asked.groupBy("bucket").cogroup(shards.groupBy("bucket")).applyInArrow(
        probe, "chunk int, bucket int, answer binary")
    return rows.cogroup(answers.groupBy("chunk")).applyInArrow(
        finish, "doc_id long, n_lines long, n_dropped long, kept_text string")
