"""Substring dedup: level-wise doubling of repeated word windows.

A window of ``window`` words can only repeat if its first and last
``ceil(window / 2)`` words repeat.  The levels are the lengths got by halving
``window`` (13: 7 and 13).  At each level but the last a chunk asks about the
32-bit keys of its candidate windows, and only windows whose key came up
again are joined with their neighbour into windows of up to twice the
length.  A false agreement of two keys merely lets a candidate through: the
last level compares 96 bits and decides by document id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import (bucket_of, chunk_count, dealt, edges_of, full_windows, id_or_null,
                     join_words, owner, pack_bits, pack_keys, received, replies_of, split_words, squeeze, unpack_keys, unsqueeze, window_hash, word_hashes)

#: Shorter windows repeat by chance and would prune nothing.
SHORTEST = 6


def levels(window: int) -> list[int]:
    """Window lengths from the shortest level to the last."""
    out = [window]
    while out[0] > 2 * SHORTEST:
        out.insert(0, -(-out[0] // 2))
    return out


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = 13) -> DataFrame:
    """Remove each word covered by a window of ``window`` words whose word
    sequence also starts in a document with a smaller id.

    Words are ``[^\\x20\\x09-\\x0D]+``.  Windows are judged on the input.
    Returns one row per input row: ``doc_id, n_words, n_removed, kept_text``
    (kept words joined by one space).  Null or empty text: no words.  A null
    id counts as larger than any other; rows with equal ids never remove each
    other's words.  Other columns are ignored, whatever their names; an empty
    table gives an empty result.
    """
    lengths, n = levels(window), chunk_count(docs, text_col)
    last = len(lengths) - 1
    rows = dealt(docs, id_col, text_col, n)

    def read(table: pa.Table):
        ids, texts = received(table)
        words, starts = split_words(texts)
        return ids, words, starts, word_hashes(words)

    def candidates(starts, hashes, answers: pa.Table | None, level: int) -> np.ndarray:
        """Places where a candidate of the level begins."""
        alive = None
        for k in range(level + 1):
            at = full_windows(starts, lengths[k])
            if alive is not None:
                at = at[alive[at] & alive[at + (lengths[k] - lengths[k - 1])]]
            if k == level:
                return at
            keys, place, count, edges = short_keys(hashes, at, k)
            mine = answers.filter(pa.compute.equal(answers["level"], k))
            again = (count > 1) | replies_of(mine, edges)
            alive = np.zeros(starts[-1] + 1, bool)
            alive[at] = again[place]

    def short_keys(hashes, at, level):
        h = window_hash(hashes[:, 0], at, lengths[level])
        key = (bucket_of(h, n) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
        keys, place, count = np.unique(key, return_inverse=True, return_counts=True)
        return keys.astype(np.uint32), place, count, edges_of(keys >> np.uint64(32), n)

    def ask_short(level: int):
        def ask(table: pa.Table, answers: pa.Table | None) -> pa.Table:
            _, _, starts, hashes = read(table)
            at = candidates(starts, hashes, answers, level)
            keys, _, _, edges = short_keys(hashes, at, level)
            b = np.flatnonzero(np.diff(edges))
            return pa.table({
                "chunk": pa.array([table["chunk"][0].as_py()] * len(b), pa.int32()) if table.num_rows else pa.array([], pa.int32()),
                "bucket": pa.array(b, pa.int32()), "n": pa.array(np.diff(edges)[b], pa.int32()),
                "keys": pa.array([pack_keys(keys[edges[x]:edges[x + 1]]) for x in b], pa.binary())})
        return ask if level else lambda table: ask(table, None)

    def answer_short(level: int):
        def answer(table: pa.Table) -> pa.Table:
            asked = [unpack_keys(k, c) for k, c in zip(table["keys"].to_pylist(), table["n"].to_pylist())]
            keys, count = np.unique(np.concatenate(asked), return_counts=True)
            said = [pack_bits(count[np.searchsorted(keys, k)] > 1) for k in asked]
            return pa.table({"chunk": table["chunk"], "bucket": table["bucket"],
                             "level": pa.array([level] * len(said), pa.int32()),
                             "answer": pa.array(said, pa.binary())})
        return answer

    def long_keys(ids, starts, hashes, answers):
        """The distinct candidates of the last level: their bucket, hashes and
        first document in the order asked, and for each occurrence its place
        in the text, its document and its key's place in that order."""
        at = candidates(starts, hashes, answers, last)
        a = window_hash(hashes[:, 0], at, window)
        b = (window_hash(hashes[:, 1], at, window) >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((b, a))  # stable, so the first of equal keys has the smallest id
        a, b, doc = a[order], b[order], ids[owner(starts)[at[order]]]
        new = np.ones(len(at), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        key = np.cumsum(new) - 1
        a, b, first = a[new], b[new], doc[new]
        bucket = bucket_of(a, n)
        asked = np.lexsort((first, bucket))
        place = np.empty(len(asked), np.int64)
        place[asked] = np.arange(len(asked))
        return (edges_of(bucket[asked], n), a[asked], b[asked], first[asked],
                at[order], doc, place[key])

    def ask_long(table: pa.Table, answers: pa.Table | None) -> pa.Table:
        ids, _, starts, hashes = read(table)
        edges, a, b, first, *_ = long_keys(ids, starts, hashes, answers)
        full = np.flatnonzero(np.diff(edges))
        cut = [slice(edges[x], edges[x + 1]) for x in full]
        chunk = table["chunk"][0].as_py() if table.num_rows else 0
        return pa.table({
            "chunk": pa.array([chunk] * len(full), pa.int32()), "bucket": pa.array(full, pa.int32()),
            "a": pa.array([a[c].tobytes() for c in cut], pa.binary()),
            "b": pa.array([b[c].tobytes() for c in cut], pa.binary()),
            "first": pa.array([squeeze(first[c]) for c in cut], pa.binary())})

    def answer_long(table: pa.Table) -> pa.Table:
        a = [np.frombuffer(x, np.uint64) for x in table["a"].to_pylist()]
        first = np.concatenate([unsqueeze(x, len(y)) for x, y in zip(table["first"].to_pylist(), a)])
        edges = np.cumsum([0, *map(len, a)])
        a = np.concatenate(a)
        b = np.concatenate([np.frombuffer(x, np.uint32) for x in table["b"].to_pylist()])
        order = np.lexsort((first, b, a))
        new = np.ones(len(a), bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        least = np.empty(len(a), np.int64)
        least[order] = first[order][new][np.cumsum(new) - 1]
        earlier = least < first
        said = [pack_bits(earlier[x:y]) for x, y in zip(edges, edges[1:])]
        return pa.table({"chunk": table["chunk"], "bucket": table["bucket"],
                         "level": pa.array([last] * len(said), pa.int32()),
                         "answer": pa.array(said, pa.binary())})

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        ids, words, starts, hashes = read(table)
        edges, _, _, first, at, doc, place = long_keys(ids, starts, hashes, answers)
        final = answers.filter(pa.compute.equal(answers["level"], last))
        hit = at[(doc > first[place]) | replies_of(final, edges)[place]]
        change = np.zeros(starts[-1] + 1, np.int64)
        np.add.at(change, hit, 1)
        np.add.at(change, hit + window, -1)
        keep = np.cumsum(change)[:-1] == 0
        kept = np.concatenate([[0], np.cumsum(keep)])[starts]
        return pa.table({"doc_id": id_or_null(ids), "n_words": pa.array(np.diff(starts), pa.int64()),
                         "n_removed": pa.array(np.diff(starts) - np.diff(kept), pa.int64()),
                         "kept_text": pa.array(join_words(words, starts, keep), pa.string())})

    said, short = None, "chunk int, bucket int, n int, keys binary"
    for k in range(last):
        asked = (rows.applyInArrow(ask_short(0), short) if said is None
                 else rows.cogroup(said.groupBy("chunk")).applyInArrow(ask_short(k), short))
        more = asked.groupBy("bucket").applyInArrow(
            answer_short(k), "chunk int, bucket int, level int, answer binary")
        said = more if said is None else said.union(more)
    final = "chunk int, bucket int, a binary, b binary, first binary"
    asked = (rows.applyInArrow(lambda table: ask_long(table, None), final) if said is None
             else rows.cogroup(said.groupBy("chunk")).applyInArrow(ask_long, final))
    more = asked.groupBy("bucket").applyInArrow(
        answer_long, "chunk int, bucket int, level int, answer binary")
    said = more if said is None else said.union(more)
    return rows.cogroup(said.groupBy("chunk")).applyInArrow(
        finish, "doc_id long, n_words long, n_removed long, kept_text string")
