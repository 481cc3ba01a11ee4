"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark.

Texts are normalised as bytes of their UTF-8 form: A-Z lower-cased, every
byte outside ``[0-9a-z\\x80-\\xFF]`` a space, runs of spaces one.  Each byte
keeps its place, so that hits map back to the original text.  The automaton's
patterns are the items' word windows with a space at both ends, and each text
is scanned once.  Benchmarks beyond ``BLOCK_BYTES`` are scanned in blocks of
items, one automaton each, so that what a task holds stays bounded.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_array

#: Bytes of benchmark text behind one automaton.
BLOCK_BYTES = 4 << 20
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
               for c in range(256))


def normalised(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_PLAIN).split()


def _windows(words: list[bytes], size: int) -> set[str]:
    if not words:
        return set()
    return {b" ".join([b"", *words[i:i + size], b""]).decode("latin-1")
            for i in range(max(1, len(words) - size + 1))}


def _automaton(items: list[tuple[str | None, str]], size: int):
    windows: dict[str, list] = {}
    for item, text in items:
        for w in _windows(normalised(text), size):
            windows.setdefault(w, []).append(item)
    found = ahocorasick.Automaton()
    for w, of in windows.items():
        found.add_word(w, (w.count(" ") - 1, of))
    if windows:
        found.make_automaton()
    return found if windows else None


def _scan(automaton, text: str | None):
    """Number of words, flags of the words hit, item ids found, and where each
    word starts and ends in the text (code points)."""
    raw = (text or "").encode()
    plain = np.frombuffer(raw.translate(_PLAIN), np.uint8)
    inside = np.concatenate([[False], plain != 32, [False]])
    begin = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    end = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    change = np.zeros(len(begin) + 1, np.int64)
    items: set[str] = set()
    if automaton is not None and len(begin):
        line = b" ".join([b"", *plain.tobytes().split(), b""])
        spaces = None
        for at, (n, of) in automaton.iter(line.decode("latin-1")):
            if spaces is None:
                spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
            stop = np.searchsorted(spaces, at)  # words before the closing space
            change[stop - n] += 1
            change[stop] -= 1
            items.update(of)
    hit = np.cumsum(change)[:-1] > 0
    return raw, begin, end, hit, items


def _spans(raw: bytes, begin, end, hit) -> list[dict]:
    """Runs of hit words as code point ranges of the original."""
    if not hit.any():
        return []
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [{"start": int(chars[begin[a]]), "end": int(chars[end[b]])} for a, b in zip(first, last)]


def _sorted(items: set) -> list:
    return sorted(x for x in items if x is not None) + [None] * (None in items)


def _blocks(items: DataFrame, item_col: str, text_col: str):
    """The items in blocks of bounded size, read through one partition at a time."""
    block, size = [], 0
    for item, text in items.select(F.col(item_col).cast("string"), F.col(text_col)).toLocalIterator():
        if not text:
            continue
        block.append((item, text))
        size += len(text)
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    yield block


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = 10,
                  keep_clean: bool = False) -> DataFrame:
    """Find the benchmark windows that occur in each document.

    A window is ``window`` consecutive words of an item; an item of fewer words,
    but not none, is one window.  Null or empty texts have no words; items with equal ids count as one, and
    so do those with a null id.
    Returns one row per input row: ``doc_id, n_words, n_hit, items``
    (sorted ids, a null last) and ``spans`` (``start, end`` in code points of the original
    text, of each run of words hit).  With ``keep_clean`` the input rows without
    a hit, with their own columns, whatever these are called.  An empty table
    gives an empty result; an empty benchmark hits nothing.
    """
    spark, out = docs.sparkSession, None
    shared = [spark.sparkContext.broadcast(b) for b in _blocks(items, item_col, item_text_col)]

    if keep_clean:
        place, schema = docs.columns.index(text_col), docs.schema
        clean = docs
        for block in shared:
            def drop(batches, block=block):
                automaton = _automaton(block.value, window)
                for batch in batches:
                    texts = batch.column(place).to_pylist()
                    keep = [not _scan(automaton, t)[3].any() for t in texts]
                    yield batch.filter(pa.array(keep, pa.bool_()))
            clean = clean.mapInArrow(drop, schema)
        return clean

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    span = "array<struct<start: int, end: int>>"
    if len(shared) == 1:
        block = shared[0]

        def scan(batches):
            automaton = _automaton(block.value, window)
            for batch in batches:
                got = [_scan(automaton, t) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array([len(g[1]) for g in got], pa.int64()),
                    pa.array([int(g[3].sum()) for g in got], pa.int64()),
                    pa.array([_sorted(g[4]) for g in got], pa.list_(pa.string())),
                    pa.array([_spans(*g[:4]) for g in got], pa.list_(pa.struct(
                        [("start", pa.int32()), ("end", pa.int32())])))],
                    names=["doc_id", "n_words", "n_hit", "items", "spans"])
        return rows.mapInArrow(scan, f"doc_id long, n_words long, n_hit long, items array<string>, spans {span}")

    # several blocks: each adds its hit words and items to the row, which stays where it is
    rows = rows.select("doc_id", "text", F.lit(None).cast("binary").alias("hit"),
                       F.expr("CAST(array() AS array<string>)").alias("items"))
    for block in shared:
        def add(batches, block=block):
            automaton = _automaton(block.value, window)
            for batch in batches:
                hits, found = [], []
                for text, hit, had in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                    *_, now, items = _scan(automaton, text)
                    if hit is not None:
                        now = now | np.unpackbits(np.frombuffer(hit, np.uint8), count=len(now)).astype(bool)
                    hits.append(np.packbits(now).tobytes())
                    found.append(_sorted(items | set(had)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(hits, pa.binary()),
                     pa.array(found, pa.list_(pa.string()))], names=["doc_id", "text", "hit", "items"])
        rows = rows.mapInArrow(add, "doc_id long, text string, hit binary, items array<string>")

    def close(batches):
        for batch in batches:
            got = []
            for text, hit in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw, begin, end, now, _ = _scan(None, text)
                now = np.unpackbits(np.frombuffer(hit, np.uint8), count=len(now)).astype(bool)
                got.append((len(now), int(now.sum()), _spans(raw, begin, end, now)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.int64()),
                 pa.array([g[1] for g in got], pa.int64()), as_array(batch.column(3)),
                 pa.array([g[2] for g in got], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                names=["doc_id", "n_words", "n_hit", "items", "spans"])
    return rows.mapInArrow(close, f"doc_id long, n_words long, n_hit long, items array<string>, spans {span}")
