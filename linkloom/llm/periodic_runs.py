"""Periodic run detection: maximal pairs in the LCP-interval tree.

A run is a stretch of words with smallest period q that no neighbouring word
extends.  Its words without the last q, and without the first q, are two places of
one repeated stretch that differ in the word to the left and in the word to the
right: a *maximal pair* at distance q.  Conversely a maximal pair of ``l`` common
words at distance ``d`` spans ``d + l`` words of period d and cannot be extended.
So the pairs with ``d + l`` of at least the least length, and of at least
``repeats`` times d, are the runs, once for each multiple of the period; of
pairs with one span the least distance stays.

The pairs come from a bottom-up walk over the LCP intervals of a text's
suffixes.  Each interval holds its places by the class of the word to their
left.  Where children of an interval meet, the pairs are neighbours of
different classes (places nearer to each other than their common stretch is long
form a row of equal steps in which only the first can have another left word).  The
smaller child is put into the larger, so a place moves a logarithmic number of times.

The suffixes of all texts of a batch are sorted together by prefix doubling; words
of different texts never compare as equal.  An interval needs ``least``
common words (16 for 24 words and three repeats), so places whose first words occur
once are out after a few rounds, as is a block of one left class, or
one whose places all lie too far apart.
"""

from __future__ import annotations

from bisect import bisect_left
from fractions import Fraction
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_array, join_words, owner, portions, split_words

#: Bytes of text whose suffixes are sorted at once (a longer text goes alone).
BATCH_BYTES = 4 << 20
RUN = "struct<start:long,length:long,period:long>"


def ranks(code: np.ndarray, starts: np.ndarray, group_of: np.ndarray | None = None) -> list[np.ndarray]:
    """Ranks of all places by their first 1, 2, 4, ... words, up to the length at
    which no two places of a text are equal.  Equal rank: equal words in one
    text, or in texts of one group; a window that the text's end cuts equals no other."""
    n = len(code)
    of = owner(starts)
    stop = starts[1:][of]
    of = of if group_of is None else group_of[of]
    order = np.lexsort((code, of))
    new = np.ones(n, bool)
    new[1:] = (code[order][1:] != code[order][:-1]) | (of[order][1:] != of[order][:-1])
    head = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(head, np.diff(head, append=n))
    levels = [rank.astype(np.int32)]
    open_ = order[np.repeat(np.diff(head, append=n) > 1, np.diff(head, append=n))]
    length = 1
    while len(open_):
        after = open_ + length
        inside = after < stop[open_]
        second = np.where(inside, rank[np.minimum(after, n - 1)] + 1, -open_)
        first = rank[open_]
        order = np.lexsort((second, first))
        open_, first, second = open_[order], first[order], second[order]
        at = np.arange(len(open_))
        group = np.ones(len(open_), bool)
        group[1:] = first[1:] != first[:-1]
        new = group.copy()
        new[1:] |= second[1:] != second[:-1]
        begin = np.maximum.accumulate(np.where(group, at, 0))
        head = np.maximum.accumulate(np.where(new, at, 0))
        rank[open_] = first + head - begin
        sizes = np.diff(np.flatnonzero(new), append=len(open_))
        levels.append(rank.astype(np.int32))
        open_ = open_[np.repeat(sizes > 1, sizes)]
        length *= 2
    return levels


def common_words(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from the places ``a`` and ``b`` of one text on are equal."""
    n, found = len(levels[0]), np.zeros(len(a), np.int64)
    for t in range(len(levels) - 1, -1, -1):
        x, y = a + found, b + found
        inside = (x < n) & (y < n)
        same = inside & (levels[t][np.minimum(x, n - 1)] == levels[t][np.minimum(y, n - 1)])
        found += same.astype(np.int64) << t
    return found


def maximal_pairs(places: list[int], depths: list[int], left: np.ndarray, least: int, repeats: int):
    """Maximal pairs ``(place, distance, common words)`` of a block of sorted suffixes.
    ``depths``: common words of each suffix and the one before."""
    found: list[tuple[int, int, int]] = []

    def meet(held: list[int], child: list[int], depth: int) -> list[int]:
        if len(held) < len(child):
            held, child = child, held
        reach = depth // (repeats - 1)
        for place in child:
            at = bisect_left(held, place)
            for i, j in ((held[at - 1] if at else None, place), (place, held[at] if at < len(held) else None)):
                if i is None or j is None or j - i > reach or j - i + depth < least or left[i] == left[j]:
                    continue
                found.append((i, j - i, depth))
        if len(child) * 8 < len(held):
            for place in child:
                held.insert(bisect_left(held, place), place)
            return held
        return sorted(held + child)

    open_: list[tuple[int, list[int]]] = []  # intervals by depth, with the places of their closed children
    child = [places[0]]
    for place, depth in zip(places[1:], depths):
        while open_ and open_[-1][0] > depth:
            d, held = open_.pop()
            child = meet(held, child, d)
        if open_ and open_[-1][0] == depth:
            child = meet(open_.pop()[1], child, depth)
        open_.append((depth, child))
        child = [place]
    while open_:
        d, held = open_.pop()
        child = meet(held, child, d)
    return found


def runs_of(code: np.ndarray, starts: np.ndarray, least: int, repeats: int) -> dict[tuple[int, int], int]:
    """All runs: ``{(first word, length): period}``, with places in the whole batch."""
    if not len(code):
        return {}
    shallow = -(-least * (repeats - 1) // repeats)  # d + l >= least and l >= (repeats - 1) * d
    levels = ranks(code, starts)
    level = shallow.bit_length() - 1
    if level >= len(levels):
        return {}
    order = np.argsort(levels[-1], kind="stable")
    near = levels[level][order]
    pair = np.flatnonzero(near[1:] == near[:-1])  # suffixes next to each other that share 2 ** level words
    depth = common_words(levels, order[pair], order[pair + 1])
    pair, depth = pair[depth >= shallow], depth[depth >= shallow]
    if not len(pair):
        return {}
    first = np.ones(len(pair), bool)  # a block's pairs follow each other
    first[1:] = pair[1:] != pair[:-1] + 1
    begin = np.flatnonzero(first)
    end = np.append(begin[1:], len(pair))
    left = np.append(-1, code[:-1])
    left[starts[:-1][starts[:-1] < len(code)]] = -1
    # a block needs two left classes, and two places as near as its deepest interval allows
    size = end - begin + 1
    block = np.repeat(np.arange(len(begin)), size)
    place = order[np.repeat(pair[begin] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
    head = np.cumsum(size) - size
    classes = left[place]
    mixed = np.maximum.reduceat(classes, head) != np.minimum.reduceat(classes, head)
    by = np.lexsort((place, block))
    gap = np.diff(place[by], append=0)
    gap[np.append(head[1:], len(place)) - 1] = np.iinfo(np.int64).max
    near_ = np.minimum.reduceat(gap, head) * (repeats - 1) <= np.maximum.reduceat(depth, begin)
    found: dict[tuple[int, int], int] = {}
    for b in np.flatnonzero(mixed & near_).tolist():
        own = place[head[b]:head[b] + size[b]].tolist()
        for i, distance, common in maximal_pairs(own, depth[begin[b]:end[b]].tolist(), left, least, repeats):
            key = (i, distance + common)
            found[key] = min(distance, found.get(key, distance))
    return found


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24,
           repeats: int = 3) -> DataFrame:
    """Periodic runs of the words ``[^\\x20\\x09-\\x0D]+`` of each whole text.

    Returns one row per input row: ``doc_id, n_words, runs`` (``array<struct<start,
    length, period>>``, by start, then period: every stretch with smallest period q
    of at least ``least`` words and ``repeats`` periods that no neighbouring word
    extends), ``best`` (the run of greatest length / period; ties: smallest start, then
    period; null without a run) and ``collapsed`` (the words without those that some
    run contains after its first q words, joined by one space).

    Null and empty texts have no words and no run.  Rows with equal or null ids are
    judged each by itself; other columns are ignored; an empty table gives an
    empty result.  A text is one task's work, whatever its length.
    """
    if repeats < 2 or least < 2:
        raise ValueError("a run has two words and two repeats at least")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, starts = split_words(as_array(batch.column(1)))
        code = words.dictionary_encode().indices.to_numpy().astype(np.int64)
        found = runs_of(code, starts, least, repeats)
        keys = sorted((start, period, length) for (start, length), period in found.items())
        table = np.array(keys, np.int64).reshape(-1, 3)
        edge = np.zeros(len(words) + 1, np.int64)  # words in a run after its first period
        np.add.at(edge, table[:, 0] + table[:, 1], 1)
        np.add.at(edge, table[:, 0] + table[:, 2], -1)
        keep = np.cumsum(edge)[:-1] == 0
        of = np.searchsorted(starts, table[:, 0], side="right") - 1
        begin = np.searchsorted(of, np.arange(len(starts)))
        start = table[:, 0] - starts[of]
        structs = pa.StructArray.from_arrays([pa.array(start), pa.array(table[:, 2]), pa.array(table[:, 1])],
                                             fields=list(run))
        best: list[int | None] = [None] * (len(starts) - 1)
        for d in np.flatnonzero(np.diff(begin)).tolist():
            best[d] = max(range(begin[d], begin[d + 1]), key=lambda i: (Fraction(keys[i][2], keys[i][1]), -i))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(starts), pa.int64()),
             pa.ListArray.from_arrays(pa.array(begin, pa.int32()), structs),
             structs.take(pa.array(best, pa.int64())), pa.array(join_words(words, starts, keep), pa.string())],
            names=["doc_id", "n_words", "runs", "best", "collapsed"])

    def work(batches):
        for portion in chain.from_iterable(portions(b, 1, BATCH_BYTES) for b in batches):
            yield judge(portion)

    return rows.mapInArrow(work, f"doc_id long, n_words long, runs array<{RUN}>, best {RUN}, collapsed string")
