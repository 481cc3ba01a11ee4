"""The mixing model against a plain reading of its definition, and what it learns from."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from linkloom.llm import lm_score


def _plain_score(text, train, state, share, end_share):
    """log10 probability of a text, bit by bit, with counts kept by context."""
    def body(t):
        return b" ".join((t or "").encode().lower().split())

    counts, words = Counter(), Counter()
    for t in train:
        data = b"\0" * 4 + body(t) + b"\0"
        words.update(body(t).split())
        for i in range(4, len(data)):
            bits = f"{data[i]:08b}"
            for j in range(8):
                for order in range(1, 5):
                    counts[data[i - order:i], order, bits[:j], bits[j]] += 1
    total, logs, out, word = sum(words.values()), 0.0, 0.0, b""
    data = b"\0" * 4 + body(text) + b"\0"
    for i in range(4, len(data)):
        bits = f"{data[i]:08b}"
        for j in range(8):
            seen = [[counts[data[i - o:i], o, bits[:j], b] for b in "01"] for o in range(1, 5)]
            inputs = [max(-8, min(8, math.log((one + 0.3) / (zero + 0.3)))) for zero, one in seen] + [0.3]
            gate = [sum(sum(s) >= x for x in (1, 4, 16, 128)) for s in seen[2:]]
            w = state["weights"][25 * j + 5 * gate[0] + gate[1]]
            logit = max(-8, min(7.999, sum(a * b for a, b in zip(w, inputs))))
            place = (logit + 8) * 2
            low, row = int(place), state["map"][int("1" + bits[:j], 2)]
            mapped = row[low] * (1 - (place - low)) + row[low + 1] * (place - low)
            p = max(1e-6, min(1 - 1e-6, (1 / (1 + math.exp(-logit)) + mapped) / 2))
            logs += math.log10(p if bits[j] == "1" else 1 - p)
        if data[i:i + 1] in (b" ", b"\0"):
            known = words[word] / max(total, 1) * (end_share if data[i] == 0 else 1 - end_share) if word else 0
            out += math.log10(share * known + (1 - share) * 10 ** logs)
            logs, word = 0.0, b""
        else:
            word += data[i:i + 1]
    return out


def _is_held_out(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def test_score_equals_a_plain_reading_of_the_model(spark):
    texts = ["ab ab  ba", "AB ba", "", None, "b", "ab\tab ab ab", "é ab", "a a a a a a a b"] * 3
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    flat = df.select(F.col("doc_id").alias("id"), "text")
    counts = spark.sparkContext.broadcast(lm_score._tables(flat))
    train = [t for i, t in rows if not _is_held_out(i)]
    places = sum(len((t or "").encode()) + 1 for t in train)
    state = lm_score._fitted(flat, counts, places)
    assert not np.allclose(state["weights"], lm_score.Mixer().weights)
    ends, total = len(train), sum(len((t or "").split()) for t in train)
    end_share = min(max(ends / total, 1e-9), 0.5)
    got = {r.doc_id: r.score for r in lm_score.score(df).collect()}
    assert any(_is_held_out(i) for i, _ in rows)
    for i, t in rows:
        assert math.isclose(got[i], _plain_score(t, train, state, lm_score.SHARE, end_share), rel_tol=1e-6), (i, t)


def test_places_are_spread_over_whole_texts_whatever_stands_beside_them():
    texts = ["x" * 40_000, "", "ab " * 50, "x" * 40_000, None]
    ids = np.array([1, 2, 3, 1, 5], np.int64)
    buffer, begin = lm_score.layout(texts)
    at, drawn = lm_score.spread_places(buffer, begin, ids, 0.01)
    inside = [at[(at >= b) & (at < b + len((t or "").strip()) + 1)] - b for b, t in zip(begin, texts)]
    assert sum(map(len, inside)) == len(at) == len(drawn)
    assert len(inside[0]) in (400, 401) and np.diff(inside[0]).max() <= 101 and inside[0][-1] > 39_800
    assert (inside[0] == inside[3]).all()
    alone, first = lm_score.layout(texts[:1])
    assert (lm_score.spread_places(alone, first, ids[:1], 0.01)[0] - first[0] == inside[0]).all()
    every, _ = lm_score.spread_places(buffer, begin, ids, 1.0)
    assert len(every) == len(set(every.tolist())) == sum(len((t or "").strip()) + 1 for t in texts)


def test_long_texts_alone_and_several_groups_teach_the_mixer(spark, monkeypatch):
    rows = [(i, f"lorem{i % 3} ipsum " * 2000) for i in range(6)]
    flat = spark.createDataFrame(rows, "id long, text string").repartition(3)
    counts = spark.sparkContext.broadcast(lm_score._tables(flat))
    places = sum(len(t.encode()) + 1 for _, t in rows)
    one = lm_score._fitted(flat, counts, places)
    again = lm_score._fitted(flat.coalesce(1), counts, places)
    monkeypatch.setattr(lm_score, "GROUP", 5000)
    many = lm_score._fitted(flat, counts, places)
    start = lm_score.Mixer().weights
    assert (one["weights"] == again["weights"]).all()  # the split of the rows makes no difference
    assert not np.allclose(one["weights"], start) and not np.allclose(many["weights"], start)


def test_no_training_row_leaves_the_first_mixer(spark):
    held = next(i for i in range(100) if _is_held_out(i))
    df = spark.createDataFrame([(held, "some words"), (held, None)], "doc_id long, text string")
    assert all(r.score < 0 and r.base_score == 0 for r in lm_score.score(df).collect())


def test_the_mixer_learns_from_every_place(spark, monkeypatch):
    rows = [(i, f"word{i % 5} and  Some words{i} " * (40 * i)) for i in range(12)]
    flat = spark.createDataFrame(rows, "id long, text string").repartition(3)
    want = Counter()
    for i, t in rows:
        if not _is_held_out(i):
            data = b"\0" * 4 + b" ".join(t.encode().lower().split()) + b"\0"
            want.update(int.from_bytes(data[k - 4:k + 1], "big") for k in range(4, len(data)))
    for held, size in ((1 << 22, 1 << 25), (8, 3000)):
        monkeypatch.setattr(lm_score, "HELD", held)
        monkeypatch.setattr(lm_score, "PLACES", size)
        placed = lm_score._places(flat, sum(want.values()))
        found = [(r.code, r.times, r.n) for r in placed.collect()]
        got = {int(c): int(t) for code, times, n in found
               for c, t in zip(lm_score.unsqueeze(code, n), lm_score.unsqueeze(times, n))}
        assert got == dict(want) and sum(n for *_, n in found) == len(want)
    counts = spark.sparkContext.broadcast(lm_score._tables(flat))
    # the texts of some rows beyond a sample's reach change what is learned
    fitted = lm_score._fitted(flat, counts, sum(want.values()), placed)
    code, times = np.array(list(want), np.uint64), np.array(list(want.values()))
    portion = sum(want.values()) // len(want)
    parts = -(-times // portion)
    of = np.repeat(np.arange(len(code)), parts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    share = times[of] // parts[of] + (nth < times[of] % parts[of])
    assert share.sum() == sum(want.values()) and share.max() <= portion and len(share) <= 2 * len(want)
    order = np.argsort(lm_score.mix(lm_score.mix(code[of]) + nth.astype(np.uint64)))
    plain = lm_score.Mixer()
    plain.learn(counts.value, code[of][order], share[order])
    assert np.allclose(plain.weights, fitted["weights"]) and np.allclose(plain.map, fitted["map"])
