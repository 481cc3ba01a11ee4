"""Periodic runs, cross-tokenizer alignment and the quality classifier against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("linkloom.llm")

from pyspark.sql import functions as F  # noqa: E402

from linkloom.llm import periodic_runs, quality, queries, token_align, tokens  # noqa: E402

SF = "/root/testdata/sf0.001"


def frame(spark, rows):
    """Rows ``(id, text)`` with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 1, b"", None) for i, t in rows],
                                 "doc_id long, text string, groups string, part int, x binary, runs string")


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def plain_runs(w, least=24, repeats=3):
    """Every maximal stretch of each period, the smallest period for each span."""
    found = {}
    for p in range(1, len(w) // repeats + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            length = j - i + p
            if j > i and length >= max(least, repeats * p):
                found.setdefault((i, length), p)
            i = j + 1
    return sorted((s, p, n) for (s, n), p in found.items())


def made_texts(rng):
    texts = ["", None, " \t\n", "one", "a " * 200, "a b " * 90 + "a", "ab " * 23, "ab " * 24, "ab " * 25 + "c",
             "x " + "a b c " * 8, ("a b a b a b c " * 9), "a b c d e f g h " * 3, "a b c d e f g h " * 2]
    for _ in range(150):
        part = lambda n, k: [rng.choice("abcdef"[:k]) for _ in range(n)]
        w = []
        for _ in range(rng.randint(1, 5)):
            w += part(rng.randint(0, 6), 3)
            cycle = part(rng.randint(1, 12), rng.randint(1, 4))
            w += (cycle * 30)[:rng.randint(1, 90)]
        texts.append(" ".join(w))
    texts.append(" ".join(("a b a a b a b a " * 40).split()))
    return texts


def test_runs_match_brute_force(spark):
    texts = made_texts(random.Random(5))
    found = periodic_runs.detect(frame(spark, [(i % 150 if i % 9 else None, t) for i, t in enumerate(texts)]))
    got = Counter()
    for r in found.collect():
        got[r.n_words, tuple((x.start, x.period, x.length) for x in r.runs),
            r.best and (r.best.start, r.best.length, r.best.period), r.collapsed] += 1
    want = Counter()
    for t in texts:
        w = split(t)
        runs = plain_runs(w)
        gone = {i for s, p, n in runs for i in range(s + p, s + n)}
        best = min(runs, key=lambda x: (-Fraction(x[2], x[1]), x[0], x[1])) if runs else None
        want[len(w), tuple(runs), best and (best[0], best[2], best[1]),
             " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    assert got == want
    assert sum(len(k[1]) * n for k, n in want.items()) > 100


@pytest.mark.parametrize("least,repeats", [(2, 2), (7, 2), (12, 4)])
def test_runs_of_other_lengths(least, repeats):
    rng = random.Random(least)
    for _ in range(120):
        w = [rng.choice("ab") for _ in range(rng.randint(0, 60))]
        code = np.array([ord(c) for c in w], np.int64)
        got = periodic_runs.runs_of(code, np.array([0, len(w)]), least, repeats)
        assert sorted((s, p, n) for (s, n), p in got.items()) == plain_runs(w, least, repeats)


def test_runs_of_long_texts(spark):
    long = " ".join(f"w{i % 70_000}" for i in range(300_000)) + " end " + "a b " * 100_000
    got = periodic_runs.detect(frame(spark, [(1, long), (2, "a " * 300_000)])).orderBy("doc_id").collect()
    assert [tuple(r) for r in got[0].runs] == [(0, 300_000, 70_000), (300_001, 200_000, 2)]
    assert [tuple(r) for r in got[1].runs] == [(0, 300_000, 1)] and got[1].collapsed == "a"


def test_runs_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, SF).collect()}
    planted = 0
    for doc_id, text in rows:
        w = split(text)
        h = zlib.crc32(str(doc_id).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(w)
        planted += bool(runs)
        r = got.pop(doc_id)
        text = "".join(f"{s},{n},{p}\n" for s, p, n in runs)
        gone = {i for s, p, n in runs for i in range(s + p, s + n)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        if runs:
            s, p, n = min(runs, key=lambda x: (-Fraction(x[2], x[1]), x[0], x[1]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (s, n, p, 1000 * n // p)
        else:
            assert r.start is r.length is r.period is r.exponent_milli is None
    assert not got and planted > 10


def test_empty_tables(spark):
    none = frame(spark, []).limit(0)
    assert periodic_runs.detect(none).count() == 0
    assert token_align.align(none, queries.tokenizer_json(), queries.piece_model()).count() == 0
    rows = quality.measured(none)
    model = quality.train(rows, spark.createDataFrame([], "doc_id long, quality int"), F.lit(True))
    assert quality.score(rows, model).count() == 0
    some = quality.measured(frame(spark, [(1, "x"), (None, None)]))
    assert [r.score for r in quality.score(some, model).collect()] == [1.0, 1.0]


def test_ids_match_the_libraries():
    from tokenizers import Tokenizer
    rng = random.Random(0)
    letters = [*"abcXYZ  \n\n\t'''sstrevmldd 019²½._-—!?%éñßüªº¼\xad«µ×÷Āŉſ  \r\x1c\x00日本🙂", "<|endoftext|>", "aaaa", "</s>"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    texts += ["a" * k for k in range(70)] + ["=" * k for k in range(150)] + ["ab" * k for k in range(50)]
    for plain in (False, True):
        library = Tokenizer.from_str(queries.tokenizer_json())
        library.encode_special_tokens = plain
        mine = tokens.ByteTokens(queries.tokenizer_json(), plain)
        assert [x.tolist() for x in mine.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def plain_alignment(text, a, b):
    """Groups of one text as pairs of id lists, or none."""
    if not text:
        return []
    ia, ib = a.encode([" " + text])[0].tolist(), b.encode([text])[0].tolist()
    data = (" " + text).encode()
    if b"".join(a.bytes[i] for i in ia) != data or b"".join(b.bytes[i] for i in ib) != data:
        return []

    def ends(ids, of):
        at, out = 0, []
        for i in ids:
            at += len(of[i])
            out.append(at)
        return out
    ea, eb = ends(ia, a.bytes), ends(ib, b.bytes)
    cuts = sorted({*ea} & {*eb})
    groups, x, y = [], 0, 0
    for c in cuts:
        u, v = ea.index(c) + 1, eb.index(c) + 1
        groups.append((ia[x:u], ib[y:v]))
        x, y = u, v
    return groups


def test_alignment_matches_brute_force(spark):
    rng = random.Random(3)
    parts = ["the ", "and", " ", "\n", "é", "日本語", "🙂", "tokenization ", "</s>", "<|endoftext|>", "▁", "x1y2", "  ", "<0x41>", "ﬁ"]
    rows = [(i % 40 if i % 7 else None, "".join(rng.choices(parts, k=rng.randint(0, 12)))) for i in range(80)]
    rows += [(i, t) for i, t in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(25).collect()]
    rows += [(900, None), (901, ""), (902, " "), (903, "a\x00b"), (904, "long " * 30_000), (905, "abc" * 5_000), (906, "\U0001F9FF" * 400)]
    a, b = tokens.ByteTokens(queries.tokenizer_json(), True), tokens.PieceTokens(queries.piece_model())
    groups = [plain_alignment(t, a, b) for _, t in rows]
    links = [Counter((x, y) for ga, gb in g for x in ga for y in gb) for g in groups]
    count = Counter(k for c in links for k in c)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    want = Counter()
    for (i, _), g, c in zip(rows, groups, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        want[i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()),
             sum(n for k, n in c.items() if count[k] == best[k[0]]), sum(n * count[k] for k, n in c.items()),
             hashlib.sha256(text.encode()).hexdigest() if text else "", text] += 1
    got = token_align.align(frame(spark, rows).repartition(5), queries.tokenizer_json(), queries.piece_model(), texts=True)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    assert Counter(tuple(r) for r in got.collect()) == want


def test_links_in_blocks(monkeypatch):
    """Links listed in several blocks add up to the same."""
    a, b = tokens.ByteTokens(queries.tokenizer_json(), True), tokens.PieceTokens(queries.piece_model())
    texts = ["the cat sat 12345 " * 20, "zzxxyyqq" * 30]
    use = np.ones(2, bool)
    ta = token_align.tokens_of(a.encode([" " + t for t in texts]), np.array([len(x) for x in a.bytes]), use)
    tb = token_align.tokens_of(b.encode(texts), np.array([len(x) for x in b.bytes]), use)
    ga, gb = token_align.groups_of(ta, tb)
    once = token_align.linked(ta, tb, ga, gb, len(b.bytes))
    monkeypatch.setattr(token_align, "PAIRS", 7)
    for x, y in zip(once, token_align.linked(ta, tb, ga, gb, len(b.bytes))):
        assert x.tolist() == y.tolist()


def plain_rising(weight, total):
    """Least squares under rising order: the largest mean of a stretch that ends at or before, the smallest that ends
    at or after."""
    n = len(weight)
    def mean(i, j):
        return sum(total[i:j + 1]) / sum(weight[i:j + 1])
    return [max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)]


def test_calibration_is_isotonic():
    rng = np.random.default_rng(1)
    for _ in range(30):
        weight = rng.integers(1, 5, 12).astype(float)
        total = np.floor(weight * rng.random(12))
        line, want = quality.rising(weight, total), plain_rising(weight, total)
        assert (np.diff(line) >= -1e-12).all()
        # a pool's value is met at its weighted centre
        for v in set(np.round(want, 9)):
            own = np.flatnonzero(np.isclose(want, v))
            assert np.isclose(np.interp((weight[own] * own).sum() / weight[own].sum(), np.arange(12), line), v, atol=0.15)


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    d = len(quality.STATISTICS)
    model = {"mean": np.zeros(d), "deviation": np.ones(d), "directions": rng.normal(size=(d, 8192)) / 4.0,
             "shifts": rng.uniform(0, 2 * np.pi, 8192)}
    x = rng.normal(size=(20, d))
    z = quality.random_features(x, model)
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * 4.0 ** 2))
    assert np.abs(z @ z.T - want).max() < 0.06


def test_normal_equations_match_numpy(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["fine", "words", "BAD!!", "BAD!!" if i % 3 == 0 else "good"])
                         for _ in range(rng.randint(5, 60)))) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i, _ in rows] + [(None, 1), (5, 7), (999, 1)], "doc_id long, quality int")
    docs = frame(spark, rows).repartition(7)
    measured = quality.measured(docs)
    model = quality.train(measured, labels, F.col("doc_id") % 5 != 0, features=32)
    x = quality.statistics(pa.array([t for _, t in rows]))
    train = np.array([i % 5 != 0 for i, _ in rows])
    assert np.allclose(model["mean"], x[train].mean(axis=0))
    assert np.isclose(model["base"], np.mean([i % 3 != 0 for i, _ in rows if i % 5]))
    fits = {r.doc_id for r in measured.where(F.pmod(F.xxhash64("x"), F.lit(4)) != 0).collect()}
    use = np.array([i in fits and i % 5 != 0 for i, _ in rows])
    z = quality.random_features(x[use], model)
    y = np.array([i % 3 != 0 for i, _ in rows], float)[use] - model["base"]
    want = np.linalg.solve(z.T @ z + (quality.PENALTY * len(z) + 1e-9) * np.eye(32), z.T @ y)
    assert np.allclose(model["weights"], want, atol=1e-6)
    got = {r.doc_id: r.score for r in quality.score(measured, model).collect()}
    right = np.mean([(got[i] >= 0.5) == (i % 3 != 0) for i, _ in rows if i % 5 == 0])
    assert right > 0.9


def test_statistics_of_odd_texts():
    texts = pa.array([None, "", " \n", "A", "é", "!!!", "word " * 50_000, "x\n" * 3])
    x = quality.statistics(texts)
    assert np.isfinite(x).all() and not x[:2].any()
    assert (x == np.concatenate([quality.statistics(texts[i:i + 1]) for i in range(len(texts))])).all()
    assert (x[3:5] == quality.statistics(texts.slice(3, 2))).all()


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.op13_quality_classifier(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [(got[i].score, got[i].predicted, y) for i, y in labels.items() if i in got and zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert all(0 <= s <= 1 and p == int(s >= 0.3) for s, p, _ in held)
    low, high = [s for s, _, y in held if not y], [s for s, _, y in held if y]
    area = np.mean([(h > x) + (h == x) / 2 for h in high for x in low])
    right = np.mean([p == y for _, p, y in held])
    print("held out", len(held), "area", area, "right", right, "low caught", np.mean([s < 0.3 for s in low]), "high kept", np.mean([s >= 0.3 for s in high]))
    assert area > 0.97 and right > 0.96
