"""Operators of the training-text subpackage against brute force."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

pytest.importorskip("linkloom.llm")

from pyspark.sql import functions as F  # noqa: E402

from linkloom.llm import (chat_format, common, decontaminate, exact_dedup, html_extract, lang_id,  # noqa: E402
                          line_dedup, lm_score, packing, queries, simhash, substring_dedup)

SF = "/root/testdata/sf0.001"
ODD = [
    (1, "Same line of text here\n  SAME line of text here \nshort\nshort"),
    (2, "same line of text here\x0b\nshort\n\nother line that is long"),
    (3, None), (4, ""), (5, " \t\n"), (6, "Éa ßb"), (None, "same line of text here"),
    (7, "same line of text here"), (7, "same line of text here"),
    (8, " ".join(f"w{i}" for i in range(40))), (9, "x " + " ".join(f"w{i}" for i in range(5, 30)) + " y"),
    (10, "a b   c\x1cd"), (11, "  Same  line oftexthere"), (12, "1234 !!"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty texts, ties, repeated rows, and columns whose names the operators use themselves."""
    df = spark.createDataFrame([(i, t, "x", 1, b"") for i, t in ODD],
                               "doc_id long, text string, kept string, chunk int, packet binary")
    return df.withColumn("lang", F.lit(None).cast("string"))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def both(docs, odd):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    return docs.select("doc_id", "text").union(odd.select(F.col("doc_id") + 100_000, "text")), (
        rows + [(None if i is None else i + 100_000, t) for i, t in ODD])


def big(i):
    return math.inf if i is None else i


def ascii_lower(t):
    return t.encode().lower().decode()


def words(t):
    return (t or "").encode().split()


def rows_of(df, *columns):
    return sorted(([r[c] for c in columns] for r in df.collect()), key=repr)


def test_line_dedup(both):
    df, rows = both

    def key(line):
        k = ascii_lower(line.strip(" \t\n\x0b\x0c\r"))
        return k if len(k) >= 10 else None

    first, want = {}, []
    for i, t in rows:
        for line in (t or "").split("\n"):
            first[key(line)] = min(first.get(key(line), math.inf), big(i))
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) is None or first[key(x)] == big(i)]
        want.append([i, len(lines), len(lines) - len(kept), "\n".join(kept)])
    assert rows_of(line_dedup.line_dedup(df), "doc_id", "n_lines", "n_dropped", "kept_text") == sorted(want, key=repr)


def test_minimal_perfect_hash():
    keys = np.random.default_rng(1).integers(0, 2**63, (5000, 2)).astype(np.uint64)
    sizes, bits = line_dedup.build_hash(keys)
    assert sorted(line_dedup.look_up(keys, sizes, bits).tolist()) == list(range(5000))
    sizes, bits = line_dedup.build_hash(keys[:0])
    assert len(line_dedup.look_up(keys[:3], sizes, bits)) == 3


def test_exact_dedup(both):
    df, rows = both
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0d]", "", t or "")].append((-len(t or ""), big(i), i))
    want = []
    for k, v in groups.items():
        for n, _, i in v:
            best = min(v)
            want.append([i, best[2], len(v), (n, big(i)) == best[:2], hashlib.sha256(k.encode()).hexdigest()])
    got = exact_dedup.exact_dedup(df)
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)


def test_exact_dedup_keeps_own_columns(odd):
    got = exact_dedup.exact_dedup(odd, keep_rows=True)
    assert got.columns == odd.columns
    assert sorted(big(r.doc_id) for r in got.collect()) == [1, 2, 5, 6, 7, 7, 8, 9, 10, 11, 12]


@pytest.mark.parametrize("window", [1, 3, 13, 30])
def test_substring_dedup(both, window):
    df, rows = both
    first, want = {}, []
    for i, t in rows:
        w = words(t)
        for j in range(len(w) - window + 1):
            k = tuple(w[j:j + window])
            first[k] = min(first.get(k, math.inf), big(i))
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if first[tuple(w[j:j + window])] < big(i):
                gone[j:j + window] = [True] * window
        want.append([i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()])
    got = substring_dedup.substring_dedup(df, window=window)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_text") == sorted(want, key=repr)


def test_levels():
    assert substring_dedup.levels(13) == [7, 13]
    assert substring_dedup.levels(50) == [7, 13, 25, 50]
    assert substring_dedup.levels(5) == [5]


def test_packed_keys():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**32, 3000).astype(np.uint32))
    assert (common.unpack_keys(common.pack_keys(keys), len(keys)) == keys).all()
    ids = np.array([-5, 2**62, 3, common.NO_ID], np.int64)
    assert (common.unsqueeze(common.squeeze(ids), 4) == ids).all()


def benchmark_words(t):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t or ""))


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 300])
def test_decontaminate(spark, both, block, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    df, rows = both
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(9001, "W7 w8, w9"), (9002, "éa SSb"), (9003, None), (None, "same line"), (9004, "!!"), (9005, "Éa ßb")]
    windows = defaultdict(set)
    for i, t in items:
        w = benchmark_words(t)
        for j in range(max(1, len(w) - 9)) if w else ():
            windows[tuple(w[j:j + 10])].add(None if i is None else str(i))
    sizes, want = {len(k) for k in windows}, []
    for i, t in rows:
        w = benchmark_words(t)
        hit, found = [False] * len(w), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if (k := tuple(w[j:j + n])) in windows:
                    hit[j:j + n] = [True] * n
                    found |= windows[k]
        want.append([i, len(w), sum(hit), sorted(found - {None}) + [None] * (None in found)])
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(df, table)
    assert rows_of(got, "doc_id", "n_words", "n_hit", "items") == sorted(want, key=repr)
    texts = {i: t for i, t in rows if i is not None}
    for r in got.where("n_hit > 0 AND doc_id IS NOT NULL").collect():
        covered = " ".join(texts[r.doc_id][s.start:s.end] for s in r.spans)
        assert len(benchmark_words(covered)) == r.n_hit
    clean = decontaminate.decontaminate(df, table, keep_clean=True)
    assert sorted(map(big, (r.doc_id for r in clean.collect()))) == sorted(big(w[0]) for w in want if not w[2])


def test_language_id(docs, odd):
    model = queries.language_model(docs)
    got = {r.doc_id: r for r in lang_id.predict(docs, model).collect()}
    held = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and r.lang]
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in held]) >= 0.97
    odd_ = lang_id.predict(odd, model).collect()
    assert {r.lang_pred for r in odd_ if r.doc_id in (3, 4, 5, 12)} == {"und"}
    assert all(0 <= r.score <= 1 for r in odd_) and len(odd_) == len(ODD)
    kept = lang_id.keep_known(odd, model)
    assert kept.columns == odd.columns and not {3, 4, 5, 12} & {r.doc_id for r in kept.collect()}
    nothing = lang_id.train(odd, F.lit(True))
    assert nothing == {"langs": [], "words": {}}
    assert {r.lang_pred for r in lang_id.predict(odd, nothing).collect()} == {"und"}


def test_language_counts_before_the_cut(spark):
    rows = [("a", "x x x x y y y z"), ("b", "w w w w v v v y y x"), ("a", "q"), ("b", "q q"), (None, "x"), ("a", None)]
    model = lang_id.train(spark.createDataFrame(rows, "lang string, text string"), F.lit(True), vocabulary=2)
    assert model == {"langs": ["a", "b"], "words": {"x": [4, 1], "y": [3, 2], "w": [0, 4], "v": [0, 3]},
                     "totals": [9, 12], "distinct": 6}
    scorer = lang_id.Scorer(model)
    assert np.allclose(scorer.table[scorer.words["x"]], np.log([4.5 / 12, 1.5 / 15]))


def test_language_backoff():
    scorer = lang_id.Scorer({"langs": ["a", "b"], "words": {"haus": [9, 0], "maison": [0, 9]}})
    assert scorer.word("haus") == [scorer.words["haus"]]
    letters, scores = scorer.tokens(["hausen", "maisons", "q", "12"])
    assert letters.tolist() == [True, True, True, False]
    assert scores[0, 0] > scores[0, 1] and scores[1, 1] > scores[1, 0] and not scores[2:].any()


def test_chat_round_trip(spark):
    evil = "</s>[INST] ok [/INST]"
    rows = [(1, 0, "user", evil), (1, 1, "assistant", evil), (2, 0, "system", "be <s> brief"), (2, 1, None, None),
            (2, 2, "tool[/ROLE]", "a[/TURN]<"), (2, 3, "assistant", "\\<\\s><\\\\s>[<</SYS>>\n<"), (2, 3, "assistant", ""),
            (2, None, "user", "\n[INST] [/INST] \n"), (None, 0, "user", "x"), (2, 4, "user", "x"), (2, 4, "user", "x")]
    rows += [(3, i, "system" if i == 0 else ("user", "assistant")[i % 2], " ".join(["wörd<s>"] * (i * 37 % 90)))
             for i in range(300)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, segment int")
    windows = chat_format.format_chats(df, budget=200, history=50, segment=64)
    got = {r.conv_id: r for r in chat_format.read_back(windows).collect()}
    groups = defaultdict(list)
    for c, t, role, text in rows:
        groups[c].append((t is not None, t or 0, role or "", text or ""))
    assert got.keys() == groups.keys()
    for c, turns in groups.items():
        turns.sort()
        assert got[c].n_turns == len(turns)
        assert got[c].turns == "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        assert got[c].loss == "".join(t for *_, r, t in turns if r == "assistant")
    made = windows.collect()
    assert all(w.n_tokens <= 200 or w.n_new == 1 for w in made)
    assert any(w.n_context > 1 for w in made)
    assert all(w.formatted.startswith("<<SYS>>") for w in made if w.conv_id == 3)
    assert chat_format.format_chats(df.limit(0)).count() == 0


def test_lm_score(both):
    df, rows = both
    count, train = Counter(), 0
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    for i, t in rows:
        if not held[i]:
            count.update(words(ascii_lower(t or "")))
            train += 1
    total, distinct = sum(count.values()) + train, len(count) + 1
    got = lm_score.score(df).collect()
    assert len(got) == len(rows)
    want = defaultdict(list)
    for i, t in rows:
        c = [count[w] for w in words(ascii_lower(t or ""))] + [train]
        want[i].append((len(c), sum(x > 0 for x in c), sum(math.log10((x + 1) / (total + distinct + 1)) for x in c)))
    for r in got:
        assert r.train_tokens == total and r.held_out == held[r.doc_id]
        assert any((r.n_tokens, r.n_known) == w[:2] and math.isclose(r.base_score, w[2], rel_tol=1e-9) for w in want[r.doc_id])
        assert r.score < 0 and math.isclose(r.bits_per_byte, -r.score * math.log2(10) / r.n_bytes)
    real = [r for r in got if r.held_out and r.n_tokens > 50]
    assert np.mean([r.bits_per_byte for r in real]) < 3.5


def test_lm_bits_are_a_distribution():
    """The bits of all 256 bytes after a context have probabilities that add up to one."""
    counts = np.random.default_rng(0).integers(0, 50, (2, lm_score._SLOTS)).astype(np.uint16)
    code = (np.uint64(0x61626364) << np.uint64(8)) + np.arange(256, dtype=np.uint64)
    assert math.isclose((10 ** lm_score.Mixer().log10(counts, code)).sum(), 1, rel_tol=1e-9)


def test_packing(both):
    from tokenizers import Tokenizer
    df, rows = both
    tokenizer = Tokenizer.from_str(queries.tokenizer_json())
    got = packing.pack(df, queries.tokenizer_json(), capacity=64, ids=True).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id].append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.tokens, "<u4").tobytes()) and len(r.tokens) == r.length
    for s in sequences.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == np.cumsum([0] + [r.length for r in s])[:-1].tolist()
        assert sum(r.length for r in s) <= 64
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(tokenizer.encode(t or "", add_special_tokens=False).ids + [0])
    for i, t in texts.items():
        assert sum(r.length for r in pieces[i]) == sum(map(len, t))
        if len(t) == 1:
            assert [x for r in sorted(pieces[i], key=lambda r: r.start) for x in r.tokens] == t[0]
    assert len(sequences) * 64 - sum(r.length for r in got) < 64 * 16


def test_packing_encoder_matches_the_library():
    import random
    rng, encoder = random.Random(0), packing.Encoder(queries.tokenizer_json())
    letters = "abcXYZ  \n\n\t'''sstrevmldd 019²½._-—!?%éñßüªº¼\xad«µ×÷Āŉſ  \r\x1c<|endoftext|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(3000)] + ["a<|endoftext|>b"]
    assert encoder.encode(texts) == [encoder.ids(t) for t in texts]


def plain_fingerprint(text):
    w = words(ascii_lower(text or ""))
    parts = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def test_html_reads_faulty_markup():
    def text(page):
        return html_extract.article_text(html_extract.blocks(page))
    cases = {
        '<article><a class="z"">one</a> two</article>': "one two",
        "<!--><article>seen</article>": "seen", "<!---><article>a<!-- b --!>c</article>": "ac",
        '<article title="a>b" =x data-t="<p>no</p>">yes</ <b>>no</article>': "yes>no",
        "<article><math><mi>x</mi><mo>+</mo></math><p role=\"note\">n</p></article>": "x+ n",
        '<article>kept</article><p title="never closed><p>gone</p>': "kept",
        "<article>a<br/>b<p>c<p>d<ul><li>e<li>f</ul></article>": "a b c d e f",
    }
    for page, want in cases.items():
        assert text(page) == want, page


def test_html_is_read_in_linear_time():
    import time

    def seconds(page):
        began = time.process_time()
        html_extract.blocks(page)
        return time.process_time() - began
    for make in (lambda n: "<a" + ' b="c"' * n + ' "' + "<p>x</p>" * 10, lambda n: "<div>" * n + "<p>x<td>y" * n,
                 lambda n: "<ul><li>" * n + "<dd></i>" * n, lambda n: "<article>" + "<a b='" * n):
        small, large = seconds(make(4_000)), seconds(make(32_000))
        assert large < 2 and large < 30 * max(small, 0.02), (small, large)


def test_simhash(both):
    df, rows = both
    rows = rows + [(7, "zz yy xx ww vv uu"), (None, "zz yy xx ww vv uu"), (None, "aa bb"), (8, "aa bb"), (7, "qq")]
    df = df.union(df.sparkSession.createDataFrame(rows[-5:], df.schema))
    prints = [plain_fingerprint(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                up[root(a)] = root(b)
    first = defaultdict(lambda: math.inf)
    for a, (i, _) in enumerate(rows):
        first[root(a)] = min(first[root(a)], big(i))
    component = [first[root(a)] for a in range(len(rows))]
    got = simhash.near_duplicates(df)
    want = [[i, f"{x:016x}", None if c == math.inf else c] for (i, _), x, c in zip(rows, prints, component)]
    assert rows_of(got, "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)
    stay = {big(i) for (i, _), c in zip(rows, component) if c == big(i)}
    kept = simhash.keep_first(df)
    assert sorted(big(r.doc_id) for r in kept.collect()) == sorted(big(i) for i, _ in rows if big(i) in stay)


@pytest.mark.parametrize("shards", [1, 7])
def test_vantage_point_tree_finds_all_links(shards):
    rng = np.random.default_rng(shards)
    near = np.full(1500, 2**40 + 7, np.uint64)
    for _ in range(3):
        near ^= np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64)
    fp = np.unique(np.concatenate([rng.integers(0, 2**63, 1500).astype(np.uint64), near, np.array([0, 1, 2**64 - 1], np.uint64)]))
    exact, found = simhash.Forest(len(fp)), simhash.Forest(len(fp))
    for i in range(len(fp)):
        j = np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= 2)
        exact.link(np.full(len(j), i), j)
    at, shard, home = simhash.deal(simhash.fit_tree(fp, shards), fp, 2)
    assert home.sum() == len(fp)
    for k in set(shard.tolist()):
        x, h = at[shard == k], home[shard == k]
        found.link(x, x[simhash.link_within(fp[x], h, 2)])
    every = np.arange(len(fp))
    assert (exact.roots(every) == found.roots(every)).all()


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = dict(simhash.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)}


def test_html_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    import html
    got = {r.page_id: r for r in html_extract.extract(pages).collect()}
    for r in pages.collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1].replace("<br>", " ")
        parts = [html.unescape(re.sub("<[^>]*>", "", x)) for x in re.split("</?p>|</?h1>", article)]
        want = " ".join(t for x in parts if (t := re.sub(r"[\x20\x09-\x0d]+", " ", x).strip(" ")))
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &lt;text", "plain <text"),
    ('<div class="sidebar">x</div><p>A<b>b</b>c <span class="ad">buy</span>d<br>e</p><script>if(a<b)"</p>"</script>'
     "<p>z<form>f</form>", "Abc d e z"),
    ('<nav><ul><li>one<article><h1>T</h1><header>by me</header><p>x<aside>no</aside>y</p>'
     '<div id="comments"><p>hi</p></div></article>', "T by me x y"),
    ("<main><p>a&nbsp;b\t c<!-- <p>no</p> --><table><tr><td>1<td>2</table></main><footer>f</footer>", "a b c 1 2"),
    ("<article><p>say &quot;hi&quot; &#38;lt; &eacute;</p><form><p>mail</p></form></article>", 'say "hi" &lt; é'),
    ("<article><p>one<style>p{}</style> two<div role=navigation>n</div></article", "one two"),
    ("<article><p hidden>no</p><p>a<img alt='x>y'>b</p></article>", "ab"),
])
def test_html_structure(spark, page, text):
    got = html_extract.extract(spark.createDataFrame([(1, None, page, "k")], "page_id long, url string, html string, text string"))
    assert [(r.text, r.n_chars) for r in got.collect()] == [(text, len(text))]


@pytest.mark.parametrize("page, text", [
    ('<div class="right-sidebar"><article><p>a</p></article></div>', "a"),
    ('<div class="no-sidebar"><main><p>a</p></main></div>', "a"),
    ('<div id=sidebar>x<div class="header">y<article><p>a</p></article></div>z</div>', "a"),
    ('<article><div class="post-header"><h1>T</h1></div><div class="header">by me</div><h2 id="related-work">R</h2>'
     '<h2 id="related">S</h2><section id="social-effects"><p>s</p></section><section id="comments"><p>c</p></section>'
     "</article>", "T by me R S s c"),
    ('<main><div class="menu"><article>a</article></div></main>', "a"),
    ('<article>a<div class="sidebar">b<article>c</article></div><div class="social">d</div></article>', "a"),
    ('<article>a</article><div class="comments"><article>b</article></div><aside><article>c</article></aside>'
     '<footer><div class="header"><article>d</article></div></footer><div class="sidebar"><aside><article>e</article>'
     "</aside></div>", "a"),
    ('<div class="ad"><article>b</article></div><div hidden><article>c</article></div><p class="ad-hoc">d</p>', "d"),
])
def test_html_names_are_whole_words(spark, page, text):
    got = html_extract.extract(spark.createDataFrame([(1, None, page)], "page_id long, url string, html string"))
    assert [r.text for r in got.collect()] == [text]


def test_html_host_boilerplate(spark):
    menu, foot = "Home News Sport Weather Travel Money now", "All rights reserved by the publishing house"
    pages = [(i, f"http://h{i % 3}.com/{i}", f"<div>{menu}</div><p>Story {i} tells things number {i * 7} here</p><p>{foot}</p>")
             for i in range(40)] + [(99, "http://solo.com/", f"<p>{foot}</p>")]
    got = {r.page_id: r.text for r in html_extract.extract(
        spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Story {i} tells things number {i * 7} here" for i in range(40)} | {99: foot}


def test_html_host_copies_are_one_page(spark):
    menu, foot = "Home News Sport Weather Travel Money now", "All rights reserved by the publishing house"

    def page(i):
        return (f"<div>{menu}</div><p>Story {i} tells things number {i * 7} here in nine words</p>"
                f"<p>{foot} wrote Kate{i}</p>")

    rows = ([(i, f"http://h.com/{i}", page(i)) for i in range(12)]
            + [(0, "http://h.com/0", page(0))]                                       # the same row again
            + [(100 + i, f"http://h.com/1?utm={i}", page(1)) for i in range(60)]     # a hot group of copies
            + [(200, "http://h.com/2/print", page(2).replace(menu, "Print view"))]   # a copy with other surroundings
            + [(300, "http://two.com/a", "<p>one story told by two pages of a host</p>"),
               (301, "http://two.com/b", "<p>one story told by two pages of a host</p>")]
            + [(400, None, "<p>recrawled page with its one and only story here</p>")]
            + [(400, None, f"<p>recrawled page with its one and only story here</p><p>{i}</p>") for i in range(5)])
    got = defaultdict(set)
    for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)).collect():
        got[r.page_id].add(r.text)
    want = {i: {f"Story {i} tells things number {i * 7} here in nine words Kate{i}"} for i in range(12)}
    want |= {100 + i: want[1] for i in range(60)}
    want[200] = {"Print view " + want[2].copy().pop()}
    want |= {i: {"one story told by two pages of a host"} for i in (300, 301)}
    want[400] = {"recrawled page with its one and only story here" + x for x in ("", " 0", " 1", " 2", " 3", " 4")}
    assert got == want


def test_suffix_ranks_match_brute_force():
    import pyarrow as pa
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(list("abc"), rng.integers(0, 30))) for _ in range(30)]
    list_, starts = common.split_words(pa.array(texts))
    host = rng.integers(0, 2, len(texts))
    for length in (1, 3, 6):
        places, _, other = html_extract.repeated_places(list_, starts, host, length)
        tokens, page = list_.to_pylist(), common.owner(starts)
        seen = defaultdict(set)
        for p in common.full_windows(starts, length):
            seen[host[page[p]], tuple(tokens[p:p + length])].add(page[p])
        want = {p: len(seen[host[page[p]], tuple(tokens[p:p + length])]) > 1 for p in common.full_windows(starts, length).tolist()}
        assert dict(zip(places.tolist(), other.tolist())) == want


def test_suffix_array_matches_brute_force():
    """Whole suffixes in order, by host, and the lengths that neighbours have in common, copies of pages included."""
    import pyarrow as pa
    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice(list("ab"), rng.integers(0, 40))) for _ in range(20)]
    texts += texts[:5] + [" ".join(f"w{i}" for i in range(300))] * 3 + ["", "a"]
    list_, starts = common.split_words(pa.array(texts))
    host = rng.integers(0, 2, len(texts))
    suffixes, depth = html_extract.suffix_array(list_, starts, host)
    tokens, page = list_.to_pylist(), common.owner(starts)

    def suffix(p):
        return tokens[p:starts[page[p] + 1]]

    assert sorted(suffixes.tolist()) == list(range(len(tokens)))
    seen = defaultdict(list)
    for at, (p, d) in enumerate(zip(suffixes.tolist(), depth.tolist())):
        before = suffixes[at - 1]
        equal = 0
        if at and host[page[before]] == host[page[p]]:
            equal = len(os.path.commonprefix([suffix(before), suffix(p)]))
        assert d == equal
        seen[host[page[p]]].append(suffix(p))
    for h, found in seen.items():  # a shared prefix is one stretch of the array, whatever its length
        for length in (1, 2, 7, 100):
            heads = [tuple(x[:length]) for x in found if len(x) >= length]
            assert sum(a != b for a, b in zip(heads, heads[1:])) == max(len(set(heads)) - 1, 0)


@pytest.mark.parametrize("most", [1, 2_000, 1 << 22])
def test_html_rows_come_through_the_host_arrays(spark, monkeypatch, most):
    """Pages with an article too: the array finds what the host repeats around it, in one shard or in many."""
    monkeypatch.setattr(html_extract, "HOST_BYTES", most)
    menu, licence = "Home News Sport Weather Travel Money now", "This story may be shared under the terms of our licence"
    pages = [(i, f"http://h{i % 2}.com/{i}", f"<nav>{menu}</nav><article><p>Story {i} of {i * 7}</p><p>{licence}</p></article>"
              f"<p>open {i}</p>") for i in range(30)]
    pages += [(100 + i, f"http://h{i % 2}.com/open/{i}", f"<div>{menu}</div><p>Open story {i} of {i * 9}</p>") for i in range(30)]
    pages += [(200, "http://solo.com/", pages[0][2]), (201, None, None), (202, "http://solo.com/e", "")]
    got = {r.page_id: (r.text, r.n_tokens, r.n_repeated) for r in html_extract.extract(
        spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    # runs go on over the ends of blocks: the menu and "open" or "Open story"
    want = {i: (f"Story {i} of {i * 7} {licence}", 9, 8) for i in range(30)}
    want |= {100 + i: (f"Open story {i} of {i * 9}", 12, 9) for i in range(30)}
    want |= {200: (f"Story 0 of 0 {licence}", 9, 0), 201: ("", 0, 0), 202: ("", 0, 0)}
    assert got == want


@pytest.mark.parametrize("most, share", [(1, 0.5), (700, 0.5), (1 << 22, 0.5), (1, 0.3), (1 << 22, 0.3)])
def test_html_articles_are_in_the_host_arrays(spark, monkeypatch, most, share):
    """Whole pages against brute force: what articles say is evidence as well, in one shard or in many."""
    monkeypatch.setattr(html_extract, "HOST_BYTES", most)
    rng = np.random.default_rng(8)
    licence = "This story may be shared under the terms of our licence"
    pages = [(i, f"http://h{i % 2}.com/{i}", f"<article><p>Story {i} of {i * 7}</p><p>{licence}</p></article>") for i in range(30)]
    pages += [(100 + i, f"http://h{i % 2}.com/o{i}", f"<p>{licence}</p><p>Open story {i} of {i * 9} alone</p>") for i in range(4)]
    lines = [" ".join(rng.choice(list("abc"), 9)) for _ in range(12)]
    for i in range(60):
        picked = [f"<{tag}>{lines[j]}</{tag}>" for tag, j in zip(rng.choice(["div", "nav", "p", "article"][:3 + i % 2], 4),
                                                                   rng.choice(12, 4, p=[0.3] + [0.7 / 11] * 11))]
        pages.append((200 + i, f"http://g{i % 2}.com/{i}", "".join(picked)))
    pages += [(300 + i, f"http://g{i % 2}.com/copy{i}", pages[-1 - i % 2][2]) for i in range(20)]
    pages += pages[:3] + [(None, "http://g0.com/n", "<p>a b c a b c a b</p>"), (400, "http://h0.com/e", None)]

    rows = [(u.split("/")[2], tuple((k, t) for k, t in html_extract.blocks(h))) for _, u, h in pages]
    streams = {(host, " ".join(t for _, t in found)) for host, found in rows}
    seen = defaultdict(set)
    for host, text in streams:
        words = text.split()
        for p in range(len(words) - 5):
            seen[host, tuple(words[p:p + 6])].add(text)
    want = Counter()
    for (i, u, _), (host, found) in zip(pages, rows):
        words = [w for _, t in found for w in t.split(" ")]
        outside = [k != html_extract.ARTICLE for k, t in found for _ in t.split(" ")]
        unique = np.ones(len(words), bool)
        least = max(3, share * sum(h == host for h, _ in streams))
        for p in range(len(words) - 5):
            unique[p:p + 6] &= len(seen[host, tuple(words[p:p + 6])]) < least
        want[i, u, html_extract.kept_of(list(found), unique), sum(outside),
             sum(o and not x for o, x in zip(outside, unique))] += 1
    got = Counter((r.page_id, r.url, r.text, r.n_tokens, r.n_repeated) for r in html_extract.extract(
        spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5), min_share=share).collect())
    assert got == want
    assert {r[2] for r in got if r[0] in range(100, 104)} == {f"Open story {i} of {i * 9} alone" for i in range(4)}


def test_empty_tables(spark, odd):
    empty, model = odd.limit(0), {"langs": ["en"], "words": {"a": [1]}}
    items = spark.createDataFrame([], "item_id long, text string")
    for df in (line_dedup.line_dedup(empty), exact_dedup.exact_dedup(empty), lang_id.predict(empty, model),
               decontaminate.decontaminate(empty, items), substring_dedup.substring_dedup(empty), lm_score.score(empty),
               packing.pack(empty, queries.tokenizer_json()), simhash.near_duplicates(empty), simhash.keep_first(empty)):
        assert df.count() == 0
    assert decontaminate.decontaminate(odd, items).agg(F.sum("n_hit")).first()[0] == 0


def test_very_long_text(spark):
    text = " ".join(f"word{i % 5000}" for i in range(300_000))
    df = spark.createDataFrame([(1, text), (2, text + " end"), (3, "x")], "doc_id long, text string")
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(df).collect()}
    assert (got[2].n_removed, got[2].kept_text, got[1].n_removed) == (300_000, "end", 0)
    assert {r.doc_id: r.n_lines for r in line_dedup.line_dedup(df).collect()} == {1: 1, 2: 1, 3: 1}
    assert lm_score.score(df).count() == 3
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()}[2] == 1


def test_queries_have_the_contracted_columns(spark):
    want = {
        "op1_html_extraction": "page_id url text n_chars", "op2_line_dedup": "doc_id n_lines n_dropped kept_sha256",
        "op3_exact_dedup": "doc_id keep_id group_size kept text_sha256", "op4_language_id": "doc_id held_out lang_pred score",
        "op5_chat_formatting": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
        "op6_benchmark_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
        "op7_substring_dedup": "doc_id n_words n_removed kept_sha256",
        "op8_lm_scoring": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op9_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        "op10_simhash_near_dedup": "doc_id fingerprint component_id",
        "op11_periodic_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
        "op12_token_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
        "op13_quality_classifier": "doc_id held_out score predicted"}
    assert set(queries.REGISTRY) == set(want)
    for name, columns in want.items():
        assert queries.REGISTRY[name](spark, SF).columns[:len(columns.split())] == columns.split(), name
