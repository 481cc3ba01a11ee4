"""HTML extraction: host suffix arrays, with the article known by structure.

Pages are read as a stream of tags and text.  Text in an ``article`` or ``main`` element is the article, also
where a layout wrapper around it has a class of surroundings; it stays, whatever other pages repeat.
Text in menus, headers, footers, sidebars, notices, adverts, forms, reader comments, scripts and styles
is boilerplate by its element, its role or a whole word of its class or id.

All pages go through the array of their host: the token streams of its whole pages, articles included, are
concatenated; a suffix array over them is built by prefix doubling until every suffix has a rank of
its own, with the lengths of common prefixes (LCP) from the ranks of each step.  An LCP interval of
``min_run`` tokens or more is a repeated substring; longer repeats lie in intervals inside it and are in no page that
it is not in, so the pages of the outermost intervals decide.  Substrings in ``min_share`` of the
host's distinct pages (and in ``MIN_PAGES`` at least) are repeated runs.  Of open blocks, which structure calls neither, of
a page without an article those of which more than half is in repeated runs keep the unique runs only; the
others stay whole.  Rows with equal ids or equal token streams are one page, so that copies of a page
are no evidence against its text.

A host is one shard, unless it has more than ``HOST_BYTES``.  Then its pages are dealt into several, with an array each; these
ask each other which of them counts a stream.  A substring in ``min_share`` of the host's pages is in that share
of the pages of one shard at least.  So a shard names the intervals that reach it, the host's shards count those that
can still reach it in all, and the sums decide as they would in one array.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (as_array, bucket_of, chunk_count, chunk_of, digests, edges_of, full_windows, mix, owner,
                     pack_bits, replies_of, split_words, squeeze, unpack_bits, unsqueeze, window_hash)
from .periodic_runs import common_words, ranks

_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section "
    "summary table tbody td tfoot th thead tr ul".split())
#: Elements whose content is no text of the page.
_RAW = frozenset("script style noscript template iframe noembed noframes object svg title textarea select "
                 "xmp canvas audio video head".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements and roles of a page's surroundings.
_AROUND = frozenset("nav header footer aside form menu dialog button search".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Classes and ids that name surroundings which have articles of their own: adverts,
#: lists of other pages, readers' comments.
_CLOSED = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation "
    "footer aside related comment comments disqus reply replies".split())
#: Classes and ids that name surroundings.
_NAMED = _CLOSED | frozenset(
    "banner menu header masthead sidebar notice notices cookie cookies consent gdpr popup modal newsletter "
    "subscribe breadcrumb breadcrumbs pagination share sharing social".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup section".split())
_ARTICLE = frozenset(["article", "main"])
#: An open p ends where one of these begins.
_ENDS_P = _BLOCKS - frozenset(["body", "caption", "html", "legend", "td", "th", "tr", "tbody", "thead", "tfoot"])
#: Attributes one at a time, as a tag reader takes them: a name begins with any character but white space,
#: ``/`` and ``>``; an unquoted value ends at white space or ``>``; a quote that is not closed takes the rest
#: of the page.  Possessive, so a page is read once whatever its quotes.
_VALUE = r"""\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s\"'>][^\s>]*+"""
_ONE = rf"[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:{_VALUE})?+)?+"
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?:[!?]|/(?![a-zA-Z]))[^>]*+(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_ONE})*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(rf"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+({_VALUE})?+)?+")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
#: Surroundings, the article, neither, and surroundings by a class or id that an
#: article inside ends.
AROUND, ARTICLE, OPEN, WRAPPER = 0, 1, 2, 3
#: Two pages with a text in common can be copies of a story; boilerplate is in more.
MIN_PAGES = 3
#: Bytes of html of a host in one shard.
HOST_BYTES = 4 << 20
_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


def _surrounds(name: str, attributes: str, in_article: bool) -> int | None:
    """The kind of surroundings that an element begins, if any.  In an article a
    header is its heading, and the ids of headings and sections are anchors."""
    if name in _AROUND and not (name == "header" and in_article):
        return AROUND
    if name in _ARTICLE or name in ("html", "body") or not attributes:
        return None
    found = None
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), html.unescape(value.strip("\"'")).lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return AROUND
        if key == "role" and value.strip() in _ROLES:
            return AROUND
        if key == "class" or key == "id" and not (in_article and name in _HEADINGS):
            for part in value.split():
                if part in _CLOSED:
                    return AROUND
                if part in _NAMED and not (part == "header" and in_article):
                    found = WRAPPER
    return found


def blocks(page: str | None) -> list[tuple[int, str]]:
    """The page's text blocks in order, each with its kind: in the surroundings,
    in an article, or open."""
    page = page or ""
    out: list[tuple[int, str]] = []
    text: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements, and the kind of text inside
    inside: Counter = Counter()  # how many of them by name, and by name and kind
    at = 0

    def kind() -> int:
        return stack[-1][1] if stack else OPEN

    def flush() -> None:
        if text:
            whole = _SPACE.sub(" ", "".join(text)).strip(" ")
            if whole:
                out.append((kind(), whole))
            text.clear()

    def close(name: str) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == name:
                if any(n in _BLOCKS for n, _ in stack[i:]) or kind() != (stack[i - 1][1] if i else OPEN):
                    flush()
                inside.subtract(n for n, _ in stack[i:])
                inside.subtract(stack[i:])
                del stack[i:]
                return

    while at < len(page):
        tag = _TOKEN.search(page, at)
        if tag is None:
            text.append(html.unescape(page[at:]))
            break
        if tag.start() > at:
            text.append(html.unescape(page[at:tag.start()]))
        at = tag.end()
        if tag[2] is None:
            continue
        name, attributes = tag[2].lower(), tag[3]
        if tag[1]:
            if name == "br":
                text.append(" ")
            elif inside[name]:
                close(name)
            elif name in _BLOCKS:
                flush()
            continue
        if name in _RAW and name not in ("head", "object"):
            if not attributes.rstrip().endswith("/") or name != "svg":
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name in ("br", "hr") or name in _VOID:
            if name in _BLOCKS:
                flush()
            elif name == "br":
                text.append(" ")
            continue
        if name in _ENDS_P and inside["p"]:
            close("p")
        if name in ("li", "dd", "dt", "td", "th", "tr", "option") and inside[name]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    close(name)
                    break
                if stack[i][0] in ("ul", "ol", "dl", "menu", "table"):
                    break
        if name in _ARTICLE and not inside["article", AROUND]:
            # an article that begins where surroundings were never closed ends them
            while stack and stack[-1][1] == AROUND and stack[-1][0] in ("nav", "header", "menu", "ul", "li", "a"):
                close(stack[-1][0])
        now = kind()
        if name in _ARTICLE and (now == OPEN or now == WRAPPER and not inside["article", ARTICLE]):
            now = ARTICLE
        elif now != AROUND and (around := _surrounds(name, attributes, now == ARTICLE)) is not None:
            now = around
        if name in _BLOCKS or now != kind():
            flush()
        stack.append((name, now))
        inside[name] += 1
        inside[name, now] += 1
    flush()
    return out


def article_text(found: list[tuple[int, str]]) -> str | None:
    """The article's blocks joined; None if the page has none, so that its open
    blocks must be judged."""
    own = [t for k, t in found if k == ARTICLE]
    if own:
        return " ".join(own)
    return None if any(k == OPEN for k, _ in found) else ""


def kept_of(found: list[tuple[int, str]], unique: np.ndarray) -> str:
    """The text that stays of a page's blocks; ``unique`` tells which of their tokens are in no run
    that the host repeats."""
    own = article_text(found)
    if own is not None:  # no open block is left to the array
        return own
    at, kept = 0, []
    for kind, text in found:
        words = text.split(" ")
        alone = unique[at:at + len(words)]
        at += len(words)
        if kind == OPEN and 2 * alone.sum() >= len(words):
            kept.append(text)
        elif kind == OPEN and alone.any():
            kept.append(" ".join(w for w, u in zip(words, alone) if u))
    return " ".join(kept)


def suffix_array(words: pa.Array, starts: np.ndarray, host: np.ndarray):
    """The suffixes of all pages' tokens in order, host by host, and how many tokens each has in common
    with the one before, if that is of the same host.  A suffix ends with its page."""
    if not len(words):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    levels = ranks(words.dictionary_encode().indices.to_numpy(), starts, host)
    suffixes = np.argsort(levels[-1])
    left = starts[1:][owner(starts)[suffixes]] - suffixes
    common = common_words(levels, suffixes[:-1], suffixes[1:])
    return suffixes, np.append(0, np.minimum(common, np.minimum(left[:-1], left[1:])))


def repeated_places(words: pa.Array, starts: np.ndarray, host: np.ndarray, length: int):
    """Places where ``length`` tokens begin, in the order of the suffix array; the
    LCP interval of that depth that each is in; and whether it is in several pages of the host."""
    suffixes, common = suffix_array(words, starts, host)
    page = owner(starts)
    # suffixes that are too short have an interval of their own
    fits = np.zeros(len(suffixes), bool)
    fits[full_windows(starts, length)] = True
    suffixes, new = suffixes[fits[suffixes]], (common < length)[fits[suffixes]]
    group = np.cumsum(new) - 1
    pages = page[suffixes]
    first = pages[new]
    other = np.bincount(group, weights=pages != first[group], minlength=len(first)) > 0 if len(suffixes) else new
    return suffixes, group, other[group] if len(suffixes) else other


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_run: int = 6, min_share: float = 0.5) -> DataFrame:
    """The main text of each whole page: ``page_id, url, text, n_chars, n_tokens, n_repeated``; the
    last two are the tokens outside its article, and those of them in runs that its host repeats.

    Character references are decoded; white space ``[\\x20\\x09-\\x0D]`` inside a
    block becomes one space; blocks are trimmed and joined by one space.  Null
    or empty html: empty text.  A null url is a host of its own.  One row per
    input row, repeated rows included; other columns are ignored; an empty table
    gives an empty result.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    shards = chunk_count(rows, "html")
    hosted = rows.withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST, 1)))
    # hosts of several shards: at most one for each HOST_BYTES of input
    large = (hosted.groupBy("host").agg(F.sum(F.octet_length("html")).alias("bytes")).where(F.col("bytes") > HOST_BYTES)
             .select("host", F.ceil(F.col("bytes") / HOST_BYTES).alias("parts")))
    part = F.pmod(F.xxhash64("page_id"), F.col("parts"))
    dealt = hosted.join(F.broadcast(large), "host", "left").select(
        "page_id", "url", "html", "host", F.col("parts").isNotNull().alias("split"),
        F.coalesce(part, F.lit(0)).alias("part"),
        chunk_of(F.concat_ws(" ", "host", part), shards).alias("chunk"))

    def read_blocks(batches):
        """What the hosts' suffix arrays are made of."""
        for batch in batches:
            found = [blocks(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *batch.columns[3:],
                 pa.array([[t for _, t in f] for f in found], pa.list_(pa.string())),
                 pa.array([[k for k, _ in f] for f in found], pa.list_(pa.int8()))],
                names=["page_id", "url", "host", "split", "part", "chunk", "texts", "kinds"])

    streams = (dealt.mapInArrow(read_blocks, f"page_id {kind}, url string, host string, split boolean, part long, chunk int, "
                                             "texts array<string>, kinds array<tinyint>")
               .groupBy("chunk"))

    def named(table: pa.Table):
        """Each page's host, the hosts, their hashes, and the whole pages' token streams."""
        hosts = as_array(table["host"]).dictionary_encode()
        hashed = digests(hosts.dictionary)[:, 0] if len(hosts.dictionary) else np.empty(0, np.uint64)
        return hosts.indices.to_numpy(), hosts.dictionary, hashed, pc.binary_join(as_array(table["texts"]), " ")

    def some_hosts(table: pa.Table, split: bool):
        """The rows of hosts of several shards, or of the others, shard by shard: those of one part of their hosts,
        ``HOST_BYTES`` of text at once, or a shard that goes beyond."""
        own = as_array(table["split"])
        table = table.filter(own if split else pc.invert(own))
        parts = as_array(table["part"]).to_numpy()
        for part in np.unique(parts).tolist():
            shard = table.filter(pa.array(parts == part))
            host, names, _, streams_ = named(shard)
            size = np.bincount(host, pc.binary_length(streams_).to_numpy(), len(names))
            turn = ((np.cumsum(size) - size) // HOST_BYTES)[host]
            for t in np.unique(turn):
                yield part, shard.filter(pa.array(turn == t))

    def first_pages(table: pa.Table):
        """The distinct streams' keys in order, the host of each, each page's place among them, and whether it is the
        first page of its stream, by id."""
        host, _, hashed, streams_ = named(table)
        key, at, place = np.unique(mix(digests(streams_)[:, 0]) ^ hashed[host], return_index=True, return_inverse=True)
        order = pc.sort_indices(pa.table({"place": place, "id": as_array(table["page_id"])}),
                                [("place", "ascending"), ("id", "ascending")]).to_numpy()
        first = np.zeros(len(place), bool)
        first[order[np.flatnonzero(np.diff(place[order], prepend=-1))]] = True
        return key, host[at], place, first

    def page_numbers(table: pa.Table, host: np.ndarray) -> np.ndarray:
        """Rows of one id and host are one page; a null id is a page of its own."""
        number = as_array(table["page_id"]).dictionary_encode().indices.fill_null(-1).to_numpy().astype(np.int64)
        number = np.where(number < 0, len(number) + np.arange(len(number)), number)
        return np.unique(number * (len(host) + 1) + host, return_inverse=True)[1]

    def pages_per(at: np.ndarray, page: np.ndarray, n: int) -> np.ndarray:
        """In how many pages each of ``n`` things is, of the places that have one and their pages."""
        pages = int(page.max()) + 1 if len(page) else 1
        return np.bincount(np.unique(at * pages + page) // pages, minlength=n)

    def arrays(table: pa.Table, counted: np.ndarray):
        """Through the suffix array: the pages' tokens and where they begin, its places, the outermost LCP interval of
        each, a place of each interval, in how many of the counted pages each is, and how many of these a host has."""
        host, names, _, streams_ = named(table)
        words, starts = split_words(streams_)
        places, group, _ = repeated_places(words, starts, host, min_run)
        row, page = owner(starts)[places], page_numbers(table, host)
        seen = counted[row]
        head = places[np.flatnonzero(np.diff(group, prepend=-1))]
        return (words, starts, places, group, head, pages_per(group[seen], page[row[seen]], len(head)),
                pages_per(host[counted], page[counted], len(names)))

    def keys_at(words: pa.Array, of: np.ndarray, places: np.ndarray) -> np.ndarray:
        """What shards know the ``min_run`` tokens at places by; ``of``: their hosts' hashes."""
        if not len(places):
            return np.empty(0, np.uint64)
        coded = words.dictionary_encode()
        return window_hash(digests(coded.dictionary)[:, 0][coded.indices.to_numpy()], places, min_run) ^ of

    def places_of(table: pa.Table, keys: list[bytes]):
        """The pages' tokens and where they begin, the given keys in order, the places that have one, and its place among them."""
        host, _, hashed, streams_ = named(table)
        words, starts = split_words(streams_)
        places = full_windows(starts, min_run)
        known = np.unique(np.frombuffer(b"".join(keys), np.uint64))
        key = keys_at(words, hashed[host[owner(starts)[places]]], places)
        at = np.searchsorted(known, key)
        found = np.flatnonzero(known[np.minimum(at, len(known) - 1)] == key) if len(known) else np.empty(0, np.int64)
        return words, starts, known, places[found], at[found]

    def shards_of(table: pa.Table):
        """By part: the rows of split hosts, and the keys of their distinct streams in order."""
        for part, found in groupby(some_hosts(table, True), lambda x: x[0]):
            tables = [t for _, t in found]
            yield part, tables, np.unique(np.concatenate([first_pages(t)[0] for t in tables]))

    def claim(table: pa.Table) -> pa.Table:
        """These keys, by bucket."""
        chunk, rows = table["chunk"][0].as_py(), []
        for part, _, key in shards_of(table):
            edges = edges_of(bucket_of(key, shards), shards)
            rows += [(chunk, part, b, key[edges[b]:edges[b + 1]].tobytes()) for b in np.flatnonzero(np.diff(edges)).tolist()]
        return rows_of(claimed, rows)

    def assign(table: pa.Table) -> pa.Table:
        """A stream is counted in one of the shards that have it, picked by hash: all count about as many."""
        asked = [np.frombuffer(k, np.uint64) for k in table["keys"].to_pylist()]
        shard = mix(as_array(table["chunk"]).to_numpy().astype(np.uint64) + np.uint64(1))
        shard = mix(shard + as_array(table["part"]).to_numpy().astype(np.uint64))
        key = np.concatenate(asked)
        order = np.lexsort((mix(key ^ np.repeat(shard, [len(k) for k in asked])), key))
        own = np.zeros(len(key), bool)
        own[order[np.append(True, np.diff(key[order]) > 0)]] = True
        answer = [pack_bits(x) for x in np.split(own, np.cumsum([len(k) for k in asked])[:-1])]
        return table.drop_columns("keys").append_column("answer", pa.array(answer, pa.binary()))

    def rows_of(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else
                        [pa.array([], f.type) for f in schema], schema=schema)

    def least_of(pages: np.ndarray) -> np.ndarray:
        """Most pages that are under ``min_share`` of so many (a little less, as sums of rounded products could differ)."""
        return np.maximum(np.ceil(min_share * (1 - 1e-9) * pages).astype(np.int64) - 1, 0)

    def nominate(table: pa.Table, answers: pa.Table) -> pa.Table:
        """Of each shard: which streams are counted in it, how many pages, and the intervals in ``min_share`` of them."""
        chunk, rows = table["chunk"][0].as_py(), []
        for part, tables, every in shards_of(table):
            said = answers.filter(pc.equal(answers["part"], part))
            owned = every[replies_of(said, edges_of(bucket_of(every, shards), shards))]
            for shard in tables:
                key, of, place, first = first_pages(shard)
                own = np.isin(key, owned)
                host, names, hashed, _ = named(shard)
                words, starts, _, _, head, n, pages = arrays(shard, first & own[place])
                home = host[owner(starts)[head]]
                some = np.flatnonzero((n > 0) & (n > least_of(pages)[home]))
                found = keys_at(words, hashed[home[some]], head[some])
                for h, name in enumerate(names.to_pylist()):
                    here = home[some] == h
                    order = np.argsort(found[here])
                    rows.append((name, chunk, part, pack_bits(own[of == h]), int(pages[h]), found[here][order].tobytes(),
                                 squeeze(n[some][here][order])))
        return rows_of(nominated, rows)

    def gather(table: pa.Table) -> pa.Table:
        """A host's shards, and what any of them named, if it can be in ``min_share`` of all pages: where it was not
        named it is in less than that."""
        table = table.sort_by([("chunk", "ascending"), ("part", "ascending")])
        pages = as_array(table["pages"]).to_numpy()
        asked = [np.frombuffer(k, np.uint64) for k in table["keys"].to_pylist()]
        n = [unsqueeze(x, len(k)) for x, k in zip(table["n"].to_pylist(), asked)]
        key, place = np.unique(np.concatenate(asked), return_inverse=True)
        under = least_of(pages)
        gain = np.concatenate(n) - np.repeat(under, [len(k) for k in asked])
        most = under.sum() + np.bincount(place, gain, len(key))
        key = key[most >= np.maximum(MIN_PAGES, min_share * (1 - 1e-9) * pages.sum())]
        return pa.table({"host": table["host"][:1], "keys": pa.array([key.tobytes()], pa.binary()),
                         "chunks": pa.array([table["chunk"].to_pylist()], pa.list_(pa.int32())),
                         "parts": pa.array([table["part"].to_pylist()], pa.list_(pa.int64())),
                         "owns": pa.array([table["own"].to_pylist()], pa.list_(pa.binary()))})

    def count(table: pa.Table, asked: pa.Table) -> pa.Table:
        """In how many of the pages counted here each of the keys is."""
        rows, asked_of = [], {(r["host"], r["part"]): r for r in asked.to_pylist()}
        for part, shard in some_hosts(table, True):
            key, of, place, first = first_pages(shard)
            host, names, _, _ = named(shard)
            own = np.zeros(len(key), bool)
            mine = [asked_of[h, part] for h in names.to_pylist()]
            for h, r in enumerate(mine):
                own[of == h] = unpack_bits(r["own"], int((of == h).sum()))
            counted = pa.array(first & own[place])
            page = page_numbers(shard, host).compress(counted)
            pages = pages_per(host.compress(counted), page, len(names))
            words, starts, known, places, at = places_of(shard.filter(counted), [r["keys"] for r in mine])
            n = pages_per(at, page[owner(starts)[places]], len(known))
            for h, r in enumerate(mine):
                keys = np.frombuffer(r["keys"], np.uint64)
                rows.append((r["host"], r["chunk"], int(pages[h]), squeeze(n[np.searchsorted(known, keys)]),
                             r["keys"] if r["lead"] else None))
        return rows_of(counts, rows)

    def decide(table: pa.Table) -> pa.Table:
        """A host's repeated runs."""
        key = np.frombuffer(next(k for k in table["keys"].to_pylist() if k is not None), np.uint64)
        total = sum(unsqueeze(x, len(key)) for x in table["n"].to_pylist())
        key = key[total >= np.maximum(MIN_PAGES, min_share * sum(table["pages"].to_pylist()))]
        return pa.table({"keys": pa.array([key.tobytes()], pa.binary()),
                         "chunks": pa.array([pc.unique(table["chunk"]).to_pylist()], pa.list_(pa.int32()))})

    def judged(table: pa.Table, words: pa.Array, starts: np.ndarray, hit: np.ndarray) -> pa.Table:
        """The pages' rows, of the places where repeated runs of ``min_run`` tokens begin."""
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, hit, 1)
        np.add.at(change, hit + min_run, -1)
        unique = np.cumsum(change)[:-1] == 0
        texts, kinds = as_array(table["texts"]), as_array(table["kinds"])
        outside = np.repeat(kinds.flatten().to_numpy() != ARTICLE,
                            pc.count_substring(texts.flatten(), " ").to_numpy() + 1)
        page, rows = owner(starts), len(table)
        found = [list(zip(k, t)) for k, t in zip(kinds.to_pylist(), texts.to_pylist())]
        alone = [unique[a:b] for a, b in zip(starts.tolist(), starts[1:].tolist())]
        return pa.table({"page_id": table["page_id"], "url": table["url"],
                         "text": pa.array([kept_of(f, u) for f, u in zip(found, alone)], pa.string()),
                         "n_tokens": pa.array(np.bincount(page[outside], minlength=rows), pa.int64()),
                         "n_repeated": pa.array(np.bincount(page[outside & ~unique], minlength=rows), pa.int64())})

    def judge(table: pa.Table, repeated: pa.Table) -> pa.Table:
        out = []
        for _, hosts in some_hosts(table, False):
            host, _, _, _ = named(hosts)
            words, starts, places, group, head, n, pages = arrays(hosts, first_pages(hosts)[3])
            runs = n >= np.maximum(MIN_PAGES, min_share * pages)[host[owner(starts)[head]]]
            out.append(judged(hosts, words, starts, places[runs[group]]))
        for _, shard in some_hosts(table, True):
            words, starts, _, places, _ = places_of(shard, repeated["keys"].to_pylist())
            out.append(judged(shard, words, starts, places))
        return pa.concat_tables(out)

    schema = f"page_id {kind}, url string, text string, n_tokens long, n_repeated long"
    claimed = pa.schema([("chunk", pa.int32()), ("part", pa.int64()), ("bucket", pa.int32()), ("keys", pa.binary())])
    nominated = pa.schema([("host", pa.string()), ("chunk", pa.int32()), ("part", pa.int64()), ("own", pa.binary()), ("pages", pa.int64()),
                           ("keys", pa.binary()), ("n", pa.binary())])
    counts = pa.schema([("host", pa.string()), ("chunk", pa.int32()), ("pages", pa.int64()), ("n", pa.binary()),
                        ("keys", pa.binary())])
    owners = (streams.applyInArrow(claim, "chunk int, part long, bucket int, keys binary").groupBy("bucket")
              .applyInArrow(assign, "chunk int, part long, bucket int, answer binary"))
    asked = (streams.cogroup(owners.groupBy("chunk"))
             .applyInArrow(nominate, "host string, chunk int, part long, own binary, pages long, keys binary, n binary")
             .groupBy("host").applyInArrow(gather, "host string, keys binary, chunks array<int>, parts array<long>, owns array<binary>")
             .select("host", "keys", F.posexplode(F.arrays_zip("chunks", "parts", "owns")).alias("at", "shard"))
             .select("host", "keys", (F.col("at") == 0).alias("lead"), F.col("shard.chunks").alias("chunk"),
                     F.col("shard.parts").alias("part"), F.col("shard.owns").alias("own")))
    repeated = (streams.cogroup(asked.groupBy("chunk"))
                .applyInArrow(count, "host string, chunk int, pages long, n binary, keys binary").groupBy("host")
                .applyInArrow(decide, "keys binary, chunks array<int>").select(F.explode("chunks").alias("chunk"), "keys"))
    return (streams.cogroup(repeated.groupBy("chunk")).applyInArrow(judge, schema)
            .select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_tokens", "n_repeated"))
