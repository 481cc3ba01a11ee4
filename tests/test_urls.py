"""Canonical URLs, reverse host, href resolution."""

import pytest
from pyspark.sql import functions as F

from linkloom.functions.urls import normalize_urls, page_url, resolve_urls, reverse_hostname

REVERSE_CASES = [
    ("test.com", "com.test"),
    ("truc.test.com", "com.test.truc"),
    ("com.test", "test.com"),
    ("com.test.truc", "truc.test.com"),
]

NORMALIZE_OK = [
    ("example.dev", "http://example.dev"),
    ("http://test.com/", "http://test.com"),
    ("http://test.com:80", "http://test.com"),
    ("https://test.com:443", "https://test.com"),
    ("http://test.com/truc#machin", "http://test.com/truc"),
    ("http://test.com/truc?machin=bidule", "http://test.com/truc"),
]

NORMALIZE_REJECT = [
    ("ftp://test.com", "url scheme is not http or https: ftp"),
    ("http://test.com:4531", "port is not 80 or 443: 4531"),
    ("http://127.0.0.1/", "hostname is an ip adress: 127.0.0.1"),
]


def _norm(spark, inputs):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(inputs)], "i int, u string")
    rows = normalize_urls(df, "u").orderBy("i").collect()
    return rows


def test_reverse_hostname(spark):
    df = spark.createDataFrame(REVERSE_CASES, "h string, e string")
    got = df.select(reverse_hostname(F.col("h")).alias("r"), "e",
                    reverse_hostname(reverse_hostname(F.col("h"))).alias("rr"), "h").collect()
    for r in got:
        assert r.r == r.e
        assert r.rr == r.h  # self-inverse


def test_normalize_valid(spark):
    rows = _norm(spark, [i for i, _ in NORMALIZE_OK])
    for (inp, exp), r in zip(NORMALIZE_OK, rows):
        assert r.reject_reason is None, inp
        assert r.url == exp, inp


def test_normalize_rejects_exact_message(spark):
    rows = _norm(spark, [i for i, _ in NORMALIZE_REJECT])
    for (inp, exp), r in zip(NORMALIZE_REJECT, rows):
        assert r.reject_reason == exp, inp
        assert r.url is None


def test_seed_without_scheme_gets_host(spark):
    r = _norm(spark, ["example.dev"])[0]
    assert (r.host, r.host_reversed, r.path) == ("example.dev", "dev.example", "")


def test_normalize_extra(spark):
    cases = {
        "HTTP://Test.com/A": ("http://Test.com/A", None),  # scheme lower-cased, host case kept
        "http://h.com/x?": ("http://h.com/x", None),        # bare '?' dropped
        "http://h.com:443/x": ("http://h.com/x", None),     # 443 dropped whatever the scheme
        "http://h.com/für": ("http://h.com/f%C3%BCr", None),
        "http://h.com/the,": ("http://h.com/the,", None),
        "http://[::1]/": (None, "hostname is an ip adress: ::1"),
        "http://h.com/%zz": (None, "invalid URL escape"),
        "mailto:a@b.c": (None, "url scheme is not http or https: mailto"),
        "http://u:p@h.com/x": ("http://u:p@h.com/x", None),
    }
    rows = _norm(spark, list(cases))
    for (inp, (url, reason)), r in zip(cases.items(), rows):
        assert (r.url, r.reject_reason) == (url, reason), inp


def test_normalize_idempotent(spark):
    rows = _norm(spark, ["http://a.com/x/", "https://b.org/für die", "c.net/p"])
    again = _norm(spark, [r.url for r in rows])
    assert [r.url for r in rows] == [r.url for r in again]


RESOLVE = [
    ("http://h.com/a/b", "", "http://h.com/a/b"),
    ("http://h.com/a/b", "#x", "http://h.com/a/b"),
    ("http://h.com/a/b", "?q=1", "http://h.com/a/b"),
    ("http://h.com/a/b", "c", "http://h.com/a/c"),
    ("http://h.com/a/b", "a/../b/./c", "http://h.com/a/b/c"),
    ("http://h.com/a/b", "../../../x", "http://h.com/x"),
    ("http://h.com/a/b", "./", "http://h.com/a/"),
    ("http://h.com/a/b", "..", "http://h.com"),  # "/" is canonicalized to ""
    ("http://h.com", "x", "http://h.com/x"),
    ("https://h.com/a", "//other.com/x", "https://other.com/x"),
    ("http://h.com/a", "/a b", "http://h.com/a%20b"),
    ("http://h.com/a", "/für", "http://h.com/f%C3%BCr"),
    ("http://h.com/a", "/x?", "http://h.com/x"),
    ("http://h.com/a", "http://h.com:443/x", "http://h.com/x"),
    ("http://h.com/d/a", " /lead", "http://h.com/d/%20/lead"),
    ("http://h.com/a", "http://o.com/a/../b", "http://o.com/b"),
    ("http://h.com/a", "/", "http://h.com"),
]

RESOLVE_DROP = [
    ("http://h.com/a", "mailto:a@b.c"),
    ("http://h.com/a", "javascript:void(0)"),
    ("http://h.com/a", "http://[::1]/"),
    ("http://h.com/a", "http://h:8080/"),
    ("http://h.com/a", "/%zz"),
    ("http://h.com/a", "1a:b"),
    ("http://h.com/a", "/x\ny"),
]


def test_resolve(spark):
    df = spark.createDataFrame([(i, b, r) for i, (b, r, _) in enumerate(RESOLVE)], "i int, b string, r string")
    got = resolve_urls(df, "b", "r").orderBy("i").collect()
    for (b, r, exp), row in zip(RESOLVE, got):
        assert row.reject_reason is None, (b, r, row.reject_reason)
        assert row.url == exp, (b, r)


def test_resolve_drops(spark):
    df = spark.createDataFrame([(i, b, r) for i, (b, r) in enumerate(RESOLVE_DROP)], "i int, b string, r string")
    got = resolve_urls(df, "b", "r").orderBy("i").collect()
    for (b, r), row in zip(RESOLVE_DROP, got):
        assert row.url is None and row.reject_reason is not None, (b, r)


@pytest.mark.parametrize("path", ["", "/x", "/für die", "/a*b"])
def test_page_url_round_trip(spark, path):
    df = spark.createDataFrame([("https", "com.h", path)], "s string, hr string, p string")
    url = df.select(page_url(F.col("s"), F.col("hr"), F.col("p")).alias("u")).first().u
    back = _norm(spark, [url])[0]
    assert back.path == path and back.host_reversed == "com.h"


def _dot_model(full: str) -> str:
    """Plain-Python model of merge-and-remove-dot-segments on an escaped
    path, written from the segment rules (not from any implementation)."""
    if full == "":
        return ""
    out: list[str] = []
    segs = full.split("/")
    for e in segs:
        if e == ".":
            if not out:
                out = [""]
        elif e == "..":
            out = [] if len(out) <= 1 else out[:-1]
        else:
            out.append(e)
    r = "/" + "/".join(out) + ("/" if segs[-1] in (".", "..") else "")
    return r[1:] if r.startswith("//") else r


def test_remove_dot_segments_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from linkloom.functions.urls import remove_dot_segments

    seg = st.sampled_from(["", ".", "..", "a", "b", "c.d"])
    paths = st.lists(seg, min_size=0, max_size=7).map("/".join)
    samples = []

    @settings(max_examples=300, deadline=None)
    @given(paths, st.booleans())
    def collect(p, lead):
        samples.append(("/" + p) if lead else p)

    collect()
    df = spark.createDataFrame([(i, p) for i, p in enumerate(samples)], "i int, p string")
    got = df.select("i", "p", remove_dot_segments(F.col("p")).alias("r")).collect()
    for row in got:
        assert row.r == _dot_model(row.p), row.p


def test_non_ascii_host_is_escaped_in_url_only(spark):
    r = _norm(spark, ["http://bücher.de/x"])[0]
    assert r.url == "http://b%C3%BCcher.de/x"
    assert r.host == "bücher.de" and r.host_reversed == "de.bücher"


def test_plain_urls_are_what_the_whole_parse_makes_of_them(spark, monkeypatch):
    """A URL that is canonical as it stands is not taken apart; the result is the same as if it were."""
    from linkloom.functions import urls
    hosts = ["a.com", "A.b.Com", "1.2.3.4", "1.2.3.4a", "4.1.2.3", "a.1a", "a..b", "x_y.com", "localhost", "1", "é.de", "a.com:80", "u@a.com", ""]
    paths = ["", "/", "//", "/a", "/a/", "/a//b", "/./a", "/a/..", "/..a", "/a.b", "/a..", "/a~_-", "/%41", "/a+b", "/a?x", "/a#%zz", "/a\n", "/é"]
    made = [f"{s}{h}{p}" for s in ("http://", "https://", "HTTP://", "ftp://", "//", "") for h in hosts for p in paths]
    df = spark.createDataFrame(list(enumerate([*made, None])), "i int, u string")
    base = [F.lit(x) for x in ("https", "Base.org", "", "me@", "/d/e")]

    def parsed():
        monkeypatch.setattr(urls, "_BUILT", {})
        for err in (None, F.when(F.col("i") % 3 == 0, "bad base")):
            yield sorted(map(repr, urls.resolve_against(df, "u", *base, "t_", err).collect()))
        yield sorted(map(repr, urls.normalize_urls(df, "u").collect()))

    got = list(parsed())
    assert df.where(F.col("u").rlike(urls.RE_PLAIN_URL)).count() > 20
    monkeypatch.setattr(urls, "RE_PLAIN_URL", r"^(?!)(())()\z")
    assert got == list(parsed())
