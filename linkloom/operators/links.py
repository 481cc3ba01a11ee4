"""Link extraction and the edge table.

Plan shape for the bulk path: scan ``(page_id, url, html)`` -> one regex
pass per body producing an ``array<string>`` of hrefs -> ``posexplode``
-> resolve/canonicalize with native expressions -> ``distinct`` (partial
aggregation before the shuffle, keyed on ``(source, target)``).  The body
column is dropped right after extraction so nothing wide crosses a
shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.html import decoded, raw_anchor_values, unquoted
from ..functions.urls import normalize_urls, resolve_against


def canonical_pages(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Attach the canonical page URL (``source``) and the frontier key
    ``(scheme, host_reversed, path)``; pages whose URL is refused drop."""
    df = normalize_urls(pages, url_col, "c_")
    keep = [c for c in pages.columns]
    return df.where(F.col("c_reject_reason").isNull()).select(
        *keep, F.col("c_url").alias("source"), F.col("c_scheme").alias("scheme"),
        F.col("c_host").alias("host"), F.col("c_host_reversed").alias("host_reversed"),
        F.col("c_path").alias("path"), F.col("c_path_escaped").alias("path_escaped"))


def _user_prefix(url_col: str) -> F.Column:
    return F.regexp_extract(F.col(url_col), r"^[^:]+://([^@/]*@)?", 1)


def page_hrefs(pages: DataFrame, extract: str = "regex") -> DataFrame:
    """Canonical pages (one URL parse per page) with their raw hrefs:
    ``(page_id, source, scheme, host, path_escaped, user_prefix, pos, href)``.

    ``source`` is the canonical requested URL.  When ``pages`` has a
    ``final_url`` column (the URL after redirects), hrefs are resolved
    against it; the link source stays the requested URL."""
    if "final_url" in pages.columns:
        # both URLs are parsed in the page's own row: nothing is joined, and no page id need be unique
        req = canonical_pages(pages.select("page_id", "url", "final_url", "html"), "url").select(
            "page_id", F.coalesce("final_url", "url").alias("url"), "html", F.col("source").alias("requested"))
        canon = canonical_pages(req, "url").select(
            "page_id", "url", F.col("requested").alias("source"), "scheme", "host", "path_escaped", "html",
            _user_prefix("source").alias("user_prefix"))
    else:
        canon = canonical_pages(pages.select("page_id", "url", "html"), "url").select(
            "page_id", "url", "source", "scheme", "host", "path_escaped", "html",
            _user_prefix("source").alias("user_prefix"))
    if extract == "parser":
        from ..functions.html_parser import parser_links
        return parser_links(canon).drop("url")
    return _explode_hrefs(canon)


def _explode_hrefs(canon: DataFrame) -> DataFrame:
    arr = canon.select("page_id", "source", "scheme", "host", "path_escaped", "user_prefix",
                       raw_anchor_values(F.col("html")).alias("hrefs"))
    return (arr.select("page_id", "source", "scheme", "host", "path_escaped", "user_prefix",
                       F.posexplode("hrefs").alias("pos0", "raw"))
            .select("page_id", "source", "scheme", "host", "path_escaped", "user_prefix",
                    (F.col("pos0") + 1).alias("pos"), unquoted("raw").alias("raw"))
            .select("page_id", "source", "scheme", "host", "path_escaped", "user_prefix", "pos",
                    decoded("raw").alias("href")))


def _resolve(h: DataFrame) -> DataFrame:
    return resolve_against(h, "href", F.col("scheme"), F.col("host"), F.lit(""),
                           F.col("user_prefix"), F.col("path_escaped"), "t_")


def extract_raw_links(pages: DataFrame, extract: str = "regex") -> DataFrame:
    """``(page_id, url, pos, href)`` for every ``<a href>`` of every page,
    ``pos`` 1-based in document order, value entity-decoded (B6).

    ``extract="parser"`` uses Python's ``html.parser`` in ``mapInPandas``
    (full entity table, broken markup); the default stays in the JVM.
    """
    if extract == "parser":
        from ..functions.html_parser import parser_links
        return parser_links(pages.select("page_id", "url", "html"))
    arr = pages.select("page_id", "url", raw_anchor_values(F.col("html")).alias("hrefs"))
    return (arr.select("page_id", "url", F.posexplode("hrefs").alias("pos0", "raw"))
            .select("page_id", "url", (F.col("pos0") + 1).alias("pos"), unquoted("raw").alias("raw"))
            .select("page_id", "url", "pos", decoded("raw").alias("href")))


def resolve_links(pages: DataFrame, extract: str = "regex") -> DataFrame:
    """Every raw href resolved against its page's canonical URL (B7/B8):
    ``(page_id, source, pos, href, target, reject_reason)``; ``target`` is
    null for a refused link."""
    res = _resolve(page_hrefs(pages, extract))
    return res.select("page_id", "source", "pos", "href",
                      F.col("t_url").alias("target"),
                      F.col("t_reject_reason").alias("reject_reason"))


def page_links(pages: DataFrame, extract: str = "regex") -> DataFrame:
    """Distinct accepted edges ``(source, target)`` (B8 + E1)."""
    return (resolve_links(pages, extract).where(F.col("reject_reason").isNull())
            .select("source", "target").distinct())


def link_groups(links: DataFrame) -> DataFrame:
    """``(source, targets)``: a page and all its distinct outgoing links
    (B9).  The set per source is bounded by the links on one page."""
    return links.groupBy("source").agg(F.array_sort(F.collect_set("target")).alias("targets"))


def flatten_groups(groups: DataFrame) -> DataFrame:
    """Edges of link groups."""
    return groups.select("source", F.explode("targets").alias("target"))


def insert_links(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``new`` absent from ``existing`` by key (source, target),
    de-duplicated (A6).  Returns only the rows to append."""
    fresh = new.select("source", "target").distinct()
    return fresh.join(existing.select("source", "target"), ["source", "target"], "left_anti")


def replace_links(links: DataFrame, recrawled: DataFrame) -> DataFrame:
    """Link refresh (H3): a page that was read again owns exactly the links
    seen on it now.  ``recrawled`` holds ``(source, target)`` edges of the
    re-read pages plus, for re-read pages without links, a row with a null
    target.  Old edges of those sources go, new ones come in."""
    sources = recrawled.select("source").distinct()
    kept = links.join(sources, "source", "left_anti")
    return kept.unionByName(recrawled.where(F.col("target").isNotNull())
                            .select("source", "target").distinct())


def host_of(url_col: str) -> F.Column:
    """Host of a canonical URL string (``scheme://[user@]host/...``)."""
    return F.regexp_extract(F.col(url_col), r"^[^:]+://(?:[^@/]*@)?([^/]*)", 1)


def backlink_counts(links: DataFrame) -> DataFrame:
    """Per target: number of linking pages and of distinct linking hosts
    (E9 bulk).  Two-level aggregation: first on (target, host) so the
    distinct count never holds a hot target's host set in one task."""
    per_host = (links.select("target", host_of("source").alias("src_host"))
                .groupBy("target", "src_host").agg(F.count(F.lit(1)).alias("n")))
    return per_host.groupBy("target").agg(
        F.sum("n").alias("backlinks"), F.count(F.lit(1)).alias("referring_hosts"))


def backlinks_of(links: DataFrame, targets: DataFrame) -> DataFrame:
    """All sources linking to each URL of ``targets(target)`` (E9 lookup).
    ``targets`` is expected small (a request batch); Spark broadcasts it
    when its statistics say it is below the broadcast threshold."""
    return links.join(targets.select("target").distinct(), "target", "left_semi")


def link_keys(pages: DataFrame, extract: str = "regex") -> DataFrame:
    """Accepted links with the frontier key of their target:
    ``(page_id, pos, source, target, scheme, host_reversed, path)``."""
    res = _resolve(page_hrefs(pages, extract))
    return res.where(F.col("t_reject_reason").isNull()).select(
        "page_id", "pos", "source", F.col("t_url").alias("target"),
        F.col("t_scheme").alias("scheme"), F.col("t_host_reversed").alias("host_reversed"),
        F.col("t_path").alias("path"))
