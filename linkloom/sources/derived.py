"""Tables derived from the driver's Parquet data.

The archive has no response headers, robots files, request log or
cross-host link graph, so these are derived by plain, deterministic
expressions (each one also written in DuckDB SQL for the oracle).  Every
derivation is a narrow projection or one aggregation over the given
tables, so it grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import normalize_urls
from .tables import read_pages, read_table


#: Markup that a page's number goes into (at ``{n}``).
ANCHOR_MARKUP = [
    "<a href>self</a><a href=>self</a>", '<a class="x"href="/y{n}">', "<a href=/it's{n}>", '<a href="/caf&eacute;{n}">',
    '<a href="/a&#38;lt;b{n}">', '<a href="/&#0000000065;&#x00000041;&#99999999;&#x80;{n}">',
    '<noscript><a href="/n{n}"></noscript><iframe><a href="/n"></iframe ><A HREF = \'/k{n}\'>',
    '<xmp><a href="/n{n}"></xmp><textarea><a href="/n"></textarea><a data-href="/d" href="/e{n}">',
    '<a href="/x{n}?a=1&copy=2&amp;b&amp&copy">', '<abbr href="/z{n}"><a hrefx="/1" href="/2/{n}" href="/3">',
    '<a title = "a>b" href=/u/{n}/><a\nhref="/nl{n}"/>', '<a href="/p{n}">a</a><!-- open <a href="/c{n}">',
    """<img alt='<a href="/x">'><div data-t="<a href='/tip'>"><a href="/i{n}">""",
    '<!--><a href="/y{n}"><!-- c --!><a href="/w{n}">', '<a =x href="/e{n}"><plaintext><a href="/p">',
    '<!---><a href="/h{n}"></ <a href="/b">><a href="/g{n}">',
    """<a title=x"y href="/u{n}" href="/v"><a/href=/s{n}><a class='q'"href="/t"><a hr\x0bef="/m" href=>""",
    '<? <a href="/q"> ?><SCRIPT a=">">"<a href=/s></script a="</script>"><a href="/r{n}"><a href="/open{n}',
]
#: A tag of 20,000 attributes, and a megabyte in a quote that is never closed.
ANCHOR_FLOODS = ["<a" + ' x="y" z' * 10_000 + ' href="/f{n}">', '<a href="/o{n}"><a title="' + "x<a href=/n " * 90_000]


def anchor_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of each page's number with markup that is easily misread, by ``page_id``."""
    cases = [*ANCHOR_MARKUP, *ANCHOR_FLOODS]
    n = F.col("page_id")
    markup = F.element_at(F.array(*map(F.lit, cases)), (F.pmod(n, F.lit(len(cases))) + 1).cast("int"))
    return read_pages(spark, sf_dir).select("page_id", "url", F.replace(markup, F.lit("{n}"), n.cast("string")).alias("html"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` plus status / content type / robots header derived from
    ``page_id`` (404/204/429 for id%10 = 7/8/9; pdf for id%6 = 5;
    ``noindex, nofollow`` for id%8 = 3, null for id%8 = 4)."""
    pid = F.col("page_id")
    return read_pages(spark, sf_dir).select(
        "page_id", "url",
        F.when(pid % 10 == 7, 404).when(pid % 10 == 8, 204).when(pid % 10 == 9, 429)
        .otherwise(200).cast("int").alias("status"),
        F.when(pid % 6 == 5, "application/pdf").otherwise("text/html; charset=utf-8")
        .alias("content_type"),
        F.when(pid % 8 == 3, "noindex, nofollow").when(pid % 8 == 4, F.lit(None))
        .otherwise("").alias("x_robots_tag"),
        "html")


# --- fixed values: robots files of the fixture hosts, by first host label ---
ROBOTS_FIXTURE = {
    "blog": (200, "text/plain", "\ufeffUser-agent: *\nDisallowed: /*.html\n"),
    "www": (200, "Text/Plain; charset=utf-8", "User-agents: *\nDisallow: /en/\nAllow: /en/1*\nDisallow: /%c3%bc/\n"),
    "m": (200, "text/plain", "User-agent: BacklinksBot\nDisallow: /de/\n\nUser-agent: *\nDisallow: /\n"),
    "other": (404, "text/html", "not found"),
}


def robots_responses(spark: SparkSession, sf_dir: str, hosts: DataFrame | None = None) -> DataFrame:
    """One robots response per distinct host of ``pages`` (or of ``hosts``
    when the caller already has them)."""
    if hosts is None:
        hosts = (normalize_urls(read_pages(spark, sf_dir).select("url"), "url", "n_")
                 .where(F.col("n_reject_reason").isNull())
                 .select(F.col("n_host").alias("host")))
    hosts = hosts.select("host").distinct()
    label = F.split(F.col("host"), r"\.").getItem(0)

    def pick(i):
        expr = None
        for key in ("blog", "www", "m"):
            cond = label == key
            expr = F.when(cond, F.lit(ROBOTS_FIXTURE[key][i])) if expr is None \
                else expr.when(cond, F.lit(ROBOTS_FIXTURE[key][i]))
        return expr.otherwise(F.lit(ROBOTS_FIXTURE["other"][i]))

    return hosts.select("host", pick(0).cast("int").alias("status"),
                        pick(1).alias("content_type"), pick(2).alias("body"))


def node_url(k) -> F.Column:
    return F.concat(F.lit("http://s"), (k % 50).cast("string"), F.lit(".example.com/p/"),
                    k.cast("string"))


def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The node numbers ``s, t`` of G1's edges, a row for each line."""
    n_parts = read_table(spark, sf_dir, "part").agg(F.count(F.lit(1))).scalar()
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("s"), (F.col("l_orderkey") % n_parts).alias("t"))


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: distinct (l_partkey, l_orderkey % count(part)) edges of all lines.

    ``count(part)`` is a scalar subquery, evaluated once and inlined."""
    e = graph_nodes(spark, sf_dir).distinct()
    return e.select(node_url(F.col("s")).alias("source"), node_url(F.col("t")).alias("target"),
                    F.col("s").alias("s_node"), F.col("t").alias("t_node"))


def graph_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 pages: one page per source node whose html links to its targets."""
    e = graph_edges(spark, sf_dir)
    anchors = F.array_join(
        F.transform(F.array_sort(F.collect_list("target")),
                    lambda t: F.concat(F.lit('<a href="'), t, F.lit('">x</a>'))), "")
    return (e.groupBy("s_node", "source")
            .agg(anchors.alias("anchors"))
            .select(F.col("s_node").alias("page_id"), F.col("source").alias("url"),
                    F.concat(F.lit("<html><body>"), F.col("anchors"), F.lit("</body></html>"))
                    .alias("html")))


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log derived from ``events`` (host per user, HEAD for clicks,
    429 for errors and every seventh event's clicks, 301 for signups, duration = value/100)."""
    et = F.col("event_type")
    return read_table(spark, sf_dir, "events").select(
        "event_id", "ts",
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit(".example.com")).alias("host"),
        F.when(et == "click", "HEAD").otherwise("GET").alias("method"),
        F.when((et == "error") | ((et == "click") & (F.col("event_id") % 7 == 0)), 429).when(et == "signup", 301).otherwise(200).cast("int").alias("code"),
        (F.col("value") / 100).alias("duration_s"),
        F.when(et == "error", "ERROR").when(et == "signup", "WARN").otherwise("INFO").alias("level"))


def seed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed text lines built from every page URL: three URLs per line,
    separated by mixed white space; pages with id%10 = 1 also get a
    scheme twin (http<->https) and pages with id%10 = 2 a duplicate, each
    placed right after the original so the original arrives first."""
    pages = read_pages(spark, sf_dir).select("page_id", "url")
    pid = F.col("page_id")
    twin = pages.where(pid % 10 == 1).select(
        (pid.cast("double") + F.lit(0.5)).alias("k"),
        F.when(F.col("url").startswith("https://"), F.regexp_replace("url", "^https://", "http://"))
        .otherwise(F.regexp_replace("url", "^http://", "https://")).alias("url"))
    dup = pages.where(pid % 10 == 2).select((pid.cast("double") + F.lit(0.25)).alias("k"), "url")
    rows = pages.select(pid.cast("double").alias("k"), "url").unionByName(dup).unionByName(twin)
    line = F.floor(F.col("k") / 3).alias("line_no")
    return (rows.groupBy(line)
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "url"))),
                                          lambda s: s["url"]), " \t ").alias("value"))
            .select("line_no", "value"))


def url_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rewrites of every page URL that exercise the canonical-URL rules:
    upper-case scheme, explicit ports, other schemes, IP hosts, no scheme,
    root path, user info, non-ASCII and badly escaped paths, bare ``?``.
    ``(page_id, kind, input)``."""
    u, pid = F.col("url"), F.col("page_id")
    scheme = F.regexp_extract(u, r"^([A-Za-z]+)://", 1)
    host = F.regexp_extract(u, r"^[A-Za-z]+://([^/?#]*)", 1)
    suffix = F.regexp_extract(u, r"^[A-Za-z]+://[^/?#]*(.*)$", 1)
    prefix = F.concat(scheme, F.lit("://"), host)
    port = (F.when(pid % 4 == 0, "80").when(pid % 4 == 1, "443")
            .when(pid % 4 == 2, "8080").otherwise(""))
    ip = F.when(pid % 2 == 0, F.concat(F.lit("10."), (pid % 256).cast("string"), F.lit(".0.1"))) \
        .otherwise(F.lit("[::1]"))
    kinds = [
        ("raw", u),
        ("upper_scheme", F.concat(F.upper(scheme), F.lit("://"), host, suffix)),
        ("port", F.concat(prefix, F.lit(":"), port, suffix)),
        ("ftp", F.concat(F.lit("ftp://"), host, suffix)),
        ("ip", F.concat(scheme, F.lit("://"), ip, suffix)),
        ("bare", F.concat(host, suffix)),
        ("root", F.concat(prefix, F.lit("/"))),
        ("userinfo", F.concat(scheme, F.lit("://user:pw@"), host, suffix)),
        ("non_ascii", F.concat(prefix, F.lit("/für die/"), pid.cast("string"), F.lit("*x"))),
        ("bad_escape", F.concat(prefix, F.lit("/%zz"))),
        ("force_query", F.concat(prefix, F.regexp_extract(u, r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1),
                                 F.lit("?"))),
        ("dots", F.concat(prefix, F.lit("/a/../b/./c"))),
        ("idn_host", F.concat(scheme, F.lit("://bücher-"), pid.cast("string"), F.lit(".example"), suffix)),
    ]
    arr = F.array(*[F.struct(F.lit(k).alias("kind"), e.alias("input")) for k, e in kinds])
    return (read_pages(spark, sf_dir).select("page_id", "url")
            .select("page_id", F.inline(arr)))


def graph_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 pages as fetched responses, with the same status / type / robots
    header rules as :func:`responses` applied to the node number."""
    gp = graph_pages(spark, sf_dir)
    pid = F.col("page_id")
    return gp.select(
        "page_id", "url",
        F.when(pid % 10 == 7, 404).when(pid % 10 == 8, 204).when(pid % 10 == 9, 429)
        .otherwise(200).cast("int").alias("status"),
        F.when(pid % 6 == 5, "application/pdf").otherwise("text/html; charset=utf-8")
        .alias("content_type"),
        F.when(pid % 8 == 3, "noindex, nofollow").when(pid % 8 == 4, F.lit(None))
        .otherwise("").alias("x_robots_tag"),
        "html")


# --- fixed values: robots file of the G1 hosts s<k> with k % 5 = 0 -------------
GRAPH_ROBOTS = "User-agent: *\nDisallow: /p/1\n"


def graph_robots_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Robots responses of the G1 hosts: ``s<k>.example.com`` with
    ``k % 5 = 0`` disallow paths starting with ``/p/1``; the others 404."""
    e = graph_nodes(spark, sf_dir)
    # a node's host is known by its number's rest, so URLs are written for one node of each
    rest = e.select(F.col("s") % 50).union(e.select(F.col("t") % 50)).toDF("k").distinct()
    hosts = rest.select(F.regexp_extract(node_url(F.col("k")), r"^http://([^/]*)", 1).alias("host")).distinct()
    k = F.regexp_extract("host", r"^s([0-9]+)\.", 1).cast("int")
    on = k % 5 == 0
    return hosts.select("host", F.when(on, 200).otherwise(404).cast("int").alias("status"),
                        F.when(on, "text/plain").otherwise("text/html").alias("content_type"),
                        F.when(on, GRAPH_ROBOTS).otherwise("not found").alias("body"))
