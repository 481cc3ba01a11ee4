"""URL canonicalization as native Spark column expressions.

A URL is kept as plain string columns: ``scheme``, ``host`` (case kept),
``host_reversed``, ``path`` (decoded) and ``path_escaped`` (the form used
inside URL strings), plus the canonical string ``url``.  Nothing here is a
Python UDF: every step is a regex/string expression that stays inside
whole-stage code generation (higher-order functions only on the rare rows
that contain dot segments).

The functions work on a DataFrame and add columns with a caller-chosen
prefix.  The rules are a chain of projections, each of which refers to the one
before by name: Catalyst merges two only where that copies no expensive expression, so
each regex is evaluated once per row.  The last step of a parse is a one-element ``inline``, below
which no filter of a consumer can be pushed (it would take a copy of the whole chain along).
The steps' expressions depend on column names alone and are built once per session.
"""

from __future__ import annotations

from functools import wraps

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (must equal the canonical-URL rules being matched) -------
ALLOWED_SCHEMES = ["http", "https"]
DEFAULT_SCHEME = "http"
ALLOWED_PORTS = ["80", "443"]
REJECT_SCHEME = "url scheme is not http or https: "
REJECT_PORT = "port is not 80 or 443: "
REJECT_IP = "hostname is an ip adress: "
# own reasons for inputs the URL parser itself refuses
REJECT_CONTROL = "invalid control character in URL"
REJECT_MISSING_SCHEME = "missing protocol scheme"
REJECT_COLON = "first path segment in URL cannot contain colon"
REJECT_BAD_PORT = "invalid port after host"
REJECT_BRACKET = "missing ']' in host"
REJECT_HOST_CHAR = "invalid character in host name"
REJECT_ESCAPE = "invalid URL escape"
REJECT_EMPTY_HOST = "empty host"
# ---------------------------------------------------------------------------

# Regex building blocks (valid in Java regex and RE2).
RE_CONTROL = r"[\x00-\x1f\x7f]"
RE_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
# characters a path may hold verbatim, plus %XX escapes
RE_VALID_ENCODED_PATH = r"^([A-Za-z0-9\-._~!$&'()*+,;=:@\[\]/]|%[0-9A-Fa-f]{2})*$"
RE_HOST_OK = r"^[A-Za-z0-9\-._~!$&'()*+,;=:\[\]<>\"\x{80}-\x{10FFFF}]*$"
RE_IPV4 = r"^((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$"
RE_IPV6 = r"^[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*$"
RE_DOT_SEGMENT = r"(^|/)\.\.?(/|$)"
# an absolute URL that is canonical as it stands: a name as host whose last label begins with a letter, and
# segments of unreserved characters that do not begin with a dot
RE_PLAIN_URL = (r"^(https?)://((?:[A-Za-z0-9\-]++\.)*+[A-Za-z][A-Za-z0-9\-]*+)"
                r"((?:/[A-Za-z0-9\-_~][A-Za-z0-9\-_~.]*+)++/?+)\z")


def reverse_hostname(col: Column) -> Column:
    """``a.b.com`` <-> ``com.b.a`` (self-inverse)."""
    return F.array_join(F.reverse(F.split(col, r"\.")), ".")


def escape_path(decoded: Column) -> Column:
    """Percent-encode a decoded path, leaving ``A-Za-z0-9-_.~$&+,/:;=@`` bare.

    ``url_encode`` is form-style (space->'+', keeps ``*``, escapes ``~/,:;=@$&+``);
    the replacements turn it into path escaping.
    """
    e = F.url_encode(decoded)
    e = F.replace(e, F.lit("*"), F.lit("%2A"))
    e = F.replace(e, F.lit("+"), F.lit("%20"))
    for enc, ch in (("%7E", "~"), ("%24", "$"), ("%26", "&"), ("%2B", "+"),
                    ("%2C", ","), ("%2F", "/"), ("%3A", ":"), ("%3B", ";"),
                    ("%3D", "="), ("%40", "@")):
        e = F.replace(e, F.lit(enc), F.lit(ch))
    return e


def escape_host(host: Column) -> Column:
    """Host as written in a URL string: non-ASCII bytes percent-encoded
    (UTF-8, upper-case hex); the ASCII characters a host may hold stay."""
    e = F.url_encode(host)
    for enc, ch in (("%7E", "~"), ("%21", "!"), ("%24", "$"), ("%26", "&"), ("%27", "'"),
                    ("%28", "("), ("%29", ")"), ("%2B", "+"), ("%2C", ","), ("%3B", ";"),
                    ("%3D", "="), ("%3A", ":"), ("%5B", "["), ("%5D", "]"), ("%3C", "<"),
                    ("%3E", ">"), ("%22", '"')):
        e = F.replace(e, F.lit(enc), F.lit(ch))
    return F.when(host.rlike(r"[^\x00-\x7f]"), e).otherwise(host)


def decode_path(escaped: Column) -> Column:
    """Percent-decode a path; '+' stays '+' (path, not form, decoding)."""
    return F.try_url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B")))


def escaped_form(raw: Column) -> Column:
    """String form of a raw path: verbatim when it only holds legal path
    characters, else the decoded path re-escaped."""
    return F.when(raw.rlike(RE_VALID_ENCODED_PATH), raw).otherwise(escape_path(decode_path(raw)))


def has_bad_escape(raw: Column) -> Column:
    return F.regexp_replace(raw, r"%[0-9A-Fa-f]{2}", "").contains("%")


def remove_dot_segments(full: Column) -> Column:
    """Merge-and-remove-dots of a resolved (escaped) path.

    Segment list semantics: '.' keeps the list (turning an empty list into
    one empty segment), '..' drops the last segment (empties a list of one),
    anything else appends.  A final '.'/'..' leaves a trailing slash.
    Rows without dot segments take the cheap branch.
    """
    segs = F.split(full, "/")

    def step(acc, e):
        return (F.when(e == ".", F.when(F.size(acc) == 0, F.array(F.lit(""))).otherwise(acc))
                .when(e == "..", F.when(F.size(acc) <= 1, F.array().cast("array<string>"))
                      .otherwise(F.slice(acc, 1, F.size(acc) - 1)))
                .otherwise(F.concat(acc, F.array(e))))

    joined = F.concat(
        F.lit("/"),
        F.array_join(F.aggregate(segs, F.array().cast("array<string>"), step), "/"),
        F.when(F.element_at(segs, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit("")),
    )
    slow = F.when(joined.startswith("//"), joined.substr(F.lit(2), F.length(joined))).otherwise(joined)
    fast = F.when(full.startswith("/"), full).otherwise(F.concat(F.lit("/"), full))
    return (F.when(full == "", F.lit(""))
            .when(full.rlike(RE_DOT_SEGMENT), slow)
            .otherwise(fast))


_BUILT: dict = {}


def built_once(make):
    """Keep what ``make`` builds from names for the rest of the session: a parse is some thousand calls
    to the JVM otherwise, more than a small job takes."""
    @wraps(make)
    def get(*names):
        sc = SparkContext._active_spark_context
        key = (make.__name__, names, sc and sc.applicationId)
        if key not in _BUILT:
            _BUILT[key] = make(*names)
        return _BUILT[key]
    return get


def _step(**cols: Column) -> list[Column]:
    return [c.alias(n) for n, c in cols.items()]


def _through(df: DataFrame, steps: list[list[Column]], last: list[Column]) -> DataFrame:
    """The rows with the columns of ``last``, by way of the steps' columns."""
    given = [f"`{c}`" for c in df.columns]
    for step in steps:
        df = df.select("*", *step)
    return df.select(*given, F.inline(F.array(F.struct(*last))))


def _parse_steps(col: str, p: str) -> list[list[Column]]:
    """Steps that split a URL reference into its parts (columns prefixed ``p``).

    ``{p}has_scheme``, ``{p}scheme_raw``, ``{p}opaque``, ``{p}has_auth``,
    ``{p}userinfo``, ``{p}has_user``, ``{p}host``, ``{p}port``,
    ``{p}path_raw``, ``{p}perr`` (parse error text or null).
    """
    u = F.col(col)
    c = lambda n: F.col(f"{p}{n}")
    steps = [_step(**{
        f"{p}scheme_raw": F.regexp_extract(u, RE_SCHEME, 1),
        f"{p}pathq": F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?([^?#]*)", 1),
        f"{p}early_err": F.when(u.rlike(RE_CONTROL), F.lit(REJECT_CONTROL))
        .when(u.startswith(":"), F.lit(REJECT_MISSING_SCHEME))
        .when(has_bad_escape(F.regexp_extract(u, r"^[^#]*#(.*)$", 1)), F.lit(REJECT_ESCAPE)),
    })]
    pq = c("pathq")
    hs = c("scheme_raw") != ""
    opaque = hs & ~pq.startswith("/")
    has_auth = pq.startswith("//") & (hs | ~pq.startswith("///"))
    steps.append(_step(**{
        f"{p}has_scheme": hs, f"{p}opaque": opaque, f"{p}has_auth": has_auth,
        f"{p}authority": F.when(has_auth, F.regexp_extract(pq, r"^//([^/]*)", 1)).otherwise(F.lit("")),
    }))
    hs, opaque, has_auth, authority = c("has_scheme"), c("opaque"), c("has_auth"), c("authority")
    hostport = F.regexp_extract(authority, r"([^@]*)$", 1)
    steps.append(_step(**{
        f"{p}path_raw": F.when(has_auth, F.regexp_extract(pq, r"^//[^/]*(.*)$", 1))
        .when(opaque, F.lit("")).otherwise(pq),
        f"{p}colon_err": ~hs & ~pq.startswith("/") & F.regexp_extract(pq, r"^([^/]*)", 1).contains(":"),
        f"{p}has_user": authority.contains("@"),
        f"{p}userinfo": F.regexp_extract(authority, r"^(.*)@", 1),
        f"{p}hostport": hostport,
    }))
    hp = c("hostport")
    bracket = hp.startswith("[")
    host = (F.when(bracket, F.regexp_extract(hp, r"^\[([^\]]*)\]", 1))
            .when(hp.contains(":"), F.regexp_extract(hp, r"^(.*):[^:]*$", 1))
            .otherwise(hp))
    portpart = (F.when(bracket, F.regexp_extract(hp, r"^\[[^\]]*\](.*)$", 1))
                .when(hp.contains(":"), F.regexp_extract(hp, r"(:[^:]*)$", 1))
                .otherwise(F.lit("")))
    steps.append(_step(**{f"{p}host": host, f"{p}portpart": portpart}))
    pp = c("portpart")
    steps.append(_step(**{
        f"{p}port": F.regexp_extract(pp, r"^:(.*)$", 1),
        f"{p}perr": F.when(c("early_err").isNotNull(), c("early_err"))
        .when(c("colon_err"), F.lit(REJECT_COLON))
        .when(bracket & ~hp.rlike(r"^\[[^\]]*\]"), F.lit(REJECT_BRACKET))
        .when(~pp.rlike(r"^(:[0-9]*)?$"), F.lit(REJECT_BAD_PORT))
        .when(~c("host").rlike(RE_HOST_OK), F.lit(REJECT_HOST_CHAR))
        .when(has_bad_escape(c("path_raw")), F.lit(REJECT_ESCAPE)),
    }))
    return steps


def _unless_plain(url: str, p: str, but: Column | None = None) -> list[list[Column]]:
    """Steps that set plain URLs aside: ``{p}plain`` says whether a URL is one (and ``but`` is not null), ``{p}url`` is
    null then, so that the steps which take it apart have nothing to do, else the URL."""
    plain = F.col(url).rlike(RE_PLAIN_URL)
    return [_step(**{f"{p}plain": plain if but is None else plain & but.isNull()}),
            _step(**{f"{p}url": F.when(F.col(f"{p}plain"), F.lit(None)).otherwise(F.col(url))})]


def _finish(p: str, out: str, given: str, scheme: Column, user: Column, host: Column, port: Column, escaped: Column,
            perr: Column, opaque: Column) -> tuple[list[list[Column]], list[Column]]:
    """Steps that apply the canonical rules to resolved parts, and the output columns.  ``user`` ends in
    ``@`` or is empty.  A plain URL in ``given`` is its own canonical form."""
    c = lambda n: F.col(f"{p}f_{n}")
    sc, h, pt = c("scheme"), c("host"), c("port")
    steps = [_step(**{
        f"{p}f_scheme": F.lower(scheme), f"{p}f_user": user, f"{p}f_host": host, f"{p}f_port": port,
        f"{p}f_esc": escaped, f"{p}f_perr": perr, f"{p}f_opaque": opaque,
    }), _step(**{
        f"{p}f_dec": decode_path(c("esc")),
        f"{p}f_reason": F.when(c("perr").isNotNull(), c("perr"))
        .when(~sc.isin(*ALLOWED_SCHEMES), F.concat(F.lit(REJECT_SCHEME), sc))
        .when((pt != "") & ~pt.isin(*ALLOWED_PORTS), F.concat(F.lit(REJECT_PORT), pt))
        .when(h.rlike(RE_IPV4) | h.rlike(RE_IPV6), F.concat(F.lit(REJECT_IP), h))
        .when(c("opaque") | (h == ""), F.lit(REJECT_EMPTY_HOST)),
    })]
    ok = c("reason").isNull()
    is_root = c("dec") == "/"
    esc = F.when(is_root, F.lit("")).otherwise(c("esc"))
    whole, plain = F.col(given), F.col(f"{p}plain")
    part = lambda i: F.regexp_extract(whole, RE_PLAIN_URL, i)
    either = lambda own, other: F.when(plain, own).otherwise(other)
    steps.append(_step(**{
        f"{p}o_scheme": either(part(1), sc), f"{p}o_host": either(part(2), h), f"{p}o_path": either(part(3), c("dec")),
    }))
    o = lambda n: F.col(f"{p}o_{n}")
    return steps, _step(**{
        f"{out}url": either(whole, F.when(ok, F.concat(sc, F.lit("://"), c("user"), escape_host(h), esc))),
        f"{out}scheme": F.when(plain | ok, o("scheme")),
        f"{out}host": F.when(plain | ok, o("host")),
        f"{out}host_reversed": F.when(plain | ok, reverse_hostname(o("host"))),
        f"{out}path": F.when(plain, o("path")).when(ok, F.when(is_root, F.lit("")).otherwise(o("path"))),
        f"{out}path_escaped": F.when(plain, o("path")).when(ok, esc),
        f"{out}reject_reason": F.when(~plain | plain.isNull(), c("reason")),
    })


def _with_at(has_user: Column, userinfo: Column) -> Column:
    return F.when(has_user, F.concat(userinfo, F.lit("@"))).otherwise(F.lit(""))


OUT_FIELDS = ["url", "scheme", "host", "host_reversed", "path", "path_escaped", "reject_reason"]


@built_once
def _normalizing(col: str, out: str) -> tuple[list[list[Column]], list[Column]]:
    p = "_nu_"
    c = lambda n: F.col(f"{p}{n}")
    bare = ~c("has_scheme") & ~c("has_auth")
    steps = _unless_plain(col, p) + _parse_steps(f"{p}url", p) + [_step(**{
        f"{p}host2": F.when(bare, F.regexp_extract(c("path_raw"), r"^([^/]*)", 1)).otherwise(c("host")),
        f"{p}raw2": F.when(bare, F.regexp_extract(c("path_raw"), r"^[^/]*(.*)$", 1))
        .otherwise(c("path_raw")),
    }), _step(**{f"{p}esc2": escaped_form(c("raw2"))})]
    scheme = F.when(c("has_scheme"), c("scheme_raw")).otherwise(F.lit(DEFAULT_SCHEME))
    more, last = _finish(p, out, col, scheme, _with_at(c("has_user"), c("userinfo")), c("host2"), c("port"),
                         c("esc2"), c("perr"), c("opaque"))
    return steps + more, last


def normalize_urls(df: DataFrame, col: str, out: str = "") -> DataFrame:
    """Canonicalize a column of stand-alone URLs (B1, B2).

    Adds ``{out}url, {out}scheme, {out}host, {out}host_reversed, {out}path,
    {out}path_escaped, {out}reject_reason``; the first six are null for a
    rejected row.  A URL without scheme and without ``//`` takes its first
    path segment as host (``example.org/x`` -> ``http://example.org/x``).
    """
    return _through(df, *_normalizing(col, out))


def resolve_urls(df: DataFrame, base: str, ref: str, out: str = "") -> DataFrame:
    """Resolve reference ``ref`` against the canonical URL in ``base`` and
    canonicalize the result (B7 + B8).  Same output columns as
    :func:`normalize_urls`; an unparsable reference gets a reject reason.
    When the base is already split (canonical pages), prefer
    :func:`resolve_against`, which parses only the reference.
    """
    b = "_rb_"
    bc = lambda n: F.col(f"{b}{n}")
    last = _step(**{f"{b}{n}": bc(n) for n in ("scheme_raw", "host", "port", "perr")},
                 **{f"{b}esc": escaped_form(bc("path_raw")), f"{b}user": _with_at(bc("has_user"), bc("userinfo"))})
    df = _through(df, _parse_steps(base, b), last)
    df = resolve_against(df, ref, bc("scheme_raw"), bc("host"), bc("port"), bc("user"), bc("esc"),
                         out, base_err=bc("perr"))
    return df.drop(*[c for c in df.columns if c.startswith(b)])


@built_once
def _resolving(ref: str, out: str, checked_base: bool) -> tuple[list[list[Column]], list[Column]]:
    p = "_ru_"
    c = lambda n: F.col(f"{p}{n}")
    er, eb = c("esc_ref"), c("b_esc")
    own_auth = c("has_scheme") | c("has_auth")
    full = (F.when(own_auth, er)
            .when(er == "", eb)
            .when(er.startswith("/"), er)
            .otherwise(F.concat(F.regexp_extract(eb, r"^(.*/)", 1), er)))
    aside = _unless_plain(ref, p, c("b_err") if checked_base else None)
    steps = aside + _parse_steps(f"{p}url", p) + [_step(**{f"{p}esc_ref": escaped_form(c("path_raw"))}), _step(**{f"{p}full": full}),
                                    _step(**{f"{p}resolved": remove_dot_segments(c("full"))})]
    scheme = F.when(c("has_scheme"), c("scheme_raw")).otherwise(c("b_scheme"))
    more, last = _finish(
        p, out, ref, scheme, F.when(own_auth, _with_at(c("has_user"), c("userinfo"))).otherwise(c("b_user")),
        F.when(own_auth, c("host")).otherwise(c("b_host")), F.when(own_auth, c("port")).otherwise(c("b_port")),
        c("resolved"), F.coalesce(c("perr"), c("b_err")) if checked_base else c("perr"), c("opaque"))
    return steps + more, last


def resolve_against(df: DataFrame, ref: str, scheme: Column, host: Column, port: Column,
                    user_prefix: Column, path_escaped: Column, out: str = "",
                    base_err: Column | None = None) -> DataFrame:
    """Resolve ``ref`` against a base given by its parts (scheme, host,
    port, ``user@`` prefix, escaped path) and canonicalize (B7 + B8)."""
    p = "_ru_"
    parts = {"b_scheme": scheme, "b_host": host, "b_port": port, "b_user": user_prefix, "b_esc": path_escaped}
    if base_err is not None:
        parts["b_err"] = base_err
    steps, last = _resolving(ref, out, base_err is not None)
    return _through(df, [_step(**{f"{p}{n}": v for n, v in parts.items()}), *steps], last)


def page_url(scheme: Column, host_reversed: Column, path: Column) -> Column:
    """Rebuild a URL string from the stored frontier key."""
    return F.concat(scheme, F.lit("://"), escape_host(reverse_hostname(host_reversed)), escape_path(path))
