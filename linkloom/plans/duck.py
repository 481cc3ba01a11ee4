"""DuckDB SQL builders for the oracle queries.

These write the URL and HTML rules anew, in other means than ``linkloom.functions`` and without
any pattern of theirs: strings are cut at the first or last of a sign, sets of
characters are tested by deleting them.  So the Spark results are checked against an
independent reading of the rules on the same Parquet tables.  Each builder wraps a source query
and adds columns; temporary columns are removed at the end.
"""

from __future__ import annotations

import html.entities

_DIGITS, _LETTERS = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_NAME = _LETTERS + _LETTERS.upper() + _DIGITS + "-._~"
# --- fixed values: the texts of refusals ---------------------------------------
NOT_HTTP, BAD_PORT, IS_IP = "url scheme is not http or https: ", "port is not 80 or 443: ", "hostname is an ip adress: "
CONTROL, NO_SCHEME = "invalid control character in URL", "missing protocol scheme"
COLON, PORT_SYNTAX = "first path segment in URL cannot contain colon", "invalid port after host"
BRACKET, HOST_SYNTAX = "missing ']' in host", "invalid character in host name"
ESCAPE, NO_HOST = "invalid URL escape", "empty host"
# ---------------------------------------------------------------------------------


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(col: str, pattern: str) -> str:
    return f"regexp_matches({col}, {lit(pattern)})"


def ext(col: str, pattern: str, g: int = 1) -> str:
    return f"regexp_extract({col}, {lit(pattern)}, {g})"


def only(col: str, characters: str) -> str:
    """Whether a string is made of these characters."""
    return f"(translate({col}, {lit(characters)}, '') = '')"


def bad_escape(col: str) -> str:
    """Whether a ``%`` is not followed by two hexadecimal digits."""
    return (f"(len(list_filter(string_split({col}, '%')[2:], "
            f"lambda t: length(t) < 2 OR NOT {only('lower(left(t, 2))', _DIGITS + 'abcdef')})) > 0)")


def after_last(col: str, sign: str) -> str:
    return f"string_split({col}, {lit(sign)})[-1]"


def before_last(col: str, sign: str) -> str:
    return f"left({col}, greatest(length({col}) - length({after_last(col, sign)}) - 1, 0))"


def reverse_host(col: str) -> str:
    return f"array_to_string(list_reverse(string_split({col}, '.')), '.')"


def escape_path(col: str) -> str:
    e = f"url_encode({col})"
    for enc, ch in (("%24", "$"), ("%26", "&"), ("%2B", "+"), ("%2C", ","), ("%2F", "/"),
                    ("%3A", ":"), ("%3B", ";"), ("%3D", "="), ("%40", "@")):
        e = f"replace({e}, {lit(enc)}, {lit(ch)})"
    return e


def escape_host(col: str) -> str:
    e = f"url_encode({col})"
    for enc, ch in (("%21", "!"), ("%24", "$"), ("%26", "&"), ("%27", "'"), ("%28", "("), ("%29", ")"),
                    ("%2A", "*"), ("%2B", "+"), ("%2C", ","), ("%3B", ";"), ("%3D", "="), ("%3A", ":"),
                    ("%5B", "["), ("%5D", "]"), ("%3C", "<"), ("%3E", ">"), ("%22", '"')):
        e = f"replace({e}, {lit(enc)}, {lit(ch)})"
    return f"(CASE WHEN regexp_matches({col}, '[^\x00-\x7f]') THEN {e} ELSE {col} END)"


#: Signs that a path may hold as they are.
_PATH_SIGNS = "!$&'()*+,;=:@[]/"


def escaped_form(col: str) -> str:
    kept = f"(NOT {bad_escape(col)} AND {only(col, _NAME + '%' + _PATH_SIGNS)})"
    return f"CASE WHEN {kept} THEN {col} ELSE {escape_path(f'url_decode({col})')} END"


def remove_dots(col: str) -> str:
    step = ("lambda acc, e: CASE WHEN e = '.' THEN (CASE WHEN len(acc) = 0 THEN [''] ELSE acc END) "
            "WHEN e = '..' THEN (CASE WHEN len(acc) <= 1 THEN []::VARCHAR[] "
            "ELSE list_slice(acc, 1, len(acc) - 1) END) "
            "ELSE list_append(acc, e) END")
    segs = f"string_split({col}, '/')"
    joined = (f"('/' || array_to_string(list_reduce({segs}, {step}, []::VARCHAR[]), '/') || "
              f"CASE WHEN {segs}[-1] IN ('.', '..') THEN '/' ELSE '' END)")
    slow = f"(CASE WHEN starts_with({joined}, '//') THEN substr({joined}, 2) ELSE {joined} END)"
    fast = f"(CASE WHEN starts_with({col}, '/') THEN {col} ELSE '/' || {col} END)"
    return (f"CASE WHEN {col} = '' THEN '' WHEN list_has_any({segs}, ['.', '..']) THEN {slow} "
            f"ELSE {fast} END")


def parse(src: str, col: str, p: str) -> str:
    """Add the parts of a URL reference as columns ``{p}...``."""
    head = f"split_part({col}, ':', 1)"
    has_scheme = (f"(contains({col}, ':') AND contains({lit(_LETTERS)}, lower(left({head}, 1))) AND {head} <> '' "
                  f"AND {only(f'lower({head})', _LETTERS + _DIGITS + '+-.')})")
    s = f"SELECT *, {has_scheme} AS {p}has_scheme, CASE WHEN {has_scheme} THEN {head} ELSE '' END AS {p}scheme_raw FROM ({src})"
    rest = f"CASE WHEN {p}has_scheme THEN substr({col}, length({p}scheme_raw) + 2) ELSE {col} END"
    fragment = f"substr({col}, strpos({col}, '#') + 1)"
    s = (f"SELECT *, split_part(split_part({rest}, '#', 1), '?', 1) AS {p}pathq, "
         f"CASE WHEN regexp_matches({col}, '[[:cntrl:]]') THEN {lit(CONTROL)} WHEN left({col}, 1) = ':' THEN {lit(NO_SCHEME)} "
         f"WHEN contains({col}, '#') AND {bad_escape(fragment)} THEN {lit(ESCAPE)} END AS {p}early_err FROM ({s})")
    pq = f"{p}pathq"
    s = (f"SELECT *, {p}has_scheme AND left({pq}, 1) <> '/' AS {p}opaque, "
         f"left({pq}, 2) = '//' AND ({p}has_scheme OR left({pq}, 3) <> '///') AS {p}has_auth, "
         f"NOT {p}has_scheme AND left({pq}, 1) <> '/' AND contains(split_part({pq}, '/', 1), ':') AS {p}colon_err FROM ({s})")
    s = (f"SELECT *, CASE WHEN {p}has_auth THEN split_part(substr({pq}, 3), '/', 1) ELSE '' END AS {p}authority FROM ({s})")
    au = f"{p}authority"
    s = (f"SELECT *, CASE WHEN {p}has_auth THEN substr({pq}, 3 + length({au})) WHEN {p}opaque THEN '' ELSE {pq} END AS {p}path_raw, "
         f"contains({au}, '@') AS {p}has_user, {before_last(au, '@')} AS {p}userinfo, {after_last(au, '@')} AS {p}hostport FROM ({s})")
    hp = f"{p}hostport"
    close = f"strpos({hp}, ']')"
    s = (f"SELECT *, CASE WHEN left({hp}, 1) <> '[' THEN (CASE WHEN contains({hp}, ':') THEN {before_last(hp, ':')} ELSE {hp} END) "
         f"WHEN {close} > 0 THEN substr({hp}, 2, {close} - 2) ELSE '' END AS {p}host, "
         f"CASE WHEN left({hp}, 1) <> '[' THEN (CASE WHEN contains({hp}, ':') THEN ':' || {after_last(hp, ':')} ELSE '' END) "
         f"WHEN {close} > 0 THEN substr({hp}, {close} + 1) ELSE '' END AS {p}portpart FROM ({s})")
    pp = f"{p}portpart"
    plain = f"regexp_replace({p}host, '[^[:ascii:]]', '', 'g')"
    return (f"SELECT *, CASE WHEN left({pp}, 1) = ':' THEN substr({pp}, 2) ELSE '' END AS {p}port, "
            f"CASE WHEN {p}early_err IS NOT NULL THEN {p}early_err WHEN {p}colon_err THEN {lit(COLON)} "
            f"WHEN left({hp}, 1) = '[' AND {close} = 0 THEN {lit(BRACKET)} "
            f"WHEN {pp} <> '' AND NOT (left({pp}, 1) = ':' AND {only(f'substr({pp}, 2)', _DIGITS)}) THEN {lit(PORT_SYNTAX)} "
            f"WHEN NOT {only(plain, _NAME + _HOST_SIGNS)} THEN {lit(HOST_SYNTAX)} "
            f"WHEN {bad_escape(p + 'path_raw')} THEN {lit(ESCAPE)} END AS {p}perr FROM ({s})")


#: Signs that a host may hold besides letters, digits and ``-._~``; and what is beyond ASCII.
_HOST_SIGNS = """!$&'()*+,;=:[]<>\""""


def is_address(h: str) -> str:
    """Whether a host is four numbers up to 255 without leading zeros, or hexadecimal groups with colons."""
    four = f"string_split({h}, '.')"
    number = (f"t <> '' AND {only('t', _DIGITS)} AND length(t) <= 3 AND (length(t) = 1 OR left(t, 1) <> '0') "
              f"AND coalesce(TRY_CAST(t AS INTEGER), 256) <= 255")
    return (f"((len({four}) = 4 AND len(list_filter({four}, lambda t: {number})) = 4) "
            f"OR (contains({h}, ':') AND {only(f'lower({h})', _DIGITS + 'abcdef:.')}))")


def finish(src: str, p: str, out: str, scheme: str, user: str, host: str, port: str,
           esc: str, perr: str, opaque: str) -> str:
    a = (f"SELECT *, lower({scheme}) AS {p}f_scheme, {user} AS {p}f_user, {host} AS {p}f_host, "
         f"{port} AS {p}f_port, {esc} AS {p}f_esc, {perr} AS {p}f_perr, {opaque} AS {p}f_opaque "
         f"FROM ({src})")
    sc, h, pt = f"{p}f_scheme", f"{p}f_host", f"{p}f_port"
    b = (f"SELECT *, url_decode({p}f_esc) AS {p}f_dec, "
         f"CASE WHEN {p}f_perr IS NOT NULL THEN {p}f_perr "
         f"WHEN {sc} NOT IN ('http', 'https') THEN {lit(NOT_HTTP)} || {sc} "
         f"WHEN {pt} NOT IN ('', '80', '443') THEN {lit(BAD_PORT)} || {pt} "
         f"WHEN {is_address(h)} THEN {lit(IS_IP)} || {h} "
         f"WHEN {p}f_opaque OR {h} = '' THEN {lit(NO_HOST)} END AS {p}f_reason "
         f"FROM ({a})")
    ok = f"({p}f_reason IS NULL)"
    root = f"({p}f_dec = '/')"
    esc_out = f"(CASE WHEN {root} THEN '' ELSE {p}f_esc END)"
    c = (f"SELECT *, CASE WHEN {ok} THEN {sc} || '://' || {p}f_user || {escape_host(h)} || {esc_out} END AS {out}url, "
         f"CASE WHEN {ok} THEN {sc} END AS {out}scheme, CASE WHEN {ok} THEN {h} END AS {out}host, "
         f"CASE WHEN {ok} THEN {reverse_host(h)} END AS {out}host_reversed, "
         f"CASE WHEN {ok} THEN (CASE WHEN {root} THEN '' ELSE {p}f_dec END) END AS {out}path, "
         f"CASE WHEN {ok} THEN {esc_out} END AS {out}path_escaped, "
         f"{p}f_reason AS {out}reject_reason FROM ({b})")
    return c


def drop(src: str, *prefixes: str) -> str:
    pats = " OR ".join(f"starts_with(c, {lit(x)})" for x in prefixes)
    # DuckDB: COLUMNS(lambda) selects by name; keep non-temporary columns
    return f"SELECT COLUMNS(lambda c: NOT ({pats})) FROM ({src})"


def normalize(src: str, col: str, out: str = "") -> str:
    p = "_nu_"
    s = parse(src, col, p)
    bare = f"(NOT {p}has_scheme AND NOT {p}has_auth)"
    first = f"split_part({p}path_raw, '/', 1)"
    s = (f"SELECT *, CASE WHEN {bare} THEN {first} ELSE {p}host END AS {p}host2, "
         f"CASE WHEN {bare} THEN substr({p}path_raw, length({first}) + 1) ELSE {p}path_raw END AS {p}raw2 FROM ({s})")
    s = f"SELECT *, {escaped_form(p + 'raw2')} AS {p}esc2 FROM ({s})"
    scheme = f"(CASE WHEN {p}has_scheme THEN {p}scheme_raw ELSE 'http' END)"
    user = f"(CASE WHEN {p}has_user THEN {p}userinfo || '@' ELSE '' END)"
    s = finish(s, p, out, scheme, user, f"{p}host2", f"{p}port", f"{p}esc2", f"{p}perr", f"{p}opaque")
    return drop(s, p)


def resolve(src: str, base: str, ref: str, out: str = "") -> str:
    p, b = "_ru_", "_rb_"
    s = parse(src, base, b)
    s = parse(s, ref, p)
    s = (f"SELECT *, {escaped_form(p + 'path_raw')} AS {p}esc_ref, "
         f"{escaped_form(b + 'path_raw')} AS {p}esc_base FROM ({s})")
    own = f"({p}has_scheme OR {p}has_auth)"
    er, eb = f"{p}esc_ref", f"{p}esc_base"
    s = (f"SELECT *, CASE WHEN {own} THEN {er} WHEN {er} = '' THEN {eb} "
         f"WHEN starts_with({er}, '/') THEN {er} "
         f"ELSE left({eb}, length({eb}) - length({after_last(eb, '/')})) || {er} END AS {p}full "
         f"FROM ({s})")
    s = f"SELECT *, {remove_dots(p + 'full')} AS {p}resolved FROM ({s})"

    def pick(n):
        return f"(CASE WHEN {own} THEN {p}{n} ELSE {b}{n} END)"

    scheme = f"(CASE WHEN {p}has_scheme THEN {p}scheme_raw ELSE {b}scheme_raw END)"
    user = f"(CASE WHEN {pick('has_user')} THEN {pick('userinfo')} || '@' ELSE '' END)"
    s = finish(s, p, out, scheme, user, pick("host"), pick("port"), f"{p}resolved",
               f"coalesce({p}perr, {b}perr)", f"{p}opaque")
    return drop(s, p, b)


# windows-1252 characters that the numeric references 128 to 159 stand for
CP1252 = {k: ord(bytes([k]).decode("cp1252")) for k in range(128, 160) if k not in (129, 141, 143, 144, 157)}


def decode_entities(col: str) -> str:
    ref = lit(r"&(#[0-9]+;?|#[xX][[:xdigit:]]+;?|[[:alpha:]][[:alnum:]]*[;=]?)")
    digits = "ltrim(rtrim(substr(r, CASE WHEN lower(r[2]) = 'x' THEN 3 ELSE 2 END), ';'), '0')"
    number = (f"(CASE WHEN length({digits}) = 0 THEN 0 WHEN length({digits}) > 7 THEN 1114112 "
              f"WHEN lower(r[2]) = 'x' THEN CAST('0x' || {digits} AS BIGINT) ELSE CAST({digits} AS BIGINT) END)")
    remap = " ".join(f"WHEN c = {k} THEN {v}" for k, v in CP1252.items())
    char = (f"list_transform([{number}], lambda c: chr(CAST(CASE WHEN c = 0 OR c > 1114111 "
            f"OR c BETWEEN 55296 AND 57343 THEN 65533 {remap} ELSE c END AS INTEGER)))[1]")
    table = html.entities.html5
    names = f"MAP {{{', '.join(f'{lit(k)}: {lit(v)}' for k, v in table.items())}}}"
    text = (f"list_transform(regexp_extract_all({col}, {ref}, 1), lambda r: CASE WHEN starts_with(r, '#') THEN {char} "
            f"ELSE coalesce({names}[r], '&' || r) END)")
    return (f"(CASE WHEN contains({col}, '&') THEN array_to_string(list_transform("
            f"list_zip(string_split_regex({col}, {ref}), list_append({text}, '')), "
            f"lambda x: x[1] || coalesce(x[2], '')), '') ELSE {col} END)")


def raw_links(pages_src: str) -> str:
    """``(page_id, url, pos, href)`` from ``(page_id, url, html)``, in steps: what is not markup goes, the rest is
    listed tag by tag, a link's tag attribute by attribute, and the first named ``href`` is taken.  For
    pages without faulty markup; ``anchor_cases`` lists what faulty markup gives."""
    blank = "regexp_replace({}, {}, ' ', 'gis')"
    body = blank.format("html", lit("<!--.*?-->"))
    for element in ("script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp"):
        body = blank.format(body, lit(f"<{element}(\\s[^>]*)?>.*?</{element}\\s*>"))
    tag = lit(r"""</?[A-Za-z]+(\s+[^\s=>]+(\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?)*\s*/?>""")
    pair = r"""([^\s=/>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?"""
    s = f"SELECT page_id, url, list_filter(regexp_extract_all({body}, {tag}, 0), lambda t: regexp_matches(t, '^<[aA]\\s')) AS tags FROM ({pages_src})"
    s = f"SELECT page_id, url, list_transform(tags, lambda t: substr(t, 3)) AS tags FROM ({s})"
    s = (f"SELECT page_id, url, list_transform(tags, lambda t: list_filter(list_zip("
         f"regexp_extract_all(t, {lit(pair)}, 1), regexp_extract_all(t, {lit(pair)}, 2)), "
         f"lambda x: lower(x[1]) = 'href')[1]) AS found FROM ({s})")
    s = f"SELECT page_id, url, list_transform(list_filter(found, lambda x: x IS NOT NULL), lambda x: x[2]) AS v FROM ({s})"
    s = f"SELECT page_id, url, unnest(range(1, len(v) + 1)) AS pos, unnest(v) AS v FROM ({s})"
    s = f"SELECT page_id, url, pos, CASE WHEN left(v, 1) IN ('\"', '''') THEN v[2:-2] ELSE v END AS raw FROM ({s})"
    return f"SELECT page_id, url, pos, {decode_entities('raw')} AS href FROM ({s})"


def canonical_pages(src: str, url_col: str = "url") -> str:
    """Adds ``source, scheme, host, host_reversed, path`` and drops refused pages."""
    s = normalize(src, url_col, "c_")
    return (f"SELECT * EXCLUDE (c_url, c_scheme, c_host, c_host_reversed, c_path, c_path_escaped, "
            f"c_reject_reason), c_url AS source, c_scheme AS scheme, c_host AS host, "
            f"c_host_reversed AS host_reversed, c_path AS path, c_path_escaped AS path_escaped "
            f"FROM ({s}) WHERE c_reject_reason IS NULL")


def resolved_links(pages_src: str) -> str:
    raw = raw_links(pages_src)
    src = f"SELECT page_id, source, pos, href FROM ({canonical_pages(raw)})"
    r = resolve(src, "source", "href", "t_")
    return (f"SELECT page_id, source, pos, href, t_url AS target, t_reject_reason AS reject_reason "
            f"FROM ({r})")


def page_links(pages_src: str) -> str:
    return (f"SELECT DISTINCT source, target FROM ({resolved_links(pages_src)}) "
            f"WHERE reject_reason IS NULL")


def url_variants(pages: str = "pages") -> str:
    scheme = ext("url", r"^([A-Za-z]+)://")
    host = ext("url", r"^[A-Za-z]+://([^/?#]*)")
    suffix = ext("url", r"^[A-Za-z]+://[^/?#]*(.*)$")
    prefix = f"({scheme} || '://' || {host})"
    port = ("(CASE WHEN page_id % 4 = 0 THEN '80' WHEN page_id % 4 = 1 THEN '443' "
            "WHEN page_id % 4 = 2 THEN '8080' ELSE '' END)")
    ip = "(CASE WHEN page_id % 2 = 0 THEN '10.' || CAST(page_id % 256 AS VARCHAR) || '.0.1' ELSE '[::1]' END)"
    kinds = [
        ("raw", "url"),
        ("upper_scheme", f"upper({scheme}) || '://' || {host} || {suffix}"),
        ("port", f"{prefix} || ':' || {port} || {suffix}"),
        ("ftp", f"'ftp://' || {host} || {suffix}"),
        ("ip", f"{scheme} || '://' || {ip} || {suffix}"),
        ("bare", f"{host} || {suffix}"),
        ("root", f"{prefix} || '/'"),
        ("userinfo", f"{scheme} || '://user:pw@' || {host} || {suffix}"),
        ("non_ascii", f"{prefix} || '/für die/' || CAST(page_id AS VARCHAR) || '*x'"),
        ("bad_escape", f"{prefix} || '/%zz'"),
        ("force_query", f"{prefix} || {ext('url', r'^[A-Za-z]+://[^/?#]*([^?#]*)')} || '?'"),
        ("dots", f"{prefix} || '/a/../b/./c'"),
        ("idn_host", f"{scheme} || '://bücher-' || CAST(page_id AS VARCHAR) || '.example' || {suffix}"),
    ]
    structs = ", ".join(f"{{'kind': {lit(k)}, 'input': {e}}}" for k, e in kinds)
    return f"SELECT page_id, unnest([{structs}], recursive := true) FROM {pages}"


def link_keys(pages_src: str) -> str:
    raw = raw_links(pages_src)
    src = f"SELECT page_id, source, pos, href FROM ({canonical_pages(raw)})"
    r = resolve(src, "source", "href", "t_")
    return (f"SELECT page_id, pos, source, t_url AS target, t_scheme AS scheme, "
            f"t_host_reversed AS host_reversed, t_path AS path FROM ({r}) WHERE t_reject_reason IS NULL")
