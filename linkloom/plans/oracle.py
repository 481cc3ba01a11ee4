"""DuckDB oracle SQL for the registered queries (same column names)."""

from __future__ import annotations

from . import duck as Q

ORACLE: dict[str, str] = {}

PAGES = "SELECT page_id, url, html FROM pages"


def graph_edges_sql() -> str:
    node = ("'http://s' || CAST({k} % 50 AS VARCHAR) || '.example.com/p/' || CAST({k} AS VARCHAR)")
    return (f"SELECT {node.format(k='s')} AS source, {node.format(k='t')} AS target, "
            f"s AS s_node, t AS t_node FROM (SELECT DISTINCT l_partkey AS s, "
            f"l_orderkey % (SELECT count(*) FROM part) AS t FROM lineitem)")


def graph_pages_sql() -> str:
    return (f"SELECT s_node AS page_id, source AS url, '<html><body>' || "
            f"array_to_string(list_transform(list_sort(list(target)), "
            f"lambda t: '<a href=\"' || t || '\">x</a>'), '') || '</body></html>' AS html "
            f"FROM ({graph_edges_sql()}) GROUP BY s_node, source")


ORACLE["url_normalize"] = (
    "SELECT page_id, kind, input, url, scheme, host, host_reversed, path, path_escaped, "
    f"reject_reason FROM ({Q.normalize(Q.url_variants(), 'input')})")

ORACLE["url_rejects"] = (
    "SELECT regexp_extract(reject_reason, '^([^:]*)', 1) AS reason, count(*) AS n "
    f"FROM ({Q.normalize(Q.url_variants(), 'input')}) WHERE reject_reason IS NOT NULL GROUP BY 1")

ORACLE["reverse_hostname"] = (
    f"SELECT host, {Q.reverse_host('host')} AS host_reversed, "
    f"{Q.reverse_host(Q.reverse_host('host'))} AS round_trip "
    f"FROM (SELECT DISTINCT host FROM ({Q.canonical_pages('SELECT url FROM pages')}))")

ORACLE["page_keys"] = (
    "SELECT page_id, source, scheme, host_reversed, path, scheme || '://' || "
    f"{Q.escape_host(Q.reverse_host('host_reversed'))} || {Q.escape_path('path')} AS rebuilt "
    f"FROM ({Q.canonical_pages('SELECT page_id, url FROM pages')})")

ORACLE["page_links_raw"] = Q.raw_links(PAGES)
ORACLE["resolve_links"] = Q.resolved_links(PAGES)
ORACLE["page_links"] = Q.page_links(PAGES)
ORACLE["link_groups"] = (
    "SELECT source, count(*) AS n_targets, array_to_string(list_sort(list(target)), chr(10)) "
    f"AS targets FROM ({Q.page_links(PAGES)}) GROUP BY source")
ORACLE["flatten_groups"] = Q.page_links(PAGES)
ORACLE["backlink_counts"] = (
    "SELECT target, count(*) AS backlinks, "
    "count(DISTINCT regexp_extract(source, '^[^:]+://(?:[^@/]*@)?([^/]*)', 1)) AS referring_hosts "
    f"FROM ({Q.page_links(PAGES)}) GROUP BY target")
ORACLE["backlinks_of"] = (
    f"SELECT target, source FROM ({Q.page_links(graph_pages_sql())}) "
    f"WHERE target IN (SELECT source FROM ({Q.canonical_pages(graph_pages_sql())}))")


ORACLE["backlink_lookup"] = (
    f"WITH e AS MATERIALIZED ({graph_edges_sql()}) SELECT source, target FROM e WHERE target IN "
    f"(SELECT source FROM e GROUP BY s_node, source ORDER BY s_node LIMIT 20)")


# what each kind of markup links to, by hand; {n} is the page's number
_CASE_LINKS = [
    ["", ""], ["/y{n}"], ["/it's{n}"], ["/café{n}"], ["/a&lt;b{n}"], ["/AA\ufffd\u20ac{n}"], ["/k{n}"], ["/e{n}"],
    ["/x{n}?a=1&copy=2&b&\u00a9"], ["/2/{n}"], ["/u/{n}/", "/nl{n}"], ["/p{n}"],
    ["/i{n}"], ["/y{n}", "/w{n}"], ["/e{n}"], ["/h{n}", "/g{n}"], ["/u{n}", "/s{n}", ""], ["/r{n}"],
    ["/f{n}"], ["/o{n}"],
]
ORACLE["anchor_cases"] = (
    "SELECT page_id, c.pos, replace(c.href, '{n}', CAST(page_id AS VARCHAR)) AS href FROM pages JOIN (VALUES "
    + ", ".join(f"({k}, {p}, {Q.lit(h)})" for k, hs in enumerate(_CASE_LINKS) for p, h in enumerate(hs, 1))
    + ") c(k, pos, href) ON page_id % 20 = c.k")


ORACLE["stream_totals"] = f"SELECT count(*) AS links_added, 2 AS runs FROM ({Q.page_links(PAGES)})"


# --- robots and responses ----------------------------------------------------

def responses_sql() -> str:
    return ("SELECT page_id, url, CAST(CASE WHEN page_id % 10 = 7 THEN 404 WHEN page_id % 10 = 8 "
            "THEN 204 WHEN page_id % 10 = 9 THEN 429 ELSE 200 END AS INTEGER) AS status, "
            "CASE WHEN page_id % 6 = 5 THEN 'application/pdf' ELSE 'text/html; charset=utf-8' END "
            "AS content_type, CASE WHEN page_id % 8 = 3 THEN 'noindex, nofollow' WHEN page_id % 8 = 4 "
            "THEN NULL ELSE '' END AS x_robots_tag, html FROM pages")


def robots_responses_sql() -> str:
    from ..sources.derived import ROBOTS_FIXTURE as R
    label = "split_part(host, '.', 1)"

    def pick(i, cast=False):
        parts = " ".join(f"WHEN {label} = {Q.lit(k)} THEN {Q.lit(str(R[k][i]))}"
                         for k in ("blog", "www", "m"))
        e = f"CASE {parts} ELSE {Q.lit(str(R['other'][i]))} END"
        return f"CAST({e} AS INTEGER)" if cast else e

    return (f"SELECT host, {pick(0, True)} AS status, {pick(1)} AS content_type, {pick(2)} AS body "
            f"FROM (SELECT DISTINCT host FROM ({Q.canonical_pages('SELECT url FROM pages')}))")


def robots_text_sql() -> str:
    fallback = "#failed-to-get-robot.txt"
    return (f"SELECT h.host, {Q.reverse_host('h.host')} AS host_reversed, "
            f"CASE WHEN r.status = 200 AND contains(lower(coalesce(r.content_type, '')), 'text/plain') "
            f"THEN coalesce(r.body, '') ELSE {Q.lit(fallback)} END AS robot "
            f"FROM (SELECT DISTINCT host FROM ({Q.canonical_pages('SELECT url FROM pages')})) h "
            f"LEFT JOIN ({robots_responses_sql()}) r ON h.host = r.host")


def robots_rules_sql(agent: str | None = None) -> str:
    agent = agent or "BacklinksBot"
    strip = lambda c: f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
    lines = (f"SELECT host, unnest(range(0, len(l))) AS line_no, unnest(l) AS line FROM "
             f"(SELECT host, regexp_split_to_array(ltrim(robot, chr(65279)), '\\r\\n|\\r|\\n') AS l FROM ({robots_text_sql()}))")
    body = strip("regexp_replace(line, '#.*$', '')")
    kv = (f"SELECT host, line_no, lower({strip(f'CASE WHEN contains(b, {Q.lit(':')}) THEN ' + Q.ext('b', '^([^:]*):') + ' ELSE ' + Q.ext('b', r'^(\S+)[ \t]+\S+$') + ' END')}) AS key, "
          f"{strip(f'CASE WHEN contains(b, {Q.lit(':')}) THEN ' + Q.ext('b', '^[^:]*:(.*)$') + ' ELSE ' + Q.ext('b', r'^\S+[ \t]+(\S+)$') + ' END')} AS value "
          f"FROM (SELECT host, line_no, {body} AS b FROM ({lines}))")
    # fixed values: the spellings that a line's key may begin with
    begins = lambda names: "(" + " OR ".join(f"starts_with(key, {Q.lit(n)})" for n in names) + ")"
    kinds = (f"SELECT *, kind = 'agent' AND regexp_matches(value, '^\\*(\\s|$)') AS is_global, "
             f"kind = 'agent' AND lower({Q.ext('value', '^([A-Za-z_-]*)')}) = {Q.lit(agent.lower())} AS is_specific "
             f"FROM (SELECT *, CASE WHEN {begins(['user-agent', 'useragent', 'user agent'])} THEN 'agent' "
             f"WHEN starts_with(key, 'allow') THEN 'allow' "
             f"WHEN {begins(['disallow', 'dissallow', 'dissalow', 'disalow', 'diasllow', 'disallaw'])} THEN 'disallow' END AS kind FROM ({kv})) WHERE kind IS NOT NULL")
    starts = (f"SELECT *, CAST(kind = 'agent' AND coalesce(lag(kind) OVER (PARTITION BY host ORDER BY line_no) "
              f"<> 'agent', true) AS INTEGER) AS starts FROM ({kinds})")
    grp = (f"SELECT *, sum(starts) OVER (PARTITION BY host ORDER BY line_no ROWS BETWEEN UNBOUNDED "
           f"PRECEDING AND CURRENT ROW) AS group_no FROM ({starts})")
    g = (f"SELECT *, max(CAST(is_specific AS INTEGER)) OVER (PARTITION BY host, group_no) AS g_spec, "
         f"max(CAST(is_global AS INTEGER)) OVER (PARTITION BY host, group_no) AS g_glob FROM ({grp})")
    esc = ("CASE WHEN regexp_matches(value, '[^\\x00-\\x7f]') THEN array_to_string(list_transform("
           "string_split(value, ''), lambda ch: CASE WHEN ascii(ch) < 128 THEN ch ELSE url_encode(ch) END), '') "
           "ELSE value END")
    upper = ("list_reduce(list_transform(string_split(value, '%'), lambda x, i: CASE WHEN i > 1 AND "
             "regexp_matches(x, '^[0-9a-fA-F]{2}') THEN upper(x[1:2]) || x[3:] ELSE x END), lambda a, b: a || '%' || b)")
    g = f"SELECT * REPLACE ({upper} AS value) FROM ({g})"
    rules = (f"SELECT host, line_no, group_no, CASE WHEN g_spec = 1 THEN 'specific' ELSE 'global' END AS scope, "
             f"kind = 'allow' AS allow, {esc} AS pattern FROM ({g}) WHERE kind <> 'agent' AND group_no > 0 "
             f"AND (g_spec = 1 OR g_glob = 1)")
    index = (f"SELECT host, line_no, group_no, scope, allow, "
             f"{Q.ext('pattern', r'^(.*/)index\.htm[^/]*$')} || '$' AS pattern FROM r0 "
             f"WHERE allow AND regexp_matches(pattern, '/index\\.htm[^/]*$')")
    e = "replace(replace(replace(replace(pattern, '\\', '\\\\'), '%', '\\%'), '_', '\\_'), '*', '%')"
    final = (f"SELECT host, line_no, group_no, scope, allow, pattern, "
             f"CASE WHEN ends_with(pattern, '$') THEN substr({e}, 1, length({e}) - 1) ELSE {e} || '%' END "
             f"AS like_pattern, NOT contains(pattern, '*') AND NOT ends_with(pattern, '$') AS literal, "
             f"length(pattern) AS priority FROM (SELECT * FROM r0 UNION ALL {index})")
    seen = (f"SELECT DISTINCT host, NULL::BIGINT, NULL::BIGINT, 'seen', NULL::BOOLEAN, NULL::VARCHAR, "
            f"NULL::VARCHAR, NULL::BOOLEAN, NULL::BIGINT FROM ({g}) WHERE is_specific")
    return f"WITH r0 AS ({rules}) {final} UNION ALL {seen}"


def robots_allowed_sql() -> str:
    rules = robots_rules_sql()
    pages = Q.canonical_pages("SELECT page_id, url FROM pages")
    m = ("CASE WHEN r.literal THEN starts_with(p.match_path, r.pattern) "
         "ELSE p.match_path LIKE r.like_pattern ESCAPE '\\' END")

    def best(scope, allow):
        return (f"coalesce(max(CASE WHEN r.scope = '{scope}' AND r.allow = {allow} AND {m} "
                f"THEN r.priority END), 0)")

    agg = (f"SELECT p.page_id, p.source, p.host, {best('specific', 'true')} AS sa, "
           f"{best('specific', 'false')} AS sd, {best('global', 'true')} AS ga, "
           f"{best('global', 'false')} AS gd, bool_or(r.scope = 'seen') AS ever "
           f"FROM (SELECT *, CASE WHEN path_escaped = '' THEN '/' ELSE path_escaped END AS match_path "
           f"FROM ({pages})) p LEFT JOIN ({rules}) r ON p.host = r.host GROUP BY p.page_id, p.source, p.host")
    return (f"SELECT page_id, source, host, CASE WHEN sa > 0 OR sd > 0 THEN NOT (sd > sa) "
            f"WHEN coalesce(ever, false) THEN true WHEN ga > 0 OR gd > 0 THEN NOT (gd > ga) ELSE true END "
            f"AS allowed FROM ({agg})")


def crawl_reason_sql() -> str:
    return ("CASE WHEN status IS NULL OR status < 200 OR status > 299 OR status = 204 THEN 'status' "
            "WHEN NOT contains(coalesce(content_type, ''), 'html') THEN 'content_type' "
            "WHEN contains(coalesce(x_robots_tag, ''), 'nofollow') OR contains(coalesce(x_robots_tag, ''), "
            "'noindex') THEN 'robots_header' END")


ORACLE["robots_text"] = robots_text_sql()
ORACLE["hosts_table"] = f"SELECT host_reversed, robot FROM ({robots_text_sql()})"
ORACLE["robots_rules"] = robots_rules_sql()
ORACLE["robots_allowed"] = robots_allowed_sql()
ORACLE["crawlable_pages"] = (
    f"SELECT page_id, url, status, content_type, x_robots_tag FROM ({responses_sql()}) "
    f"WHERE ({crawl_reason_sql()}) IS NULL")


def page_reasons_sql() -> str:
    return (f"SELECT r.page_id, coalesce(CASE WHEN NOT coalesce(a.allowed, true) THEN 'robots' "
            f"ELSE {crawl_reason_sql()} END, 'kept') AS reason, r.url, r.html "
            f"FROM ({responses_sql()}) r LEFT JOIN ({robots_allowed_sql()}) a ON r.page_id = a.page_id")


_KEPT = "SELECT page_id, url, html FROM pr WHERE reason = 'kept'"
ORACLE["drop_reasons"] = (
    f"WITH pr AS ({page_reasons_sql()}) "
    f"SELECT 'page' AS stage, reason, count(*) AS n FROM pr GROUP BY reason UNION ALL "
    f"SELECT 'link' AS stage, regexp_extract(reject_reason, '^([^:]*)', 1) AS reason, count(*) AS n "
    f"FROM ({Q.resolved_links(_KEPT)}) "
    f"WHERE reject_reason IS NOT NULL GROUP BY 2")


# --- frontier ----------------------------------------------------------------

AS_OF = "TIMESTAMP '2024-03-01 00:00:00'"
SAMPLE_SEED = "round-1"


def seed_lines_sql() -> str:
    twin = ("CASE WHEN starts_with(url, 'https://') THEN regexp_replace(url, '^https://', 'http://') "
            "ELSE regexp_replace(url, '^http://', 'https://') END")
    rows = (f"SELECT CAST(page_id AS DOUBLE) AS k, url FROM pages UNION ALL "
            f"SELECT page_id + 0.25, url FROM pages WHERE page_id % 10 = 2 UNION ALL "
            f"SELECT page_id + 0.5, {twin} FROM pages WHERE page_id % 10 = 1")
    return (f"SELECT CAST(floor(k / 3) AS BIGINT) AS line_no, array_to_string(list_transform("
            f"list_sort(list({{'k': k, 'url': url}})), lambda s: s.url), ' ' || chr(9) || ' ') AS value "
            f"FROM ({rows}) GROUP BY 1")


def seeds_sql() -> str:
    toks = (f"SELECT line_no, unnest(range(0, len(t))) AS pos, unnest(t) AS input FROM "
            f"(SELECT line_no, regexp_split_to_array(trim(value), '\\s+') AS t FROM ({seed_lines_sql()}))")
    return Q.normalize(f"SELECT * FROM ({toks}) WHERE input <> ''", "input")


def first_pages_sql(src: str, order: str) -> str:
    return (f"SELECT md5(host_reversed || chr(10) || path) AS id, scheme, host_reversed, path, "
            f"CAST(NULL AS TIMESTAMP) AS latest_visit FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY host_reversed, path ORDER BY {order}, scheme) AS rn FROM ({src})) WHERE rn = 1")


def seed_frontier_sql() -> str:
    return first_pages_sql(f"SELECT line_no, pos, scheme, host_reversed, path FROM ({seeds_sql()})",
                           "line_no, pos")


def insert_pages_sql() -> str:
    new = first_pages_sql(Q.link_keys(PAGES), "page_id, pos")
    return (f"WITH sf AS MATERIALIZED ({seed_frontier_sql()}) "
            f"SELECT n.* FROM ({new}) n ANTI JOIN sf e "
            f"ON e.host_reversed = n.host_reversed AND e.path = n.path")


def crawl_frontier_sql() -> str:
    new = first_pages_sql(Q.link_keys(PAGES), "page_id, pos")
    return (f"WITH sf AS MATERIALIZED ({seed_frontier_sql()}) SELECT * FROM sf UNION ALL "
            f"SELECT n.* FROM ({new}) n ANTI JOIN sf e "
            f"ON e.host_reversed = n.host_reversed AND e.path = n.path")


def visited_frontier_sql() -> str:
    h = "(length(path) * 7 + length(host_reversed))"
    return (f"SELECT id, scheme, host_reversed, path, CASE WHEN {h} % 3 = 0 THEN NULL ELSE "
            f"{AS_OF} - to_days(CAST({h} % 60 AS INTEGER)) END AS latest_visit "
            f"FROM ({crawl_frontier_sql()})")


def page_url_sql(scheme="scheme", hr="host_reversed", path="path") -> str:
    return f"{scheme} || '://' || {Q.escape_host(Q.reverse_host(hr))} || {Q.escape_path(path)}"


def frontier_next_sql(f: str = "cf") -> str:
    host = (f"SELECT host_reversed FROM {f} WHERE latest_visit IS NULL "
            f"ORDER BY md5(id || {Q.lit(SAMPLE_SEED)}) LIMIT 1")
    return (f"SELECT id, scheme, host_reversed, path, {page_url_sql()} AS url FROM {f} "
            f"WHERE latest_visit IS NULL AND host_reversed = ({host}) ORDER BY path LIMIT 128")


ORACLE["seed_frontier"] = seed_frontier_sql()
ORACLE["insert_pages"] = insert_pages_sql()
ORACLE["insert_links"] = (
    f"SELECT DISTINCT l.source, l.target FROM ({Q.page_links(f'{PAGES} UNION ALL {graph_pages_sql()}')}) l "
    f"ANTI JOIN ({graph_edges_sql()}) g ON g.source = l.source AND g.target = l.target")
ORACLE["frontier_next"] = f"WITH cf AS MATERIALIZED ({crawl_frontier_sql()}) {frontier_next_sql()}"
ORACLE["mark_visited"] = (
    f"WITH cf AS MATERIALIZED ({crawl_frontier_sql()}), nb AS ({frontier_next_sql()}) "
    f"SELECT id, scheme, host_reversed, path, CASE WHEN id IN (SELECT id FROM nb) "
    f"THEN {AS_OF} ELSE latest_visit END AS latest_visit FROM cf")
ORACLE["frontier_all_hosts"] = (
    f"SELECT id, scheme, host_reversed, path, rank, {page_url_sql()} AS url FROM (SELECT *, row_number() "
    f"OVER (PARTITION BY host_reversed ORDER BY path) AS rank FROM ({crawl_frontier_sql()}) "
    f"WHERE latest_visit IS NULL) WHERE rank <= 128")
ORACLE["refresh_due"] = (
    f"SELECT * FROM ({visited_frontier_sql()}) WHERE latest_visit IS NULL OR "
    f"latest_visit < {AS_OF} - INTERVAL 30 DAY")
_REF = (f"SELECT host_reversed, path, count(DISTINCT regexp_extract(source, "
        f"'^[^:]+://(?:[^@/]*@)?([^/]*)', 1)) AS weight FROM ({Q.canonical_pages(Q.page_links(PAGES), 'target')}) "
        f"GROUP BY host_reversed, path")
ORACLE["frontier_ranked"] = (
    f"SELECT id, scheme, host_reversed, path, weight, rank FROM (SELECT f.id, f.scheme, f.host_reversed, "
    f"f.path, coalesce(w.weight, 0) AS weight, row_number() OVER (PARTITION BY f.host_reversed ORDER BY "
    f"coalesce(w.weight, 0) DESC, f.path) AS rank FROM ({crawl_frontier_sql()}) f LEFT JOIN ({_REF}) w "
    f"ON f.host_reversed = w.host_reversed AND f.path = w.path WHERE f.latest_visit IS NULL) "
    f"WHERE rank <= 128")
ORACLE["frontier_top"] = (
    f"SELECT f.id, f.scheme, f.host_reversed, f.path, coalesce(w.weight, 0) AS weight FROM ({crawl_frontier_sql()}) f "
    f"LEFT JOIN ({_REF}) w ON f.host_reversed = w.host_reversed AND f.path = w.path WHERE f.latest_visit IS NULL "
    f"ORDER BY weight DESC, f.host_reversed, f.path LIMIT 128")
_HS = ("array_to_string(list_reverse(string_split(regexp_extract({c}, '^[^:]+://(?:[^@/]*@)?([^/]*)', 1), "
       "'.')), '.')")
ORACLE["host_stats"] = (
    f"WITH p AS (SELECT host_reversed, count(*) AS pages, count(latest_visit) AS visited "
    f"FROM ({visited_frontier_sql()}) GROUP BY 1), l AS ({Q.page_links(PAGES)}), "
    f"o AS (SELECT {_HS.format(c='source')} AS host_reversed, count(*) AS links_out FROM l GROUP BY 1), "
    f"i AS (SELECT {_HS.format(c='target')} AS host_reversed, count(*) AS links_in FROM l GROUP BY 1) "
    f"SELECT coalesce(p.host_reversed, o.host_reversed, i.host_reversed) AS host_reversed, "
    f"coalesce(pages, 0) AS pages, coalesce(visited, 0) AS visited, "
    f"coalesce(pages, 0) - coalesce(visited, 0) AS unvisited, coalesce(links_out, 0) AS links_out, "
    f"coalesce(links_in, 0) AS links_in FROM p FULL JOIN o ON p.host_reversed = o.host_reversed "
    f"FULL JOIN i ON coalesce(p.host_reversed, o.host_reversed) = i.host_reversed")


# --- crawl over G1 -------------------------------------------------------------

def _reach_sql() -> str:
    e = graph_edges_sql()
    return (f"WITH RECURSIVE e AS MATERIALIZED ({e}), seed AS (SELECT source AS node FROM e "
            f"ORDER BY s_node LIMIT 1), r(node) AS (SELECT node FROM seed UNION "
            f"SELECT e.target FROM r JOIN e ON e.source = r.node)")


_CRAWLABLE = ("s_node % 10 NOT IN (7, 8, 9) AND s_node % 6 <> 5 AND s_node % 8 <> 3 AND NOT "
              "(s_node % 50 % 5 = 0 AND starts_with('/p/' || CAST(s_node AS VARCHAR), '/p/1'))")
ORACLE["crawl_rounds"] = (
    f"WITH RECURSIVE e AS MATERIALIZED ({graph_edges_sql()}), ok AS (SELECT DISTINCT source AS node FROM e "
    f"WHERE {_CRAWLABLE}), seed AS (SELECT source AS node FROM e ORDER BY s_node LIMIT 1), "
    f"r(node) AS (SELECT node FROM seed UNION SELECT e.target FROM r JOIN e ON e.source = r.node "
    f"WHERE e.source IN (SELECT node FROM ok)) "
    f"SELECT DISTINCT source, target FROM e WHERE source IN (SELECT node FROM r) "
    f"AND source IN (SELECT node FROM ok)")
ORACLE["crawl_depth"] = (
    f"WITH RECURSIVE e AS MATERIALIZED ({graph_edges_sql()}), seed AS (SELECT source AS node FROM e "
    f"ORDER BY s_node LIMIT 1), n AS (SELECT count(*) AS c FROM (SELECT source FROM e UNION SELECT target FROM e)), "
    f"r(node, depth) AS (SELECT node, 0 FROM seed UNION SELECT e.target, r.depth + 1 FROM r "
    f"JOIN e ON e.source = r.node WHERE r.depth < (SELECT least(c, 64) FROM n)) "
    f"SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM r GROUP BY node")


# --- pacing and metrics ----------------------------------------------------------

REQUEST_LOG = ("SELECT event_id, ts, 'u' || CAST(user_id AS VARCHAR) || '.example.com' AS host, "
               "CASE WHEN event_type = 'click' THEN 'HEAD' ELSE 'GET' END AS method, "
               "CAST(CASE WHEN event_type = 'error' OR (event_type = 'click' AND event_id % 7 = 0) THEN 429 WHEN event_type = 'signup' THEN 301 ELSE 200 END "
               "AS INTEGER) AS code, value / 100 AS duration_s, CASE WHEN event_type = 'error' THEN 'ERROR' "
               "WHEN event_type = 'signup' THEN 'WARN' ELSE 'INFO' END AS level FROM events")

_D_US = 3_600_000_000
ORACLE["politeness_schedule"] = (
    f"SELECT event_id, ts, method, host, make_timestamp(m + i * {_D_US}) AS slot_ts, "
    f"(m + i * {_D_US} - epoch_us(ts)) / 1e6 AS wait_s, m + i * {_D_US} - epoch_us(ts) > 0 AS delayed "
    f"FROM (SELECT *, max(epoch_us(ts) - i * {_D_US}) OVER (PARTITION BY method, host ORDER BY ts, event_id "
    f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY method, host ORDER BY ts, event_id) - 1 AS i FROM ({REQUEST_LOG})))")
ORACLE["adaptive_rate"] = (
    f"SELECT event_id, ts, host, method, halvings, 5.0 * pow(2.0, halvings) AS interval_s FROM "
    f"(SELECT *, coalesce(sum(CASE WHEN code = 429 AND method = 'HEAD' THEN 1 ELSE 0 END) OVER (PARTITION BY host ORDER BY ts, "
    f"event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS halvings FROM ({REQUEST_LOG}))")
# the sequential rule itself, request by request: a slot is the arrival or the slot before plus the interval
ORACLE["adaptive_schedule"] = (
    f"WITH RECURSIVE h AS (SELECT *, coalesce(sum(CASE WHEN code = 429 AND method = 'HEAD' THEN 1 ELSE 0 END) OVER "
    f"(PARTITION BY host ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS halvings, "
    f"row_number() OVER (PARTITION BY method, host ORDER BY ts, event_id) AS i FROM ({REQUEST_LOG})), "
    f"n AS MATERIALIZED (SELECT *, epoch_us(ts)::HUGEINT AS a, {_D_US}::HUGEINT * pow(2, least(halvings, 60))::HUGEINT AS d FROM h), "
    f"r AS (SELECT event_id, method, host, i, a AS slot FROM n WHERE i = 1 UNION ALL "
    f"SELECT n.event_id, n.method, n.host, n.i, greatest(n.a, r.slot + n.d) FROM r JOIN n "
    f"ON n.method = r.method AND n.host = r.host AND n.i = r.i + 1) "
    f"SELECT n.event_id, n.ts, n.method, n.host, n.halvings, TRY_CAST(slot AS BIGINT) AS slot_us, "
    f"TRY_CAST(slot AS BIGINT) - epoch_us(ts) AS wait_us, slot > a AS delayed FROM n JOIN r USING (event_id)")
ORACLE["crawl_counters"] = (
    f"SELECT (SELECT count(*) FROM ({REQUEST_LOG})) AS processed, "
    f"(SELECT count(*) FILTER (WHERE level = 'ERROR') FROM ({REQUEST_LOG})) AS errors, "
    f"(SELECT count(*) FILTER (WHERE level = 'WARN') FROM ({REQUEST_LOG})) AS warnings, "
    f"(SELECT count(*) FILTER (WHERE latest_visit IS NULL) FROM ({visited_frontier_sql()})) AS queue_size, "
    f"(SELECT count(*) FROM ({Q.page_links(PAGES)})) AS links, "
    f"(SELECT count(*) FILTER (WHERE allowed) FROM ({robots_allowed_sql()})) AS robots_allowed, "
    f"(SELECT count(*) FILTER (WHERE NOT allowed) FROM ({robots_allowed_sql()})) AS robots_disallowed")
ORACLE["log_levels"] = (f"SELECT level, count(*) AS n FROM ({REQUEST_LOG}) WHERE level IN ('ERROR', 'WARN') "
                        f"GROUP BY level")
ORACLE["requests_by_code"] = f"SELECT code, method, count(*) AS n FROM ({REQUEST_LOG}) GROUP BY code, method"


def histogram_sql(label: str, value: str, buckets: list[float]) -> str:
    bounds = "[" + ", ".join(repr(b) for b in buckets) + "]::DOUBLE[]"
    names = [repr(b) for b in buckets] + ["+Inf"]
    grid_names = "[" + ", ".join(Q.lit(n) for n in names) + "]"
    return (f"WITH l AS ({REQUEST_LOG}), per AS (SELECT {label} AS label, len(list_filter({bounds}, "
            f"lambda b: b < {value})) AS b, count(*) AS n FROM l GROUP BY 1, 2), "
            f"tot AS (SELECT {label} AS label, sum({value}) AS sum, count(*) AS count FROM l GROUP BY 1), "
            f"grid AS (SELECT label, sum, count, unnest(range(0, {len(names)})) AS b, unnest({grid_names}) AS le "
            f"FROM tot) SELECT g.label, g.le, sum(coalesce(p.n, 0)) OVER (PARTITION BY g.label ORDER BY g.b "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_count, g.sum, g.count "
            f"FROM grid g LEFT JOIN per p ON g.label = p.label AND g.b = p.b")


def _buckets():
    from ..operators.metrics import DEFAULT_BUCKETS, TLS_BUCKETS
    return DEFAULT_BUCKETS, TLS_BUCKETS


ORACLE["duration_histogram"] = histogram_sql("method", "duration_s", _buckets()[0])
ORACLE["labelled_histogram"] = histogram_sql("level", "duration_s", _buckets()[1])
ORACLE["in_flight"] = (
    f"WITH ev AS (SELECT epoch_us(ts) AS t, 1 AS d, event_id AS id FROM ({REQUEST_LOG}) UNION ALL "
    f"SELECT epoch_us(ts) + CAST(floor(duration_s * 1000000) AS BIGINT), -1, event_id FROM ({REQUEST_LOG})) "
    f"SELECT date_trunc('hour', make_timestamp(t)) AS bucket, max(f) AS peak_in_flight FROM "
    f"(SELECT t, sum(d) OVER (ORDER BY t, d, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f "
    f"FROM ev) GROUP BY 1")
ORACLE["throughput"] = (
    f"WITH l AS ({REQUEST_LOG}), per AS (SELECT date_trunc('day', ts) AS bucket, count(*) AS requests, "
    f"(epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds FROM l GROUP BY 1 UNION ALL "
    f"SELECT NULL, count(*), (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 FROM l) "
    f"SELECT bucket, requests, seconds, CASE WHEN seconds > 0 THEN requests / seconds END AS rate FROM per")
ORACLE["progress_report"] = (
    f"WITH f AS MATERIALIZED ({visited_frontier_sql()}), d AS (SELECT date_trunc('day', ts) AS bucket, count(*) AS n, "
    f"count(*) FILTER (WHERE level = 'ERROR') AS e, count(*) FILTER (WHERE level = 'WARN') AS wn "
    f"FROM ({REQUEST_LOG}) GROUP BY 1), p AS MATERIALIZED (SELECT source, min(host_reversed) AS h, min(path) AS path "
    f"FROM ({Q.canonical_pages('SELECT page_id, url FROM pages')}) GROUP BY 1), "
    f"l AS MATERIALIZED (SELECT f.latest_visit AS seen FROM ({Q.page_links(PAGES)}) k JOIN p USING (source) "
    f"JOIN f ON f.host_reversed = p.h AND f.path = p.path) "
    f"SELECT bucket, n AS requests, sum(n) OVER w AS processed, sum(e) OVER w AS errors, sum(wn) OVER w AS warnings, "
    f"(SELECT count(*) FROM l WHERE seen < bucket + INTERVAL 1 DAY) AS links, "
    f"(SELECT count(*) FROM f WHERE latest_visit IS NULL OR latest_visit >= bucket + INTERVAL 1 DAY) AS queue "
    f"FROM d WINDOW w AS (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


# --- streaming and remaining ---------------------------------------------------------

ORACLE["stream_ingest"] = Q.page_links(PAGES)
ORACLE["stream_progress"] = (
    f"WITH k AS MATERIALIZED ({Q.link_keys(PAGES)}), b AS (SELECT page_id % 4 AS b, count(*) AS pages FROM pages GROUP BY 1), "
    f"s AS (SELECT page_id % 4 AS b, count(*) AS seen FROM k GROUP BY 1), "
    f"l AS (SELECT b, count(*) AS added FROM (SELECT min(page_id % 4) AS b FROM k GROUP BY source, target) GROUP BY 1), "
    f"p AS (SELECT b, count(*) AS added FROM (SELECT min(page_id % 4) AS b FROM k GROUP BY host_reversed, path) GROUP BY 1), "
    f"j AS (SELECT b, pages, coalesce(seen, 0) AS links_seen, coalesce(l.added, 0) AS links_added, "
    f"coalesce(p.added, 0) AS pages_added FROM b LEFT JOIN s USING (b) LEFT JOIN l USING (b) LEFT JOIN p USING (b)) "
    f"SELECT b AS batch_id, pages, links_seen, links_added, pages_added, sum(pages) OVER w AS processed, "
    f"sum(links_added) OVER w AS link_pairs, sum(pages_added) OVER w AS queue_size FROM j WINDOW w AS (ORDER BY b)")
ORACLE["archive_fetch"] = (
    f"WITH cf AS MATERIALIZED ({crawl_frontier_sql()}), a AS ("
    f"SELECT scheme AS a_scheme, host_reversed, path, page_id, status, content_type, x_robots_tag "
    f"FROM ({Q.canonical_pages(responses_sql())})) "
    f"SELECT id, scheme, host_reversed, path, page_id, status, content_type, x_robots_tag, "
    f"page_id IS NOT NULL AS fetched FROM (SELECT cf.id, cf.scheme, cf.host_reversed, cf.path, a.page_id, "
    f"a.status, a.content_type, a.x_robots_tag, row_number() OVER (PARTITION BY cf.id ORDER BY "
    f"(a.a_scheme <> cf.scheme) ASC NULLS LAST, a.page_id ASC NULLS LAST) AS rn FROM cf LEFT JOIN a "
    f"ON cf.host_reversed = a.host_reversed AND cf.path = a.path) WHERE rn = 1")
ORACLE["replace_links"] = (
    f"WITH old AS ({Q.page_links(PAGES)}), p AS (SELECT page_id, source FROM "
    f"({Q.canonical_pages('SELECT page_id, url FROM pages')})), g AS (SELECT s_node AS page_id, target "
    f"FROM ({graph_edges_sql()})), rr AS (SELECT p.source, g.target FROM p LEFT JOIN g USING (page_id) WHERE page_id % 3 = 0) "
    f"SELECT source, target FROM old WHERE source NOT IN (SELECT source FROM rr) UNION ALL "
    f"SELECT DISTINCT source, target FROM rr WHERE target IS NOT NULL")
