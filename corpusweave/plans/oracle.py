"""SQL counterparts of the registered queries, for an outside check.

Written for another engine from the same definitions. For derived shop pages
and robots files it states the expected rows straight from the source columns
instead of parsing the text again.
"""

from __future__ import annotations

from corpusweave.plans import queries as Q
from corpusweave.sources.tables import ROBOTS_FILE

# Fixed value: the characters Unicode-aware stripping removes.
_WS = " || ".join(
    f"chr({c})"
    for c in [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
)
_URL = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(?s:.*))?$"


def _strip(x: str) -> str:
    return f"trim({x}, {_WS})"


def _decode(x: str) -> str:
    named = f"replace(replace(replace({x}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"')"
    return f"regexp_replace({named}, '&amp;?', '&', 'g')"


def _nodes(x: str) -> str:
    flat = _decode(f"regexp_replace({x}, '(?s)<[a-zA-Z/!][^>]*>', chr(1), 'g')")
    return f"list_filter(list_transform(string_split({flat}, chr(1)), lambda t: {_strip('t')}), lambda t: t <> '')"


def _text(x: str) -> str:
    return f"coalesce(array_to_string({_nodes(x)}, ' '), '')"


def _part(u: str, i: int) -> str:
    return f"regexp_extract({u}, '{_URL}', {i})"


def _norm(u: str) -> str:
    c = _strip(u)
    scheme, netloc = f"lower({_part(c, 1)})", f"lower({_part(c, 2)})"
    path = f"regexp_replace({_part(c, 3)}, ';[^/]*$', '')"
    return (
        f"(case when {scheme} <> '' then {scheme} || ':' else '' end || case when {netloc} <> '' then '//' || {netloc} else '' end"
        f" || case when {path} = '' then '/' else {path} end"
        f" || case when {_part(c, 4)} <> '' then '?' || {_part(c, 4)} else '' end)"
    )


def _domain(u: str) -> str:
    return f"lower({_part(_strip(u), 2)})"


def _base(u: str) -> str:
    c = _strip(u)
    scheme, netloc = f"lower({_part(c, 1)})", f"lower({_part(c, 2)})"
    return (
        f"(case when {scheme} <> '' then {scheme} || ':' else '' end"
        f" || case when {netloc} <> '' then '//' || {netloc} else '' end)"
    )


def _valid(u: str) -> str:
    c = _strip(u)
    return f"(lower({_part(c, 1)}) in ('http', 'https') and {_part(c, 2)} <> '')"


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


# -- shared tables ----------------------------------------------------------

# Pages without comments and without script/style bodies; this corpus has no
# noscript, so it is also the pruned page.
_CLEAN = """clean as (
  select page_id, url, regexp_replace(html, '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', chr(1), 'g') as m
  from pages)"""

# Every link of this corpus is root-relative.
_LINKS = f"""hrefs as (
  select page_id, url, i, regexp_replace({_strip(_decode('h'))}, '#.*$', '') as h from (
    select page_id, url, unnest(hs) as h, generate_subscripts(hs, 1) as i
    from (select page_id, url, regexp_extract_all(m, '(?i)<a\\s[^>]*?href="([^"]*)"', 1) as hs from clean))
  where h <> '' and h not like '#%'),
links as (
  select page_id, url as src_url, row_number() over (partition by page_id order by i) - 1 as pos, dst_url
  from (select page_id, url, regexp_extract(url, '^[^/]*//[^/?#]*', 0) || h as dst_url, min(i) as i
        from hrefs group by all))"""

_URLS = "url_list as (select url from pages union all select dst_url from links)"

_REQUESTS = """requests as (
  select event_id as req_id, 'https://u' || user_id || '.example.com/' || event_type || '/' || event_id as url,
    'u' || user_id || '.example.com' as domain, epoch_us(ts) as arrival_us,
    epoch_us(ts) + cast(floor(value * 1000) as bigint) as end_us, user_id,
    cast(floor(epoch_us(ts) / 86400000000) as bigint) as day_no,
    cast(case when k < 60 then 200 when k < 65 then 503 when k < 70 then 429 when k < 75 then 500 when k < 80 then 404
      when k < 83 then 403 when k < 86 then 418 when k < 89 then 599 when k < 92 then 301 when k < 95 then 408
      when k = 98 then 304 when k = 99 then 200 end as integer) as status,
    case when k < 95 then 'http' when k < 97 then 'timeout' when k = 97 then 'network' when k = 98 then 'response_error'
      else 'empty' end as kind,
    case when k in (95, 96) then 'TimeoutError' when k = 97 then 'ClientConnectionError' when k = 98 then 'ClientResponseError' end as cause
  from (select *, cast(regexp_extract(props, '"k": ([0-9]+)', 1) as integer) as k from events))"""

_ATTEMPTS = """attempts as (
  select url, cast(row_number() over (partition by url order by arrival_us, req_id) - 1 as integer) as attempt,
    status, kind, cause
  from (select 'https://' || domain || '/' || day_no as url, arrival_us, req_id, status, kind, cause from requests))"""


def _classified(source: str) -> str:
    return f"""classified as (
  select *,
    case when kind in ('timeout', 'empty') then 'TransientError' when kind = 'network' then 'NetworkError'
      when status in (408, 425, 429, 500, 502, 503, 504) or status >= 500 then 'TransientError'
      when status >= 400 then 'PermanentError' when kind = 'response_error' then 'NetworkError' end as error_type,
    case when kind = 'timeout' then 'Timeout while loading URL' when kind = 'network' then 'Network error while loading URL'
      when kind = 'empty' then 'Request returned empty or failed result'
      when status in (408, 425, 429, 500, 502, 503, 504) then 'Transient HTTP error: ' || status
      when status >= 500 then 'Server HTTP error: ' || status
      when status in (400, 401, 403, 404, 405, 410) then 'Permanent HTTP error: ' || status
      when status >= 400 then 'Client HTTP error: ' || status
      when kind = 'response_error' then 'HTTP client response error' end as error_base,
    case when kind in ('http', 'response_error') and (status >= 400 or kind = 'response_error') then status end as error_status,
    case when kind in ('timeout', 'network') or (kind = 'response_error' and status < 400) then cause end as error_cause
  from {source}),
messages as (
  select *, concat_ws(' | ', error_base, 'url=' || url, 'status_code=' || error_status, 'original_error=' || error_cause) as message
  from classified)"""


_REPLAY = f"""marked as (
  select *, error_type in ('TransientError', 'NetworkError') as retryable,
    case when error_type = 'NetworkError' then 1 else {Q.RETRY.max_retries} end as retry_limit from messages),
stops as (
  select url, min(attempt) as stop from marked
  where error_type is null or not retryable or attempt >= retry_limit or attempt = {Q.RETRY.max_retries} group by url),
ran as (
  select m.*, stop,
    case when error_type is not null and retryable and attempt < retry_limit
      then {Q.RETRY.base_delay} * pow(case when error_type = 'TransientError' then 3.0 else 2.0 end, attempt) end as retry_delay,
    case when stop is null then 'pending' when attempt = stop and error_type is null then 'success'
      when attempt = stop then 'failed' else 'retried' end as outcome
  from marked m left join stops using (url) where stop is null or attempt <= stop)"""

_ATTEMPT_LOG = (_REQUESTS, _ATTEMPTS, _classified("attempts"), _REPLAY)

_SITES = f"""sites as (
  select base_url, length(base_url) as n from (
    select distinct {_base('url')} as base_url from pages
    union select distinct 'https://u' || user_id || '.example.com' from events)),
open_sites as (
  select base_url, n, case when n % 4 = 0 then '/en' when n % 4 = 1 then '/fr' when n % 4 = 2 then '/de' else '' end as blocked
  from sites where n % 5 <> 0)"""


def _allowed(url: str, user_agent: str) -> str:
    """Verdict on a URL of a site ``s`` (NULL when it has no rules)."""
    target = f"regexp_extract({url}, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?(?://[^/?#]*)?(.*)$', 1)"
    if user_agent == Q.BOT:
        return (
            f"(s.base_url is null or starts_with({target}, '/en/1') or not"
            f" (starts_with({target}, '/en') or starts_with({target}, '/sign')))"
        )
    return (
        f"(s.base_url is null or s.blocked = '' or (not starts_with({target}, s.blocked)"
        f" and (starts_with({target}, '/es/1') or not starts_with({target}, '/es'))))"
    )


_URL_DIM = f"""url_dim as (
  select url from url_list union select url from requests
  union select ' ' || upper(regexp_extract(url, '^[^/]*//[^/?#]*', 0)) || '/Dir;a/Page;v=1?Q=' || page_id || '#Frag ' from pages
  union select 'mailto:p' || page_id || '@example.com' from pages
  union select '/rel/' || page_id from pages)"""

_DIM = (_CLEAN, _LINKS, _URLS, _REQUESTS, _URL_DIM)
_DIM_HTTP = f"{_base('d.url')}"


def _dim(expression: str) -> str:
    return _with(*_DIM) + f"select url, {expression} as value from url_dim"


_CANDIDATES = (
    _CLEAN, _LINKS, _URLS, f"candidates as (select distinct {_norm('url')} as url from url_list)",
    f"known as (select distinct {_norm('url')} as url from pages)",
    f"com_domains as (select distinct {_domain('url')} as domain from pages where contains(url, '.example.com/'))",
)
_EXCLUDED = " or ".join(f"regexp_matches(url, '{p}')" for p in Q.EXCLUDE)
_INCLUDED = " or ".join(f"regexp_matches(url, '{p}')" for p in Q.INCLUDE)
_IN_COM = f"{_domain('url')} in (select domain from com_domains)"
_UNKNOWN = "url not in (select url from known)"

_FRONTIER = _CANDIDATES + (
    f"""queue as (select page_id, pos, row_number() over (order by page_id, pos) as seq, {_norm('dst_url')} as url,
      cast(-pos as integer) as priority, 1 as depth from links)""",
    f"""frontier as (select url, min(seq) as seq, arg_min(page_id, seq) as page_id, arg_min(pos, seq) as pos,
      arg_min(priority, seq) as priority, arg_min(depth, seq) as depth
      from queue where {_UNKNOWN} group by url)""",
)

# -- star web ---------------------------------------------------------------

_S = "'https://star.example.com/"
_STAR = f"""raw_edges as (
  select {_S}region/' || n_regionkey as src, 1 as kind, cast(n_nationkey as bigint) as k, {_S}nation/' || n_nationkey as dst from nation
  union all select {_S}nation/' || c_nationkey, 2, c_custkey, {_S}customer/' || c_custkey from customer
  union all select {_S}nation/' || s_nationkey, 3, s_suppkey, {_S}supplier/' || s_suppkey from supplier
  union all select {_S}customer/' || o_custkey, 4, o_orderkey, {_S}order/' || o_orderkey from orders
  union all select distinct {_S}supplier/' || l_suppkey, 5, l_partkey, {_S}part/' || l_partkey from lineitem
  union all select distinct {_S}order/' || l_orderkey, 6, l_partkey, {_S}part/' || l_partkey from lineitem),
edges as (select src, cast(row_number() over (partition by src order by kind, k) - 1 as integer) as pos, dst from raw_edges),
missing as (
  select {_S}customer/' || c_custkey as url from customer where c_acctbal < 0
  union all select {_S}supplier/' || s_suppkey from supplier where s_acctbal < 0
  union all select {_S}order/' || o_orderkey from orders where o_orderstatus = 'P'),
rules as (select {_S}supplier/' || r_regionkey as prefix from region union all select {_S}order/1' || r_regionkey from region)"""


def _star_status(url: str) -> str:
    return (
        f"case when exists (select 1 from rules where starts_with({url}, prefix)) then 'blocked'"
        f" when {url} in (select url from missing) then 'failed' else 'processed' end"
    )


def _star_levels() -> str:
    """Unrolled levels; each carries everything known so far."""
    level0 = f"""level0 as (
  select url, 0 as depth, path, cast(null as varchar) as discoverer, {_star_status('url')} as status
  from (select {_S}region/' || r_regionkey as url, [cast(r_regionkey as integer)] as path from region))"""
    parts = [level0, "known0 as (select * from level0)"]
    for d in range(1, Q.STAR_DEPTH + 1):
        parts.append(f"""level{d} as (
  select url, {d} as depth, path, discoverer, {_star_status('url')} as status
  from (select e.dst as url, min(list_append(l.path, e.pos)) as path, arg_min(l.url, list_append(l.path, e.pos)) as discoverer
        from level{d - 1} l join edges e on e.src = l.url where l.status = 'processed' group by e.dst) c
  where not exists (select 1 from known{d - 1} k where k.url = c.url)),
known{d} as (select * from known{d - 1} union all select * from level{d})""")
    return ",\n".join(parts) + f""",
ordered as (select *, row_number() over (order by depth, path) - 1 as visit_order from known{Q.STAR_DEPTH})"""


_STAR_ALL = _with(_STAR, _star_levels())
_REASON = f"""case status when 'blocked' then 'Blocked by robots.txt for user-agent {Q.READER}'
  when 'failed' then 'Failed to fetch HTML' else '' end as reason"""

# -- crawl of the page corpus -----------------------------------------------

_PAGE_CRAWL = (_CLEAN, _LINKS, _SITES, f"""seeds as (
  select {_norm('url')} as url, min(page_id) as page_id from pages group by 1),
kept as (select * from seeds where not regexp_matches(url, '/the')),
verdicts0 as (select k.url, 0 as depth, k.page_id, case when {_allowed('k.url', Q.BOT)} then 'processed' else 'blocked' end as status
  from kept k left join open_sites s on s.base_url = {_base('k.url')}),
reached as (
  select distinct {_norm('l.dst_url')} as url from verdicts0 v join links l on l.page_id = v.page_id where v.status = 'processed'),
fresh as (
  select url from reached where not regexp_matches(url, '/the') and url not in (select url from kept)
  and {_domain('url')} in (select {_domain('url')} from pages)),
verdicts1 as (select f.url, 1 as depth, case when {_allowed('f.url', Q.BOT)} then
    case when f.url in (select url from seeds) then 'processed' else 'failed' end else 'blocked' end as status
  from fresh f left join open_sites s on s.base_url = {_base('f.url')}),
crawled as (select url, depth, status from verdicts0 union all select url, depth, status from verdicts1)""")

# -- shop pages -------------------------------------------------------------

_ORDER = "select o_orderkey as page_id, 'https://shop.example.com/orders/' || o_orderkey as url"


def _shop_rows(columns: tuple[str, ...], rows: list[tuple[str, ...]]) -> str:
    """A row per order and template entry, from the order's columns."""
    return "\nunion all ".join(
        _ORDER + "".join(f", {v} as {c}" for c, v in zip(columns, row, strict=True)) + " from orders" for row in rows
    )


_K, _C = "cast(o_orderkey as varchar)", "cast(o_custkey as varchar)"
_SHOP_LINKS = [
    f"'https://shop.example.com/plain/' || {_K}", f"'https://shop.example.com/customers/' || {_C}",
    f"'https://shop.example.com/about?o=' || {_K} || '&s=' || o_orderstatus", f"'https://cdn.example.net/o/' || {_K}",
]
_SHOP_IMAGES = [
    (f"'https://shop.example.com/img/' || {_C} || '.png#v'", f"'Customer ' || {_C}"),
    (f"'https://cdn.example.net/p/' || {_K} || '.jpg'", "''"),
    (f"'https://shop.example.com/img/' || {_C} || '.png#v'", "'again'"),
]
_SHOP_TABLES = [
    [["'Field'", "'Value'"], ["'Customer'", _C], ["'Detail'", "o_orderstatus", "o_orderstatus", "''"], ["o_orderstatus", "''"]],
    [["o_orderstatus", "''"]],
]
_SHOP_LISTS = [
    ("ul", [f"'Order ' || {_K}", "'Lines ' || o_orderpriority", "'Done'"]),
    ("ol", ["o_orderpriority"]),
]
_SHOP_TITLE = f"'Order ' || {_K} || ' & ' || o_orderpriority"
_SHOP_HEADINGS = [("'h1'", f"'Order ' || {_K}"), ("'h3'", "'Priority ' || o_orderpriority")]
_SHOP_TEXT = " || ' ' || ".join(
    [_SHOP_TITLE, *(t for _, t in _SHOP_HEADINGS), "'skip'", "'Status ' || o_orderstatus", f"'inner ' || {_C}",
     "'c a t m dup cdn Field Value Customer'", _C, "'Detail'", "o_orderstatus", "'Order ' || " + _K, "'Lines'",
     "o_orderpriority", "'Done'", f"'Tail © ' || {_K}"]
)


# Baskets: a page per order of the lines, with its lines in order.
_BASKETS = """baskets as (
  select l_orderkey as page_id, 'https://shop.example.com/baskets/' || l_orderkey as url, count(*) as n,
    list({n: l_linenumber, p: l_partkey} order by l_linenumber, l_partkey) as ls from lineitem group by 1)"""
_EACH = "list_transform(ls, lambda l: {})"
_BASKET_TITLE = "'Basket ' || page_id"
_BASKET_LINK = "'https://shop.example.com/orders/' || page_id || '?lines=' || n"
_BASKET_TEXT = (
    f"{_BASKET_TITLE} || ' ' || {_BASKET_TITLE} || ' ' || n || ' lines Offer ' || page_id || ' Line Part ' || "
    f"""array_to_string({_EACH.format("l.n || ' Part ' || l.p")}, ' ') || ' ' || array_to_string({_EACH.format("'Line ' || l.n")}, ' ') || ' order'"""
)
_BASKET_LISTS = (
    "list_transform(range(1, n + 1), lambda i: array_to_string(list_transform(ls[i:], lambda l: 'Line ' || l.n), ' '))"
)

# What the archived pages hold, counted in their markup.
_PAGE_FACTS = f"""link_sums as (
  select page_id, count(*) as n, array_to_string(list(dst_url order by pos), ' ') as every, array_to_string(list(dst_url order by pos)[1:5], ' ') as first_links
  from links group by page_id),
page_items as (
  select page_id, list_filter(list_transform(regexp_extract_all(m, '(?is)<li>(.*?)</li>', 1), lambda x: {_text("x")}), lambda t: t <> '') as items,
    len(regexp_extract_all(m, '(?i)<[uo]l[\\s>]')) as lists, len(regexp_extract_all(m, '(?i)<table[\\s>]')) as tables,
    len(regexp_extract_all(m, '(?i)<img[\\s>]')) as images, len(regexp_extract_all(m, '(?i)<h[1-3][\\s>]')) as headings
  from clean),
facts as (
  select c.page_id, c.url, {_text("regexp_extract(m, '(?is)<title>(.*?)</title>', 1)")} as title, {_text('m')} as text,
    {_text("regexp_extract(m, '(?is)<h1>(.*?)</h1>', 1)")} as heading, coalesce(n, 0) as n, coalesce(every, '') as every,
    coalesce(first_links, '') as first_links, items, lists, tables, images, headings
  from clean c left join link_sums using (page_id) join page_items using (page_id))"""


def _int(n: int) -> str:
    return f"cast({n} as integer)"


def _paragraphs() -> str:
    """Paragraph texts: each runs to its end tag, the next paragraph or the
    end of the article."""
    return f"""ps as (
  select page_id, url, ps[2:] as ps from (
    select page_id, url, string_split(regexp_replace(m, '(?i)<p(?:\\s[^>]*)?>', chr(2), 'g'), chr(2)) as ps from clean)),
paragraphs as (
  select page_id, url, unnest(ps) as body, generate_subscripts(ps, 1) - 1 as pos from ps)"""


_GATE = "rn * {i} + max(arrival_us - rn * {i}) over ({w} order by arrival_us, req_id rows unbounded preceding)"


def _gate(interval: int, partition: str) -> str:
    start = _GATE.format(i=interval, w=partition)
    return f"""numbered as (
  select req_id, url, domain, arrival_us, row_number() over ({partition} order by arrival_us, req_id) - 1 as rn from requests),
gated as (select req_id, url, domain, arrival_us, cast({start} as bigint) as start_us from numbered)"""


_DOMAIN_GATE = _gate(Q.DOMAIN_RATE.interval_us, "partition by domain")
_GLOBAL_GATE = _gate(Q.GLOBAL_RATE.interval_us, "")
_DELAY_US = 3_600_500_000
_HELD = f"""placed as (
  select g.*, s.base_url is not null as held,
    row_number() over (partition by domain, s.base_url is not null order by start_us, req_id) - 1 as place
  from gated g left join open_sites s on s.base_url = 'https://' || g.domain),
scheduled as (
  select req_id, url, domain, arrival_us, start_us, cast(case when held then place * {_DELAY_US} + max(start_us - place * {_DELAY_US})
    over (partition by domain, held order by start_us, req_id rows unbounded preceding) else start_us end as bigint) as final_us
  from placed)"""

_BACKOFFS = f"""bstops as (select url, min(attempt) as stop from classified where error_type is null or attempt >= {Q.BACKOFF.max_retries} group by url),
backoffs as (
  select c.url, attempt, error_type, case when error_type is not null and attempt < {Q.BACKOFF.max_retries}
    then {Q.BACKOFF.backoff_base} * pow(2.0, attempt) end as backoff
  from classified c left join bstops using (url) where stop is null or attempt <= stop)"""

_ERROR_STATS = """select cast(sum((error_type = 'TransientError')::int) as bigint) as "TransientError",
    cast(sum((error_type = 'PermanentError')::int) as bigint) as "PermanentError",
    cast(sum((error_type = 'NetworkError')::int) as bigint) as "NetworkError",
    cast(sum((error_type = 'ParseError')::int) as bigint) as "ParseError",
    cast(sum((outcome = 'success' and attempt > 0)::int) as bigint) as successful_retries,
    cast(sum((outcome = 'failed' and retryable and attempt >= retry_limit)::int) as bigint) as failed_after_retries,
    count(error_type) as total_error_events,
    cast(sum((outcome = 'failed')::int) as bigint) as final_failures,
    cast(sum((outcome = 'failed' and error_type = 'PermanentError')::int) as bigint) as permanent_error_urls,
    cast(sum(cast(round(retry_delay * 1000000000) as hugeint)) as double) / count(retry_delay) / 1e9 as average_retry_delay
  from ran"""

_SUMMARY = _with(_CLEAN, _LINKS, _BASKETS, _PAGE_FACTS, f"""every as (
  select page_id, url, title, length(text) as text_length, n as links_count, images as images_count, headings as headings_count,
    tables as tables_count, lists as lists_count, first_links from facts
  union all select o_orderkey, 'https://shop.example.com/orders/' || o_orderkey, {_SHOP_TITLE}, length({_SHOP_TEXT}), {len(_SHOP_LINKS) - 1},
    {len(_SHOP_IMAGES)}, {len(_SHOP_HEADINGS)}, {len(_SHOP_TABLES)}, {len(_SHOP_LISTS)}, {" || ' ' || ".join(_SHOP_LINKS[1:])} from orders
  union all select page_id, url, {_BASKET_TITLE}, length({_BASKET_TEXT}), 1, n, 1, 1, n, {_BASKET_LINK} from baskets)""") + """
select page_id, url, title, text_length::integer as text_length, links_count::integer as links_count, images_count::integer as images_count,
  headings_count::integer as headings_count, tables_count::integer as tables_count, lists_count::integer as lists_count, first_links, '' as errors
from every"""

_LOOKUP = (_CLEAN, _LINKS, _URLS, """fetched as (
  select u.url, coalesce(arg_min(html, page_id), '') as html from (select distinct url from url_list) u left join pages using (url) group by u.url)""")


ORACLE: dict[str, str] = {
    "corpus_scan": "select url, html from pages",
    "batch_lookup": _with(*_LOOKUP) + "select url, html from fetched",
    "fetch_status": _with(*_LOOKUP) + """select url, case when length(html) > 0 then 'OK' else 'ERROR' end as status,
  cast(length(html) as integer) as length from fetched""",
    "fetch_extract": _with(*_LOOKUP, "link_sums as (select src_url, count(*) as n from links group by src_url)") + f"""
select f.url, case when c.url is null then '' else {_text("regexp_extract(m, '(?is)<title>(.*?)</title>', 1)")} end as title,
  case when c.url is null then '' else {_text('m')} end as text, cast(coalesce(n, 0) as integer) as links_count,
  case when c.url is null then 0 else 1 end as lists_count,
  case when c.url is null then 'Failed to fetch HTML' else '' end as errors
from fetched f left join clean c using (url) left join link_sums l on l.src_url = f.url""",
    "results_sink": _SUMMARY,
    "page_summary": _SUMMARY,
    "report_sink": _with(*_ATTEMPT_LOG) + """select 'error_stats' as section, cast(1 as bigint) as entries
union all select 'error_history', count(*) from ran where outcome = 'failed'
union all select 'permanent_errors', count(*) from ran where outcome = 'failed' and error_type = 'PermanentError'
union all select 'retry_delays', count(*) from ran where retry_delay is not null""",
    "page_metadata": _with(_CLEAN) + f"""
select page_id, url, {_text("regexp_extract(m, '(?is)<title>(.*?)</title>', 1)")} as title, '' as description, '' as keywords from clean
union all {_ORDER}, {_SHOP_TITLE}, 'Customer ' || o_custkey || ' <' || o_orderstatus || '>', o_orderstatus from orders""",
    "page_text": _with(_CLEAN) + f"select page_id, url, {_text('m')} as text from clean",
    "text_by_selector": _with(_CLEAN, _BASKETS, _paragraphs()) + f"""
select 'p' as selector, page_id, url, cast(pos as integer) as pos,
  {_text("regexp_extract(body, '(?is)^(.*?)(?:</p>|</article>|</body>|<footer>|$)', 1)")} as text from paragraphs
union all select 'div.ad', page_id, url, 0, {_text("regexp_extract(m, '(?is)<div class=.ad.>(.*?)</div>', 1)")} from clean
where regexp_matches(m, '<div class=.ad.>')
union all select 'p', o_orderkey, 'https://shop.example.com/orders/' || o_orderkey, 0, 'Tail © ' || o_orderkey from orders
union all select 'p', page_id, url, 0, n || ' lines' from baskets
union all select 'div.ad', page_id, url, 0, 'Offer ' || page_id from baskets""",
    "page_links": _with(_CLEAN, _LINKS) + "select page_id, src_url, cast(pos as integer) as pos, dst_url from links\nunion all "
    + "\nunion all ".join(
        f"{_ORDER.replace(' as url', ' as src_url')}, {_int(i)} as pos, {link} as dst_url from orders" for i, link in enumerate(_SHOP_LINKS)
    ),
    "page_images": _with(_BASKETS) + _shop_rows(("pos", "src", "alt"), [(_int(i), s, a) for i, (s, a) in enumerate(_SHOP_IMAGES)]) + """
union all select page_id, url, (i - 1)::integer, 'https://shop.example.com/part/' || ls[i].p || '.png', 'Part ' || ls[i].p
from baskets, unnest(range(1, n + 1)) as u(i)""",
    "page_headings": _with(_CLEAN) + f"""
select page_id, url, 0 as pos, 'h1' as level, {_text("regexp_extract(m, '(?is)<h1>(.*?)</h1>', 1)")} as text from clean
union all """ + _shop_rows(("pos", "level", "text"), [(_int(i), l, t) for i, (l, t) in enumerate(_SHOP_HEADINGS)]),
    "page_tables": _with(_BASKETS) + """
select page_id, url, 0 as table_no, 0 as row_no, u.c::integer as cell_no, ['Line', 'Part'][u.c + 1] as text from baskets, unnest([0, 1]) as u(c)
union all select page_id, url, 0, i::integer, u.c::integer, [ls[i].n::varchar, 'Part ' || ls[i].p][u.c + 1]
from baskets, unnest(range(1, n + 1)) as r(i), unnest([0, 1]) as u(c)
union all """ + _shop_rows(
        ("table_no", "row_no", "cell_no", "text"),
        [(_int(t), _int(r), _int(c), v) for t, rows in enumerate(_SHOP_TABLES) for r, row in enumerate(rows) for c, v in enumerate(row)],
    ),
    "page_lists": _with(_CLEAN, f"""items as (
  select page_id, url, unnest(lis) as li, generate_subscripts(lis, 1) as i
  from (select page_id, url, regexp_extract_all(m, '(?is)<li>(.*?)</li>', 1) as lis from clean)),
texts as (select page_id, url, i, {_text('li')} as text from items)""") + """
select page_id, url, 0 as list_no, 'ul' as type, cast(row_number() over (partition by page_id order by i) - 1 as integer) as item_no, text
from texts where text <> ''
union all """ + _shop_rows(
        ("list_no", "type", "item_no", "text"),
        [(_int(n), f"'{kind}'", _int(i), v) for n, (kind, items) in enumerate(_SHOP_LISTS) for i, v in enumerate(items)],
    ),
    "page_record": _with(_CLEAN, _LINKS, _BASKETS, _PAGE_FACTS) + f"""
select page_id, url, title, text, '' as description, '' as keywords, every as links, '' as images, 'h1:' || heading as headings, '' as tables,
  'ul:' || array_to_string(items, '|') as lists from facts
union all select page_id, url, {_BASKET_TITLE}, {_BASKET_TEXT}, '', '', {_BASKET_LINK},
  array_to_string({_EACH.format("'https://shop.example.com/part/' || l.p || '.png^Part ' || l.p")}, ' '), 'h2:' || {_BASKET_TITLE},
  'Line,Part|' || array_to_string({_EACH.format("l.n || ',Part ' || l.p")}, '|'),
  array_to_string(list_transform({_BASKET_LISTS}, lambda t: 'ul:' || t), '||') from baskets
union all {_ORDER}, {_SHOP_TITLE} as title, {_SHOP_TEXT} as text,
  'Customer ' || o_custkey || ' <' || o_orderstatus || '>' as description, o_orderstatus as keywords,
  {" || ' ' || ".join(_SHOP_LINKS[1:])} as links,
  {" || ' ' || ".join(f"{s} || '^' || {alt}" for s, alt in _SHOP_IMAGES)} as images,
  {" || '|' || ".join(f"{level} || ':' || {t}" for level, t in _SHOP_HEADINGS)} as headings,
  {" || '||' || ".join(" || '|' || ".join(" || ',' || ".join(row) for row in rows) for rows in _SHOP_TABLES)} as tables,
  {" || '||' || ".join(f"'{kind}:' || " + " || '|' || ".join(items) for kind, items in _SHOP_LISTS)} as lists
from orders""",
    "extract_errors": _with(_CLEAN, _LINKS, _BASKETS, _PAGE_FACTS) + f"""
select page_id, url, title, n::integer as links_count, '' as errors from facts
union all select page_id, url, {_BASKET_TITLE}, 1, '' from baskets
union all {_ORDER}, case when o_orderstatus = 'P' then '' else {_SHOP_TITLE} end as title,
  case when o_orderstatus = 'P' then 0 else 3 end as links_count,
  case when o_orderstatus = 'P' then 'Failed to parse HTML: TypeError' else '' end as errors from orders""",
    "url_defrag": _dim("regexp_replace(url, '#.*$', '')"),
    "url_valid": _dim(_valid("url")),
    "url_normalize": _dim(_norm("url")),
    "url_domain": _dim(f"case when {_domain('url')} = '' then 'unknown' else {_domain('url')} end"),
    "robots_url": _dim(_base("url") + " || '/robots.txt'"),
    "url_resolve": _with(
        _CLEAN, f"""refs as (
  select page_id, url, unnest([{", ".join(f"'{r}'" for r in Q.REFERENCES)}]) as ref from pages
  union select page_id, url, {_strip(_decode('h'))} from (
    select page_id, url, unnest(regexp_extract_all(m, '(?i)<a\\s[^>]*?href="([^"]*)"', 1)) as h from clean))""",
        f"""cut as (
  select page_id, ref, regexp_extract(url, '^[^/]*//[^/?#]*', 0) as root, lower({_part('url', 1)}) as scheme,
    string_split({_part('url', 3)}, '/') as folder, {_part('url', 3)} as base_path, {_part('url', 4)} as base_query,
    {_part('ref', 1)} as rs, {_part('ref', 2)} as rn, {_part('ref', 3)} as rp, {_part('ref', 4)} as rq from refs)""",
        """segments as (
  select *, case when rp like '/%' then string_split(rp, '/')
    else list_filter(folder[1:len(folder) - 1] || string_split(rp, '/')[1:len(string_split(rp, '/')) - 1], lambda s, i: s <> '' or i = 1)
      || [string_split(rp, '/')[-1]] end as segs from cut)""",
        """walked as (
  select *, list_reduce(list_transform(segs, lambda s: [s]), lambda acc, s:
    case when s[1] = '..' then acc[1:len(acc) - 1] when s[1] = '.' then acc else acc || s end) as steps from segments)""",
    ) + """select page_id, ref, case
    when rs <> '' and rs <> scheme then regexp_replace(ref, '#.*$', '')
    when rn <> '' then scheme || '://' || rn || rp || case when rq <> '' then '?' || rq else '' end
    when rp = '' then root || base_path || case when rq <> '' then '?' || rq when base_query <> '' then '?' || base_query else '' end
    else root || case when starts_with(p, '/') then p else '/' || p end || case when rq <> '' then '?' || rq else '' end end as value
from (select *, array_to_string(case when segs[-1] in ('.', '..') then steps || [''] else steps end, '/') as p from walked)""",
    "seed_domains": f"select distinct {_domain('url')} as domain from pages where {_valid('url')}",
    "domain_counts": _with(*_DIM) + f"""select case when {_domain('url')} = '' then 'unknown' else {_domain('url')} end as domain,
  count(*) as n from url_dim group by 1""",
    "known_antijoin": _with(*_CANDIDATES) + f"select url from candidates where {_UNKNOWN}",
    "same_domain": _with(*_CANDIDATES) + f"select url from candidates where {_IN_COM}",
    "exclude_filter": _with(*_CANDIDATES) + f"select url from candidates where not ({_EXCLUDED})",
    "include_filter": _with(*_CANDIDATES) + f"select url from candidates where {_INCLUDED}",
    "link_filter": _with(*_CANDIDATES)
    + f"select url from candidates where {_valid('url')} and {_UNKNOWN} and {_IN_COM} and not ({_EXCLUDED}) and ({_INCLUDED})",
    "frontier_merge": _with(*_FRONTIER) + "select url, page_id, pos, priority, depth from frontier",
    "frontier_topk": _with(*_FRONTIER) + f"select url, page_id, pos, priority, depth from frontier order by priority desc, seq limit {Q.TOP_K}",
    "depth_lookup": _with(*_FRONTIER) + "select c.url, coalesce(f.depth, 0) as depth from candidates c left join frontier f using (url)",
    "url_state": _with(_REQUESTS, _ATTEMPTS, _classified("attempts")) + """
select url, case when error_type is null then 'processed' else 'failed' end as state, arg_max(coalesce(error_base, ''), attempt) as reason
from classified group by 1, 2""",
    "queue_stats": _STAR_ALL + f""", visited as (select * from ordered where visit_order < {Q.BUDGET}),
queued as (select distinct e.dst as url from visited v join edges e on e.src = v.url
  where v.status = 'processed' and v.depth < {Q.STAR_DEPTH} and e.dst not in (select url from visited)),
counts as (select (select count(*) from queued) as queued, (select count(*) from visited where status = 'processed') as processed,
  (select count(*) from visited where status <> 'processed') as failed)
select *, queued + processed + failed as total_known from counts""",
    "crawl_bfs": _STAR_ALL + f"select url, depth, visit_order, status, {_REASON} from ordered",
    "crawl_budget": _STAR_ALL + f"select url, depth, visit_order, status from ordered where visit_order < {Q.BUDGET}",
    "discovered_counts": _STAR_ALL + "select discoverer as url, count(*) as added from ordered where discoverer is not null group by 1",
    "crawl_outcome": _with(*_PAGE_CRAWL) + f"""select url, depth, status, case status when 'blocked' then
  'Blocked by robots.txt for user-agent {Q.BOT}' when 'failed' then 'Failed to fetch HTML' else '' end as reason from crawled""",
    "crawl_progress": _with(*_PAGE_CRAWL, _REQUESTS, "ends as (select min(arrival_us) as a, max(arrival_us) as b from requests)") + """,
counts as (select cast(sum((status = 'processed')::int) as bigint) as processed, cast(0 as bigint) as queued,
    cast(sum((status = 'failed')::int) as bigint) as failed, cast(sum((status = 'blocked')::int) as bigint) as blocked from crawled)
select *, (select count(*) from requests, ends where arrival_us <= b and end_us > b) as active, (select b - a from ends) as elapsed_us,
  (processed + failed + blocked) * 1000000.0::double / (select (b - a)::double from ends) as pages_per_second from counts""",
    "outcome_by_domain": _with(*_PAGE_CRAWL) + f"select {_domain('url')} as domain, depth, status, count(*) as urls from crawled group by 1, 2, 3",
    "rate_schedule": _with(_REQUESTS, _DOMAIN_GATE) + "select req_id, domain, arrival_us, start_us from gated",
    "rate_schedule_global": _with(_REQUESTS, _GLOBAL_GATE) + "select req_id, domain, arrival_us, start_us from gated",
    "crawl_delay_schedule": _with(_REQUESTS, _SITES, _GLOBAL_GATE, _HELD) + "select * from scheduled",
    "request_wait": _with(_REQUESTS, _SITES, _DOMAIN_GATE, _HELD) + "select req_id, domain, final_us - arrival_us as wait_us from scheduled",
    "rate_stats": _with(_REQUESTS, _ATTEMPTS, _classified("attempts"), _SITES, _DOMAIN_GATE, _HELD, _BACKOFFS) + f"""
select {Q.DOMAIN_RATE.requests_per_second!r}::double as requests_per_second, {Q.DOMAIN_RATE.effective_rps!r}::double as effective_requests_per_second,
  (select count(*) from requests where arrival_us >= (select max(arrival_us) - 1000000 from requests)) as current_requests_per_second,
  (select cast(sum(final_us - arrival_us) as double) / count(*) / 1000000 from scheduled) as average_delay,
  (select count(distinct r.url) from requests r left join open_sites s on s.base_url = 'https://' || r.domain where not {_allowed('r.url', Q.BOT)}) as blocked_by_robots,
  (select count(*) from requests) as total_requests, (select count(*) from backoffs where backoff is not null) as backoff_count""",
    "trailing_rps": _with(_REQUESTS) + """select req_id, arrival_us,
  count(*) over (order by arrival_us range between 1000000 preceding and current row) as trailing from requests""",
    "concurrency_profile": _with(_REQUESTS, """steps as (
  select at_us, sum(d) as d from (select arrival_us as at_us, 1 as d from requests where end_us > arrival_us
    union all select end_us, -1 from requests where end_us > arrival_us) group by 1)""")
    + "select at_us, cast(sum(d) over (order by at_us) as bigint) as active from steps",
    "concurrency_peaks": _with(_REQUESTS, """steps as (
  select domain, at_us, sum(d) as d from (select domain, arrival_us as at_us, 1 as d from requests where end_us > arrival_us
    union all select domain, end_us, -1 from requests where end_us > arrival_us) group by 1, 2),
profile as (select domain, sum(d) over (partition by domain order by at_us) as active from steps)""")
    + "select domain, cast(max(active) as bigint) as peak from profile group by 1",
    "domain_waves": _with(_REQUESTS) + """select req_id, domain, arrival_us,
  (row_number() over (partition by domain order by arrival_us, req_id) - 1) // 2 as wave from requests""",
    "robots_source": _with(_SITES) + """select base_url, base_url || '/robots.txt' as robots_url, n % 5 <> 0 as available, case when n % 5 <> 0 then
  replace(replace(replace('"""
    + ROBOTS_FILE.replace("'", "''").replace("\n", "' || chr(10) || '").replace("\r", "' || chr(13) || '")
    + """', '{site}', base_url), '{blocked}', case when n % 4 = 0 then '/en' when n % 4 = 1 then '/fr' when n % 4 = 2 then '/de' else '' end),
  '{delay}', cast(n % 3 as varchar)) end as body from sites""",
    "robots_rules": _with(_SITES) + " union all ".join(
        f"select base_url, {g} as group_no, '{a}' as agents, {d} as is_default, {n} as rule_no, {w} as allow, {p} as path from open_sites"
        for g, a, d, n, w, p in [
            (1, "*", "true", 0, "blocked = ''", "blocked"), (1, "*", "true", 1, "true", "'/es/1'"), (1, "*", "true", 2, "false", "'/es'"),
            (3, "MyBot,Other", "false", 0, "true", "'/en/1'"), (3, "MyBot,Other", "false", 1, "false", "'/en'"),
            (3, "MyBot,Other", "false", 2, "false", "'/sign'"), (5, "MyBot", "false", 0, "false", "'/fr'"),
            (6, "Third", "false", 0, "false", "'/fr'"),
        ]
    ),
    "robots_allowed": _with(*_DIM, _SITES) + " union all ".join(
        f"select d.url, '{ua}' as user_agent, {_allowed(_strip('d.url'), ua)} as allowed from url_dim d left join open_sites s on s.base_url = {_DIM_HTTP}"
        for ua in (Q.BOT, Q.READER)
    ),
    "robots_delays": _with(_SITES) + """select base_url, '*' as agent, 0 as position, cast(n % 3 as double) as delay from open_sites
union all select base_url, 'mybot', 1, 3600.5 from open_sites union all select base_url, 'other', 2, 7200.0 from open_sites""",
    "crawl_delay_for_agent": _with(_SITES) + " union all ".join(
        f"select s.base_url, '{ua}' as user_agent, cast(case when o.base_url is null then 0.0 else {v} end as double) as delay"
        " from sites s left join open_sites o using (base_url)"
        for ua, v in ((Q.BOT, "3600.5"), ("Other", "7200.0"), (Q.READER, "s.n % 3"))
    ),
    "robots_blocked": _with(*_DIM, _SITES) + f"""select d.url, 'Blocked by robots.txt for user-agent {Q.BOT}' as reason
from url_dim d left join open_sites s on s.base_url = {_DIM_HTTP} where not {_allowed(_strip('d.url'), Q.BOT)}""",
    "classify_status": _with(_REQUESTS) + """select req_id, status,
  case when status in (408, 425, 429, 500, 502, 503, 504) or status >= 500 then 'TransientError' when status >= 400 then 'PermanentError' end as type,
  case when status in (408, 425, 429, 500, 502, 503, 504) then 'Transient' when status >= 500 then 'Server'
    when status in (400, 401, 403, 404, 405, 410) then 'Permanent' when status >= 400 then 'Client' end || ' HTTP error: ' || status as message
from requests""",
    "classify_outcome": _with(_REQUESTS, _classified("requests")) + "select req_id, kind, error_type, error_base, error_status, error_cause from classified",
    "error_message": _with(_REQUESTS, _classified("requests")) + "select req_id, message from messages where error_type is not null",
    "retryable": _with(_REQUESTS, _classified("requests")) + """select req_id, error_type,
  coalesce(error_type in ('TransientError', 'NetworkError'), false) as retryable from classified""",
    "retry_replay": _with(*_ATTEMPT_LOG) + "select url, attempt, error_type, outcome from ran",
    "retry_delays": _with(*_ATTEMPT_LOG) + "select url, attempt, retry_delay from ran where retry_delay is not null",
    "retry_limits": _with(_REQUESTS, _classified("requests")) + f"""select req_id, error_type,
  case when error_type = 'NetworkError' then 1 else {Q.RETRY.max_retries} end as retry_limit from classified""",
    "simple_backoff": _with(_REQUESTS, _ATTEMPTS, _classified("attempts"), _BACKOFFS) + "select url, attempt, error_type, backoff from backoffs",
    "timeout_by_attempt": _with(_REQUESTS, _ATTEMPTS) + f"""select url, attempt, {Q.TIMEOUT.total_timeout} * pow(2.0, attempt) as total,
  {Q.TIMEOUT.connect_timeout} * pow(2.0, attempt) as connect, {Q.TIMEOUT.read_timeout} * pow(2.0, attempt) as "read" from attempts""",
    "error_history": _with(*_ATTEMPT_LOG) + """select url, attempt, error_type as type, message, error_status as status_code
from ran where outcome = 'failed'""",
    "permanent_errors": _with(*_ATTEMPT_LOG) + "select url, message from ran where outcome = 'failed' and error_type = 'PermanentError'",
    "error_stats": _with(*_ATTEMPT_LOG) + _ERROR_STATS,
    "error_report": _with(*_ATTEMPT_LOG) + """
select 'error_stats' as section, cast(null as varchar) as url, cast(null as varchar) as message, cast(null as double) as retry_delay,
  count(error_type) as total_error_events from ran
union all select 'error_history', url, message, null, null from ran where outcome = 'failed'
union all select 'permanent_errors', url, message, null, null from ran where outcome = 'failed' and error_type = 'PermanentError'
union all select 'retry_delays', url, null, retry_delay, null from ran where retry_delay is not null""",
    "stream_visited": _with(_REQUESTS) + "select distinct 'https://' || domain || '/' || day_no as url from requests",
    "stream_trailing": _with(_REQUESTS) + """select req_id, arrival_us,
  count(*) over (order by arrival_us range between 1000000 preceding and current row) as trailing from requests""",
    "stream_rate": _with(_REQUESTS) + """select cast(arrival_us // 1000000 * 1000000 as bigint) as window_us, domain, count(*) as n
from requests group by 1, 2""",
    "stream_schedule": _with(_REQUESTS, _DOMAIN_GATE) + "select req_id, domain, arrival_us, start_us from gated",
    "stream_errors": _with(_REQUESTS, _classified("requests")) + """select error_type, count(*) as n from classified
where error_type is not null group by 1""",
}
