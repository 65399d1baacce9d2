"""URL columns. All are native expressions that follow RFC 3986 splitting and
the resolution rules of the usual URL libraries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusweave.functions.binding import let

# Splitting pattern (scheme, netloc, path, query, fragment), web
# URLs, URLs already in normal form, and the characters Unicode-aware stripping removes.
URL_PATTERN = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
WEB_URL = r"^(?i:https?)://[^/?#]"
NORMAL_URL = (
    r"^https?://[a-z0-9.:_-]+/[\x21\x22\x24-\x3a\x3c-\x3e\x40-\x7e]*(?:\?[\x21\x22\x24-\x7e]+)?$"
)
# A host with a bracket that has no partner cannot be resolved at all.
BAD_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?=[^/?#]*[\[\]])(?![^/?#\[\]]*\[[^/?#\[\]]*\][^/?#\[\]]*(?:[/?#]|$))"
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def url_part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, URL_PATTERN, group)


def clean(url: Column) -> Column:
    """Tabs and line breaks inside a URL carry no meaning."""
    broken = url.contains("\t") | url.contains("\r") | url.contains("\n")
    return F.when(broken, F.translate(strip(url), "\t\r\n", "")).otherwise(strip(url))


def defrag(url: Column) -> Column:
    return F.regexp_replace(url, r"(?s)#.*$", "")


def split_url(url: Column) -> Column:
    """raw, scheme (lower case), netloc, path, query."""
    # A clean URL has no line break, so one match gives all parts.
    parts = lambda raw: F.split(F.regexp_replace(raw, URL_PATTERN, "$1\n$2\n$3\n$4"), "\n")
    return let(
        F.struct(clean(url).alias("raw")),
        lambda r: let(
            F.struct(r["raw"].alias("raw"), parts(r["raw"]).alias("p")),
            lambda s: F.struct(
                s["raw"].alias("raw"), F.lower(s["p"][0]).alias("scheme"), s["p"][1].alias("netloc"), s["p"][2].alias("path"), s["p"][3].alias("query"),
            ),
        ),
    )


def _query_tail(query: Column) -> Column:
    return F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")


def _merge_path(base_path: Column, path: Column) -> Column:
    base_segments = F.split(base_path, "/")
    folder = F.when(
        F.element_at(base_segments, -1) != "",
        F.slice(base_segments, F.lit(1), F.size(base_segments) - 1),
    ).otherwise(base_segments)
    joined = F.concat(folder, F.split(path, "/"))
    tidy = let(joined, lambda j: F.filter(j, lambda s, i: (s != "") | (i == 0) | (i == F.size(j) - 1)))
    segments = F.when(path.startswith("/"), F.split(path, "/")).otherwise(tidy)

    def walk(segs: Column) -> Column:
        steps = F.aggregate(
            segs,
            F.array().cast("array<string>"),
            lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
            .when(s == ".", acc)
            .otherwise(F.concat(acc, F.array(s))),
        )
        closing = F.when(F.element_at(segs, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        return F.array_join(F.concat(steps, closing), "/")

    return let(
        let(segments, walk), lambda text: F.when(text.startswith("/"), text).otherwise(F.concat(F.lit("/"), text))
    )


def resolve_split(base: Column, ref: Column, keep_fragment: bool = False) -> Column:
    """Resolve a split reference against a split base (see ``split_url``)."""
    scheme, netloc = base["scheme"], base["netloc"]
    raw = ref["raw"]
    fragment = F.regexp_extract(raw, r"(?s)#(.+)$", 0) if keep_fragment else F.lit("")
    tail = F.concat(_query_tail(ref["query"]), fragment)
    foreign = (ref["scheme"] != "") & (ref["scheme"] != scheme)
    if keep_fragment:
        verbatim = raw
    else:
        rest = defrag(raw)
        verbatim = F.when(
            raw.contains("#"),
            F.concat(ref["scheme"], F.substr(rest, F.length(ref["scheme"]) + 1)),
        ).otherwise(raw)
    root = F.concat(scheme, F.lit("://"), netloc)
    plain_absolute = ref["path"].startswith("/") & ~ref["path"].contains("/.")
    own_or_base_query = F.when(ref["query"] != "", ref["query"]).otherwise(base["query"])
    return (
        F.when(foreign, verbatim)
        .when(ref["netloc"] != "", F.concat(scheme, F.lit("://"), ref["netloc"], ref["path"], tail))
        .when(ref["path"] == "", F.concat(root, base["path"], _query_tail(own_or_base_query), fragment))
        .when(plain_absolute, F.concat(root, ref["path"], tail))
        .otherwise(F.concat(root, _merge_path(base["path"], ref["path"]), tail))
    )


def resolve(base_url: Column, href: Column) -> Column:
    """Absolute URL of ``href`` found on ``base_url``, without its fragment."""
    return resolve_split(split_url(base_url), split_url(href))


def is_web_url(url: Column) -> Column:
    return url.rlike(WEB_URL)


def normalize_split(parts: Column) -> Column:
    """Lower netloc, no last-segment parameters, a slash for an empty path; path
    case and query stay."""
    netloc = F.lower(parts["netloc"])
    path = F.regexp_replace(parts["path"], r"(?s);[^/]*$", "")
    return F.concat(
        F.when(parts["scheme"] != "", F.concat(parts["scheme"], F.lit(":"))).otherwise(""),
        F.when(netloc != "", F.concat(F.lit("//"), netloc)).otherwise(""),
        F.when(path == "", "/").otherwise(path),
        _query_tail(parts["query"]),
    )


def normalize(url: Column) -> Column:
    """Normal form of a URL without its fragment. A URL that is normal already,
    as most are, costs one match."""
    return F.when(url.rlike(NORMAL_URL), url).otherwise(normalize_split(split_url(url)))


def normalize_each(url_array: Column) -> Column:
    return F.transform(F.transform(url_array, split_url), normalize_split)


def domain(url: Column) -> Column:
    return F.lower(F.regexp_extract(clean(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1))


def domain_or_unknown(url: Column) -> Column:
    d = domain(url)
    return F.when(d == "", "unknown").otherwise(d)


def base_url(url: Column) -> Column:
    """Scheme and netloc in lower case, nothing else."""
    return F.lower(F.regexp_extract(clean(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?", 0))


def robots_url(url: Column) -> Column:
    return F.concat(base_url(url), F.lit("/robots.txt"))


def unquote(text: Column) -> Column:
    """Percent-decode; ``+`` and malformed escapes stay as they are."""
    guarded = F.regexp_replace(F.replace(text, F.lit("+"), F.lit("%2B")), r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.when(text.contains("%"), F.url_decode(guarded)).otherwise(text)


def matches_any(url: Column, patterns: tuple[str, ...] | list[str]) -> Column:
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | url.rlike(pattern)
    return hit
