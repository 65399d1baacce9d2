"""HTML columns: tag and attribute patterns, entity decoding, node text and
element scopes. Every function is a native expression over one page's text, so
extraction runs where the page was read, without a shuffle.

Control characters mark positions while a page is taken apart: ``NODE`` ends a
text node, ``OPEN`` and ``BODY`` enclose a tag the caller cares about.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusweave.functions.binding import let
from corpusweave.functions.urls import WHITESPACE, strip

NODE, OPEN, BODY = "\x01", "\x02", "\x03"

# Markup patterns. Attribute runs are quote-aware and possessive,
# so one odd tag cannot make matching recurse or backtrack without end.
_ATTRS = r"""[^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+')?+[^>=]*+)*+"""
COMMENT = r"!--.*?(?:-->|\z)"
TAG = r"(?s)<[/!?a-zA-Z](?:" + _ATTRS + r"|[^>]*+)(?:>|\z)"
RAW_TEXT = ("script", "style")
PRUNED = ("script", "style", "noscript")
HIDDEN_STRINGS = ("template", "rt", "rp")
SPACES = "[" + WHITESPACE + "]"
FETCH_FAILED = "Failed to fetch HTML"

# Tags that end an open paragraph, by the HTML parsing rules.
PARAGRAPH_ENDERS = (
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
)
VOID_TAGS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
)


def _element(name: str) -> str:
    return rf"{name}(?=[\s/>]){_ATTRS}>.*?(?:</{name}\s*+>|\z)"


def without(html: Column, names: tuple[str, ...]) -> Column:
    """Replace comments and whole named elements by a node boundary; whichever
    starts first wins, so a script may quote a comment and the reverse."""
    # One leading "<" lets matching skip ahead instead of trying every name.
    pattern = "(?is)<(?:" + "|".join([COMMENT, *(_element(n) for n in names)]) + ")"
    # Translating looks every character up, searching for a few does not.
    marked = html.contains(NODE) | html.contains(OPEN) | html.contains(BODY)
    return F.regexp_replace(F.when(marked, F.translate(html, NODE + OPEN + BODY, "")).otherwise(html), pattern, NODE)


def markup(html: Column) -> Column:
    """Page without comments and without script/style bodies."""
    return without(html, RAW_TEXT)


def pruned(html: Column) -> Column:
    """Page as it stands after its non-visible elements were deleted."""
    return without(html, PRUNED)


def visible(html: Column) -> Column:
    return without(html, PRUNED + HIDDEN_STRINGS)


def holds(html: Column, names: tuple[str, ...]) -> Column:
    """Whether a page has a tag of one of these names at all."""
    return html.rlike(r"(?i)<(?:" + "|".join(names) + r")[\s/>]")


def read_aloud(html: Column) -> Column:
    """Page whose element texts count: ruby and template strings are no text of
    the heading, cell or item around them."""
    return without(html, RAW_TEXT + HIDDEN_STRINGS)


# -- entities ---------------------------------------------------------------

def _legacy_names() -> list[str]:
    return sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))


def _name_map() -> Column:
    """Every named reference, without its semicolon, as one constant."""
    pairs = {name[:-1]: char for name, char in html5.items() if name.endswith(";")}
    text = NODE.join(f"{name}{OPEN}{char}" for name, char in sorted(pairs.items()))
    return F.str_to_map(F.lit(text), F.lit(NODE), F.lit(OPEN))


def _windows_1252() -> tuple[str, str]:
    """Codes 128 to 159 stand for what Windows-1252 has there, if anything."""
    pairs = {chr(code): bytes([code]).decode("cp1252", "ignore") for code in range(0x80, 0xA0)}
    pairs = {control: char for control, char in pairs.items() if char}
    return "".join(pairs), "".join(pairs.values())


_WINDOWS_1252 = _windows_1252()


def _from_code(reference: Column) -> Column:
    """Character of ``123`` or ``x7B``; codes outside Unicode become U+FFFD."""
    digits = F.regexp_replace(F.ltrim(reference, F.lit("xX")), "^0+(?=.)", "")
    short = F.length(digits) <= 7
    wide = F.when(short, F.when(reference.rlike("^[xX]"), digits).otherwise(F.conv(digits, 10, 16)))
    padded = F.lpad(F.upper(wide), 8, "0")
    ok = padded.between("00000004", "0000D7FF") | padded.between("0000E000", "0010FFFF")
    return F.translate(F.when(ok, F.decode(F.unhex(padded), "UTF-32")).otherwise("\ufffd"), *_WINDOWS_1252)


def decode_entities(text: Column, in_attribute: bool = False) -> Column:
    """Decode character references once, left to right. A name without its
    semicolon is decoded for the historic names only; in attributes it must
    not run into a letter, digit or ``=``."""
    legacy = "|".join(_legacy_names())
    bare = rf"^({legacy})(?![A-Za-z0-9=])" if in_attribute else rf"^({legacy})"
    names = _name_map()
    number = r"^#([0-9]+|[xX][0-9A-Fa-f]+);?"

    def one(part: Column) -> Column:
        numeric = F.concat(_from_code(F.regexp_extract(part, number, 1)), F.regexp_replace(part, number, ""))
        named = F.regexp_extract(part, r"^([A-Za-z][A-Za-z0-9]*);", 1)
        old = F.regexp_extract(part, bare, 1)
        by_name = F.concat(F.try_element_at(names, named), F.substr(part, F.length(named) + 2))
        by_old = F.concat(F.try_element_at(names, old), F.substr(part, F.length(old) + 1))
        return (
            F.when(part.startswith("amp;"), F.concat(F.lit("&"), F.substr(part, F.lit(5))))
            .when(part.rlike(number), numeric)
            .otherwise(F.coalesce(by_name, by_old, F.concat(F.lit("&"), part)))
        )

    def decoded(whole: Column) -> Column:
        parts = F.transform(F.split(whole, "&"), lambda p, i: F.when(i == 0, p).otherwise(one(p)))
        return F.when(whole.contains("&"), F.array_join(parts, "")).otherwise(whole)

    return let(text, decoded)


# -- text -------------------------------------------------------------------

def untag(marked: Column) -> Column:
    """Tags become node boundaries, then character references are decoded."""
    return decode_entities(F.regexp_replace(marked, TAG, NODE))


def nodes(flat: Column) -> Column:
    """Stripped, non-empty text nodes of a string whose boundaries are marked."""
    return F.filter(F.transform(F.split(flat, NODE), strip), lambda t: t != "")


def node_text(flat: Column, separator: str = " ") -> Column:
    return F.array_join(nodes(flat), separator)


def visible_text(html: Column) -> Column:
    return node_text(untag(visible(html)))


def title_of(clean: Column) -> Column:
    """Text of the first title; a title that never closes ends with the head."""
    inner = F.regexp_extract(
        clean, rf"(?is)<title(?=[\s/>]){_ATTRS}>(.*?)(?:</title|</head|<body|\z)", 1
    )
    return node_text(untag(inner), "")


# -- tags and attributes ----------------------------------------------------

def tags(clean: Column, name: str) -> Column:
    """Start tags of one element name, in document order."""
    return F.regexp_extract_all(clean, F.lit(rf"(?is)<{name}(?=[\s/>]){_ATTRS}>"), 0)


def attribute_values(tag_array: Column, name: str) -> Column:
    """First value of an attribute in each tag; empty where it is absent."""
    # Every attribute but the wanted one, however many: possessive, so matching neither recurses nor backtracks.
    other = rf"""(?:[\s/]++(?!{name}\s*+=)[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+)*+"""
    value = r"""("[^"]*+"|'[^']*+'|[^\s"'>]++)"""
    pattern = rf"(?is)^<[^\s/>]++{other}[\s/]++{name}\s*+=\s*+{value}"
    quoted = F.transform(tag_array, lambda t: F.regexp_extract(t, pattern, 1))
    bare = F.transform(
        quoted,
        lambda v: F.when(v.startswith('"') | v.startswith("'"), F.substr(v, F.lit(2), F.length(v) - 2)).otherwise(v),
    )
    return F.transform(bare, lambda v: F.when(v.contains("&"), decode_entities(v, in_attribute=True)).otherwise(v))


def meta_pairs(clean: Column) -> Column:
    """(name, content) of each meta tag."""
    return let(
        tags(clean, "meta"),
        lambda metas: F.arrays_zip(
            attribute_values(metas, "name").alias("name"), attribute_values(metas, "content").alias("content")
        ),
    )


def meta_content(pairs: Column, name: str) -> Column:
    """Stripped content of the first meta tag of that exact name."""
    first = F.try_element_at(F.filter(pairs, lambda p: p["name"] == name), F.lit(1))
    return strip(F.coalesce(first["content"], F.lit("")))


def heading_items(clean: Column) -> Column:
    """h1–h3 in document order as (level, text), blank ones dropped."""
    found = F.regexp_extract_all(
        clean, F.lit(r"(?is)<h[1-3](?=[\s/>])" + _ATTRS + r">.*?(?:</h[1-6]\s*+>|(?=<h[1-6][\s/>])|\z)"), 0
    )
    items = F.transform(
        found, lambda h: F.struct(F.lower(F.substr(h, F.lit(2), F.lit(2))).alias("level"), node_text(untag(h)).alias("text"))
    )
    return F.filter(items, lambda h: h["text"] != "")
