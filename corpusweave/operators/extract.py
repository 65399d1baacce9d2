"""Page extraction: every operator maps pages (page_id, url, html) to facts.

Work stays inside the task that read the page. One kind of fact is made of array
columns; records, nested elements and selectors come from ``functions/pages.py``.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusweave.functions import html as H
from corpusweave.functions import pages as P
from corpusweave.functions import urls as U
from corpusweave.functions.binding import let, settled


# -- array columns over cleaned markup --------------------------------------

def _bad_host(reference: Column) -> Column:
    """Only a reference with a bracket at all is matched."""
    return (reference.contains("[") | reference.contains("]")) & F.rlike(reference, F.lit(U.BAD_HOST))


def link_array(clean: Column, page_url: Column) -> Column:
    """Absolute web links of a page, first occurrence of each exact string; null
    if a reference has a host that cannot be read."""
    hrefs = F.transform(H.attribute_values(H.tags(clean, "a"), "href"), U.strip)
    found = F.array_distinct(F.filter(hrefs, lambda h: (h != "") & ~h.startswith("#")))

    def resolved(wanted: Column) -> Column:
        absolute = let(
            U.split_url(page_url),
            lambda base: F.transform(F.transform(wanted, U.split_url), lambda r: U.resolve_split(base, r)),
        )
        bad = F.exists(wanted, _bad_host)
        return F.when(~bad, F.array_distinct(F.filter(absolute, U.is_web_url)))

    return let(found, resolved)


def image_array(clean: Column, page_url: Column) -> Column:
    """(src, alt) of every image with a web source, duplicates kept; null if a
    source has a host that cannot be read."""
    pairs = let(
        H.tags(clean, "img"),
        lambda imgs: F.arrays_zip(
            F.transform(H.attribute_values(imgs, "src"), U.split_url).alias("ref"),
            H.attribute_values(imgs, "alt").alias("alt"),
        ),
    )

    def resolved(found: Column) -> Column:
        images = let(
            U.split_url(page_url),
            lambda base: F.transform(
                F.filter(found, lambda p: p["ref"]["raw"] != ""),
                lambda p: F.struct(
                    U.resolve_split(base, p["ref"], keep_fragment=True).alias("src"), U.strip(p["alt"]).alias("alt")
                ),
            ),
        )
        bad = F.exists(found, lambda p: _bad_host(p["ref"]["raw"]))
        return F.when(~bad, F.filter(images, lambda i: U.is_web_url(i["src"])))

    return let(pairs, resolved)


# -- exploded tables --------------------------------------------------------

def metadata(clean: Column) -> Column:
    """(title, description, keywords) of a page."""
    return let(
        H.meta_pairs(clean),
        lambda metas: F.struct(
            H.title_of(clean).alias("title"),
            H.meta_content(metas, "description").alias("description"),
            H.meta_content(metas, "keywords").alias("keywords"),
        ),
    )


def metadata_table(pages: DataFrame) -> DataFrame:
    return _array_rows(pages, "meta", metadata).select("page_id", "url", "meta.title", "meta.description", "meta.keywords")


def text_table(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", H.visible_text(F.col("html")).alias("text"))


def _array_rows(pages: DataFrame, name: str, build, clean=H.markup) -> DataFrame:
    """Pages with one column of facts, computed once per page."""
    facts = let(clean(F.col("html")), build)
    return settled(pages.select("page_id", "url", facts.alias(name)), name, F.col(name))


def link_table(pages: DataFrame) -> DataFrame:
    """Edges (page_id, src_url, pos, dst_url)."""
    links = _array_rows(pages, "links", lambda m: link_array(m, F.col("url")))
    return links.select("page_id", F.col("url").alias("src_url"), F.posexplode("links").alias("pos", "dst_url"))


def image_table(pages: DataFrame) -> DataFrame:
    images = _array_rows(pages, "images", lambda m: image_array(m, F.col("url")))
    return images.select("page_id", "url", F.posexplode("images").alias("pos", "i")).select(
        "page_id", "url", "pos", "i.src", "i.alt"
    )


def heading_table(pages: DataFrame) -> DataFrame:
    headings = _array_rows(pages, "headings", H.heading_items, H.read_aloud)
    return headings.select("page_id", "url", F.posexplode("headings").alias("pos", "i")).select(
        "page_id", "url", "pos", "i.level", "i.text"
    )


def cell_table(pages: DataFrame) -> DataFrame:
    """Cell texts of every table; a nested table's rows also show in the table around it."""
    cells = settled(pages.select("page_id", "url", "html"), "html", P.table_cells(F.col("html")))
    return cells.select("page_id", "url", F.inline("html"))


def list_item_table(pages: DataFrame) -> DataFrame:
    """Items of every non-empty list: its direct children, whatever else may stand in between."""
    items = settled(pages.select("page_id", "url", "html"), "html", P.list_items(F.col("html")))
    return items.select("page_id", "url", F.inline("html"))


# -- selectors --------------------------------------------------------------

def _parse_selector(selector: str) -> tuple[str | None, str | None, str | None]:
    found = re.fullmatch(r"([A-Za-z][A-Za-z0-9-]*)?(?:\.([\w-]+)|#([\w-]+))?", selector.strip())
    if not selector.strip() or not found:
        raise ValueError("selector must be tag, .class, #id, tag.class or tag#id")
    tag, cls, ident = found.groups()
    return (tag.lower() if tag else None), cls, ident


def _hidden(selector: str) -> tuple[str, ...]:
    """Raw-text bodies hold no elements; a selector for one of them wants the body."""
    tag = _parse_selector(selector)[0]
    return tuple(n for n in H.RAW_TEXT + H.HIDDEN_STRINGS if n != tag)


def _selected(pages: DataFrame, selectors: tuple[str, ...]) -> DataFrame:
    """(page_id, url, found): the texts of each selector's elements, a page taken apart once.
    The selectors must hide the same elements."""
    found = P.selected(F.col("html"), [_parse_selector(s) for s in selectors], _hidden(selectors[0]))
    return settled(pages.select("page_id", "url", "html"), "found", found).select("page_id", "url", "found")


def selector_matches(pages: DataFrame, selector: str) -> DataFrame:
    """(page_id, url, pos, text) per element that matches the selector."""
    return _selected(pages, (selector,)).select("page_id", "url", F.posexplode(F.col("found")[0]).alias("pos", "text"))


def matches_of_each(pages: DataFrame, selectors: tuple[str, ...]) -> DataFrame:
    """(selector, page_id, url, pos, text) per selector and element that matches it. A page is
    taken apart once for all selectors that hide the same elements."""
    alike: dict[tuple[str, ...], list[str]] = {}
    for s in dict.fromkeys(selectors):
        alike.setdefault(_hidden(s), []).append(s)
    parts = []
    for group in alike.values():
        named = F.transform(
            F.arrays_zip(F.array(*(F.lit(s) for s in group)).alias("s"), F.col("found").alias("f")),
            lambda g: F.struct(g["s"].alias("selector"), g["f"].alias("texts")),
        )
        rows = _selected(pages, tuple(group)).select("page_id", "url", F.explode(named).alias("g"))
        parts.append(rows.select(F.col("g.selector").alias("selector"), "page_id", "url", F.posexplode("g.texts").alias("pos", "text")))
    return reduce(DataFrame.unionByName, parts)


def text_by_selector(pages: DataFrame, selector: str) -> DataFrame:
    """One row per page: matching elements' texts joined by a space."""
    return _selected(pages, (selector,)).select("page_id", "url", F.array_join(F.col("found")[0], " ").alias("text"))


# -- whole records ----------------------------------------------------------

def page_records(pages: DataFrame, missing: Column | None = None) -> DataFrame:
    """The full typed record per page, plus ``missing`` when it is given.

    Title and meta come from the page as read; links, images, headings, tables
    and lists from the page after script, style and noscript were removed. A
    NULL body becomes a parse-failure record. Links or images that cannot be
    resolved fail by themselves: that part is empty and ``errors`` names it.
    """
    keep = [c for c in ("page_id",) if c in pages.columns]
    if missing is not None:
        pages = pages.withColumn("missing", missing)
        keep.append("missing")
    failed = F.col("_failed")
    parts = pages.select(*keep, "url", F.col("html").isNull().alias("_failed"), P.record(F.col("html"), F.col("url")).alias("_r"))
    part = lambda name: F.col(f"_r.{name}").alias(name)
    part_errors = [
        F.when(failed, "Failed to parse HTML: TypeError"),
        F.when(F.col("_r.links").isNull(), "Failed to extract links: ValueError"),
        F.when(F.col("_r.images").isNull(), "Failed to extract images: ValueError"),
    ]
    return parts.select(
        *keep, "url", part("title"), part("text"), F.coalesce("_r.links", F.array().cast("array<string>")).alias("links"),
        F.when(~failed, F.struct(part("title"), part("description"), part("keywords"))).alias("metadata"),
        F.coalesce("_r.images", F.array().cast("array<struct<src:string,alt:string>>")).alias("images"),
        part("headings"), part("tables"), part("lists"), F.array_compact(F.array(*part_errors)).alias("errors"),
    )


def with_fetch_failures(records: DataFrame, missing: Column) -> DataFrame:
    """Rows whose body is missing or empty become the failed-fetch record."""
    out = records
    for name in ("links", "images", "headings", "tables", "lists"):
        kind = records.schema[name].dataType
        out = out.withColumn(name, F.when(missing, F.array().cast(kind)).otherwise(F.col(name)))
    for name in ("title", "text"):
        out = out.withColumn(name, F.when(missing, F.lit("")).otherwise(F.col(name)))
    return out.withColumn("metadata", F.when(~missing, F.col("metadata"))).withColumn(
        "errors", F.when(missing, F.array(F.lit(H.FETCH_FAILED))).otherwise(F.col("errors"))
    )


def page_summary(records: DataFrame, first_links: int = 5) -> DataFrame:
    """Counts per page, with the first links of each."""
    keep = [c for c in ("page_id",) if c in records.columns]
    return records.select(
        *keep,
        "url",
        "title",
        F.length("text").alias("text_length"),
        F.size("links").alias("links_count"),
        F.size("images").alias("images_count"),
        F.size("headings").alias("headings_count"),
        F.size("tables").alias("tables_count"),
        F.size("lists").alias("lists_count"),
        F.slice("links", 1, first_links).alias("first_links"),
        "errors",
    )
