"""Links, key/value tables and source classes out of HTML message bodies, whole bodies always."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what an archive link looks like.
ARCHIVE_LINK_RE = r"(?i)https://mailback\d*\.camsonline\.com/[^\s\"<>]+\.zip"

ANCHOR_RE = r"(?is)<a\b([^>]*)>(?:\s*<[a-z][^>]*>)?[^<]*click here[^<]*<"
HREF_RE = r"(?is)\bhref\s*=\s*[\"']([^\"']*)[\"']"
TABLE_RE = r"(?is)<table\b[^>]*>(.*?)</table>"
ROW_RE = r"(?is)<tr\b[^>]*>(.*?)</tr>"
CELL_RE = r"(?is)<td\b[^>]*>(.*?)</td>"


def unescape(c: Column) -> Column:
    """The character entities that occur in generated mail; the ampersand goes last."""
    for entity, char in (
        ("&nbsp;", "\xa0"),
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#39;", "'"),
        ("&amp;", "&"),
    ):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def archive_links(body: Column) -> Column:
    return F.regexp_extract_all(body, F.lit(ARCHIVE_LINK_RE), 0)


def click_here_href(body: Column) -> Column:
    """Address of the first anchor whose text says "click here", or NULL."""
    attributes = F.regexp_extract(body, ANCHOR_RE, 1)
    return F.nullif(unescape(F.regexp_extract(attributes, HREF_RE, 1)), F.lit(""))


def message_links(body: Column) -> Column:
    """Distinct archive links and the anchor link of one message."""
    return F.array_distinct(
        F.concat(archive_links(body), F.array_compact(F.array(click_here_href(body))))
    )


def cell_text(cell: Column) -> Column:
    """Text of a cell: tags dropped, the piece on each side of a tag stripped."""
    stripped = F.regexp_replace(cell, r"\s*<[^>]*>\s*", "")
    return F.btrim(unescape(stripped), F.lit(" \t\r\n\xa0"))


def html_fields(body: Column) -> Column:
    """First table of the body as a map; rows need two cells and a repeated key keeps its last value."""
    rows = F.regexp_extract_all(F.regexp_extract(body, TABLE_RE, 1), F.lit(ROW_RE), 1)
    cells = F.transform(rows, lambda r: F.regexp_extract_all(r, F.lit(CELL_RE), 1))
    kept = F.filter(cells, lambda c: F.size(c) >= 2)
    pairs = F.transform(
        kept, lambda c, i: F.struct(cell_text(c[0]).alias("k"), i.alias("i"), cell_text(c[1]).alias("v"))
    )
    # A lambda's argument is worked out once, so the table is parsed once: sorted by key and place, the last
    # pair of a key is the one before another key.
    return _with(
        F.array_sort(pairs),
        lambda p: F.map_from_entries(
            F.transform(
                F.filter(p, lambda x, i: ~F.get(p, i + 1)["k"].eqNullSafe(x["k"])),
                lambda x: F.struct(x["k"], x["v"]),
            )
        ),
    )


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def field(fields: Column, name: str) -> Column:
    """Upper-cased value of one field, empty text when the field is absent."""
    return F.upper(F.coalesce(F.try_element_at(fields, F.lit(name)), F.lit("")))


def source_class(url: Column) -> Column:
    return F.when(F.contains(F.lower(url), F.lit("kfintech")), "kfintech").otherwise("cams")


def ledger_key(first: Column, second: Column) -> Column:
    return F.concat_ws("_", first, second)
