"""Page extraction (P1-P9): projections and explodes over nested analysis results.

All per-document work is row-local (higher-order functions over the arrays of one
row), so nothing here shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import bind
from ..functions.text import py_strip

# Page-range validation messages (first failing check wins).
RANGE_NO_HYPHEN = "Page range must be in format 'start-end' (e.g., '1-50')"
RANGE_HYPHENS = "Page range must have exactly one hyphen"
RANGE_NOT_INT = "Page range start and end must be integers"
RANGE_NOT_POSITIVE = "Page numbers must be positive integers"


# ---------------------------------------------------------------- current results

def page_count(pages: Column) -> Column:
    """Number of pages, 0 when the array is null or empty."""
    return F.when(pages.isNull(), F.lit(0)).otherwise(F.size(pages))


#: Stands before decoded slices, so a U+FEFF at the start of a page is text, not a mark.
BYTE_ORDER = bytes([0, 0, 0xFE, 0xFF])


def code_points(content: Column) -> Column:
    """The text with four bytes per code point: a slice costs its length, wherever it is."""
    return F.encode(content, "UTF-32")


def page_text(content: Column, wide: Column, page: Column) -> Column:
    """P2 (M2, M3): concatenate the code-point slices of the page's valid spans; when
    none is valid (or there is no content) join the line texts with one space.
    ``wide`` is :func:`code_points` of the content, made once per document."""
    valid = F.filter(page["spans"], lambda s: s["offset"].isNotNull() & s["length"].isNotNull())
    by_spans = F.array_join(F.transform(valid, lambda s: F.decode(F.concat(
        F.lit(BYTE_ORDER), F.substring(wide, s["offset"] * 4 + 1, s["length"] * 4)), "UTF-32")), "")
    by_lines = F.coalesce(F.array_join(F.transform(page["lines"], lambda l: l["content"]), " "), F.lit(""))
    use_spans = content.isNotNull() & (content != "") & (F.coalesce(F.size(valid), F.lit(0)) > 0)
    return F.when(use_spans, by_spans).otherwise(by_lines)


def split_pages(results: DataFrame) -> DataFrame:
    """One E4 row per page, ``page_number`` = 1-based position (M1).
    A document without pages yields no rows (not a phantom null page).

    Page texts are cut inside the document row first and only then exploded, so
    the document's full text is never copied into each of its page rows."""
    content = F.col("content")
    texts = bind(code_points(content), lambda wide: F.transform(F.col("pages"), lambda p: page_text(content, wide, p)))
    exploded = results.select("document_id", "blob_path", F.posexplode(texts).alias("pos", "content"))
    return exploded.select(
        "document_id",
        (F.col("pos") + 1).cast("int").alias("page_number"),
        "blob_path",
        "content",
        F.length("content").cast("int").alias("length"),
    )


def page_counts(results: DataFrame) -> DataFrame:
    """P1 over a table of results."""
    return results.select("document_id", page_count(F.col("pages")).alias("page_count"))


# ---------------------------------------------------------------- legacy results

def legacy_page_count(pages: Column, contents: Column) -> Column:
    """P4 (M19): ``size(pages)``, else the largest ``contents.pageNumber``, else 1."""
    max_page = F.array_max(F.transform(contents, lambda c: F.coalesce(c["pageNumber"], F.lit(0))))
    fallback = F.when(F.coalesce(max_page, F.lit(0)) > 0, max_page).otherwise(F.lit(1))
    return F.when(F.coalesce(F.size(pages), F.lit(0)) > 0, F.size(pages)).otherwise(fallback)


def legacy_item_text(item: Column) -> Column:
    return F.when(item["markdown"].isNotNull(), item["markdown"]).otherwise(F.coalesce(item["text"], F.lit("")))


def legacy_page_content(contents: Column, page: Column) -> Column:
    """P5: items on the page, ``markdown`` when present (even if empty) else ``text``,
    empty strings dropped, joined by a blank line."""
    on_page = F.filter(contents, lambda c: F.coalesce(c["pageNumber"], F.lit(0)) == page)
    texts = F.transform(on_page, legacy_item_text)
    kept = F.filter(texts, lambda t: t != "")
    return F.coalesce(F.array_join(kept, "\n\n"), F.lit(""))


def legacy_pages(results: DataFrame) -> DataFrame:
    """P4+P5 as a table: one row per page ``1..legacy_page_count``.

    Each item is one row of its page, and an empty item stands for each page, so a
    document costs its items and pages, and one with very many pages is spread by page."""
    def item(page: Column, pos: Column, text: Column) -> Column:
        return F.struct(page.cast("int").alias("page"), pos.cast("int").alias("pos"), text.alias("text"))

    pages = F.transform(F.sequence(F.lit(1), F.col("n")), lambda p: item(p, F.lit(-1), F.lit("")))
    items = F.transform("contents", lambda c, i: item(c["pageNumber"], i, legacy_item_text(c)))
    rows = results.select("document_id", "contents", legacy_page_count(F.col("pages"), F.col("contents")).alias("n"),
                          F.monotonically_increasing_id().alias("row"))
    rows = rows.select("row", "document_id", "n", F.explode(F.concat(pages, F.coalesce(items, F.array()))).alias("item"))
    on_page = F.array_sort(F.collect_list(F.struct("item.pos", "item.text")))
    texts = F.filter(F.transform(on_page, lambda t: t["text"]), lambda t: t != "")
    return rows.where("item.page BETWEEN 1 AND n").groupBy("row", "document_id", F.col("item.page").alias("page_number")).agg(
        F.array_join(texts, "\n\n").alias("content")).drop("row")


def document_abstract(summary: Column, metadata_summary: Column) -> Column:
    """``summary``, else ``metadata.summary``; empty strings fall through to null."""
    return F.coalesce(F.nullif(summary, F.lit("")), F.nullif(metadata_summary, F.lit("")))


def figures(results: DataFrame) -> DataFrame:
    """One row per detected figure."""
    return results.select("document_id", F.explode("figures").alias("f")).select(
        "document_id", F.col("f.pageNumber").alias("page_number"), F.col("f.description").alias("description")
    )


def page_figures(results: DataFrame, page: int) -> DataFrame:
    """Figures on one page."""
    return figures(results).filter(F.col("page_number") == page)


# ---------------------------------------------------------------- page ranges (P8), truncation

def parse_page_range(range_str: Column) -> Column:
    """``struct(start, end, error)`` for a 'start-end' string (inclusive)."""
    parts = F.split(range_str, "-", -1)
    s = F.when(F.size(parts) == 2, py_strip(F.element_at(parts, 1)).try_cast("int"))
    e = F.when(F.size(parts) == 2, py_strip(F.element_at(parts, 2)).try_cast("int"))
    error = (
        F.when(range_str.isNull() | ~range_str.contains("-"), F.lit(RANGE_NO_HYPHEN))
        .when(F.size(parts) != 2, F.lit(RANGE_HYPHENS))
        .when(s.isNull() | e.isNull(), F.lit(RANGE_NOT_INT))
        .when((s < 1) | (e < 1), F.lit(RANGE_NOT_POSITIVE))
        .when(s > e, F.format_string("Invalid range: start (%d) > end (%d)", s, e))
    )
    ok = error.isNull()
    return F.struct(F.when(ok, s).alias("start"), F.when(ok, e).alias("end"), error.alias("error"))


def select_page_range(pages: DataFrame, range_str: Column, page_col: str = "page_number") -> DataFrame:
    """Pages inside an inclusive 'start-end' range, a literal or one per row. A row
    whose range is invalid raises its message."""
    bounds = parse_page_range(range_str)
    inside = F.col(page_col).between(bounds["start"], bounds["end"])
    return pages.filter(F.when(bounds["error"].isNull(), inside).otherwise(F.raise_error(bounds["error"]).cast("boolean")))


def truncate_page(text: Column, max_chars: int) -> Column:
    """The first ``max_chars`` code points."""
    return F.substring(text, 1, max_chars)
