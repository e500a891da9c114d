"""Sections as page intervals, years of pages, and the pages that lie in them (Q12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import word_tokens
from .analytics import NUMBER_PATTERN, YEAR_PATTERN

PAGE = ["document_id", "page_number"]


def page_heading(text: Column | str = "content", most_words: int = 6) -> Column:
    """A page's heading: its first line, if that has one to ``most_words`` words; else null."""
    line = F.trim(F.regexp_extract(text, r"^([^\n]*)", 1))
    return F.when(F.size(word_tokens(line)).between(1, most_words), line)


def sections(pages: DataFrame, heading: Column, block: int = 4096) -> DataFrame:
    """Sections as page intervals: (document_id, section, start_page, end_page), from a
    page with a heading up to, not including, the next one or the document's end. Pages
    before the first heading are in none; rows without a page number are left out.

    The next heading is looked for within blocks of ``block`` pages, then over one row
    per block, so a huge document is not one window task."""
    at = pages.where("page_number is not null").select(*PAGE, heading.alias("section"))
    at = at.withColumn("block", F.floor(F.col("page_number") / block))
    head = F.when(F.col("section").isNotNull(), F.col("page_number"))
    blocks = at.groupBy("document_id", "block").agg(F.min(head).alias("first_head"), F.max("page_number").alias("last_page"))
    later = Window.partitionBy("document_id").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy("document_id")
    blocks = blocks.select("document_id", "block", F.coalesce(
        F.first("first_head", ignorenulls=True).over(later), F.max("last_page").over(whole) + 1).alias("after"))
    inside = Window.partitionBy("document_id", "block").orderBy("page_number")
    heads = at.where("section is not null").withColumn("next", F.lead("page_number").over(inside))
    return heads.join(blocks, ["document_id", "block"]).select(
        "document_id", "section", F.col("page_number").alias("start_page"), F.coalesce("next", "after").cast("int").alias("end_page"))


def page_years(pages: DataFrame, text: str = "content") -> DataFrame:
    """Every year that a page mentions, once: (document_id, page_number, year)."""
    mentions = F.filter(F.regexp_extract_all(text, F.lit(NUMBER_PATTERN), 0), lambda x: x.rlike(YEAR_PATTERN))
    return pages.select(*PAGE, F.explode(F.array_distinct(mentions).cast("array<int>")).alias("year"))


def pages_within(pages: DataFrame, intervals: DataFrame, width: int = 64) -> DataFrame:
    """The rows of ``pages`` (document_id, page_number, ...) that lie in any interval
    [start_page, end_page) of their document, once each.

    A join on ranges alone would pair every page of a document with every interval;
    here both sides meet by buckets of ``width`` pages: an interval is one row per
    bucket that it touches, a page is one row."""
    def bucket(page: Column) -> Column:
        return F.floor(page / width)

    i = intervals.where("start_page < end_page").select(
        F.col("document_id").alias("in_document"), "start_page", "end_page",
        F.explode(F.sequence(bucket(F.col("start_page")), bucket(F.col("end_page") - 1))).alias("in_bucket"))
    met = ((pages["document_id"] == i["in_document"]) & (bucket(pages["page_number"]) == i["in_bucket"])
           & (pages["page_number"] >= i["start_page"]) & (pages["page_number"] < i["end_page"]))
    return pages.join(i, met, "left_semi")
