"""S10 / L1 again: only pages whose content changed are summarised, only their documents
are summed up, and both are merged by key into what is stored."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import summarize
from ..session import materialize
from ..sources.files import stored_rows, write_pages

KEY = ["document_id", "page"]
REMOVED = "removed"  # status of what is stored but no longer there
PAGE_STATE = "document_id string, page int, status string, summary string, error string, attempts int, content_hash string"
DOC_STATE = "document_id string, status string, summary string, summary_blob string, error string"


@dataclass
class Updated:
    page_summaries: DataFrame  # E5 of all pages, as stored now
    doc_summaries: DataFrame   # E6 of all documents, as stored now
    changed: DataFrame         # (document_id, page): pages that this run summarised


def _read(spark, path: str, schema: str) -> DataFrame | None:
    return stored_rows(spark, path, "parquet", T._parse_datatype_string(f"{schema}, bucket int"))


def update_corpus(
    pages: DataFrame,
    root: str,
    sentences: int = 2,
    doc_sentences: int = 5,
    summarizer: Callable[[str], str] | None = None,
    buckets: int = 64,
) -> Updated:
    """Bring the summaries stored under ``root`` up to date with ``pages``.

    A page is summarised if its content's md5 is not the one stored with a finished
    summary: it is new, changed, or failed before. Pages that are gone leave a row of
    status ``removed``. Documents with any such page are summed up again from all their
    pages; other rows are met by the anti and semi joins alone, as keys and hashes.
    Documents are stored before pages, so a run that broke off is done again in full.
    The first run (nothing stored) does all. Pages are unique by document and number;
    rows without either are left out."""
    spark = pages.sparkSession
    digest = F.md5(F.coalesce("content", F.lit("")).cast("binary"))
    pages = pages.where("document_id IS NOT NULL AND page_number IS NOT NULL").withColumns(
        {"page": F.col("page_number").cast("int"), "content_hash": digest})
    state = _read(spark, f"{root}/pages", PAGE_STATE)
    todo = pages
    if state is not None:
        finished = state.where(F.col("status").isin(summarize.SUCCESS, summarize.SKIPPED))
        todo = pages.join(finished.select(*KEY, "content_hash"), [*KEY, "content_hash"], "left_anti")
    todo = materialize(todo)
    made = summarize.summarize_pages(todo, sentences) if summarizer is None else summarize.summarize_with(todo, summarizer)
    fresh = made.select(*KEY, "status", "summary", "error", "attempts").join(todo.select(*KEY, "content_hash"), KEY)
    rows = fresh
    if state is not None:
        present = state.where(F.col("status") != REMOVED)
        nothing = F.lit(None).cast("string")
        rows = fresh.unionByName(present.join(pages.select(*KEY), KEY, "left_anti").select(
            *KEY, F.lit(REMOVED).alias("status"), nothing.alias("summary"), nothing.alias("error"), F.lit(0).alias("attempts"),
            nothing.alias("content_hash")))
    rows = materialize(rows)
    touched = rows.select("document_id").distinct()
    current = rows.where(F.col("status") != REMOVED)
    if state is not None:
        rest = present.join(touched, "document_id", "left_semi").join(rows.select(*KEY), KEY, "left_anti")
        current = current.unionByName(rest.select(*rows.columns))
    docs = summarize.summarize_documents(current, doc_sentences)
    docs = touched.join(docs, "document_id", "left").withColumn("status", F.coalesce("status", F.lit(REMOVED)))
    write_pages(docs, f"{root}/documents", buckets)
    write_pages(rows, f"{root}/pages", buckets, keys=tuple(KEY))

    def stored(name: str, schema: str) -> DataFrame:
        found = _read(spark, f"{root}/{name}", schema)
        found = spark.createDataFrame([], schema) if found is None else found.drop("bucket")
        return found.where(F.col("status") != REMOVED)

    return Updated(stored("pages", PAGE_STATE).drop("content_hash"), stored("documents", DOC_STATE), todo.select(*KEY))
