"""Aggregations and reports (A1-A5, A10). Three meanings of "failed" (M7) live in
their own operators on purpose; there is no shared ``is_failed`` helper."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .summarize import DRY_RUN, FAILED, SKIPPED, SUCCESS

ERR_TOTAL_PAGES = "'total_pages' (non-negative int) is required for write_report."


def processing_report(page_summaries: DataFrame, totals: DataFrame) -> DataFrame:
    """A1 (M7a, M9, M14). ``totals(document_id, total_pages)`` drives the rows, so a
    document without pages still gets a report. Not-success counts as failed; the
    detail list carries ``error_category`` (default ``unknown``) and ``error_message``
    (``error_message``, else ``error``, else ''), sorted by page. A negative or null
    total is rejected through the ``error`` column."""
    status = F.coalesce(F.col("status"), F.lit(""))
    not_ok = status != SUCCESS
    cat = F.col("error_category") if "error_category" in page_summaries.columns else F.lit(None).cast("string")
    msg = F.col("error_message") if "error_message" in page_summaries.columns else F.lit(None).cast("string")
    detail = F.struct(
        F.col("page").alias("page"),
        F.coalesce(cat, F.lit("unknown")).alias("error_category"),
        F.coalesce(msg, F.col("error"), F.lit("")).alias("error_message"),
    )
    agg = page_summaries.groupBy("document_id").agg(
        F.count_if(status == SUCCESS).alias("successful_pages"),
        F.count_if(not_ok).alias("failed_pages"),
        F.array_sort(F.collect_list(F.when(not_ok, detail))).alias("failed_page_details"),
    )
    t = F.col("total_pages")
    empty = F.array().cast(agg.schema["failed_page_details"].dataType)
    return totals.join(agg, "document_id", "left").select(
        "document_id",
        t.cast("int").alias("total_pages"),
        F.coalesce(F.col("successful_pages"), F.lit(0)).alias("successful_pages"),
        F.coalesce(F.col("failed_pages"), F.lit(0)).alias("failed_pages"),
        F.coalesce(F.col("failed_page_details"), empty).alias("failed_page_details"),
        F.concat(F.col("document_id"), F.lit(".json")).alias("report_blob"),
        F.when(t.isNull() | (t < 0), F.lit(ERR_TOTAL_PAGES)).alias("error"),
    )


def pipeline_result(requests: DataFrame, totals: DataFrame, report: DataFrame, doc_summaries: DataFrame) -> DataFrame:
    """A2: per request, page count, failed count, summary and report blobs.
    Left joins keep documents with no pages (M9); a document without a successful
    summary has ``summary_blob`` ''."""
    summ = doc_summaries.filter(F.col("status") == SUCCESS).select("document_id", "summary_blob")
    return (
        requests.select("document_id", "blob_path")
        .join(totals, "document_id", "left")
        .join(report.select("document_id", "failed_pages", "report_blob"), "document_id", "left")
        .join(summ, "document_id", "left")
        .select(
            "document_id",
            "blob_path",
            F.coalesce(F.col("total_pages"), F.lit(0)).cast("int").alias("page_count"),
            F.coalesce(F.col("failed_pages"), F.lit(0)).cast("int").alias("failed_page_count"),
            F.coalesce(F.col("summary_blob"), F.lit("")).alias("summary_blob"),
            F.coalesce(F.col("report_blob"), F.concat(F.col("document_id"), F.lit(".json"))).alias("report_blob"),
        )
    )


def regeneration_stats(page_results: DataFrame, doc_summaries: DataFrame, dry_run: bool = False) -> DataFrame:
    """A3 (M7b): failed = not success, not skipped, not dry-run. The summary flag is
    true only when a document summary with status success exists."""
    s = F.coalesce(F.col("status"), F.lit(""))
    agg = page_results.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("total_pages"),
        F.count_if(s == SUCCESS).alias("successful_pages"),
        F.count_if(s == SKIPPED).alias("skipped_pages"),
        F.count_if(~s.isin(SUCCESS, SKIPPED, DRY_RUN)).alias("failed_pages"),
    )
    gen = doc_summaries.filter(F.col("status") == SUCCESS).select("document_id", F.lit(True).alias("_gen"))
    return agg.join(gen, "document_id", "left").select(
        "document_id",
        "total_pages",
        "successful_pages",
        "skipped_pages",
        "failed_pages",
        F.coalesce(F.col("_gen"), F.lit(False)).alias("document_summary_generated"),
        F.lit(dry_run).alias("dry_run"),
    )


def render_stats(page_summaries: DataFrame) -> DataFrame:
    """A4 (M7c): failed means exactly ``failed``."""
    return page_summaries.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("total_pages"),
        F.count_if(F.col("status") == SUCCESS).alias("successful_pages"),
        F.count_if(F.col("status") == SKIPPED).alias("skipped_pages"),
        F.count_if(F.col("status") == FAILED).alias("failed_pages"),
    )


def progress(page_results: DataFrame, batch_size: int = 32) -> DataFrame:
    """A5: completed pages after each batch of ``batch_size`` pages (pages 1..n in
    order, as the orchestrator schedules them) against the document's total.
    ``batch_size <= 0`` means 32. The window runs over per-batch counts, not pages."""
    n = batch_size if batch_size and batch_size > 0 else 32
    per_batch = page_results.groupBy(
        "document_id", F.floor((F.col("page") - 1) / n).cast("int").alias("batch")
    ).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("document_id").orderBy("batch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wt = Window.partitionBy("document_id")
    return per_batch.select(
        "document_id",
        (F.col("batch") + 1).alias("batch"),
        F.lit("page_summary").alias("stage"),
        F.sum("n").over(w).cast("bigint").alias("completed_pages"),
        F.sum("n").over(wt).cast("bigint").alias("total_pages"),
    )


def corpus_overview(doc_index: DataFrame) -> DataFrame:
    """A10: documents, pages and failed pages per index status."""
    return doc_index.groupBy("status").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("page_count").cast("bigint").alias("pages"),
        F.sum("failed_page_count").cast("bigint").alias("failed_pages"),
    )
