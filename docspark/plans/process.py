"""L1: process a corpus -- pages, page summaries, document summaries, reports,
results and index records -- as one lazy Spark plan over all documents.

Shuffle boundaries: group by document (document input, summaries, report) and the
final joins. Page content never enters a shuffle after summarisation; only
summaries and counts do."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import index, pages, report, summarize
from ..session import materialize
from ..sources.files import write_pages

DEFAULT_RUN_TIME = "2025-01-01 00:00:00"


@dataclass
class Processed:
    pages: DataFrame          # E4
    totals: DataFrame         # (document_id, total_pages) from the split (P1)
    page_summaries: DataFrame  # E5
    doc_summaries: DataFrame   # E6
    report: DataFrame          # E7
    result: DataFrame          # A2
    index: DataFrame           # E8


def process_corpus(
    results: DataFrame,
    sentences: int = 2,
    doc_sentences: int = 5,
    run_time: str = DEFAULT_RUN_TIME,
    summarizer: Callable[[str], str] | None = None,
    max_attempts: int = summarize.DEFAULT_MAX_ATTEMPTS,
    concurrency: int | None = None,
    persist: bool = False,
    totals: DataFrame | None = None,
    persist_all: bool = False,
) -> Processed:
    """Run L1 over analysis results (E2: ``document_id, blob_path, content, pages``).

    ``summarizer`` replaces the extractive page summariser with the caller's function
    (Z3, retried up to ``max_attempts``). ``persist`` checkpoints the page summaries
    -- read by four consumers -- into the shared checkpoint folder, and
    ``persist_all`` the document summaries and the report as well, for callers that read
    them and the index. ``totals`` are page counts that are known without making the pages."""
    pg = pages.split_pages(results)
    if totals is None:
        totals = results.select("document_id", pages.page_count(F.col("pages")).alias("total_pages"))
    if summarizer is None:
        ps = summarize.summarize_pages(pg, sentences=sentences)
    else:
        ps = summarize.summarize_with(pg, summarizer, max_attempts=max_attempts, concurrency=concurrency)
    if persist or persist_all:
        ps = materialize(ps)
    ds = summarize.summarize_documents(ps, max_sentences=doc_sentences)
    rep = report.processing_report(ps, totals)
    if persist_all:
        ds, rep = materialize(ds), materialize(rep)
    res = report.pipeline_result(results.select("document_id", "blob_path"), totals, rep, ds)
    idx = index.build_index(res, run_time)
    return Processed(pg, totals, ps, ds, rep, res, idx)


def store_processed(done: Processed, root: str) -> None:
    """L1's outputs (E5-E8) under ``root``, each as a keyed table of its own: a document
    that is processed again replaces its own rows and no others."""
    write_pages(done.page_summaries, f"{root}/page_summaries", keys=("document_id", "page"))
    for name in ("doc_summaries", "report", "index"):
        write_pages(getattr(done, name), f"{root}/{name}")
