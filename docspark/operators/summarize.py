"""Summarisation.

The hosted model of the original service is not reproducible, so the default
summarisers are deterministic and extractive, written as Spark expressions:
pages keep their lead sentences (Z2); documents keep their highest-weighted page
sentences (Z9). A caller's own function can replace the page summariser through
:func:`summarize_with` (Z3), which keeps the status / retry protocol.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_blank, lead_sentences, py_strip, sentences, terms, truthy_text
from .common import ordered_concat

# Status words and literal texts of the page protocol.
SUCCESS, SKIPPED, FAILED, DRY_RUN = "success", "skipped", "failed", "dry-run"
BLANK_PAGE_SUMMARY = "[No text content on this page]"
DRY_RUN_SUMMARY = "[Dry run - not actually processed]"
NO_PAGE_SUMMARIES = "At least one page summary with non-empty 'summary' is required."
DEFAULT_MAX_ATTEMPTS = 5
DEFAULT_CONCURRENCY = 32

PAGE_SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("document_id", T.StringType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
    ]
)


def _page_text(pages: DataFrame):
    """M4: first truthy of ``content`` and ``text``."""
    cols = [c for c in ("content", "text") if c in pages.columns]
    return truthy_text(*cols)


def classify_pages(pages: DataFrame) -> DataFrame:
    """Z1 (M4, M5): ``(document_id, page, text, blank)``."""
    text = _page_text(pages)
    return pages.select(
        "document_id",
        F.col("page_number").cast("int").alias("page"),
        text.alias("text"),
        is_blank(text).alias("blank"),
    )


def _check_sentences(n: int) -> None:
    if not isinstance(n, int) or isinstance(n, bool) or n <= 0:
        raise ValueError("sentences must be a positive integer")


def summarize_pages(pages: DataFrame, sentences: int = 2) -> DataFrame:
    """Every page gets a record. Blank pages are ``skipped`` with the fixed text
    (M6); the others are ``success`` with their first ``sentences`` sentences."""
    _check_sentences(sentences)
    c = classify_pages(pages)
    return c.select(
        "document_id",
        "page",
        F.when(F.col("blank"), F.lit(SKIPPED)).otherwise(F.lit(SUCCESS)).alias("status"),
        F.when(F.col("blank"), F.lit(BLANK_PAGE_SUMMARY)).otherwise(lead_sentences("text", sentences)).alias("summary"),
        F.lit(None).cast("string").alias("error"),
        F.when(F.col("blank"), F.lit(0)).otherwise(F.lit(1)).alias("attempts"),
    )


def limit_concurrency(df: DataFrame, n: int = DEFAULT_CONCURRENCY) -> DataFrame:
    """At most ``n`` tasks (so at most ``n`` calls in flight); ``n <= 0`` means 32.
    Rows are hash-spread, so no batch barrier holds fast pages behind slow ones."""
    n = n if n and n > 0 else DEFAULT_CONCURRENCY
    return df.repartition(n, "document_id", "page")


def summarize_with(
    pages: DataFrame,
    fn: Callable[[str], str],
    max_attempts: int = DEFAULT_MAX_ATTEMPTS,
    concurrency: int | None = None,
) -> DataFrame:
    """Z3 (M13, M20): run ``fn(text) -> summary`` once per non-blank page with up to
    ``max_attempts`` tries; a page that never succeeds becomes a ``failed`` record
    with the last error, not a job failure. Blank pages are ``skipped`` without a
    call. ``fn`` runs in Arrow batches via ``mapInPandas``."""
    if max_attempts < 1:
        raise ValueError("max_attempts must be >= 1")
    c = classify_pages(pages)
    todo = c.filter(~F.col("blank")).select("document_id", "page", "text")
    if concurrency is not None:
        todo = limit_concurrency(todo, concurrency)

    def run(batches):
        import pandas as pd

        for pdf in batches:
            status, summary, error, attempts = [], [], [], []
            for text in pdf["text"]:
                last = None
                for attempt in range(1, max_attempts + 1):
                    try:
                        out = fn(text)
                        status.append(SUCCESS)
                        summary.append(("" if out is None else str(out)).strip())
                        error.append(None)
                        attempts.append(attempt)
                        break
                    except Exception as exc:  # failure becomes data
                        last = exc
                else:
                    status.append(FAILED)
                    summary.append(None)
                    error.append(str(last) if last is not None else "Unknown error")
                    attempts.append(max_attempts)
            yield pd.DataFrame(
                {
                    "document_id": pdf["document_id"],
                    "page": pdf["page"].astype("int32"),
                    "status": status,
                    "summary": summary,
                    "error": error,
                    "attempts": pd.Series(attempts, dtype="int32"),
                }
            )

    called = todo.mapInPandas(run, PAGE_SUMMARY_SCHEMA)
    skipped = c.filter(F.col("blank")).select(
        "document_id",
        "page",
        F.lit(SKIPPED).alias("status"),
        F.lit(BLANK_PAGE_SUMMARY).alias("summary"),
        F.lit(None).cast("string").alias("error"),
        F.lit(0).alias("attempts"),
    )
    return called.unionByName(skipped)


# Error categories by message pattern (first match wins).
ERROR_RULES = [
    ("transient", r"(?i)(timeout|timed out|rate limit|too many requests|\b429\b|\b503\b|temporar|unavailable|connection)"),
    ("permanent", r"(?i)(invalid|not found|\b404\b|\b400\b|unauthori[sz]ed|forbidden|too long|context length)"),
]


def classify_errors(df: DataFrame, error_col: str = "error") -> DataFrame:
    """``error_category`` from the message; ``unknown`` when nothing matches."""
    cat = F.lit("unknown")
    for name, pattern in reversed(ERROR_RULES):
        cat = F.when(F.col(error_col).rlike(pattern), F.lit(name)).otherwise(cat)
    return df.withColumn("error_category", F.when(F.col(error_col).isNull(), F.lit("unknown")).otherwise(cat))


def normalize_summary(c):
    """Strip (Python rule) and end with a sentence terminator when non-empty."""
    s = py_strip(c)
    return F.when((s != "") & ~s.rlike(r"[.!?]$"), F.concat(s, F.lit("."))).otherwise(s)


def dry_run_plan(pages: DataFrame) -> DataFrame:
    """Z7 (M21): the pages a run would process, status ``dry-run``; no model call."""
    return pages.select(
        "document_id",
        F.col("page_number").cast("int").alias("page"),
        F.lit(DRY_RUN).alias("status"),
        F.lit(DRY_RUN_SUMMARY).alias("summary"),
        F.lit(None).cast("string").alias("error"),
        F.lit(0).alias("attempts"),
    )


def doc_input(page_summaries: DataFrame) -> DataFrame:
    """Z8 (M10, M11): per document, ``Page n: summary`` lines in page order joined by
    newline, from successful pages with a non-empty summary; ``n_parts`` counts them.
    Large documents are split by page bucket before the final merge."""
    ok = page_summaries.filter(
        (F.col("status") == SUCCESS) & F.col("summary").isNotNull() & (F.col("summary") != "")
    )
    line = F.when(F.col("page").isNull(), F.col("summary")).otherwise(
        F.concat(F.lit("Page "), F.col("page").cast("string"), F.lit(": "), F.col("summary"))
    )
    lines = ok.select(
        "document_id", F.coalesce(F.col("page"), F.lit(0)).alias("page"), line.alias("line")
    ).withColumn("_bucket", F.floor(F.col("page") / 4096))
    # two levels: partial strings and counts per (document, page bucket), then one merge
    part = lines.groupBy("document_id", "_bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "line"))), lambda x: x["line"]), "\n").alias("_s"),
    )
    return part.groupBy("document_id").agg(
        F.sum("n").alias("n_parts"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_bucket", "_s"))), lambda x: x["_s"]), "\n").alias("doc_input"),
    )


def sentence_scores(page_summaries: DataFrame) -> DataFrame:
    """Score each sentence of each successful page summary by the document-level
    weight of its terms: weight(term) = number of pages of the document whose summary
    contains it; score = sum of weights over the sentence's term occurrences."""
    ok = page_summaries.filter(
        (F.col("status") == SUCCESS) & F.col("summary").isNotNull() & (F.col("summary") != "")
    )
    sents = ok.select("document_id", "page", F.posexplode(sentences("summary")).alias("sidx", "sentence"))
    toks = sents.select("document_id", "page", "sidx", F.explode(terms("sentence")).alias("term"))
    # distinct (doc, page, term) first: partial aggregation shrinks hot terms map-side
    page_terms = toks.groupBy("document_id", "page", "term").agg(F.count(F.lit(1)).alias("tf"))
    weights = page_terms.groupBy("document_id", "term").agg(F.count(F.lit(1)).alias("w"))
    scored = (
        toks.join(weights, ["document_id", "term"])
        .groupBy("document_id", "page", "sidx")
        .agg(F.sum("w").alias("score"))
    )
    return sents.join(scored, ["document_id", "page", "sidx"], "left").select(
        "document_id", "page", "sidx", "sentence", F.coalesce(F.col("score"), F.lit(0)).cast("bigint").alias("score")
    )


def summarize_documents(page_summaries: DataFrame, max_sentences: int = 5) -> DataFrame:
    """Multi-paragraph document summary from page summaries.

    The ``max_sentences`` best-scored sentences are kept (ties: earlier page, earlier
    sentence), put back in page order, one paragraph per page, paragraphs separated by
    a blank line. Documents with successful pages but no non-empty summary get a
    ``failed`` row (M10); documents without successful pages get no row."""
    if max_sentences < 1:
        raise ValueError("max_sentences must be >= 1")
    w = Window.partitionBy("document_id").orderBy(F.col("score").desc(), "page", "sidx")
    top = sentence_scores(page_summaries).withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= max_sentences)
    paras = ordered_concat(top, ["document_id", "page"], ["sidx"], "sentence", " ", "para")
    text = ordered_concat(paras, ["document_id"], ["page"], "para", "\n\n", "summary_text")
    docs = page_summaries.groupBy("document_id").agg(
        F.count_if(F.col("status") == SUCCESS).alias("n_success"),
        F.count_if((F.col("status") == SUCCESS) & F.col("summary").isNotNull() & (F.col("summary") != "")).alias("n_text"),
    ).filter(F.col("n_success") > 0)
    has_text = F.col("n_text") > 0
    return docs.join(text, "document_id", "left").select(
        "document_id",
        F.when(has_text, F.lit(SUCCESS)).otherwise(F.lit(FAILED)).alias("status"),
        F.when(has_text, F.coalesce(F.col("summary_text"), F.lit(""))).alias("summary"),
        F.when(has_text, F.concat(F.col("document_id"), F.lit(".json"))).alias("summary_blob"),
        F.when(~has_text, F.lit(NO_PAGE_SUMMARIES)).alias("error"),
    )
