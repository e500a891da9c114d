"""Intake validation (S1, S2), page classification (M4-M6), summaries."""

import pytest
from pyspark.sql import functions as F

from docspark.operators import summarize as Z
from docspark.sources import intake

PAGES = "document_id string, page_number int, content string, text string"


def test_validation_first_error_wins(spark):
    rows = [("ok", "c/x.pdf"), (None, None), ("id", None), (None, "c/x.pdf"), ("", "c/x.pdf"), ("id", "")]
    df = spark.createDataFrame(rows, "document_id string, blob_path string")
    valid, rejected = intake.validate_requests(df)
    assert valid.count() == 1
    errs = [r.error for r in intake.with_validation(df).collect()]
    assert errs == [None, intake.ERR_DOCUMENT_ID, intake.ERR_BLOB_PATH, intake.ERR_DOCUMENT_ID, intake.ERR_DOCUMENT_ID, intake.ERR_BLOB_PATH]
    assert rejected.count() == 5


def test_blob_path_parts(spark):
    df = spark.createDataFrame([("raw-pdfs/a/b.pdf",), ("nofolder.pdf",)], "blob_path string")
    got = {r.blob_path: r for r in intake.parse_blob_path(df).collect()}
    a = got["raw-pdfs/a/b.pdf"]
    assert (a.container, a.blob_name, a.file_name, a.path_error) == ("raw-pdfs", "a/b.pdf", "b.pdf", None)
    b = got["nofolder.pdf"]
    assert (b.container, b.blob_name, b.file_name) == (None, None, "nofolder.pdf")
    assert b.path_error == intake.ERR_PATH_FORM


def test_truthy_text_and_python_blank_rule(spark):
    rows = [
        ("d", 1, "", "from text. Second. Third."),   # empty content falls through to text
        ("d", 2, "   ", "ignored"),                  # whitespace-only does not fall through
        ("d", 3, None, None),
        ("d", 4, "\x1c　\t", None),              # str.strip() removes these too
        ("d", 5, "One! Two? Three.", None),
        ("d", 6, "...", None),                       # no sentence: still success, empty summary
    ]
    ps = {r.page: r for r in Z.summarize_pages(spark.createDataFrame(rows, PAGES), sentences=2).collect()}
    assert (ps[1].status, ps[1].summary) == ("success", "from text. Second.")
    for p in (2, 3, 4):
        assert (ps[p].status, ps[p].summary) == ("skipped", Z.BLANK_PAGE_SUMMARY)
    assert ps[5].summary == "One! Two?"
    assert (ps[6].status, ps[6].summary) == ("success", "")


@pytest.mark.parametrize("bad", [0, -1, True])
def test_sentences_must_be_positive(spark, bad):
    df = spark.createDataFrame([("d", 1, "x.", None)], PAGES)
    with pytest.raises(ValueError):
        Z.summarize_pages(df, sentences=bad)


def _flaky_until(n_failures):
    calls = {}

    def fn(text):
        calls[text] = calls.get(text, 0) + 1
        if calls[text] <= n_failures:
            raise TimeoutError("model timeout")
        return "  summary of " + text[:5] + "  "

    return fn


def test_retry_protocol(spark):
    df = spark.createDataFrame([("d", 1, "alpha text", None), ("d", 2, "", None)], PAGES).coalesce(1)
    ok = {r.page: r for r in Z.summarize_with(df, _flaky_until(0)).collect()}
    assert (ok[1].status, ok[1].attempts, ok[1].summary) == ("success", 1, "summary of alpha")
    assert (ok[2].status, ok[2].attempts) == ("skipped", 0)
    third = {r.page: r for r in Z.summarize_with(df, _flaky_until(2)).collect()}
    assert (third[1].status, third[1].attempts) == ("success", 3)
    never = {r.page: r for r in Z.summarize_with(df, _flaky_until(99)).collect()}
    assert (never[1].status, never[1].attempts, never[1].error, never[1].summary) == ("failed", 5, "model timeout", None)
    cats = Z.classify_errors(Z.summarize_with(df, _flaky_until(99))).filter(F.col("page") == 1).first()
    assert cats.error_category == "transient"


def test_doc_input_order_and_filters(spark):
    rows = [("d", 3, "success", "c"), ("d", 1, "success", "a"), ("d", 2, "success", ""), ("d", 4, "skipped", "s"),
            ("d", None, "success", "bare"), ("e", 1, "failed", None)]
    ps = spark.createDataFrame(rows, "document_id string, page int, status string, summary string")
    got = {r.document_id: r for r in Z.doc_input(ps).collect()}
    assert got["d"].doc_input == "bare\nPage 1: a\nPage 3: c"
    assert got["d"].n_parts == 3
    assert "e" not in got


def test_document_summary_status_rules(spark):
    rows = [("d", 1, "success", "Alpha beta. Gamma."), ("d", 2, "success", "Beta delta."),
            ("empty", 1, "success", ""), ("none", 1, "skipped", "x")]
    ps = spark.createDataFrame(rows, "document_id string, page int, status string, summary string")
    got = {r.document_id: r for r in Z.summarize_documents(ps, max_sentences=5).collect()}
    assert got["d"].status == "success"
    assert got["d"].summary == "Alpha beta. Gamma.\n\nBeta delta."   # one paragraph per page, page order
    assert got["d"].summary_blob == "d.json"
    assert (got["empty"].status, got["empty"].error) == ("failed", Z.NO_PAGE_SUMMARIES)
    assert "none" not in got
    top1 = {r.document_id: r.summary for r in Z.summarize_documents(ps, max_sentences=1).collect()}
    assert top1["d"] == "Alpha beta."  # 'beta' is on two pages: highest weight


def test_normalize_and_dry_run(spark):
    df = spark.createDataFrame([(" text without end ",), ("Done.",), ("",)], "s string")
    got = [r.n for r in df.select(Z.normalize_summary(F.col("s")).alias("n")).collect()]
    assert got == ["text without end.", "Done.", ""]
    plan = Z.dry_run_plan(spark.createDataFrame([("d", 1, "x", None)], PAGES)).first()
    assert (plan.status, plan.summary) == ("dry-run", Z.DRY_RUN_SUMMARY)
