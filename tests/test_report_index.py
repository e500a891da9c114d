"""Reports (A1-A5), index records (A6, A7) and upserts."""

from pyspark.sql import functions as F

from docspark.operators import index as I
from docspark.operators import report as A

PS = "document_id string, page int, status string, summary string, error string"


def test_processing_report_counts_and_details(spark):
    ps = spark.createDataFrame(
        [("d", 1, "success", "s", None), ("d", 2, "success", "s", None), ("d", 3, "failed", None, "boom"),
         ("k", 1, "skipped", "x", None)], PS)
    totals = spark.createDataFrame([("d", 3), ("k", 1), ("zero", 0), ("neg", -1)], "document_id string, total_pages int")
    rep = {r.document_id: r for r in A.processing_report(ps, totals).collect()}
    d = rep["d"]
    assert (d.total_pages, d.successful_pages, d.failed_pages) == (3, 2, 1)
    assert [(x.page, x.error_category, x.error_message) for x in d.failed_page_details] == [(3, "unknown", "boom")]
    assert rep["k"].failed_pages == 1                # M7a: skipped counts as failed here
    z = rep["zero"]
    assert (z.total_pages, z.successful_pages, z.failed_pages, z.failed_page_details, z.error) == (0, 0, 0, [], None)
    assert rep["neg"].error == A.ERR_TOTAL_PAGES
    assert d.report_blob == "d.json"


def test_three_meanings_of_failed(spark):
    ps = spark.createDataFrame(
        [("d", 1, "success", "s", None), ("d", 2, "skipped", "x", None), ("d", 3, "failed", None, "e"),
         ("d", 4, "dry-run", "x", None), ("d", 5, "weird", None, None)], PS)
    regen = A.regeneration_stats(ps, ps.limit(0).select("document_id", F.lit("x").alias("status"))).first()
    assert (regen.successful_pages, regen.skipped_pages, regen.failed_pages) == (1, 1, 2)  # M7b
    render = A.render_stats(ps).first()
    assert render.failed_pages == 1                                                       # M7c


def test_progress_batches(spark):
    ps = spark.createDataFrame([("d", p, "success", "s", None) for p in range(1, 71)], PS)
    got = [(r.batch, r.completed_pages, r.total_pages) for r in A.progress(ps, 32).orderBy("batch").collect()]
    assert got == [(1, 32, 70), (2, 64, 70), (3, 70, 70)]
    assert A.progress(ps, 0).count() == 3  # <= 0 means 32


def test_index_status_and_upsert_idempotence(spark):
    res = spark.createDataFrame(
        [("a", "raw-pdfs/x/a.pdf", 10, 1, "a.json", "a.json"), ("b", "raw-pdfs/b.pdf", 5, 0, "", "b.json")],
        "document_id string, blob_path string, page_count int, failed_page_count int, summary_blob string, report_blob string")
    idx = {r.id: r for r in I.build_index(res, "2025-01-01 00:00:00").collect()}
    assert idx["a"].status == "completed_with_errors" and idx["b"].status == "completed"
    assert idx["a"].file_name == "a.pdf"
    assert idx["a"].created_at == idx["a"].updated_at
    first = I.build_index(res, "2025-01-01 00:00:00")
    later = I.build_index(res.filter("document_id = 'a'").withColumn("failed_page_count", F.lit(0)), "2025-02-01 00:00:00")
    once = I.upsert_index(first, later)
    twice = I.upsert_index(once, later)
    key = lambda df: sorted(map(tuple, df.select("id", "status", "created_at", "updated_at").collect()))
    assert key(once) == key(twice)
    a = once.filter("id = 'a'").first()
    assert a.status == "completed" and str(a.created_at).startswith("2025-02-01")   # whole record replaced
    kept = I.upsert_index(first, later, keep_created=True).filter("id = 'a'").first()
    assert str(kept.created_at).startswith("2025-01-01") and str(kept.updated_at).startswith("2025-02-01")


def test_page_index_ids(spark):
    ps = spark.createDataFrame([("doc-123", 17, "success", "s", None), ("doc-123", 1000, "success", "s", None)], PS)
    ids = sorted(r.id for r in I.page_index(ps).collect())
    assert ids == ["doc-123-017", "doc-123-1000"]
