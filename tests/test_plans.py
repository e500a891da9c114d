"""End-to-end plans: regeneration (Z10) and the corpus plan with a caller's
summariser (L1 + Z3)."""

from pyspark.sql import functions as F

from docspark.operators import pages as P
from docspark.plans.process import process_corpus
from docspark.plans.regenerate import regenerate
from docspark.sources import corpus

SF_SMALL = "/root/testdata/sf0.001"
PAGES = "document_id string, page_number int, content string"


def test_regenerate_range_dry_run_and_missing_range(spark):
    rows = [("d", p, "" if p == 2 else f"Text {p}. More.") for p in range(1, 6)] + [("short", 1, "Only. Page.")]
    pg = spark.createDataFrame(rows, PAGES)
    full = {r.document_id: r for r in regenerate(pg).collect()}
    assert (full["d"].total_pages, full["d"].successful_pages, full["d"].skipped_pages) == (5, 4, 1)
    assert full["d"].document_summary_generated and full["d"].status == "success"
    ranged = {r.document_id: r for r in regenerate(pg, page_range=" 2 - 3 ", scope="range").collect()}
    assert (ranged["d"].total_pages, ranged["d"].skipped_pages) == (2, 1)
    assert (ranged["short"].status, ranged["short"].error) == ("failed", "No pages in range 2-3")
    dry = {r.document_id: r for r in regenerate(pg, dry_run=True).collect()}
    assert (dry["d"].total_pages, dry["d"].successful_pages, dry["d"].failed_pages) == (5, 0, 0)
    assert dry["d"].dry_run and not dry["d"].document_summary_generated


def test_corpus_plan_with_failing_summariser(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source")
    results = corpus.documents_corpus(docs)

    def model(text):
        if len(text) > 2000:
            raise ValueError("input too long")
        return text.split(".")[0] + "."

    pr = process_corpus(results, summarizer=model, max_attempts=2)
    pages = P.split_pages(results)
    long_pages = pages.filter(F.length("content") > 2000).count()
    blank_pages = pages.filter(F.col("content") == "").count()
    ps = pr.page_summaries
    assert ps.filter("status = 'failed'").count() == long_pages
    assert ps.filter("status = 'failed'").agg(F.max("attempts")).first()[0] == 2
    assert ps.filter("status = 'skipped'").count() == blank_pages
    rep = pr.report.agg(F.sum("failed_pages").alias("f"), F.sum("total_pages").alias("t")).first()
    assert rep.f == long_pages + blank_pages and rep.t == pages.count()
    idx = pr.index
    bad_docs = ps.filter("status <> 'success'").select("document_id").distinct().count()
    assert idx.filter("status = 'completed_with_errors'").count() == bad_docs
    assert idx.count() == docs.count()


def test_stored_outputs_are_computed_once(spark, capsys):
    docs = spark.createDataFrame([(1, "One. Two.\nThree.", "web"), (2, None, "web"), (3, "", "books")], "doc_id long, text string, source string")
    results = corpus.documents_corpus(docs)
    once, lazy = process_corpus(results, persist_all=True), process_corpus(results)
    capsys.readouterr()
    for name in ("doc_summaries", "report", "index"):
        kept, made = getattr(once, name), getattr(lazy, name)
        assert sorted(map(str, kept.collect())) == sorted(map(str, made.collect()))
        kept.explain()
        assert "Generate" not in capsys.readouterr().out  # neither pages nor sentences are made again
