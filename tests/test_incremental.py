"""Runs over changed pages equal full runs, and summarise nothing else."""

import pytest

from docspark.operators import summarize as Z
from docspark.plans.incremental import update_corpus

PAGES = "document_id string, page_number int, content string"
FIRST = [("a", 1, "One is here. Two."), ("a", 2, ""), ("b", 1, "Same words. Again same words."), ("c", 1, "Going away."),
         ("d", 1, " "), ("e", 1, "First."), ("e", 2, "Second page.")]
SECOND = [("a", 1, "One is new. Two."), ("a", 2, ""), ("b", 1, "Same words. Again same words."), ("d", 1, None),
          ("e", 1, "First."), ("e", 3, "A third page."), (None, 1, "lost"), ("b", None, "lost")]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_second_run_equals_a_full_run(spark, tmp_path):
    root = str(tmp_path / "store")
    first = update_corpus(spark.createDataFrame(FIRST, PAGES), root, buckets=3)
    assert rows(first.changed, "document_id", "page") == sorted((d, p) for d, p, _ in FIRST)
    second = spark.createDataFrame(SECOND, PAGES)
    got = update_corpus(second, root, buckets=3)
    assert rows(got.changed, "document_id", "page") == [("a", 1), ("d", 1), ("e", 3)]
    full = update_corpus(second, str(tmp_path / "full"), buckets=3)
    for name, columns in (("page_summaries", ("document_id", "page", "status", "summary")), ("doc_summaries", ("document_id", "status", "summary"))):
        assert rows(getattr(got, name), *columns) == rows(getattr(full, name), *columns)
    assert {r["document_id"] for r in got.doc_summaries.collect()} == {"a", "b", "e"}
    again = update_corpus(second, root, buckets=3)
    assert again.changed.count() == 0 and again.page_summaries.count() == 6


def test_failed_pages_are_done_again(spark, tmp_path):
    pages = spark.createDataFrame([("a", 1, "good"), ("a", 2, "bad")], PAGES)

    def model(text):
        if text == "bad":
            raise ValueError("invalid model response")
        return text.upper()

    root = str(tmp_path / "store")
    first = update_corpus(pages, root, summarizer=model, buckets=2)
    assert rows(first.page_summaries, "page", "status") == [(1, Z.SUCCESS), (2, Z.FAILED)]
    second = update_corpus(pages, root, summarizer=str.title, buckets=2)
    assert rows(second.changed, "page") == [(2,)]
    assert rows(second.page_summaries, "page", "summary") == [(1, "GOOD"), (2, "Bad")]


@pytest.mark.parametrize("earlier", [[], FIRST])
def test_empty_tables(spark, tmp_path, earlier):
    root = str(tmp_path / "store")
    if earlier:
        update_corpus(spark.createDataFrame(earlier, PAGES), root, buckets=2)
    out = update_corpus(spark.createDataFrame([], PAGES), root, buckets=2)
    assert out.page_summaries.count() == 0 and out.doc_summaries.count() == 0 and out.changed.count() == 0
