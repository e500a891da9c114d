"""Page extraction rules M1-M3, P1-P9 on hand-built analysis results."""

import re

import pytest
from pyspark.sql import functions as F

from docspark.operators import pages as P

SPAN = "struct<offset:int,length:int>"
ANALYSIS = (
    f"document_id string, blob_path string, content string, "
    f"pages array<struct<spans:array<{SPAN}>,lines:array<struct<content:string>>>>"
)


def _split(spark, rows):
    df = spark.createDataFrame(rows, ANALYSIS)
    return {(r.document_id, r.page_number): r for r in P.split_pages(df).collect()}


def test_spans_lines_and_fallbacks(spark):
    content = "Hello world. Second page text.\U0001F600tail"
    pages = [
        ([(0, 5), (5, 7)], [("x",)]),          # two spans concatenated with no separator
        ([(None, 3), (13, 17)], []),           # null offset skipped
        ([(0, 0)], [("ignored",)]),            # zero-length span is valid: '' and no fallback
        ([(30, 100)], []),                     # past the end clamps (non-BMP char counts once)
        ([], [("a",), ("b",)]),                # no spans: lines joined by one space
        ([], []),                              # nothing: ''
    ]
    got = _split(spark, [("d", "c/d.pdf", content, pages)])
    assert got[("d", 1)].content == "Hello world."
    assert got[("d", 2)].content == "Second page text."
    assert got[("d", 3)].content == ""
    assert got[("d", 4)].content == "\U0001F600tail"
    assert got[("d", 4)].length == 5
    assert got[("d", 5)].content == "a b"
    assert got[("d", 6)].content == ""
    assert sorted(k[1] for k in got) == [1, 2, 3, 4, 5, 6]  # M1: 1-based position


def test_no_content_uses_lines_and_empty_document_has_no_pages(spark):
    got = _split(spark, [("d", "c/d.pdf", "", [([(0, 3)], [("l1",), ("l2",)])]), ("e", "c/e.pdf", "x", [])])
    assert got[("d", 1)].content == "l1 l2"
    assert not [k for k in got if k[0] == "e"]  # no phantom page


def test_page_count(spark):
    df = spark.createDataFrame([("a", None), ("b", []), ("c", [([], [])] * 3)], f"document_id string, pages array<struct<spans:array<{SPAN}>,lines:array<struct<content:string>>>>")
    got = {r.document_id: r.page_count for r in P.page_counts(df).collect()}
    assert got == {"a": 0, "b": 0, "c": 3}


LEGACY = (
    "document_id string, pages array<struct<pageNumber:int>>, "
    "contents array<struct<pageNumber:int,markdown:string,text:string>>, "
    "figures array<struct<pageNumber:int,description:string>>, summary string, metadata struct<summary:string>"
)


def test_legacy_accessors(spark):
    rows = [
        ("three", [(1,), (2,), (3,)], [(1, "# One", None), (2, None, "two text"), (2, "", "dropped"), (2, "more", None)],
         [(1, "f1"), (2, "f2a"), (2, "f2b")], None, ("meta summary",)),
        ("gap", [], [(1, "a", None), (2, "b", None), (5, "e", None)], [], "top", None),
        ("empty", [], [], [], "", ("",)),
    ]
    df = spark.createDataFrame(rows, LEGACY)
    counts = {r.document_id: r.n for r in df.select("document_id", P.legacy_page_count(F.col("pages"), F.col("contents")).alias("n")).collect()}
    assert counts == {"three": 3, "gap": 5, "empty": 1}
    content = {(r.document_id, r.page_number): r.content for r in P.legacy_pages(df).collect()}
    assert content[("three", 1)] == "# One"
    assert content[("three", 2)] == "two text\n\nmore"   # empty markdown does not fall through
    assert content[("gap", 3)] == ""
    p99 = df.select(P.legacy_page_content(F.col("contents"), F.lit(99)).alias("c")).collect()
    assert all(r.c == "" for r in p99)
    abstract = {r.document_id: r.a for r in df.select("document_id", P.document_abstract(F.col("summary"), F.col("metadata.summary")).alias("a")).collect()}
    assert abstract == {"three": "meta summary", "gap": "top", "empty": None}
    figs = P.figures(df)
    assert figs.filter(F.col("document_id") == "three").count() == 3
    assert P.page_figures(df, 2).count() == 2
    assert P.page_figures(df, 3).count() == 0


@pytest.mark.parametrize(
    "text,expected",
    [
        ("1-50", (1, 50, None)),
        (" 1 - 5 ", (1, 5, None)),
        ("5", (None, None, P.RANGE_NO_HYPHEN)),
        ("1-2-3", (None, None, P.RANGE_HYPHENS)),
        ("a-b", (None, None, P.RANGE_NOT_INT)),
        ("0-3", (None, None, P.RANGE_NOT_POSITIVE)),
        ("9-2", (None, None, "Invalid range: start (9) > end (2)")),
    ],
)
def test_page_range(spark, text, expected):
    r = spark.createDataFrame([(text,)], "r string").select(P.parse_page_range(F.col("r")).alias("p")).first().p
    assert (r.start, r.end, r.error) == expected
    pages = spark.range(1, 80).select(F.col("id").cast("int").alias("page_number"))
    if expected[2] is None:
        got = [x.page_number for x in P.select_page_range(pages, F.lit(text)).collect()]
        assert sorted(got) == list(range(expected[0], expected[1] + 1))
    else:
        with pytest.raises(Exception, match=re.escape(expected[2])):
            P.select_page_range(pages, F.lit(text)).collect()


def test_truncate(spark):
    r = spark.createDataFrame([("abcdef",)], "t string").select(P.truncate_page(F.col("t"), 3).alias("x")).first()
    assert r.x == "abc"
