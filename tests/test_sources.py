"""Sources and sinks (S3-S7, S10, S14) on files written to a scratch folder."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from docspark.operators import pages as P
from docspark.sources import corpus, files, intake


def test_paginate_spans_equal_line_slices(spark):
    text = "l1\nline two\n\nl4 é\U0001F600\nl5\nl6\nl7"
    df = spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")
    got = {r.page_number: r.content for r in P.split_pages(corpus.paginate(df, lines_per_page=3)).collect()}
    lines = text.split("\n")
    want = {i // 3 + 1: "\n".join(lines[i:i + 3]) for i in range(0, len(lines), 3)}
    assert got == want
    covered = {r.page_number: r.content for r in P.split_pages(corpus.paginate(df, 3, cover=F.lit(True))).collect()}
    assert covered == {1: "", **{n + 1: t for n, t in want.items()}}


def test_pages_keep_every_character(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pages = P.split_pages(corpus.documents_corpus(docs))
    per = pages.groupBy("document_id").agg(F.sum("length").alias("chars"), F.count("*").alias("pages"),
                                           F.min(F.when(F.col("page_number") == 1, F.col("length"))).alias("first"))
    totals = corpus.documents_totals(docs).join(per, "document_id")
    rows = totals.join(docs.withColumn("document_id", F.concat(F.lit("doc-"), "doc_id")), "document_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        cover = r.doc_id % 7 == 0
        assert r.pages == r.total_pages and (not cover or r["first"] == 0)
        assert r.chars + r.pages - 1 - cover == r.n_chars


def test_pages_of_marks_and_wide_characters(spark):
    text = "\ufeffa\U0001F600\n\ufeff\né"
    df = spark.createDataFrame([(1, text, "s"), (2, "", "s"), (3, None, "s")], "doc_id long, text string, source string")
    got = {(r.document_id, r.page_number): r.content for r in P.split_pages(corpus.paginate(df, 1)).collect()}
    assert got == {("doc-1", 1): "\ufeffa\U0001F600", ("doc-1", 2): "\ufeff", ("doc-1", 3): "é", ("doc-2", 1): ""}


def test_pagination_is_linear_in_lines(spark):
    import time

    def seconds(n):
        rows = [(1, "\n".join(f"line {i} of the text" for i in range(n)), "s")]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        best = 1e9
        for _ in range(3):
            t = time.perf_counter()
            assert P.split_pages(corpus.paginate(df)).agg(F.sum("length")).first()[0] > 0
            best = min(best, time.perf_counter() - t)
        return best

    seconds(8_000)
    assert seconds(64_000) < 8 * seconds(8_000) + 1.0


def test_page_files_round_trip_and_enumeration(spark):
    root = tempfile.mkdtemp(prefix="docspark-files-")
    os.makedirs(f"{root}/parsed-pages/doc-1")
    recs = [{"documentId": "doc-1", "pageNumber": 1, "blobPath": "raw/doc-1.pdf", "content": "", "text": "T1", "length": 2},
            {"documentId": "doc-1", "pageNumber": 2, "blobPath": "raw/doc-1.pdf", "content": "C2", "length": 2}]
    for r in recs:
        with open(f"{root}/parsed-pages/doc-1/{r['pageNumber']}.json", "w", encoding="utf-8") as fh:
            json.dump(r, fh)
    with open(f"{root}/parsed-pages/doc-1/notes.json", "w") as fh:
        fh.write("{}")
    pages = files.read_pages(spark, f"{root}/parsed-pages/*/*.json").filter(F.col("document_id").isNotNull())
    got = {r.page_number: r.content for r in pages.collect()}
    assert got == {1: "T1", 2: "C2"}  # M4: empty content falls through to text
    found = files.enumerate_pages(pages.select(F.col("file_path").alias("path")))
    assert sorted(r.page for r in found.collect()) == [1, 2]
    paths = spark.createDataFrame([("doc-1.json",), ("doc-1/pages/1.json",), ("doc-2.json",), ("x.txt",)], "path string")
    assert sorted(r.document_id for r in files.list_documents(paths).collect()) == ["doc-1", "doc-2"]
    manifest = intake.source_manifest(spark, f"{root}/parsed-pages")
    assert manifest.count() == 3 and "content" not in manifest.columns
    out = f"{root}/out"
    files.write_pages(pages.drop("file_path"), out, buckets=4)
    files.write_pages(pages.drop("file_path").filter("page_number = 1"), out, buckets=4)  # same bucket rewritten
    assert spark.read.parquet(out).count() == 2  # the other page stays


def test_rewriting_one_document_keeps_all_others(spark):
    out = tempfile.mkdtemp(prefix="docspark-files-") + "/out"
    rows = spark.range(200).select(F.concat(F.lit("doc-"), F.col("id").cast("string")).alias("document_id"), F.lit("old").alias("markdown"))
    files.write_markdown(rows, out, buckets=8)
    again = rows.where("document_id = 'doc-7'").withColumn("markdown", F.lit("new"))
    for _ in range(2):
        files.write_markdown(again, out, buckets=8)
        got = {r.document_id: r.markdown for r in spark.read.parquet(out).collect()}
        assert len(got) == spark.read.parquet(out).count() == 200
        assert got["doc-7"] == "new" and sum(v == "old" for v in got.values()) == 199
    files.write_json(again, out + "-json", buckets=2)
    files.write_json(rows, out + "-json", buckets=2)
    assert spark.read.json(out + "-json").where("markdown = 'old'").count() == 200


def test_stored_buckets_are_few_files_however_many_tasks_write(spark):
    import glob

    out = tempfile.mkdtemp(prefix="docspark-files-") + "/out"
    rows = spark.range(2000).repartition(32).select(F.concat(F.lit("doc-"), F.col("id").cast("string")).alias("document_id"), F.lit("m").alias("markdown"))
    for _ in range(2):
        files.write_markdown(rows, out, buckets=16)
        assert spark.read.parquet(out).count() == 2000
        assert len(glob.glob(f"{out}/bucket=*")) == 16
        assert len(glob.glob(f"{out}/bucket=*/*.parquet")) <= 32  # a file per task and bucket before


def test_index_version_written_twice_counts_once(spark):
    from docspark.operators import index

    root = tempfile.mkdtemp(prefix="docspark-files-") + "/index"
    one = spark.range(200).select(F.col("id").cast("string").alias("id"))
    for _ in range(2):
        index.append_version(one, root, 1)
    assert index.read_current(spark, root).count() == 200
    index.append_version(one.limit(50), root, 2)
    assert index.read_current(spark, root).count() == 50


def test_pending_pages(spark):
    pg = spark.createDataFrame([("d", 1), ("d", 2), ("d", 3)], "document_id string, page_number int")
    done = spark.createDataFrame([("d", 1, "success"), ("d", 2, "failed")], "document_id string, page int, status string")
    assert sorted(r.page_number for r in files.pending_pages(pg, done).collect()) == [2, 3]
