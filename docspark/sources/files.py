"""Page and summary files (S4-S10, S12, S13): JSON at the boundary, explicit
schemas, Parquet inside, hash-bucketed partitions (never one directory per document)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import truthy_text
from ..session import materialize

# Reference JSON field names (camelCase) of a parsed page.
PAGE_JSON_SCHEMA = T.StructType(
    [
        T.StructField("documentId", T.StringType()),
        T.StructField("pageNumber", T.IntegerType()),
        T.StructField("blobPath", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("length", T.IntegerType()),
    ]
)
SUMMARY_JSON_SCHEMA = T.StructType(
    [
        T.StructField("documentId", T.StringType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Parsed-page JSON files, never schema-inferred; text by the M4 rule. The
    file path is kept so page numbers can be recovered from names (S6)."""
    raw = spark.read.schema(PAGE_JSON_SCHEMA).json(path)
    return raw.select(
        F.col("documentId").alias("document_id"),
        F.col("pageNumber").alias("page_number"),
        F.col("blobPath").alias("blob_path"),
        truthy_text("content", "text").alias("content"),
        F.col("length"),
        F.col("_metadata.file_path").alias("file_path"),
    )


def bucket_of(document_id: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(document_id)), F.lit(buckets)).cast("int")


def stored_rows(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame | None:
    """What is stored at ``path``; None when nothing is."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_pages(df: DataFrame, path: str, buckets: int = 64, fmt: str = "parquet", keys: tuple[str, ...] | None = None) -> None:
    """Store rows by key; rows with a key that is stored replace those, all other
    stored rows stay. The key is (document_id, page_number) where there are pages, else
    document_id. Only the hash buckets that ``df`` touches are read and written: the
    stored rows of other keys are copied aside and merged in, and the merged buckets take
    their places in one commit, so repeating a failed write gives the same result."""
    spark = df.sparkSession
    keys = keys or (("document_id", "page_number") if "page_number" in df.columns else ("document_id",))
    merged = df.withColumn("bucket", bucket_of("document_id", buckets))
    old = stored_rows(spark, path, fmt, merged.schema)
    if old is not None:
        new = materialize(merged)
        touched = new.select("bucket").distinct()  # one row per bucket at most
        same = [old[k].eqNullSafe(new[k]) for k in ("bucket", *keys)]
        kept = old.join(touched, "bucket", "left_semi").join(new, on=same, how="left_anti")
        merged = new.unionByName(materialize(kept))
    (
        merged.hint("rebalance", "bucket")  # a file or a few per bucket, not one per task and bucket
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket")
        .format(fmt)
        .save(path)
    )


def write_json(df: DataFrame, path: str, buckets: int = 64) -> None:
    """The JSON form of :func:`write_pages` (UTF-8)."""
    write_pages(df, path, buckets, fmt="json")


def enumerate_pages(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """``parsed-pages/{doc}/{page}.json`` names -> (document_id, page); names whose
    page part is not an integer are ignored."""
    p = F.col(path_col)
    name = F.substring_index(p, "/", -1)
    page = F.regexp_replace(name, r"\.json", "").try_cast("int")
    doc = F.regexp_extract(p, r"parsed-pages/([^/]+)/[^/]+$", 1)
    return (
        paths.filter(p.endswith(".json"))
        .select(doc.alias("document_id"), page.alias("page"))
        .filter(F.col("page").isNotNull() & (F.col("document_id") != ""))
    )


def list_documents(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """Ids of ``{doc}.json`` summaries at the container root (no '/')."""
    p = F.col(path_col)
    return (
        paths.filter(p.endswith(".json") & ~p.contains("/"))
        .select(F.regexp_replace(p, r"\.json", "").alias("document_id"))
        .distinct()
    )


def fetch_page_summaries(page_summaries: DataFrame, document_ids: DataFrame) -> DataFrame:
    """The page summaries of the listed documents; a missing page sorts as 0."""
    return page_summaries.join(document_ids, "document_id", "left_semi").withColumn(
        "sort_page", F.coalesce(F.col("page"), F.lit(0))
    )


def fetch_doc_summary(requests: DataFrame, doc_summaries: DataFrame) -> DataFrame:
    """Point lookups as a left join; absent summaries are null."""
    return requests.join(doc_summaries, "document_id", "left")


def pending_pages(pages: DataFrame, summaries: DataFrame) -> DataFrame:
    """Pages without a stored summary. Failed records are stored elsewhere by
    the original service (M15), so only success/skipped records count as done."""
    done = summaries.filter(F.col("status").isin("success", "skipped")).select(
        "document_id", F.col("page").alias("page_number")
    )
    return pages.join(done, ["document_id", "page_number"], "left_anti")


def write_markdown(rendered: DataFrame, path: str, buckets: int = 64) -> None:
    """``(document_id, markdown)`` stored as Parquet by hash bucket; no driver loop."""
    write_pages(rendered, path, buckets)


def write_embeddings(records: DataFrame, path: str) -> None:
    """One table partitioned by level; batching is Spark's."""
    records.write.mode("overwrite").partitionBy("level").parquet(path)
