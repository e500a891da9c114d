"""Index records (A6, A7) and versioned, idempotent upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.paths import file_name

COMPLETED, COMPLETED_WITH_ERRORS = "completed", "completed_with_errors"


def build_index(result: DataFrame, run_time: str) -> DataFrame:
    """A6 (M8, M17): one E8 record per document. ``run_time`` ('YYYY-MM-DD HH:MM:SS',
    UTC) is passed in so a run reproduces; created = updated = run time."""
    ts = F.to_timestamp(F.lit(run_time))
    return result.select(
        F.col("document_id").alias("id"),
        "document_id",
        file_name(F.col("blob_path")).alias("file_name"),
        "blob_path",
        F.col("page_count").cast("int").alias("page_count"),
        "summary_blob",
        "report_blob",
        F.col("failed_page_count").cast("int").alias("failed_page_count"),
        F.when(F.col("failed_page_count") == 0, F.lit(COMPLETED)).otherwise(F.lit(COMPLETED_WITH_ERRORS)).alias("status"),
        ts.alias("created_at"),
        ts.alias("updated_at"),
    )


def upsert_index(current: DataFrame, updates: DataFrame, keep_created: bool = False) -> DataFrame:
    """The latest record per ``id`` wins (ties go to ``updates``). By default a
    record is replaced whole (the original behaviour); ``keep_created`` keeps the
    earliest ``created_at``. Idempotent: upserting the same updates twice equals once.
    One shuffle by ``id`` serves both window expressions."""
    both = current.withColumn("_src", F.lit(0)).unionByName(updates.withColumn("_src", F.lit(1)))
    w = Window.partitionBy("id").orderBy(F.col("updated_at").desc(), F.col("_src").desc())
    ranked = both.withColumn("_rk", F.row_number().over(w))
    if keep_created:
        ranked = ranked.withColumn("created_at", F.min("created_at").over(Window.partitionBy("id")))
    return ranked.filter(F.col("_rk") == 1).drop("_rk", "_src")


def append_version(df: DataFrame, root: str, version: int) -> None:
    """Write index version ``version`` (again: replaces it) and then commit it. Readers
    see a version only once its commit is written, and never a path being written."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{root}/versions/{version}")
    spark.range(version, version + 1).select(F.col("id").alias("version")).write.mode("overwrite").parquet(f"{root}/commits/{version}")


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The newest committed version (the commits are one row each)."""
    newest = spark.read.parquet(f"{root}/commits/*").agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{root}/versions/{newest}")


def page_index(page_summaries: DataFrame) -> DataFrame:
    """``id = {doc}-{page:03d}`` (wider pages keep all digits)."""
    return page_summaries.select(
        F.concat(F.col("document_id"), F.lit("-"), F.format_string("%03d", F.col("page"))).alias("id"),
        "document_id",
        "page",
        "summary",
        F.concat(F.lit("parsed-pages/"), F.col("document_id"), F.lit("/"), F.col("page").cast("string"), F.lit(".json")).alias("text_blob"),
    )


def summary_index(doc_summaries: DataFrame, page_summaries: DataFrame) -> DataFrame:
    """One record per document summary with the number of page units."""
    units = page_summaries.groupBy("document_id").agg(F.count(F.lit(1)).alias("units"))
    return doc_summaries.join(units, "document_id", "left").select(
        F.col("document_id").alias("id"),
        "document_id",
        F.col("summary_blob").alias("final_summary_blob"),
        F.coalesce(F.col("units"), F.lit(0)).alias("units"),
    )
