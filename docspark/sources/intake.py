"""Intake (S1-S3): request validation, blob path parsing, source manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths

# Validation messages, first failing check wins.
ERR_DOCUMENT_ID = "'documentId' (string) is required."
ERR_BLOB_PATH = "'blobPath' (string) is required."
ERR_PATH_FORM = "blob_path must be of the form 'container/blob-name.pdf'"


def with_validation(requests: DataFrame, id_col: str = "document_id", path_col: str = "blob_path") -> DataFrame:
    """S1. Adds ``error`` (null when valid): non-empty id first, then non-empty path."""
    ident, path = F.col(id_col), F.col(path_col)
    error = (
        F.when(ident.isNull() | (ident == ""), F.lit(ERR_DOCUMENT_ID))
        .when(path.isNull() | (path == ""), F.lit(ERR_BLOB_PATH))
    )
    return requests.withColumn("error", error)


def validate_requests(requests: DataFrame, id_col: str = "document_id", path_col: str = "blob_path") -> tuple[DataFrame, DataFrame]:
    """S1. Split into ``(valid, rejected)``; rejected rows carry ``error``."""
    checked = with_validation(requests, id_col, path_col)
    valid = checked.filter(F.col("error").isNull()).drop("error")
    rejected = checked.filter(F.col("error").isNotNull())
    return valid, rejected


def parse_blob_path(df: DataFrame, path_col: str = "blob_path") -> DataFrame:
    """S2 (M18). ``container`` and ``blob_name`` split on the first '/', ``file_name``
    after the last '/', ``path_error`` when there is no '/'."""
    p = F.col(path_col)
    return df.select(
        "*",
        paths.container(p).alias("container"),
        paths.blob_name(p).alias("blob_name"),
        paths.file_name(p).alias("file_name"),
        F.when(~p.contains("/"), F.lit(ERR_PATH_FORM)).alias("path_error"),
    )


def source_manifest(spark: SparkSession, path_glob: str, recursive: bool = True) -> DataFrame:
    """S3. Which source files exist, without reading their bytes: ``binaryFile``
    with only metadata columns selected, so the ``content`` column is pruned."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path_glob)
        .select("path", "length", "modificationTime")
    )
    name = F.regexp_extract(F.col("path"), r"([^/]+?)(\.[^./]*)?$", 1)
    return files.select(
        F.col("path"),
        F.col("length"),
        F.col("modificationTime").alias("modified"),
        name.alias("document_id"),
    )
