"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: The white space of all word rules: blank and the code points 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder and read back:
    lineage ends there, and a lost executor costs only its running tasks."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, key: str) -> DataFrame:
    """Like :func:`stored`, in as many buckets of ``key`` as a shuffle has partitions: a
    join on it moves only the other side."""
    spark = df.sparkSession
    name, n = "b" + uuid.uuid4().hex, int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}"
    df.repartition(n, key).write.bucketBy(n, key).option("path", path).saveAsTable(name)
    return spark.table(name)


def words(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def carried(df: DataFrame) -> Column:
    """The whole input row as one struct: its column names cannot clash with ours."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])
