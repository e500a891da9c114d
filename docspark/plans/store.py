"""Stored index tables (S13): built by an explicit step, read by later searches.

A build gets a folder of its own under the shared checkpoint folder, so builds never
meet, and is read only through the handle that the build returns (or by its path).
Within a session the registered queries share one build per input and parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.embed import record_vectors
from ..operators.search import RECORD_COLS, SparseIndex
from ..operators.sections import page_heading, page_years, sections
from ..session import ensure_checkpoint_dir


def build_index_tables(records: DataFrame, topics: DataFrame, dim: int, pages: DataFrame | None = None) -> str:
    """Write records, topics, term vectors (a row per record, with its norm) and of
    ``pages`` (none: no rows) the sections and years; the path of the new build. Vectors
    are partitioned by level, so a level filter prunes folders."""
    spark = records.sparkSession
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/indexes/{uuid.uuid4().hex}"
    records.select(*RECORD_COLS).write.option("compression", "zstd").parquet(f"{root}/records")
    topics.write.parquet(f"{root}/topics")
    if pages is None:
        pages = spark.createDataFrame([], "document_id string, page_number int, content string")
    sections(pages, page_heading()).write.parquet(f"{root}/sections")
    page_years(pages).write.parquet(f"{root}/years")
    recs = spark.read.parquet(f"{root}/records")
    record_vectors(recs, "id", "text", dim, keep=("level",)).write.option("compression", "zstd").partitionBy("level").parquet(f"{root}/vectors")
    return root


def read_index_tables(spark: SparkSession, root: str, dim: int) -> SparseIndex:
    return SparseIndex(*(spark.read.parquet(f"{root}/{name}") for name in ("records", "vectors")), dim,
                       *(spark.read.parquet(f"{root}/{name}") for name in ("topics", "sections", "years")))


_BUILT: dict[tuple[str, str], str] = {}


def session_index(spark: SparkSession, key: str, build: Callable[[], tuple[DataFrame, ...]], dim: int) -> SparseIndex:
    """The index that this session built for ``key``, built now if there is none.
    ``build()`` returns records, topics and, if it has them, pages. Another session, or another version of the
    code, never reads it."""
    mine = (spark.sparkContext.applicationId, key)
    if mine not in _BUILT:
        records, topics, *pages = build()
        _BUILT[mine] = build_index_tables(records, topics, dim, *pages)
    return read_index_tables(spark, _BUILT[mine], dim)
