"""Structured Streaming forms of the corpus plan.

One intake row carries a whole document, so page and document roll-ups stay
inside a micro-batch and need no cross-batch state; only progress counts (T3) and
de-duplication (T4) keep state, both bounded by watermark or key count."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import pages as P
from ..operators import summarize as Z
from ..plans.process import DEFAULT_RUN_TIME, process_corpus
from ..session import ensure_checkpoint_dir, materialize
from ..sources import corpus, intake
from ..sources.files import stored_rows, write_pages

DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


#: Files that one micro-batch takes at most.
FILES_PER_BATCH = 64


def scratch_root(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for one stream's sink and
    checkpoint."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/streams/{name}-{uuid.uuid4().hex}"


def document_stream(spark: SparkSession, path: str, max_files_per_trigger: int = FILES_PER_BATCH) -> DataFrame:
    """Documents arriving as Parquet files (explicit schema, never inferred), with
    the arrival time the original intake does not record. A batch takes a bounded number
    of files, so a backlog is worked off in many batches."""
    reader = spark.readStream.schema(DOCUMENT_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path).withColumn("arrival_ts", F.current_timestamp())


def _run(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def _started(stream: DataFrame, write, sink: str, **options) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{sink}/_checkpoint")
    for name, value in options.items():
        writer = getattr(writer, name)(value)
    return writer.trigger(availableNow=True).start()


def stream_intake(spark: SparkSession, path: str, sink: str, lines_per_page: int = 10, sentences: int = 2,
                  max_files_per_trigger: int = FILES_PER_BATCH) -> StreamingQuery:
    """Validated requests (S1), stateless split and page summaries per micro-batch,
    appended to ``{sink}/data/batch=N`` (overwrite: a replayed batch replaces itself).
    Rows that fail validation go to ``{sink}/rejected/batch=N`` with their error."""
    docs = document_stream(spark, path, max_files_per_trigger)
    requests = intake.with_validation(corpus.documents_corpus(docs, lines_per_page))

    def write(batch: DataFrame, batch_id: int) -> None:
        good = batch.filter(F.col("error").isNull()).drop("error")
        ps = Z.summarize_pages(P.split_pages(good), sentences=sentences)
        ps.write.mode("overwrite").parquet(f"{sink}/data/batch={batch_id}")
        bad = batch.filter(F.col("error").isNotNull()).select("document_id", "blob_path", "error")
        bad.write.mode("overwrite").parquet(f"{sink}/rejected/batch={batch_id}")

    return _started(requests, write, sink)


def stream_upsert(spark: SparkSession, path: str, sink: str, lines_per_page: int = 10, run_time: str = DEFAULT_RUN_TIME,
                  max_files_per_trigger: int = FILES_PER_BATCH) -> StreamingQuery:
    """The whole L1 plan per micro-batch; its index records replace those of the same
    documents in ``{sink}/index`` (hash buckets; only the touched ones are rewritten), so
    a read is a plain scan and a replayed batch changes nothing."""
    docs = document_stream(spark, path, max_files_per_trigger)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = materialize(batch.drop("arrival_ts"))  # read by several consumers
        totals = corpus.documents_totals(batch, lines_per_page)
        done = process_corpus(corpus.documents_corpus(batch, lines_per_page), run_time=run_time, persist=True, totals=totals)
        write_pages(done.index.dropDuplicates(["id"]), f"{sink}/index")

    return _started(docs, write, sink)


def read_index(spark: SparkSession, sink: str) -> DataFrame:
    """The current index: one record per id, the latest batch's."""
    return spark.read.parquet(f"{sink}/index").drop("bucket")


def stream_progress(spark: SparkSession, path: str, sink: str, lines_per_page: int = 10, delay: str = "1 hour",
                    max_files_per_trigger: int = FILES_PER_BATCH) -> StreamingQuery:
    """Completed pages per document against its total, as a streaming aggregate
    (output mode ``update``). A document's pages all complete inside its micro-batch, so
    the completed count is the number of pages split off; the total comes from its line
    ends. A document that arrives twice counts once (the larger count). Grouping by
    arrival window under a watermark lets Spark drop the state of closed windows. Each
    batch's changed rows go to ``{sink}/progress/batch=N``."""
    docs = document_stream(spark, path, max_files_per_trigger).withWatermark("arrival_ts", delay)
    results = corpus.documents_corpus(docs, lines_per_page, keep=("arrival_ts", "doc_id", "text"))
    per_doc = results.withColumn("n_pages", P.page_count(F.col("pages")))
    per_doc = corpus.documents_totals(per_doc, lines_per_page, keep=("arrival_ts", "n_pages"))
    done = per_doc.groupBy(F.window("arrival_ts", delay), "document_id").agg(
        F.max("n_pages").cast("long").alias("completed_pages"), F.max("total_pages").cast("long").alias("total_pages"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select("document_id", "completed_pages", "total_pages", F.col("window.start").alias("window_start")).withColumn(
            "batch", F.lit(batch_id)
        ).write.mode("overwrite").parquet(f"{sink}/progress/batch={batch_id}")

    return _started(done, write, sink, outputMode="update")


def read_progress(spark: SparkSession, sink: str) -> DataFrame:
    """Latest reported count per document (latest window, then latest batch)."""
    allb = spark.read.parquet(f"{sink}/progress")
    w = Window.partitionBy("document_id").orderBy(F.col("window_start").desc(), F.col("batch").desc())
    return allb.withColumn("_rk", F.row_number().over(w)).filter("_rk = 1").drop("_rk", "batch", "window_start")


def stream_dedupe(spark: SparkSession, paths: list[str], sink: str, delay: str = "1 hour",
                  max_files_per_trigger: int = FILES_PER_BATCH) -> StreamingQuery:
    """T4: a document id is processed once. Within the watermark delay the stream's state
    drops repeats (``dropDuplicatesWithinWatermark``, bounded); beyond it a batch skips
    the ids that earlier batches have stored."""
    streams = [document_stream(spark, p, max_files_per_trigger) for p in paths]
    s = streams[0]
    for other in streams[1:]:
        s = s.unionByName(other)
    req = s.select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("document_id"), "text", "arrival_ts"
    )
    unique = req.withWatermark("arrival_ts", delay).dropDuplicatesWithinWatermark(["document_id"])

    def write(batch: DataFrame, batch_id: int) -> None:
        stored = stored_rows(spark, f"{sink}/data", "parquet", T.StructType([*batch.schema.fields, T.StructField("batch", T.LongType())]))
        if stored is not None:  # a replayed batch must not see itself
            earlier = stored.filter(F.col("batch") < batch_id).select("document_id")
            batch = batch.join(earlier, "document_id", "left_anti")
        batch.write.mode("overwrite").parquet(f"{sink}/data/batch={batch_id}")

    return _started(unique, write, sink)


def run_to_completion(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` stream and surface its failure, if any."""
    _run(query)


__all__ = [
    "DOCUMENT_SCHEMA", "document_stream", "stream_intake", "stream_upsert", "read_index",
    "stream_progress", "read_progress", "stream_dedupe", "run_to_completion", "scratch_root",
]
