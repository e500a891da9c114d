"""T3 while pages finish: part progress, completion and stalls per document."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .intake import FILES_PER_BATCH, _started

EVENT = "document_id string, total_pages int, page int, ts timestamp"
PROGRESS = "document_id string, completed_pages long, total_pages long, status string"
#: Kept per group, for each of its documents: its id, its total, how many pages it has
#: finished (their numbers follow one another in ``pages``), whether a stall was reported,
#: and the event time in ms after which it has been silent for too long.
STATE = "ids array<string>, totals array<int>, counts array<int>, pages array<int>, stalled array<boolean>, due array<long>"
#: Groups of documents that share a state, by hash of the id.
GROUPS = 4096


def follow(stall_ms: int):
    """The state step of a group of documents: counts each one's different finished pages
    against its total. No event for ``stall_ms`` of event time: an unfinished document is
    reported as stalled once, a finished one's state is dropped, as is a stalled one's the
    next time. A group's timeout is the earliest of its documents'."""
    def step(key: tuple, events: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, docs, moved = state.getCurrentWatermarkMs(), {}, {}
        if state.exists:
            ids, totals, counts, pages, stalled, due = state.get
            at = 0
            for doc, total, n, was_stalled, until in zip(ids, totals, counts, stalled, due, strict=True):
                docs[doc] = (total, set(pages[at:at + n]), was_stalled, until)
                at += n
        if not state.hasTimedOut:
            for some in events:
                for doc, total, page, ms in zip(some["document_id"], some["total_pages"], some["page"], some["ms"].tolist(), strict=True):
                    if doc not in moved:
                        before, done, _, _ = docs.get(doc, (None, set(), False, 0))
                        moved[doc] = [before, done, now]
                    mine = moved[doc]
                    if not pd.isna(total):
                        mine[0] = max(int(total), mine[0] or 0)
                    if not pd.isna(page):
                        mine[1].add(int(page))
                    mine[2] = max(mine[2], ms)
        out = []
        for doc, (total, done, was_stalled, until) in list(docs.items()):
            if doc in moved or until >= now:
                continue
            if was_stalled or (total is not None and len(done) >= total):
                del docs[doc]
                continue
            docs[doc] = (total, done, True, now + stall_ms)
            out.append((doc, len(done), total, "stalled"))
        for doc, (total, done, latest) in moved.items():
            docs[doc] = (total, done, False, latest + stall_ms)
            out.append((doc, len(done), total, "waiting" if total is None else "complete" if len(done) >= total else "running"))
        if docs:
            totals, sets, stalled, due = (list(x) for x in zip(*docs.values(), strict=True))
            state.update((list(docs), totals, [len(x) for x in sets], [p for x in sets for p in sorted(x)], stalled, due))
            state.setTimeoutTimestamp(min(due))
        else:
            state.remove()
        if out:
            ids, counts, totals, status = zip(*out, strict=True)
            yield pd.DataFrame({"document_id": ids, "completed_pages": counts,
                                "total_pages": pd.array(totals, dtype="Int64"), "status": status})

    return step


def stream_page_progress(spark: SparkSession, requests: str, pages: str, sink: str, delay: str = "10 minutes",
                         stall_minutes: int = 60, max_files_per_trigger: int = FILES_PER_BATCH, groups: int = GROUPS) -> StreamingQuery:
    """How far each document is, batch by batch, while its pages finish.

    Two file streams meet in one keyed state: ``requests`` (document_id, total_pages, ts)
    as documents are split, and ``pages`` (document_id, page, ts) as pages finish, in any
    order and over any number of files. Every batch writes the documents that moved to
    ``{sink}/progress/batch=N`` as ``waiting`` (pages before their request), ``running``,
    ``complete`` or -- after ``stall_minutes`` of event time without a page --
    ``stalled``. A page that finishes twice counts once; events later than ``delay``
    behind the newest are the watermark's to drop. The state of a document is its page
    numbers and goes ``stall_minutes`` after its last event. Documents are followed in
    ``groups`` by hash, so a batch makes a call per group that moved and not per document;
    a checkpoint goes on with the number that it began with. A stopped stream goes on from
    its checkpoint; a replayed batch replaces its own rows."""
    read = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    asked = read.schema("document_id string, total_pages int, ts timestamp").parquet(requests)
    done = read.schema("document_id string, page int, ts timestamp").parquet(pages)
    events = asked.withColumn("page", F.lit(None).cast("int")).select("document_id", "total_pages", "page", "ts").unionByName(
        done.withColumn("total_pages", F.lit(None).cast("int")).select("document_id", "total_pages", "page", "ts"))
    events = events.filter("document_id IS NOT NULL AND ts IS NOT NULL").withWatermark("ts", delay)
    events = events.withColumns({"ms": F.unix_millis("ts"), "group": F.pmod(F.xxhash64("document_id"), F.lit(groups))})
    moved = events.groupBy("group").applyInPandasWithState(
        follow(stall_minutes * 60_000), PROGRESS, STATE, "update", GroupStateTimeout.EventTimeTimeout)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/progress/batch={batch_id}")

    return _started(moved, write, sink, outputMode="update")


def read_page_progress(spark: SparkSession, sink: str) -> DataFrame:
    """The newest report of every document."""
    schema = T.StructType.fromDDL(PROGRESS + ", batch long")
    reports = spark.read.schema(schema).parquet(f"{sink}/progress")
    newest = Window.partitionBy("document_id").orderBy(F.col("batch").desc())
    return reports.withColumn("rank", F.row_number().over(newest)).filter("rank = 1").drop("rank", "batch")
