"""Ranks of rows by a distributed sort, without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored


def numbering(n_keys: int, kept: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A pass over one sorted partition: where each row's group begins in it, and the
    keys at its two ends. Rows that are alone for certain are left out."""
    def rows(at: int, start: np.ndarray, before: np.ndarray, after: np.ndarray, batch: pa.Table,
             last: bool, pid: int) -> pa.RecordBatch | None:
        n = batch.num_rows
        place = at + np.arange(n)
        lead, tail = place == 0, np.zeros(n, dtype=bool)
        tail[-1] = last
        keep = np.flatnonzero(before | after | lead | tail)
        if not len(keep):
            return None
        edge = (lead | tail)[keep]
        cols = {name: batch.column(name).take(keep) for name in kept}
        cols |= {"part_id": pa.array(np.full(len(keep), pid, dtype=np.int32)), "part_start": pa.array(start[keep]),
                 "part_twin": pa.array((before | after)[keep]), "part_lead": pa.array(lead[keep]), "part_tail": pa.array(tail[keep]),
                 "part_rows": pa.array(np.where(tail[keep], at + n, 0))}
        for j in range(n_keys):
            key = batch.column(j).combine_chunks() if isinstance(batch.column(j), pa.ChunkedArray) else batch.column(j)
            cols[f"k{j}"] = pa.array(key.take(keep).to_numpy(zero_copy_only=False), mask=~edge, type=pa.int64())
        return pa.Table.from_pydict(cols).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        held, at, before_held, start_held = None, 0, False, 0  # the last row waits for the one after it
        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, new]) if held is not None else new
            keys = np.stack([table.column(j).to_numpy() for j in range(n_keys)])
            same = (keys[:, 1:] == keys[:, :-1]).all(axis=0)
            before = np.concatenate(([before_held], same))
            place = at + np.arange(table.num_rows)
            start = np.maximum.accumulate(np.where(before, start_held, place))
            most = table.num_rows - 1
            if most:
                some = rows(at, start[:most], before[:most], same, table.slice(0, most), False, pid)
                if some is not None:
                    yield some
            held, at = table.slice(most), at + most
            before_held, start_held = bool(before[most]), int(start[most])
        if held is not None:
            yield rows(at, np.array([start_held]), np.array([before_held]), np.array([False]), held, True, pid)

    return run


def ranked(rows: DataFrame, keys: list[str], ids: list[str], carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose keys (whole numbers, never null) occur more than once, with ``rank``:
    how many rows have smaller keys. Equal keys have equal ranks. Ids tell rows apart;
    columns to ``carry`` come along.

    The sort is by keys and then by ids, so a key that very many rows share is dealt to
    many partitions. A partition only passes on its row count and the keys at its ends;
    from these, one small row per partition, ranks across partitions follow."""
    kinds = dict(rows.dtypes)
    order = [*keys, *ids]
    kept = [*ids, *carry]
    lined = rows.select(*order, *carry).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = (", ".join(f"{c} {kinds[c]}" for c in kept) + ", part_id int, part_start long, part_twin boolean, "
              "part_lead boolean, part_tail boolean, part_rows long, " + ", ".join(f"k{j} long" for j in range(len(keys))))
    marked = stored(lined.select(*[F.col(c).cast("long") for c in keys], *kept).mapInArrow(
        numbering(len(keys), kept), schema))
    key = F.struct(*[f"k{j}" for j in range(len(keys))])
    parts = marked.where(F.col("part_lead") | F.col("part_tail")).groupBy("part_id").agg(
        F.max(F.when(F.col("part_lead"), key)).alias("first"), F.max(F.when(F.col("part_tail"), key)).alias("last"),
        F.max("part_rows").alias("part_rows"), F.max(F.when(F.col("part_tail"), F.col("part_start"))).alias("open"))
    line = Window.orderBy("part_id")  # one row per partition
    parts = parts.select(
        "part_id", "open", F.coalesce(F.col("first") == F.lag("last").over(line), F.lit(False)).alias("goes_on"),
        F.coalesce(F.sum("part_rows").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    begun = F.when((F.col("open") > 0) | ~F.col("goes_on"), F.col("offset") + F.col("open"))
    parts = parts.select(
        "part_id", "goes_on", "offset", F.last(begun, ignorenulls=True).over(
            line.rowsBetween(Window.unboundedPreceding, -1)).alias("carry"),
        F.coalesce(F.lead("goes_on").over(line), F.lit(False)).alias("next_goes_on"))
    into = F.col("goes_on") & (F.col("part_start") == 0)
    return (marked.join(F.broadcast(parts), "part_id")
            .where(F.col("part_twin") | (F.col("part_lead") & F.col("goes_on")) | (F.col("part_tail") & F.col("next_goes_on")))
            .select(*kept, F.when(into, F.col("carry")).otherwise(F.col("offset") + F.col("part_start")).alias("rank")))
