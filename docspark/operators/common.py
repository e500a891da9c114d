"""Shared DataFrame helpers for ordered per-group strings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered_concat(
    df: DataFrame,
    keys: list[str],
    order_cols: list[str],
    text_col: str,
    sep: str,
    out_col: str,
    bucket_col: str | None = None,
    bucket_size: int = 4096,
) -> DataFrame:
    """Per ``keys`` group, ``text_col`` values joined by ``sep`` in ``order_cols`` order.

    ``collect_list`` is unordered after a shuffle, so values travel with their sort
    key and are sorted inside the row. When ``bucket_col`` (an integer ordering
    column such as the page number) is given, a hot group is split first: partial
    strings are built per ``(keys, bucket_col div bucket_size)`` -- spread over many
    tasks -- and only those partial strings meet in the final per-group merge."""
    order = [F.col(c) for c in order_cols]

    def agg(frame: DataFrame, group: list, sort: list, value: str, name: str) -> DataFrame:
        items = F.array_sort(F.collect_list(F.struct(*sort, F.col(value).alias("_v"))))
        return frame.groupBy(*group).agg(F.array_join(F.transform(items, lambda x: x["_v"]), sep).alias(name))

    if bucket_col is None:
        return agg(df, keys, order, text_col, out_col)
    part = df.withColumn("_bucket", F.floor(F.col(bucket_col) / bucket_size))
    partial = agg(part, keys + ["_bucket"], order, text_col, "_part")
    return agg(partial, keys, [F.col("_bucket")], "_part", out_col)
