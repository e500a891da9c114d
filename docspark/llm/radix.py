"""Exact de-duplication by distributed MSD radix partitioning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, carried, stored

#: Characters per digit. The last pass takes whatever is left.
WIDTHS = (64, 1024, 16384)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 widths: tuple[int, ...] = WIDTHS, carry: bool = False) -> DataFrame:
    """Groups of documents whose texts are equal once white space is deleted.

    Every pass looks at the next run of characters (the digit) of the rows still
    open, splits each class by it and closes the groups that have one row or whose
    texts end within the digit. Groups are compared by the characters themselves, no
    digest decides. The counts per (class, digit) are combined before their shuffle
    and joined back to the rows by an equi-join that adaptive execution can split, so
    a text that a third of all rows share does not meet in one task. Only open rows
    are written for the next pass.

    Returns one row per input row: ``id_col``, keep_id, group_size, kept,
    text_sha256 (of the normalised text) and, with ``carry``, the whole input row
    as struct ``doc``. In a group the row with the most code points in its original
    text stays, then the smallest id (a null id last), then the earliest row, so of
    fully repeated rows exactly one stays. A null text counts as empty; all empty
    texts are one group. An empty table gives an empty result."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    norm = F.translate(text, SPACES, "")
    # the text travels once: within the carried row, or as what no pass has seen yet
    held = ["doc"] if carry else ["rest"]
    content = F.translate(F.coalesce(F.col("doc").getField(text_col), F.lit("")), SPACES, "") if carry else F.col("rest")
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("id"),
        F.length(text).alias("cp"), F.sha2(norm.cast("binary"), 256).alias("sha"),
        F.lit(-1).cast("long").alias("cls"), carried(docs).alias("doc") if carry else norm.alias("rest"))
    closed, seen = [], 0
    for width in (*widths, None):
        digit = F.substring(content, F.lit(seen + 1 if carry else 1), F.lit(width or 2**31 - 1))
        rows = rows.withColumn("digit", digit)
        order = F.struct((-F.col("cp")).alias("neg"), F.col("id").isNull().alias("none"), "id", "rid")
        groups = (rows.groupBy("cls", "digit")
                  .agg(F.count("*").alias("n"), F.min(order).alias("best")))
        ended = F.lit(True) if width is None else F.length("digit") < width
        done = (F.col("n") == 1) | ended
        left = F.col("doc") if carry else F.when(~done, F.substring("rest", F.lit((width or 0) + 1), F.lit(2**31 - 1)))
        passed = rows.join(groups, ["cls", "digit"]).select(
            "rid", "id", "cp", "sha", F.col("best.rid").alias("cls"), left.alias(held[0]),
            F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"),
            (F.col("rid") == F.col("best.rid")).alias("kept"), done.alias("done"))
        passed = stored(passed, "done")
        closed.append(passed.where("done").select(
            F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"),
            *(["doc"] if carry else [])))
        if width is None:
            break
        seen += width
        rows = passed.where("not done").select("rid", "id", "cp", "sha", "cls", *held)
        if rows.isEmpty():
            break
    return reduce(DataFrame.unionByName, closed)
