"""Pairs of rows, and what is needed of the rows, brought together in groups."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def meet(pairs: DataFrame, rows: DataFrame, run: Callable, schema: str, per: int = 20_000, hot: int = 40_000,
         labels: bool = True) -> DataFrame:
    """``run(rows, pairs)`` for groups of about ``per`` of the stored ``pairs(a, b)``: Arrow
    tables of the group's pairs by (a, b) and of the rows ``(ref, ...)`` that these name, by
    ref; it yields record batches of ``schema``.

    A pair lies with the first partner of its first member (itself, if it comes second in none),
    so the members of a cluster go to one group, once, instead of along with each of their pairs. More than ``hot`` pairs
    of one label are cut into blocks, a pair by its members' hashes, and a member goes to
    its blocks' row and column. Without ``labels`` all pairs are cut so."""
    total = pairs.count()
    groups = max(1, math.ceil(total / per))
    placed = pairs.select("a", "b")

    def block(k):
        return [F.pmod(F.xxhash64(c), k) for c in ("a", "b")]

    if not labels:
        groups = max(1, math.ceil(math.sqrt(total / per))) ** 2
        side, other = block(F.lit(math.isqrt(groups)))
        placed = placed.withColumn("group", side * math.isqrt(groups) + other)
    else:
        least = placed.groupBy(F.col("b").alias("end")).agg(F.min("a").alias("label"))
        placed = placed.join(least, F.col("a") == F.col("end"), "left").select("a", "b", F.coalesce("label", "a", "b").alias("label"))
        k = F.lit(1)
        if total > hot:
            placed = materialize(placed)
            sizes = placed.groupBy("label").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot)
            cut = sizes.select("label", F.ceil(F.sqrt(F.col("n") / hot)).alias("k"))
            placed = placed.join(F.broadcast(cut), "label", "left")  # at most one row per ``hot`` pairs
            k = F.coalesce("k", F.lit(1))
        placed = placed.select("a", "b", F.pmod(F.xxhash64("label", *block(k)), F.lit(groups)).alias("group"))
    needed = placed.select("group", F.explode(F.array("a", "b")).alias("ref")).distinct()
    kept = [c for c in rows.columns if c != "ref"]
    sent = needed.join(rows, "ref").select("group", F.lit(0).alias("kind"), F.col("ref").alias("a"), F.col("ref").alias("b"), *kept)
    both = sent.unionByName(placed.select("group", F.lit(1).alias("kind"), "a", "b"), allowMissingColumns=True)
    lined = both.repartition(groups, "group").sortWithinPartitions("group", "kind", "a", "b")
    return lined.mapInArrow(_by_group(run, kept), schema)


def _by_group(run: Callable, kept: list[str]) -> Callable:
    def step(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def done(held):
            t = pa.Table.from_batches(held)
            n = int(np.count_nonzero(t["kind"].to_numpy() == 0))
            rows = t.slice(0, n).select(["a", *kept]).rename_columns(["ref", *kept]).combine_chunks()
            return run(rows, t.slice(n).select(["a", "b"]).combine_chunks()) if n < t.num_rows else ()

        held: list = []
        for batch in batches:
            group = batch.column(0).to_numpy()
            ends = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)] if len(group) else [0]
            for i, j in zip(ends, ends[1:]):
                if held and held[-1].column(0)[0].as_py() != int(group[i]):
                    yield from done(held)
                    held = []
                held.append(batch.slice(i, j - i))
        if held:
            yield from done(held)

    return step
