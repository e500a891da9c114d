"""Sharding by histogram sort: probe key boundaries, count exact bytes, exchange once."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import carried, stored

SIGN = 1 << 63


def _pack(h: int, i: int) -> int:
    """The sort key (hash, id) as one whole number; arithmetic between keys needs it."""
    return ((h + SIGN) << 64) | (i + SIGN)


def _unpack(key: int) -> tuple[int, int]:
    return (key >> 64) - SIGN, (key & ((1 << 64) - 1)) - SIGN


def below(bounds_h: np.ndarray, bounds_i: np.ndarray, h: np.ndarray, i: np.ndarray) -> np.ndarray:
    """Per row, the number of boundaries at or below its key."""
    low = np.searchsorted(bounds_h, h, side="left")
    high = np.searchsorted(bounds_h, h, side="right")
    out = high.astype(np.int64)
    tied = np.flatnonzero(low < high)
    for start in np.unique(low[tied]):
        at = tied[low[tied] == start]
        out[at] = start + np.searchsorted(bounds_i[start:high[at[0]]], i[at], side="right")
    return out


def _binned(df: DataFrame, bounds: list[int]) -> DataFrame:
    parts = [_unpack(b) for b in bounds]
    bounds_h = np.array([p[0] for p in parts], dtype=np.int64)
    bounds_i = np.array([p[1] for p in parts], dtype=np.int64)

    @F.pandas_udf("long")
    def bin_of(h: pd.Series, i: pd.Series) -> pd.Series:
        # the boundaries grow with shards and bins only, never with the rows
        return pd.Series(below(bounds_h, bounds_i, h.to_numpy(), i.to_numpy()))

    return df.withColumn("bin", bin_of("h", "i"))


def splitters(keys: DataFrame, targets: list[int], slack: list[int], probes: int = 8,
              first: int = 4096) -> list[int]:
    """Boundaries whose exact bytes below come within ``slack`` of ``targets``, or as
    near as the keys allow. ``keys``: h, i, size. Each round counts bytes and the
    smallest and largest key of every bin between probes in one combined aggregate
    and narrows the brackets; brackets shrink to the keys that are really there, so
    one hash that many rows share is refined by id at once."""
    total = keys.agg(F.sum("size"), F.min(F.struct("h", "i")), F.max(F.struct("h", "i"))).first()
    if total[0] is None:
        return []
    known = {_pack(*total[1]): 0, _pack(*total[2]) + 1: total[0]}  # key -> bytes below it
    whole = False
    last: dict[int, tuple[int, int, int]] = {min(known): (total[0], min(known), max(known) - 1)}
    while True:
        order = sorted(known)
        cum = np.array([known[k] for k in order])
        wanted: set[int] = set()
        chosen = []
        for t, s in zip(targets, slack):
            at = int(np.searchsorted(cum, t, side="left"))
            at = min(max(at, 1), len(order) - 1)
            a, b = order[at - 1], order[at]
            best = a if t - known[a] <= known[b] - t else b
            chosen.append(best)
            if abs(known[best] - t) <= s:
                continue
            _, lowest, highest = last.get(a, (0, a, b - 1))
            if lowest >= highest:  # one key: nothing left to split
                continue
            n = probes if whole else max(probes, first // max(1, len(targets)))
            step = (highest - lowest) / (n + 1)
            # probes split the keys that are there; above `lowest`, up to `highest`
            wanted.update(min(highest, lowest + 1 + int(step * (j + 1))) for j in range(n))
            wanted.update((lowest + 1, highest))
        wanted -= set(known)
        whole = True
        if not wanted:
            return chosen
        bounds = sorted(wanted | set(chosen) | set(known))
        counted = (_binned(keys, bounds).groupBy("bin")
                   .agg(F.sum("size").alias("bytes"), F.min(F.struct("h", "i")).alias("lo"),
                        F.max(F.struct("h", "i")).alias("hi")).collect())
        per = {r["bin"]: r for r in counted}
        known, last, run = {}, {}, 0
        for n, key in enumerate(bounds):
            run += per[n]["bytes"] if n in per else 0  # rows below this boundary
            known[key] = run
            if n + 1 in per:
                r = per[n + 1]
                last[key] = (r["bytes"], _pack(*r["lo"]), _pack(*r["hi"]))


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
          overhead: int = 16, bins: int = 16, bin_bytes: int = 128 << 20, tolerance: float = 0.001) -> DataFrame:
    """Deal rows to shards of nearly equal bytes by a histogram sort.

    A row has the UTF-8 bytes of its text plus ``overhead``. Rows are ordered by
    (hash of the text, id): equal texts are neighbours, yet a text that a third of
    all rows share can be cut between two ids. Boundaries are found on a table of key
    and size only; every shard has at least ``bins`` bins of at most about
    ``bin_bytes``, and the rows move once, to their bin. The place in the shard is
    the exact number of rows in the bins before plus the place in the bin.

    Returns all columns of the input as struct ``doc`` and size, shard, slot (0, 1,
    ... without gaps in each shard). A shard's bytes are off by ``tolerance`` of its
    share or one row, whichever is more. Null texts have ``overhead`` bytes, null ids
    come first; rows equal in text and id share a bin and their order is arbitrary.
    With fewer rows than shards some shards stay empty."""
    text = F.col(f"`{text_col}`")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long")
    keyed = docs.select(
        carried(docs).alias("doc"), size.alias("size"),
        F.xxhash64(text).alias("h"), F.coalesce(F.col(f"`{id_col}`"), F.lit(-SIGN)).cast("long").alias("i"))
    keys = stored(keyed.select("h", "i", "size"))
    total = keys.agg(F.sum("size")).first()[0] or 0
    per = max(bins, -(-total // (shards * bin_bytes)))
    n = shards * per
    targets = [total * k // n for k in range(1, n)]
    share = total / shards
    slack = [int(share * tolerance / 2) if k % per == 0 else int(share / per / 4) for k in range(1, n)]
    found = splitters(keys, targets, slack)
    bounds = sorted({b for b in found})
    cuts = np.array([int(np.searchsorted(np.array(bounds, dtype=object), found[k * per - 1], side="left")) + 1
                     for k in range(1, shards)], dtype=np.int64) if found else np.array([], dtype=np.int64)
    rows = {r["bin"]: r["count"] for r in _binned(keys, bounds).groupBy("bin").count().collect()}
    offsets, run, prev = [], 0, -1
    for b in range(len(bounds) + 1):
        s = int(np.searchsorted(cuts, b, side="right"))
        run = 0 if s != prev else run
        offsets.append((b, s, run))
        run, prev = run + rows.get(b, 0), s
    table = docs.sparkSession.createDataFrame(offsets or [(0, 0, 0)], "bin long, shard int, first long")
    inside = W.partitionBy("bin").orderBy("h", "i")
    return (_binned(keyed, bounds)
            .withColumn("place", F.row_number().over(inside) - 1)
            .join(F.broadcast(table), "bin")
            .select("doc", "size", "shard", (F.col("first") + F.col("place")).alias("slot")))
