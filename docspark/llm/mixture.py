"""Mixing sources to target weights: equal-token blocks apportioned by Sainte-Lague."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import carried, stored, words

#: Weights given to the sources in code point order, null last, again and again.
WEIGHTS = (5, 2, 1)


def capped_targets(sizes: np.ndarray, weights: np.ndarray, total: float, cap: float) -> np.ndarray:
    """Shares of ``total`` by weight, none above ``cap`` times its size; what a capped
    source leaves goes to the others by weight until none is above."""
    limit = cap * sizes
    target = np.zeros(len(sizes))
    free = sizes > 0
    left = min(float(total), float(limit.sum()))
    while free.any():
        share = left * weights / weights[free].sum()
        over = free & (share >= limit)
        if not over.any():
            target[free] = share[free]
            break
        target[over] = limit[over]
        left = max(0.0, left - limit[over].sum())
        free &= ~over
    return target


def apportion(votes: np.ndarray, seats: int) -> np.ndarray:
    """Sainte-Lague: ``seats`` to the highest quotients votes / (seats so far + 1/2).

    A divisor found by bisection places all but the seats tied at the last quotient,
    which go out one by one, so the work does not depend on the number of seats.
    Equal quotients: the earlier entry first."""
    got = np.zeros(len(votes), dtype=np.int64)
    if seats <= 0 or votes.sum() <= 0:
        return got
    low, high = 0.0, 2.0 * votes.max() + 1.0  # quotients at or above `high`: none
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        if np.floor(votes / middle + 0.5).sum() > seats:
            low = middle
        else:
            high = middle
    got = np.floor(votes / high + 0.5).astype(np.int64)
    for _ in range(int(seats - got.sum())):
        got[int(np.argmax(votes / (got + 0.5)))] += 1
    return got


def shares(votes: np.ndarray, limit: np.ndarray, total: int, block: int) -> np.ndarray:
    """``total`` words by ``votes`` in whole blocks, none above its ``limit``; what limits
    cut off goes in words to those furthest below their part, then to the room of the
    others, in blocks and at last in words, so nothing is lost while there is room."""
    got = np.minimum(apportion(votes, total // block) * block, limit)
    left = int(min(total, limit.sum()) - got.sum())
    if votes.sum() > 0:  # first to those furthest below their part of the total
        short = np.minimum(np.maximum(np.floor(votes / votes.sum() * total) - got, 0), limit - got).astype(np.int64)
        order = np.argsort(-short, kind="stable")
        short[order] = np.clip(left - (np.cumsum(short[order]) - short[order]), 0, short[order])
        got += short
        left -= int(short.sum())
    while left >= block:
        room = limit - got
        more = np.minimum(apportion(room.astype(np.float64), left // block) * block, room)
        got += more
        left -= int(more.sum())
    room = limit - got
    order = np.argsort(-room, kind="stable")
    got[order] += np.clip(left - (np.cumsum(room[order]) - room[order]), 0, room[order])
    return got


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with column copy: 0, 1, ... among those equal in source_no, ord and id.
    The high bits of ``row`` are the partition that held the row; copies are numbered in
    each by itself and the partitions' counts give where each begins, so that no task
    sees a whole group."""
    key = ["source_no", "ord", "id"]
    rows = rows.withColumn("part", F.shiftright("row", 33))
    counts = rows.groupBy(*key, "part").agg(F.count("*").alias("n"))
    group = W.partitionBy(*key)
    running = group.orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow)
    repeated = counts.select(*[F.col(c).alias(f"its_{c}") for c in [*key, "part"]],
                             (F.sum("n").over(running) - F.col("n")).alias("first"),
                             F.sum("n").over(group).alias("copies")).where("copies > 1")
    same = [F.col(c).eqNullSafe(F.col(f"its_{c}")) for c in [*key, "part"]]
    place = F.row_number().over(W.partitionBy(*key, "part").orderBy("row")) - 1
    return (rows.join(repeated, same, "left")
            .withColumn("copy", F.when(F.col("first").isNull(), 0).otherwise(F.col("first") + place).cast("long"))
            .select(*[c for c in rows.columns if c != "part"], "copy"))


def mix(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
        weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0, block_words: int = 16,
        shard_words: int = 250_000, seed: int = 7, carry: bool = False, spans: bool = False) -> DataFrame:
    """Take words of the sources in proportion to weights, as whole blocks of words.

    Each (source, shard) is a tape: its documents in seeded order. The mix has
    ``share`` times all words, in blocks of ``block_words``; Sainte-Lague gives each
    source its blocks by its target, and again each of its shards by the words there.
    What the cap cuts off goes to others with room, in words where less than a block is
    left. A shard then takes its quota as consecutive words of the ring that its tape
    makes, from a seeded block on, so at most two documents are cut and none is taken
    more than ``cap`` times (rounded up) or beyond ``cap`` times its words.
    A source has a tape per ``shard_words`` of its own words, or rows where those are
    more, so no tape outgrows a task and the other sources do not matter. Only one row
    per source comes to the driver.

    Returns per row: ``id_col``, size, source_size, target, taken (words, repeats
    counted), with ``spans`` the taken ranges (pass, from, to) of the row's words,
    and with ``carry`` the input row as struct ``doc``. A null text has no words and
    takes none; null is a source of its own, the last. Repeated rows are rows like
    others: each has its own place on a tape of its own draw. Reruns agree: order comes
    from hashes of id, text and the number among equal rows."""
    spark = docs.sparkSession
    text = F.col(f"`{text_col}`")
    base = docs.select(
        F.col(f"`{source_col}`").cast("string").alias("source"), F.col(f"`{id_col}`").alias("id"),
        words(text).alias("size"), F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), text).alias("ord"),
        F.monotonically_increasing_id().alias("row"), *([carried(docs).alias("doc")] if carry else []))
    base = stored(base)
    rows = base.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-32-be")))
    sizes = np.array([r["size"] for r in rows], dtype=np.float64)
    weight = np.array([weights[i % len(weights)] for i in range(len(rows))], dtype=np.float64)
    target = capped_targets(sizes, weight, share * sizes.sum(), cap)
    quota = shares(target, np.floor(cap * sizes).astype(np.int64), int(round(target.sum())), block_words)
    shards = [-(-max(r["size"], r["n"]) // shard_words) for r in rows]
    catalogue = spark.createDataFrame(
        [(i, r["source"], int(r["size"]), float(target[i]), int(quota[i]), shards[i]) for i, r in enumerate(rows)],
        "source_no int, source string, source_size long, target double, quota long, shards int")

    dealt = base.drop("doc").join(F.broadcast(catalogue), base["source"].eqNullSafe(catalogue["source"])).drop("source")
    dealt = stored(numbered(dealt))
    dealt = dealt.withColumn("ord", F.when(F.col("copy") == 0, F.col("ord")).otherwise(F.xxhash64("ord", "copy")))
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "ord"), F.col("shards")).cast("int"))
    tapes = dealt.groupBy("source_no", "shard", "quota").agg(F.sum("size").alias("tape"))

    def quotas(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard")
        tape = pdf["tape"].to_numpy(dtype=np.float64)
        n = shares(tape, np.floor(cap * tape).astype(np.int64), int(pdf["quota"].iloc[0]), block_words)
        return pd.DataFrame({"source_no": pdf["source_no"], "shard": pdf["shard"], "tape": pdf["tape"], "take": n})

    tapes = tapes.groupBy("source_no").applyInPandas(quotas, "source_no int, shard int, tape long, take long")
    along = W.partitionBy("source_no", "shard").orderBy("ord", "id", "copy").rowsBetween(W.unboundedPreceding, W.currentRow)
    # The ring: a tape of `tape` words read from a seeded block on; a row's words lie
    # at [at, at + size) of it, modulo its length. The first pass takes
    # min(take, tape) words from there, the later ones what is left.
    first = F.pmod(F.xxhash64(F.lit(seed + 2), "source_no", "shard"),
                   F.greatest(F.lit(1), F.ceil(F.col("tape") / block_words))) * block_words
    placed = (dealt.withColumn("before", F.sum("size").over(along) - F.col("size"))
              .join(tapes, ["source_no", "shard"])
              .withColumn("at", F.pmod(F.col("before") - first, F.greatest(F.lit(1), F.col("tape")))))
    passes = int(np.ceil(cap))

    def part(k: int, lo, hi):
        """Words of the row within [lo, hi) of the ring that pass k takes."""
        end = F.least(F.col("tape"), F.col("take") - k * F.col("tape"))
        return F.greatest(F.lit(0), F.least(hi, end) - lo)

    at, size, tape = F.col("at"), F.col("size"), F.col("tape")
    head = F.least(size, tape - at)  # words up to the ring's end; the rest lies at its start
    ranges = []
    for k in range(passes):
        a, b = part(k, at, at + head), part(k, F.lit(0), size - head)
        for lo, hi in ((F.lit(0), a), (head, head + b)):
            ranges.append(F.struct(F.lit(k).alias("pass"), lo.cast("long").alias("from"), hi.cast("long").alias("to")))
    ranges = F.filter(F.array(*ranges), lambda s: s["to"] > s["from"])
    out = placed.withColumn("spans", ranges)
    if carry:
        out = out.join(base.select("row", "doc"), "row")
    return out.select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"]).alias("taken"),
        *(["spans"] if spans else []), *(["doc"] if carry else []))


def mixed_rows(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` with the text that each pass takes, so a row
    occurs once per pass that takes words of it. A text taken whole stays as it is; one
    that a block boundary cuts keeps the words of its ranges with the white space before
    each. Rows of which nothing is taken go. All columns keep their names."""
    names = docs.columns
    mixed = mix(docs, text_col=text_col, carry=True, spans=True, **options)
    rows = mixed.withColumn("pass", F.explode(F.array_distinct(F.transform("spans", lambda s: s["pass"]))))
    mine = F.filter("spans", lambda s: s["pass"] == F.col("pass"))
    n = F.aggregate(mine, F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    pieces = F.regexp_extract_all(F.col(f"doc.`{text_col}`"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.array_join(F.flatten(F.transform(mine, lambda s: F.slice(
        pieces, (s["from"] + 1).cast("int"), (s["to"] - s["from"]).cast("int")))), "")
    text = F.when(n == F.col("size"), F.col(f"doc.`{text_col}`")).otherwise(cut)
    return rows.select(*[text.alias(c) if c == text_col else F.col(f"doc.`{c}`").alias(c) for c in names])
