"""The prefix trie of conversations by truncation peeling."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

ROOT = bytes(16)  # the key of the empty sequence
NOBODY = hashlib.sha256(b"").hexdigest()
NODE = ("key binary, parent binary, conv_id long, depth int, n_bytes long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long")


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[bool, pa.RecordBatch, np.ndarray]]:
    """Batches of rows sorted by their first ``keys`` columns with, per row, whether it
    begins a new group; the flag tells whether the batch goes on with the last group."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = list(zip(*(batch.column(j).to_pylist() for j in range(keys)), strict=True))
        new = np.array([a != b for a, b in zip(rows, [last, *rows[:-1]], strict=True)])
        last = rows[-1]
        yield not new[0], batch, new


def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, turn digest, bytes) in order -> with the turn's place in its conversation."""
    at = 0
    for goes_on, batch, new in runs(batches, 1):
        begin = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
        place = np.where(begin < 0, at + np.arange(len(new)), np.arange(len(new)) - begin)
        at = int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=["conv_id", "turn_key", "n_bytes", "place"])


def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, turn digest or null for the root, bytes) in order -> one row per prefix:
    its key, its parent's, the keys at depths 1, 2, 4, ..., and whether it is the whole."""
    conv, key, depth, marks, held = None, ROOT, 0, [], None
    names = ["conv_id", "depth", "key", "parent", "n_bytes", "marks", "whole"]
    for batch in batches:
        out = []
        for c, turn, n in zip(*(batch.column(j).to_pylist() for j in range(3)), strict=True):
            if held is not None:
                out.append((*held, c != conv))
            if turn is None:
                conv, key, depth, marks, parent = c, ROOT, 0, [], None
            else:
                parent, depth = key, depth + 1
                key = hashlib.blake2b(key + turn, digest_size=16).digest()
                if depth & (depth - 1) == 0:
                    marks = [*marks, key]
            held = (c, depth, key, parent, n, marks)
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=CHAIN)
    if held is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(names, (*held, True), strict=True))], schema=CHAIN)


CHAIN = pa.schema([("conv_id", pa.int64()), ("depth", pa.int32()), ("key", pa.binary()), ("parent", pa.binary()),
                   ("n_bytes", pa.int64()), ("marks", pa.list_(pa.binary())), ("whole", pa.bool_())])


def peel_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subtrees of bounded size, one group of prefixes after the other, peeled from their
    deepest level up to their top. Every node leaves with its parent's smallest member
    (the tops' are found later)."""
    def peel(rows: list[tuple]) -> list[dict]:
        levels: dict[int, list[tuple]] = {}
        for r in rows:
            levels.setdefault(r[1], []).append(r)
        out, below = [], {}
        for depth in sorted(levels, reverse=True):
            nodes: dict[bytes, dict] = {}
            for _, _, key, parent, n_bytes, conv, ended in levels[depth]:
                node = nodes.get(key)
                if node is None:
                    node = nodes[key] = {"key": key, "parent": parent, "conv_id": None, "depth": depth, "n_bytes": n_bytes,
                                         "n_convs": 0, "n_children": 0, "n_leaves": 0, "saved_tokens": 0}
                if ended:  # newly ended conversations
                    node["conv_id"] = conv if node["conv_id"] is None else min(conv, node["conv_id"])
                    node["n_convs"] += ended
            for child in below.values():  # surviving nodes, their last turn stripped
                node = nodes[child["parent"]]
                node["conv_id"] = child["conv_id"] if node["conv_id"] is None else min(child["conv_id"], node["conv_id"])
                for c in ("n_convs", "n_leaves", "saved_tokens"):
                    node[c] += child[c]
                node["n_children"] += 1
            for node in nodes.values():
                node["saved_tokens"] += (node["n_convs"] - 1) * node["n_bytes"]
                node["n_leaves"] = node["n_leaves"] or 1
            out += [child | {"parent_conv_id": nodes[child["parent"]]["conv_id"]} for child in below.values()]
            below = nodes
        return out + [node | {"parent_conv_id": None} for node in below.values()]

    held: list[tuple] = []
    for _, batch, new in runs(batches, 1):
        out = []
        for r, first in zip(zip(*(c.to_pylist() for c in batch.columns), strict=True), new, strict=True):
            if first and held:
                out += peel(held)
                held = []
            held.append(r)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=PEELED)
    if held:
        yield pa.RecordBatch.from_pylist(peel(held), schema=PEELED)


PEELED = pa.schema([("key", pa.binary()), ("parent", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int32()),
                    *[(c, pa.int64()) for c in ("n_bytes", "n_convs", "n_children", "n_leaves", "saved_tokens")],
                    ("parent_conv_id", pa.int64())])


def join_ids(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted (key, conv_id) -> (key, first conv_id, comma-joined ids of at most ``most``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, batch, new in runs(batches, 1):
            keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            cuts = [0]
            for i in range(1, len(ids)):
                if new[i] or i - cuts[-1] >= most:
                    cuts.append(i)
            spans = list(zip(cuts, [*cuts[1:], len(ids)], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[a] for a, _ in spans], pa.binary()), pa.array([ids[a] for a, _ in spans], pa.int64()),
                 pa.array([",".join(map(str, ids[a:b])) for a, b in spans])], names=["key", "first", "ids"])

    return run


def hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, first, joined ids) -> (key, SHA-256 of all its ids, comma-joined): the
    ids run through the hash, no list is held."""
    key, state = None, None
    for _, batch, new in runs(batches, 1):
        done = []
        for k, _, ids, first in zip(*(c.to_pylist() for c in batch.columns), new, strict=True):
            if first:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])],
                                             names=["key", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])],
                                         names=["key", "ends_sha256"])


def by_group(df: DataFrame, key: str, *order: str) -> DataFrame:
    """All rows of a key in one partition, in order."""
    return df.repartition(key).sortWithinPartitions(key, *order)


def rebuilt(rows: DataFrame, shared: int = 9, step: int = 5) -> DataFrame:
    """One row per prefix of every rebuilt conversation (``CHAIN``'s columns).

    The turns of a conversation are ordered by turn (null first), then role, then text.
    Conversation c becomes the first h turns of conversation c - c % step and its own
    after its first h, h = crc32(c in decimals) % shared."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.where("conv_id IS NOT NULL").select(
        "conv_id", F.col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    turns = by_group(turns, "conv_id", "turn", "role", "text").select(  # nulls sort first
        F.col("conv_id").cast("long").alias("conv_id"),
        F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)).alias("turn_key"),
        F.octet_length("text").cast("long").alias("n_bytes"))
    turns = stored(turns.mapInArrow(number, "conv_id long, turn_key binary, n_bytes long, place long"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared
    convs = turns.where("place = 0").select("conv_id", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % step).alias("base"))
    root = convs.select("conv_id", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("place"),
                        F.lit(None).cast("binary").alias("turn_key"), F.lit(0).cast("long").alias("n_bytes"))
    begun = (turns.where(F.col("place") < shared - 1).withColumnRenamed("conv_id", "base").join(convs, "base")
             .where("place < h").select("conv_id", F.lit(0).alias("part"), "place", "turn_key", "n_bytes"))
    own = turns.where(F.col("place") >= head).select("conv_id", F.lit(1).alias("part"), "place", "turn_key", "n_bytes")
    lined = by_group(root.unionByName(begun).unionByName(own), "conv_id", "part", "place")
    return lined.select("conv_id", "turn_key", "n_bytes").mapInArrow(
        chain, "conv_id long, depth int, key binary, parent binary, n_bytes long, marks array<binary>, whole boolean")


def regroup(rows: DataFrame) -> DataFrame:
    """Rows of one depth -- ended conversations and stripped nodes -- to that depth's nodes."""
    total = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    nodes = rows.groupBy("key").agg(F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"),
                                    F.max("depth").alias("depth"), F.max("n_bytes").alias("n_bytes"), *total)
    return nodes.withColumns({
        "n_leaves": F.greatest("n_leaves", F.lit(1).cast("long")),
        "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("n_bytes")})


def trie(prefixes: DataFrame, task_rows: int = 20_000) -> DataFrame:
    """The trie over all prefixes of some conversations (``rebuilt``'s rows): one row per
    distinct sequence of first turns, the root included.

    Method, truncation peeling from the maximum depth: at every depth the newly ended
    conversations are merged with the nodes that survive from below, each stripped of its
    last turn, and regrouped by what is left; the aggregates of a subtree are made with
    its top. Equal conversations are one row with a count from the start. A subtree of at
    most ``task_rows`` prefixes (counted before) is peeled within one task; what lies
    above such subtrees is peeled level by level by Spark aggregates, which combine a hot
    prefix's rows before their shuffle. So the number of jobs follows the depth down to
    which more than ``task_rows`` different prefixes hang together, not the longest
    conversation. The ids that end at a node are sorted and hashed in a stream, never
    collected.

    Returns per node: conv_id (smallest member), depth, parent_conv_id (null at the
    root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Turns are equal by
    SHA-256 of role and text, sequences by 128-bit chained hashes. Null roles and texts
    are empty ones; rows without a conv_id belong to no conversation; turns that tie are
    ordered by role, then text, so repeated rows are two turns; very long texts only
    travel to be hashed; other columns are not read. Without conversations there is no
    root and no row."""
    prefixes = stored(prefixes)
    whole = prefixes.where("whole")
    ended = stored(whole.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("ended")))
    rows = prefixes.join(ended.select("conv_id", "ended"), "conv_id").withColumn(
        "ended", F.when(F.col("whole"), F.col("ended")).otherwise(0))
    rows = stored(rows.select("depth", "key", "parent", "n_bytes", "conv_id", "ended", "marks"))
    peeled, upper, open_, mark = [], [rows.where("depth = 0")], rows.where("depth > 0"), 0
    while not open_.isEmpty():
        top = 2**mark
        upper.append(open_.where(F.col("depth") < top))
        below = open_.where(F.col("depth") >= top).withColumn("top", F.get("marks", F.lit(mark)))
        crowded = stored(below.groupBy("top").agg(F.count("*").alias("n")).where(F.col("n") > task_rows).select("top"))
        small = below.join(crowded, "top", "left_anti").select("top", "depth", "key", "parent", "n_bytes", "conv_id", "ended")
        peeled.append(stored(by_group(small, "top").mapInArrow(
            peel_groups, NODE + ", parent_conv_id long").withColumn("is_top", F.col("depth") == top)))
        open_ = stored(below.join(crowded, "top", "left_semi").drop("top"))
        mark += 1
    peeled = reduce(DataFrame.unionByName, peeled) if peeled else None
    upper = stored(reduce(DataFrame.unionByName, upper))
    started = upper.where("ended > 0").unionByName(upper.where("ended = 0").withColumn("conv_id", F.lit(None).cast("long")))
    started = started.select("key", "parent", "conv_id", "depth", "n_bytes", F.col("ended").cast("long").alias("n_convs"),
                             *[F.lit(0).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])
    deepest = upper.agg(F.max("depth")).first()[0]
    found, below = [], None
    for depth in range(-1 if deepest is None else deepest, -1, -1):
        survivors = []
        if below is not None:
            survivors.append(below)
        if peeled is not None and depth & (depth + 1) == 0:  # tops stand at depths 1, 2, 4, ...
            survivors.append(peeled.where(F.col("is_top") & (F.col("depth") == depth + 1)).drop("is_top", "parent_conv_id"))
        survivors = reduce(DataFrame.unionByName, survivors) if survivors else None
        here = started.where(F.col("depth") == depth)
        if survivors is not None:
            here = here.unionByName(survivors.select(
                F.col("parent").alias("key"), F.lit(None).cast("binary").alias("parent"), "conv_id", F.lit(depth).alias("depth"),
                F.lit(None).cast("long").alias("n_bytes"), "n_convs", F.lit(1).cast("long").alias("n_children"),
                "n_leaves", "saved_tokens"))
        nodes = stored(regroup(here))
        if survivors is not None:
            found.append(survivors.join(nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent"))
        below = nodes
    if below is not None:
        found.append(below.withColumn("parent_conv_id", F.lit(None).cast("long")))
    else:
        found.append(started.withColumn("parent_conv_id", F.lit(None).cast("long")))
    if peeled is not None:
        found.append(peeled.where("NOT is_top").drop("is_top"))
    sorted_ends = whole.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = sorted_ends.mapInArrow(join_ids(4096), "key binary, first long, ids string")
    ends = by_group(parts, "key", "first").mapInArrow(hash_ids, "key binary, ends_sha256 string")
    nodes = reduce(DataFrame.unionByName, found).join(ends, "key", "left")
    return nodes.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
                        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOBODY)).alias("ends_sha256"))
