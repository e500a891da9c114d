"""Exact top-k inner products: a KD-tree per shard, searched best first."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

HIT = "query_row long, query_id long, vec_id long, score long"


def exact(vectors: np.ndarray) -> np.ndarray:
    """Whole-number vectors in the fastest type whose inner products are exact."""
    most = int(np.abs(vectors).max(initial=0))
    if most * most * max(1, vectors.shape[1]) < 1 << 53:
        return vectors.astype(np.float64)
    return vectors if most * most * max(1, vectors.shape[1]) < 1 << 62 else vectors.astype(object)


def build(vectors: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A KD-tree: the rows' new order, and per node its range of rows, its children (0
    for a leaf) and its tight bounding box. Nodes split their widest dimension at the
    median row, so depth stays logarithmic however many rows are equal."""
    order = np.arange(len(vectors))
    spans, children, boxes, todo = [(0, len(vectors))], [(0, 0)], [None], [0]
    while todo:
        node = todo.pop()
        a, b = spans[node]
        rows = vectors[order[a:b]]
        low, high = rows.min(axis=0), rows.max(axis=0)
        boxes[node] = (low, high)
        if b - a <= leaf or (low == high).all():
            continue
        widest, middle = int(np.argmax(high - low)), (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(rows[:, widest], middle, kind="introselect")]
        for span in ((a, a + middle), (a + middle, b)):
            spans.append(span)
            children.append((0, 0))
            boxes.append(None)
        children[node] = (len(spans) - 2, len(spans) - 1)
        todo += children[node]
    return order, np.array(spans), np.array(children), np.array(boxes)


def search(query: np.ndarray, own: int, ids: np.ndarray, vectors: np.ndarray, spans: np.ndarray, children: np.ndarray,
           boxes: np.ndarray, k: int, kth: int | None) -> list[tuple[int, int]]:
    """The best k of one tree as (score, -id), among scores of at least ``kth``, but for
    the row at place ``own`` (-1: none).

    A box bounds the inner product from above by its better end in every dimension.
    The box with the highest bound is opened next; the search ends at the first one
    below the k-th score known so far. Boxes that equal it are opened: a tie may have
    a smaller id."""
    bounds = np.maximum(boxes[:, 0] * query, boxes[:, 1] * query).sum(axis=1)
    heap, best = [(-bounds[0], 0)], []
    while heap:
        bound, node = heapq.heappop(heap)
        floor = best[0][0] if len(best) == k else kth
        if floor is not None and -bound < floor:
            break
        left, right = children[node]
        if left:
            heapq.heappush(heap, (-bounds[left], left))
            heapq.heappush(heap, (-bounds[right], right))
            continue
        a, b = spans[node]
        scores = vectors[a:b] @ query
        good = np.flatnonzero(scores >= floor) if floor is not None else np.arange(b - a)
        for i in good:
            if a + i != own:
                hit = (int(scores[i]), -int(ids[a + i]))
                if len(best) < k:
                    heapq.heappush(best, hit)
                elif hit > best[0]:
                    heapq.heapreplace(best, hit)
    return best


def top_k(embeddings: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, id_col: str = "vec_id",
          vector_col: str = "embedding", shard_rows: int = 8192, leaf: int = 256, block_shards: int = 16) -> DataFrame:
    """For each row whose id is divisible by ``every``, the ``k`` other rows with the
    highest inner product of floor(scale * x), ties to the smaller id.

    Rows are hashed to shards of about ``shard_rows``; each shard builds its tree once
    and answers its own queries, whose k-th scores then travel with the queries, in
    blocks of ``block_shards`` shards, to every other shard. Nothing is broadcast, and
    a task holds one shard's tree and one block of queries. Every shard is searched,
    so the result is exact.

    Returns query_id, rank (from 1), vec_id, score. Vectors that are null or empty or
    hold null or non-finite components, and rows without an id, take no part. Vectors
    are compared within their dimension. Rows are what counts, not ids: each row of a
    repeated query id is a query with hits of its own, the others among its candidates,
    and repeated rows each take a place. An empty table gives no rows; further columns
    are not read."""
    vec = F.col(f"`{vector_col}`").cast("array<double>")
    whole = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (embeddings.where(F.col(f"`{id_col}`").isNotNull() & (F.size(vec) > 0) & whole)
            .select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                    F.transform(vec, lambda x: F.floor(x * scale).cast("long")).alias("v"))
            .withColumn("dim", F.size("v")).withColumn("row", F.monotonically_increasing_id()))
    rows = stored(rows)
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = -(-shards // block_shards)
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, number, raw = pdf["vec_id"].to_numpy(), pdf["row"].to_numpy(), np.stack(pdf["v"].to_numpy())
        order, spans, children, boxes = build(raw, leaf)
        ids, number, raw = ids[order], number[order], raw[order]
        asked = np.flatnonzero(ids % every == 0)
        fit, box = exact(raw), exact(boxes.reshape(len(boxes), -1)).reshape(boxes.shape)
        hits, floors = [], []
        for i in asked:
            best = search(fit[i], i, ids, fit, spans, children, box, k, None)
            hits += [{"query_row": int(number[i]), "query_id": int(ids[i]), "vec_id": -v, "score": s} for s, v in best]
            floors.append(min(best)[0] if len(best) == k else None)
        return pd.DataFrame([{
            "dim": raw.shape[1], "shard": int(pdf["shard"].iloc[0]), "ids": ids.tobytes(), "raw": raw.tobytes(),
            "spans": spans.astype(np.int64).tobytes(), "children": children.astype(np.int64).tobytes(),
            "boxes": boxes.astype(np.int64).tobytes(), "asked": ids[asked].tolist(), "asked_rows": number[asked].tolist(),
            "asked_raw": raw[asked].tobytes(), "floors": floors, "hits": hits}])

    trees = stored(rows.groupBy("dim", "shard").applyInPandas(
        grow, "dim int, shard int, ids binary, raw binary, spans binary, children binary, boxes binary, "
              f"asked array<long>, asked_rows array<long>, asked_raw binary, floors array<long>, hits array<struct<{HIT.replace(' ', ':')}>>"
        .replace(",:", ",")))
    home = trees.select(F.inline("hits"))
    block = F.floor(F.col("shard") / block_shards).cast("int")
    asked = (trees.where(F.size("asked") > 0)
             .select("dim", F.col("shard").alias("home"), block.alias("block"), "asked", "asked_rows", "asked_raw", "floors")
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
             .where("home <> shard"))
    grown = (trees.select("dim", "shard", "ids", "raw", "spans", "children", "boxes")
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))

    def visit(tree: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        for t in tree.itertuples(index=False):
            ids = np.frombuffer(t.ids, dtype=np.int64)
            raw = np.frombuffer(t.raw, dtype=np.int64).reshape(len(ids), t.dim)
            spans, children = (np.frombuffer(x, dtype=np.int64).reshape(-1, 2) for x in (t.spans, t.children))
            boxes = np.frombuffer(t.boxes, dtype=np.int64).reshape(-1, 2, t.dim)
            for q in queries.itertuples(index=False):
                asked_raw = np.frombuffer(q.asked_raw, dtype=np.int64).reshape(-1, t.dim)
                both = exact(np.concatenate([boxes.reshape(-1, t.dim), asked_raw]))
                fit = raw.astype(both.dtype)
                box, ask = both[:-len(asked_raw)].reshape(boxes.shape), both[-len(asked_raw):]
                for asked_id, asked_row, vector, floor in zip(q.asked, q.asked_rows, ask, q.floors):
                    floor = None if floor is None or floor != floor else int(floor)
                    out += [(int(asked_row), int(asked_id), -v, s) for s, v in
                            search(vector, -1, ids, fit, spans, children, box, k, floor)]
        return pd.DataFrame(out, columns=["query_row", "query_id", "vec_id", "score"])

    away = (grown.groupBy("dim", "shard", "block").cogroup(asked.groupBy("dim", "shard", "block"))
            .applyInPandas(visit, HIT))
    best = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (home.unionByName(away).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
