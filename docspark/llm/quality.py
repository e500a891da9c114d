"""Quality classifier: a byte-level convolutional network in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENT = 128  # positions; a chunk is two neighbouring segments, so chunks overlap by half


@dataclass
class Network:
    """Filters as tables byte -> response per place (width, filters, 256), their biases,
    and the combining layers."""

    filters: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float


def laid_out(texts: list[bytes], width: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The texts one after the other, each filled with zeros to whole segments (an
    empty text to one): per place in a filter the byte that it meets at every position,
    zero beyond the text's own end; and the number of segments of each."""
    segments = np.array([max(1, -(-len(t) // SEGMENT)) for t in texts])
    ends = np.cumsum(segments) * SEGMENT
    out = np.zeros(int(ends[-1]) + width, dtype=np.uint8)
    for t, start in zip(texts, (ends - segments * SEGMENT).tolist()):
        out[start:start + len(t)] = np.frombuffer(t, dtype=np.uint8)
    met = []
    for j in range(width):
        shifted = out[j:int(ends[-1]) + j].copy()
        for k in range(1, j + 1):
            shifted[ends - k] = 0
        met.append(shifted)
    return met, segments


def maxima(net: Network, met: list[np.ndarray], places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Max-pooled filters per segment (segments, filters) and where the maxima are.
    Works through long data in parts that fit the cache."""
    n_filters = net.filters.shape[1]
    n = len(met[0]) // SEGMENT
    best = np.empty((n, n_filters), dtype=np.float32)
    at = np.empty((n, n_filters), dtype=np.int64) if places else None
    part = 512
    for a in range(0, n, part):
        b = min(n, a + part)
        pieces = [m[a * SEGMENT:b * SEGMENT] for m in met]
        for f in range(n_filters):
            total = net.filters[0, f][pieces[0]]
            for j in range(1, len(pieces)):
                total += net.filters[j, f][pieces[j]]
            r = total.reshape(-1, SEGMENT)
            if places:
                p = r.argmax(axis=1)
                at[a:b, f] = (np.arange(a, b) * SEGMENT) + p
                best[a:b, f] = r[np.arange(b - a), p]
            else:
                best[a:b, f] = r.max(axis=1)
    return best + net.bias, at


def pooled(best: np.ndarray, segments: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, tuple]:
    """Per text the largest, smallest and mean chunk maximum of every filter, and how
    full its first chunk is (few positions have smaller maxima)."""
    starts = np.concatenate(([0], np.cumsum(segments)[:-1]))
    owner = np.repeat(np.arange(len(segments)), segments)
    nxt = np.minimum(np.arange(len(best)) + 1, starts[owner] + segments[owner] - 1)  # the last pairs with itself
    chunk = np.maximum(best, best[nxt])
    real = np.ones(len(best), dtype=bool)  # the last segment is no chunk of its own unless alone
    real[(starts + segments - 1)[segments > 1]] = False
    low, high = np.where(real[:, None], chunk, np.inf), np.where(real[:, None], chunk, -np.inf)
    n = np.maximum(1, segments - 1)[:, None]
    fill = 3 * np.log2([[1 + min(len(t), 2 * SEGMENT)] for t in texts]) / 8
    features = np.concatenate((np.maximum.reduceat(high, starts), np.minimum.reduceat(low, starts),
                               np.add.reduceat(np.where(real[:, None], chunk, 0), starts) / n, fill), axis=1)
    return features, (starts, owner, nxt, chunk, real, low, high, n)


def probability(net: Network, features: np.ndarray) -> np.ndarray:
    hidden = np.tanh(features @ net.hidden + net.hidden_bias)
    return 1 / (1 + np.exp(-np.clip(hidden @ net.out + net.out_bias, -30, 30)))


def predict(net: Network, texts: list[bytes]) -> np.ndarray:
    """Probability of each whole text; about 1 MB of text at a time."""
    out, at = [], 0
    while at < len(texts):
        end, total = at, 0
        while end < len(texts) and (end == at or total < 1 << 20):
            total += len(texts[end])
            end += 1
        met, segments = laid_out(texts[at:end], len(net.filters))
        out.append(probability(net, pooled(maxima(net, met)[0], segments, texts[at:end])[0]))
        at = end
    return np.concatenate(out) if out else np.zeros(0)


def train(texts: list[bytes], labels: np.ndarray, n_filters: int = 16, width: int = 5, n_hidden: int = 16,
          steps: int = 600, batch: int = 48, rate: float = 0.01, clean: float = 0.7, seed: int = 3) -> Network:
    """Fit the network by ``steps`` of Adam on the log loss of ``batch`` texts each; label 1
    weighs ``clean`` of the total, label 0 the rest. The gradient of a maximum goes to the place that made it."""
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.5, (width, n_filters, 256)).astype(np.float32), np.zeros(n_filters, dtype=np.float32),
                  rng.normal(0, 0.2, (3 * n_filters + 1, n_hidden)), np.zeros(n_hidden), rng.normal(0, 0.3, n_hidden), 0.0)
    net.filters[:, :, 0] = 0.0  # filling stays silent
    weight = np.where(labels == 1, clean / max(1, (labels == 1).sum()), (1 - clean) / max(1, (labels == 0).sum())) * len(labels)
    names = ("filters", "bias", "hidden", "hidden_bias", "out", "out_bias")
    first = {k: np.zeros_like(np.asarray(getattr(net, k), dtype=np.float64)) for k in names}
    second = {k: np.zeros_like(v) for k, v in first.items()}
    order: list[int] = []
    for step in range(1, steps + 1):
        while len(order) < batch:
            order = rng.permutation(len(texts)).tolist() + order
        rows, order = np.array(order[-batch:]), order[:-batch]
        drawn = [texts[i] for i in rows]
        met, segments = laid_out(drawn, width)
        best, place = maxima(net, met, places=True)
        features, (starts, owner, nxt, chunk, real, low, high, n) = pooled(best, segments, drawn)
        hidden = np.tanh(features @ net.hidden + net.hidden_bias)
        p = 1 / (1 + np.exp(-np.clip(hidden @ net.out + net.out_bias, -30, 30)))
        d_out = (p - labels[rows]) * weight[rows] / len(rows)
        d_hidden = d_out[:, None] * net.out * (1 - hidden**2)
        d_features = d_hidden @ net.hidden.T
        d_max, d_min, d_mean = np.split(d_features[:, :-1], 3, axis=1)
        maxed, minned = features[owner, :n_filters], features[owner, n_filters:2 * n_filters]
        d_chunk = np.where(real[:, None], d_mean[owner] / n[owner], 0)
        d_chunk += np.where(high == maxed, d_max[owner], 0) + np.where(low == minned, d_min[owner], 0)
        own = best >= best[nxt]
        d_best = np.where(own, d_chunk, 0)
        np.add.at(d_best, nxt, np.where(own, 0, d_chunk))
        d_filters = np.zeros(net.filters.shape)
        filter_of = np.broadcast_to(np.arange(n_filters), place.shape)
        for j in range(width):
            np.add.at(d_filters[j], (filter_of, met[j][place]), d_best)
        d_filters[:, :, 0] = 0
        grads = {"filters": d_filters, "bias": d_best.sum(axis=0), "hidden": features.T @ d_hidden,
                 "hidden_bias": d_hidden.sum(axis=0), "out": hidden.T @ d_out, "out_bias": d_out.sum()}
        pace = rate * (1 - step / (steps + 1))
        for k in names:
            first[k] = 0.9 * first[k] + 0.1 * grads[k]
            second[k] = 0.999 * second[k] + 0.001 * grads[k] ** 2
            move = pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            value = getattr(net, k) - move
            setattr(net, k, value.astype(np.float32) if k in ("filters", "bias") else value)
    return net


def held_out(id_col: str, folds: int = 5) -> Column:
    """True for the rows that no learning sees: crc32 of the id as text divisible by
    ``folds``. A null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1500, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", **training) -> Network | float:
    """The network learned from at most ``per_class`` labelled documents of either class
    (those with the smallest hash of their id, held-out rows excluded), whole texts.
    That bound is the only limit; scoring sees every row. Labels other than 0 and 1 and
    null ids are ignored; an id labelled twice counts with its lowest label. If a class
    has no document, the result is the share of label 1 (0.5 without any)."""
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label")))
    by_hash = F.xxhash64(F.lit(11), "id")
    chosen = None
    for label in (0, 1):  # bounded: per_class rows each
        part = known.where(F.col("label") == label).orderBy(by_hash, "id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    sample = (docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text")).join(F.broadcast(chosen), "id")
              .groupBy("id", "label").agg(F.min("text").alias("text")).collect())
    sample.sort(key=lambda r: r["id"])
    y = np.array([r["label"] for r in sample], dtype=np.float64)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    return train([bytes(r["text"]) for r in sample], y, **training)


def probability_of(net: Network | float, text_col: str = "text") -> Column:
    """The probability that a row's whole text has label 1. Null and empty texts get the
    network's answer to an empty text."""
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        if isinstance(net, float):
            return pd.Series([net] * len(text))
        return pd.Series(predict(net, [t or b"" for t in text]))

    return score(F.col(f"`{text_col}`").cast("binary"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
             per_class: int = 1500, **training) -> DataFrame:
    """``id_col``, held_out, score and predicted (1 if score >= ``threshold``) of every
    row, from a network learned on the rows that are not held out."""
    net = fit(docs, labels, per_class, id_col, text_col, **training)
    out = docs.select(F.col(f"`{id_col}`").alias(id_col), probability_of(net, text_col).alias("score"))
    return out.select(id_col, held_out(id_col).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
