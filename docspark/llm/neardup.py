"""MinHash near-duplicates: universal hash minima, banding, verification, components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, stored
from .unigram import powers

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True


def spread_bits(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: np.ndarray, part: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Places and 64-bit hashes of the words of a byte string. Works through it in
    parts that end at white space, so memory does not follow a very long text."""
    starts, hashes, at = [], [], 0
    while at < len(text):
        end = min(len(text), at + part)
        while end < len(text) and not SPACE[text[end]]:
            end += 1
        piece = text[at:end]
        gap = SPACE[piece]
        first = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
        last = np.flatnonzero(~gap & np.concatenate((gap[1:], [True]))) + 1
        up, down = power_table(len(piece))
        total = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum((LOWER[piece].astype(np.uint64) + np.uint64(1)) * up[:len(piece)], out=total[1:])
        hashes.append(spread_bits((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64)))
        starts.append(first + at)
        at = end
    if not starts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def power_table(n: int, _kept: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """Powers of the rolling hash's base up to at least n, kept for the next call."""
    if _kept.get("n", -1) < n:
        _kept["n"], _kept["tables"] = n, powers(n)
    return _kept["tables"]


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, one text after the other, and
    where each text's begin. Shorter texts have their whole sequence as one shingle."""
    joined = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    starts, words = word_hashes(joined)
    doc = np.searchsorted(ends, starts, side="right")
    n_words = np.bincount(doc, minlength=len(texts))
    factors = spread_bits(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    sums = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
    for j in range(size):
        sums += words[j:len(words) - size + 1 + j] * factors[j] if len(sums) else np.uint64(0)
    whole = doc[:len(sums)] == doc[size - 1:] if len(sums) else np.zeros(0, dtype=bool)
    values, owner = [spread_bits(sums[whole])], [doc[:len(sums)][whole]]
    first = np.concatenate(([0], np.cumsum(n_words)[:-1]))
    for n in range(1, size):  # texts of fewer words
        short = np.flatnonzero(n_words == n)
        total = np.full(len(short), n, dtype=np.uint64)
        for j in range(n):
            total += words[first[short] + j] * factors[j]
        values.append(spread_bits(total))
        owner.append(short)
    values, owner = np.concatenate(values), np.concatenate(owner)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[keep], owner[keep]
    return values, np.searchsorted(owner, np.arange(len(texts) + 1))


def hash_family(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of n multiply-add-shift universal hashes."""
    rng = np.random.default_rng(seed)
    a, b = np.frombuffer(rng.bytes(16 * n), dtype=np.uint64).reshape(2, n)
    return a | np.uint64(1), b


def signatures(values: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima of every hash over every (not empty) set; their low 16 bits are kept."""
    out = np.empty((len(starts) - 1, len(a)), dtype=np.uint16)
    at = 0
    while at < len(out):  # some 32,768 values at a time stay in the cache
        end = int(np.searchsorted(starts, starts[at] + 32_768, side="right")) - 1
        end = min(len(out), max(end, at + 1))
        part, cuts = values[starts[at]:starts[end]], starts[at:end] - starts[at]
        for j in range(len(a)):
            out[at:end, j] = np.minimum.reduceat((part * a[j] + b[j]) >> np.uint64(32), cuts).astype(np.uint16)
        at = end
    return out


def in_parts(texts: list[bytes], most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together."""
    at = 0
    while at < len(texts):
        end, total = at, 0
        while end < len(texts) and (end == at or total + len(texts[end]) <= most):
            total += len(texts[end])
            end += 1
        yield at, end
        at = end


def describe(docs: DataFrame, size: int, hashes: int, seed: int, sets: bool = False) -> DataFrame:
    """id, n_shingles, cls (identity of the shingle set; null when empty) and the
    signature, or with ``sets`` the set itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = hash_family(hashes, seed)
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column("text")]
            n, cls, more = [], [], []
            for x, y in in_parts(texts):
                values, starts = shingle_sets(texts[x:y], size)
                counts = np.diff(starts)
                full = np.flatnonzero(counts)
                marks = None if sets else signatures(values, np.concatenate((starts[:-1][full], starts[-1:])), a, b)
                rank = np.cumsum(counts > 0) - 1
                for i in range(y - x):
                    own = values[starts[i]:starts[i + 1]].tobytes()
                    n.append(int(counts[i]))
                    cls.append(hashlib.blake2b(own, digest_size=16).digest() if own else None)
                    more.append((own if sets else marks[rank[i]].tobytes()) if own else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_key"), pa.array(n, pa.int64()), pa.array(cls, pa.binary()),
                 pa.array(more, pa.binary())], names=["id", "text_key", "n_shingles", "cls", "shingles" if sets else "sig"])

    return docs.mapInArrow(run, "id long, text_key long, n_shingles long, cls binary, " + ("shingles" if sets else "sig") + " binary")


def unshared(texts: DataFrame, size: int) -> DataFrame:
    """Per id, how many of its shingles no other id has (ids without any are missing)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column("id").to_numpy(), [t.as_py() for t in batch.column("text")]
            for x, y in in_parts(rows):
                values, starts = shingle_sets(rows[x:y], size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids[x:y], np.diff(starts))), pa.array(values.view(np.int64))], names=["id", "shingle"])

    rows = texts.select("id", "text").mapInArrow(run, "id long, shingle long")
    alone = rows.groupBy("shingle").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1")
    return alone.groupBy("id").agg(F.count("*").alias("own"))


def components(links: DataFrame) -> DataFrame:
    """Connected components of undirected links (a, b): node, component (its smallest
    node), for every node that has a link, by alternating large-star and small-star.

    Each round moves every link to the smallest neighbour known, so it takes a number
    of rounds logarithmic in the nodes; minima are combined before the shuffle and
    joined back, so a node with most links is split. Rounds are written tables; only a
    count and a checksum come to the driver."""
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = stored(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def bands(sig: Column, n: int, rows: int) -> Column:
    """The bucket of every band: a hash of its number and its minima."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.xxhash64(i, F.substring(sig, i * (2 * rows) + 1, F.lit(2 * rows))))


def likely(pairs: DataFrame, nodes: DataFrame, share: tuple[int, int], slack: float) -> DataFrame:
    """The pairs whose set sizes allow the similarity and whose signatures agree in at
    least the threshold less ``slack`` of all places."""
    least = share[0] / share[1] - slack

    @F.pandas_udf("boolean")
    def close(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([bool((np.frombuffer(p, np.uint16) == np.frombuffer(q, np.uint16)).mean() >= least)
                          for p, q in zip(x, y)])

    left = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sig").alias("sig_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sig").alias("sig_b"))
    sized = pairs.join(left, "a").join(right, "b")
    sized = sized.where(F.least("n_a", "n_b") * share[1] >= F.greatest("n_a", "n_b") * share[0])
    return sized.where(close("sig_a", "sig_b")).select("a", "b")


def confirmed(pairs: DataFrame, texts: DataFrame, share: tuple[int, int], size: int) -> DataFrame:
    """The pairs whose full shingle sets have the similarity. Only sets of nodes in a
    pair are made again, from ``texts`` (id = node); a set travels once per side."""
    @F.pandas_udf("boolean")
    def similar(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y):
            p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            both = len(np.intersect1d(p, q, assume_unique=True))
            out.append(share[1] * both >= share[0] * (len(p) + len(q) - both))
        return pd.Series(out)

    used = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = describe(texts.join(used, "id", "left_semi").select("id", F.lit(0).cast("long").alias("text_key"), "text"),
                    size, 0, 0, sets=True)
    sets = stored(sets.select("id", "shingles"))
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    return stored(pairs.join(left, "a").join(right, "b").where(similar("set_a", "set_b")).select("a", "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, share: tuple[int, int] = (80, 100),
                    n_bands: int = 40, rows: int = 5, slack: float = 0.18, few: int = 8, block: int = 256,
                    seed: int = 1, keys: bool = False) -> DataFrame:
    """Near-duplicate classes: documents linked when share[1] * |intersection| >=
    share[0] * |union| of their sets of ``size``-word shingles, and what links reach.

    Words are lower-cased (A to Z) runs of non-white space; a text of fewer words has
    its whole sequence as its one shingle; a text without words has an empty set and
    no link. Equal sets are one node from the start, so exact copies cost one row.
    ``n_bands`` bands of ``rows`` universal hash minima put nodes in buckets: a pair at
    the threshold 0.8 shares none with probability 1.2e-7. In a bucket every node is
    compared with the smallest node (a star, never all pairs). Signatures discard
    hopeless pairs (``slack`` is six standard deviations), full sets confirm the
    others, components follow by large-star and small-star. What a star leaves is only
    buckets whose nodes are still in several components. Where that is at most ``few``
    pairs per node, the nodes are compared across components pair by pair. In the other
    buckets a node that holds more shingles found in no other such node than the
    threshold allows has no link and goes (texts that merely share a passage); the rest
    meets in blocks of ``block`` nodes, a task compares two blocks and returns only
    links. So no pair within a component is compared after the star, and no step makes
    all pairs of a group.

    Returns one row per input row: ``id_col``, n_shingles, component_id (smallest id of
    the component, its own for an unlinked row), kept (its id is the component's).
    Null texts count as empty; null ids follow the others, and a component without
    any id has a null component and keeps its rows; repeated rows repeat. An empty
    table gives no rows; further columns are not read. ``keys`` adds what tells rows of
    one id apart: text_key (xxhash64 of the text), chosen (the row has the component's
    smallest id, nulls last, and of these texts the least key; always without words)
    and n_rows (rows with an equal set; null without words)."""
    text = F.col(f"`{text_col}`")
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("text_key"),
                       text.cast("binary").alias("text"))
    table = stored(describe(base, size, n_bands * rows, seed))
    nodes = stored(table.where("cls is not null").groupBy("cls").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")).alias("head"), F.count("*").alias("n_rows"),
        F.min("text_key").alias("text_key"), F.first("n_shingles").alias("n_shingles"),
        F.first("sig").alias("sig")).withColumn("node", F.monotonically_increasing_id()))
    near = nodes.select("node", "n_shingles", "sig")

    def crowded(buckets: DataFrame) -> DataFrame:
        """Buckets of two or more nodes, with their pivot."""
        n = buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).where("n > 1").drop("n")
        return stored(buckets.join(n, "bucket"))

    members = crowded(near.select("node", F.posexplode(bands(F.col("sig"), n_bands, rows)).alias("band", "bucket")))
    met = members.select("node").distinct().join(nodes.select("node", "text_key", "cls"), "node")
    # one full pass over the texts, any one of those that share a key of 64 bits
    found = base.join(met.select("text_key").distinct(), "text_key", "left_semi").dropDuplicates(["text_key"])
    texts = stored(found.join(met.select("node", "text_key"), "text_key").select(F.col("node").alias("id"), "text"))
    star = members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    links = confirmed(stored(likely(star, near, share, slack)), texts, share, size)
    component = stored(components(links))
    members = members.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = members.groupBy("bucket", "component").agg(F.count("*").alias("k"))
    parts = parts.groupBy("bucket").agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.col("k")).alias("inside"), F.count("*").alias("c"))
    sparse = F.col("n") * F.col("n") - F.col("inside") <= 2 * few * F.col("n")
    members = stored(members.join(parts.where("c > 1").select("bucket", sparse.alias("sparse")), "bucket"))
    x = members.where("sparse and node <> pivot")
    y = x.select("bucket", F.col("node").alias("b"), F.col("component").alias("c_b"))
    across = x.select("bucket", F.col("node").alias("a"), F.col("component").alias("c_a")).join(y, "bucket").where("c_a < c_b")
    across = across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = links.unionByName(confirmed(stored(likely(across, near, share, slack)), texts, share, size))
    dense = members.where("not sparse").select("bucket", "band", "node", "component")
    if not dense.isEmpty():
        links = links.unionByName(stored(block_links(dense, near, texts, share, slack, size, rows, block)))
    component = stored(components(links))
    group = nodes.select("cls", "head", "n_rows", "node").join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = group.groupBy("component").agg(F.min("head").alias("head"))
    group = group.select("cls", "component", "n_rows").join(first, "component").select("cls", "n_rows", "head")
    out = table.select("id", "n_shingles", "cls", "text_key").join(group, "cls", "left")
    component_id = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("head.id"))
    chosen = F.col("cls").isNull() | (F.col("id").eqNullSafe(F.col("head.id")) & F.col("text_key").eqNullSafe(F.col("head.text_key")))
    told_apart = ["text_key", chosen.alias("chosen"), "n_rows"] if keys else []
    return out.select(F.col("id").alias(id_col), "n_shingles", component_id.alias("component_id"),
                      F.col("id").eqNullSafe(component_id).alias("kept"), *told_apart)


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one document per class, that
    of its smallest id (null ids last; of one id the text with the least key). Of rows
    that repeat its id and text the one stays whose columns come first as JSON. Rows
    without words or text are in no class and stay."""
    found = near_duplicates(docs, id_col, text_col, keys=True, **options)

    def meet(df: DataFrame, rows: DataFrame, how: str) -> DataFrame:
        rows = rows.select(F.col(id_col).alias("its_id"), F.col("text_key").alias("its_key"))
        same = df[id_col].eqNullSafe(rows["its_id"]) & F.xxhash64(df[text_col]).eqNullSafe(rows["its_key"])
        return df.join(rows, same, how)

    again = found.where("chosen and n_rows > 1").groupBy(id_col, "text_key").agg(F.count("*").alias("n")).where("n > 1")
    again = stored(again.select(id_col, "text_key"))
    kept = meet(docs, found.where("not chosen"), "left_anti")
    if again.isEmpty():
        return kept
    doubled = meet(kept, again, "left_semi").select(carried(docs).alias("doc"))
    one = doubled.groupBy(F.col(f"doc.`{id_col}`"), F.xxhash64(F.col(f"doc.`{text_col}`"))).agg(
        F.min_by("doc", F.to_json("doc")).alias("doc"))
    return meet(kept, again, "left_anti").unionByName(one.select("doc.*"))


def block_links(members: DataFrame, near: DataFrame, texts: DataFrame, share: tuple[int, int], slack: float,
                size: int, rows: int, block: int) -> DataFrame:
    """Links (a, b) between nodes of a bucket that are in different components, enough to
    connect what links connect: every pair is tested in the first bucket that both are
    in, on signatures and then full sets, unless links of the same task join it already.

    A bucket's nodes are dealt to blocks of about ``block``; the task of two blocks holds
    the sets of their nodes only."""
    open_ = members.select(F.col("node").alias("id")).distinct()
    open_texts = texts.join(open_, "id", "left_semi")
    own = unshared(open_texts, size).withColumnRenamed("id", "node")
    # `own` shingles are in no other open node: a pair shares at most the rest
    able = near.join(open_.withColumnRenamed("id", "node"), "node", "left_semi").join(own, "node", "left")
    able = able.where((F.col("n_shingles") - F.coalesce("own", F.lit(0))) * share[1] >= F.col("n_shingles") * share[0]).drop("own")
    sets = describe(open_texts.select("id", F.lit(0).cast("long").alias("text_key"), "text"), size, 0, 0, sets=True)
    able = stored(able.join(sets.select(F.col("id").alias("node"), "shingles"), "node"))
    left = members.join(able.select("node"), "node", "left_semi")
    blocks = left.groupBy("bucket").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = left.join(blocks, "bucket").withColumn("mine", mine).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("bucket", "band", "node", "component", "mine", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node").reset_index(drop=True)
        band, lo, hi = int(pdf["band"].iloc[0]), int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0])
        sig = np.stack([np.frombuffer(x, np.uint16) for x in pdf["sig"]])
        sets = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
        node, comp, mine, n = (pdf[c].to_numpy() for c in ("node", "component", "mine", "n_shingles"))
        root = {c: c for c in comp.tolist()}

        def top(c):
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        out = []
        for i in range(len(node) - 1):
            later = np.arange(i + 1, len(node))
            fits = (comp[later] != comp[i]) & (np.minimum(n[later], n[i]) * share[1] >= np.maximum(n[later], n[i]) * share[0])
            fits &= (mine[later] != mine[i]) if lo != hi else True
            later = later[fits]
            same = sig[later] == sig[i]
            first = same[:, :band * rows].reshape(len(later), band, rows).all(axis=2).any(axis=1)  # met in an earlier band
            later = later[~first & (same.mean(axis=1) >= share[0] / share[1] - slack)]
            for j in later.tolist():
                p, q = top(comp[i]), top(comp[j])
                if p != q:
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if share[1] * both >= share[0] * (n[i] + n[j] - both):
                        root[p] = q
                        out.append((node[i], node[j]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return dealt.join(able, "node").groupBy("bucket", "lo", "hi").applyInPandas(compare, "a long, b long")
