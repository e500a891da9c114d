"""Repeated strings cut out by a distributed suffix array over content-chosen places."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, stored_by
from .neardup import in_parts, power_table, spread_bits
from .ranks import ranked

PLACE_BITS = 22  # of a packed (hash, place) value; a block is shorter than 2**22


def window_minima(text: np.ndarray, k: int, w: int, block: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """Of every run of w neighbouring k-byte strings of ``text``, the place of the one
    with the least hash (the first of several), as runs: first window, place. Works in
    blocks that fit a core's cache, so memory does not follow a very long text."""
    first, place = [], []
    windows = len(text) - (w + k - 1) + 1
    for at in range(0, max(0, windows), block):
        part = text[at:at + block + w + k - 2]
        up, down = power_table(len(part))
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=total[1:])
        least = spread_bits((total[k:] - total[:-k]) * down[:len(part) - k + 1])
        least &= np.uint64(~((1 << PLACE_BITS) - 1) & (2**64 - 1))
        least |= np.arange(len(least), dtype=np.uint64)
        size = 1
        while size * 2 <= w:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < w:
            least = np.minimum(least[:size - w], least[w - size:])
        where = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64) + at
        new = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1])))
        first.append(new + at)
        place.append(where[new])
    if not first:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    first, place = np.concatenate(first), np.concatenate(place)
    keep = np.concatenate(([True], place[1:] != place[:-1]))
    return first[keep], place[keep]


def names_of(strings: Iterator[memoryview]) -> np.ndarray:
    """The 128-bit names of byte strings, as two columns of whole numbers."""
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(x) for x in strings]), dtype=">i8").reshape(-1, 2).astype(np.int64)


def log2_of(n: np.ndarray) -> np.ndarray:
    """The whole part of the binary logarithm; 0 for 0."""
    return np.frexp(np.maximum(n, 1))[1].astype(np.int64) - 1


def anchors(texts: list[bytes], length: int, k: int, w: int, inner: int) -> dict[str, np.ndarray]:
    """The chosen places of some texts (each of ``length`` bytes or more) in order: of
    every window its least k-byte string, and both ends of a text (the last one is left out).

    A place stands for the starts whose window chose it (``first``, ``n``; ``lead`` is how
    far the place lies behind the first): a repeated string chooses the same place
    everywhere. ``hi``, ``lo`` name the bytes from the place to the end of the next one's
    k bytes. ``back`` and ``fwd`` are how many places before and after it cover all strings
    that it stands for, ``core`` how many places after it lie in each of them. ``reach`` is
    the level up to which anyone asks for its ranks, here or at a place that shares one of
    its strings: that one's core holds at most the places that lie in its longest, the last."""
    joined = b"".join(texts)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    end = np.cumsum(size)
    begin = end - size
    run, least = window_minima(np.frombuffer(joined, dtype=np.uint8), k, w)
    first = np.unique(np.concatenate((run, begin)))
    place = least[np.searchsorted(run, first, side="right") - 1]
    doc = np.searchsorted(begin, first, side="right") - 1
    past = np.minimum(np.append(first[1:], end[-1]), end[doc] - (w + k - 1) + 1)
    whole = first < past
    first, place, doc, past = first[whole], place[whole], doc[whole], past[whole]
    places = np.unique(np.concatenate((place, begin, end - k)))
    owner = np.searchsorted(begin, places, side="right") - 1
    own = np.searchsorted(places, place)
    n = np.maximum(0, np.minimum(past - 1, end[doc] - length) - first + 1)
    stands = n > 0
    out = {c: np.zeros(len(places), dtype=np.int64) for c in ("first", "n", "lead", "back", "fwd", "core", "hi", "lo")}
    out["n"][own] = n
    at, lo, hi = own[stands], first[stands], first[stands] + n[stands] - 1
    out["first"][at] = lo - begin[doc[stands]]
    out["lead"][at] = places[at] - lo
    out["back"][at] = at - (np.searchsorted(places, lo, side="right") - 1)
    out["fwd"][at] = np.searchsorted(places, hi + length - k, side="left") - at
    out["core"][at], most = (own[np.searchsorted(first, x + length - (w + k - 1), side="right") - 1] - at for x in (lo, hi))
    top = log2_of(out["back"] + out["fwd"])[at]
    reach = np.full(len(places), -1, dtype=np.int64)
    for where, level in ((at, np.maximum(log2_of(most), inner)), (at - out["back"][at], top),
                         (at + out["fwd"][at] - (1 << top), top)):
        np.maximum.at(reach, where, level)
    for level in range(int(reach.max()), 0, -1):  # a rank is made of two of half the span
        after = np.flatnonzero(reach >= level) + (1 << (level - 1))
        reach[after] = np.maximum(reach[after], level - 1)
    view = memoryview(joined)
    more = np.append(owner[1:] == owner[:-1], False)
    names = names_of(view[a:b] for a, b in zip(places[more].tolist(), (places[1:][more[:-1]] + k).tolist(), strict=True))
    out["hi"][more], out["lo"][more] = names[:, 0], names[:, 1]
    starts = np.searchsorted(owner, np.arange(len(texts)))
    out |= {"doc": owner, "idx": np.arange(len(places)) - starts[owner], "reach": reach}
    return {c: x[more & (reach >= 0)] for c, x in out.items()}


ANCHOR = "rid long, idx int, hi long, lo long, first int, n int, lead int, back int, fwd int, core int, reach int"
STANDING = "rid long, idx int, first int, n int, lead int, back int, fwd int, inner long, from_rank long, to_rank long"
CHUNK = 16  # starts that are asked together before they are asked one by one, at most


def table(schema: str, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A batch with the columns of a schema of whole numbers; masked ones become null."""
    kinds = {"int": pa.int32(), "long": pa.int64()}
    out = {}
    for name, kind in (c.split() for c in schema.split(", ")):
        x = columns[name]
        hidden = np.ma.getmaskarray(x) if np.ma.isMaskedArray(x) else None
        out[name] = pa.array(np.ma.getdata(x).astype(np.int64), mask=hidden).cast(kinds[kind])
    return pa.RecordBatch.from_pydict(out)


def find_anchors(length: int, k: int, w: int, inner: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid, texts = np.asarray(batch.column(0)), batch.column(1).to_pylist()
            for a, b in in_parts(texts):
                found = anchors(texts[a:b], length, k, w, inner)
                yield table(ANCHOR, found | {"rid": rid[a:b][found["doc"]]})

    return run


def find_spans(inner: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For texts with the ranks of their places at all levels: per place that stands for
    starts, and whose inner span repeats, two overlapping ranks that span all strings it
    stands for (null where that span is alone)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten()
            x = {f.name: np.asarray(flat.field(f.name).fill_null(0)) for f in flat.type}
            doc = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
            code = doc * 2**32 + x["idx"]
            levels = []
            for level in range(int(x["level"].max()) + 1):
                some = np.flatnonzero(x["level"] == level)
                some = some[np.argsort(code[some])]
                levels.append((code[some], x["rank"][some]))

            def look(level: np.ndarray, at: np.ndarray) -> np.ma.MaskedArray:
                out = np.ma.masked_all(len(at), dtype=np.int64)
                for j, (codes, ranks) in enumerate(levels):
                    mine = np.flatnonzero(level == j)
                    if len(codes) and len(mine):
                        where = np.minimum(np.searchsorted(codes, at[mine]), len(codes) - 1)
                        hit = codes[where] == at[mine]
                        out[mine[hit]] = ranks[where[hit]]
                return out

            here = np.flatnonzero((x["level"] == 0) & (x["n"] > 0))
            here = here[~np.ma.getmaskarray(look(np.maximum(log2_of(x["core"][here]), inner), code[here]))]
            place = {c: x[c][here] for c in ("idx", "first", "n", "lead", "back", "fwd")}
            top = log2_of(x["back"][here] + x["fwd"][here])
            yield table(STANDING, place | {
                "rid": np.asarray(batch.column(0))[doc[here]], "inner": look(np.full(len(here), inner), code[here]),
                "from_rank": look(top, code[here] - x["back"][here]),
                "to_rank": look(top, code[here] + x["fwd"][here] - (1 << top))})

    return run


CHUNKS = "rid long, first int, n int, core_hi long, core_lo long, hi long, lo long"


def name_chunks(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For rows of (rid, text, places asked): their starts in chunks that are the same for
    all equal strings, as they are cut by the distance to the place. ``core`` names the
    bytes that all strings of a chunk share, ``hi``, ``lo`` those that hold them all (null
    where the place does not stand for the whole chunk)."""
    size = min(CHUNK, length // 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views = [memoryview(x) for x in batch.column(1).to_pylist()]
            lists = batch.column(2)
            flat = lists.flatten()
            first, n, lead = (np.asarray(flat.field(c)).astype(np.int64) for c in ("first", "n", "lead"))
            text = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
            last, place = first + n - 1, first + lead
            least = (place - last) // size
            count = (place - first) // size - least + 1
            own = np.repeat(np.arange(len(first)), count)
            if not len(own):
                continue
            text, first, last = text[own], first[own], last[own]
            hi = place[own] - (least[own] + np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)) * size
            lo = hi - size + 1
            whole = (lo >= first) & (hi <= last)
            core = names_of(views[t][a:b] for t, a, b in zip(text.tolist(), hi.tolist(), (lo + length).tolist(), strict=True))
            cover = np.ma.masked_all((len(own), 2), dtype=np.int64)
            cover[whole] = names_of(views[t][a:b] for t, a, b in zip(
                text[whole].tolist(), lo[whole].tolist(), (hi[whole] + length).tolist(), strict=True))
            begin = np.maximum(lo, first)
            yield table(CHUNKS, {
                "rid": np.asarray(batch.column(0))[text], "first": begin, "n": np.minimum(hi, last) - begin + 1,
                "core_hi": core[:, 0], "core_lo": core[:, 1], "hi": cover[:, 0], "lo": cover[:, 1]})

    return run


def name_starts(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For rows of (rid, text, runs of starts asked): one row per start with the name of the
    string of ``length`` bytes that begins there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, text, asked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                view = memoryview(text)
                starts = np.concatenate([np.arange(x["first"], x["first"] + x["n"]) for x in asked])
                names = names_of(view[p:p + length] for p in starts.tolist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(starts), rid)), pa.array(starts.astype(np.int32)),
                     pa.array(names[:, 0]), pa.array(names[:, 1])], names=["rid", "first", "hi", "lo"])

    return run


def cut(length: int, kept_too: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For rows of (id, size, text, repeated starts as runs): the removed spans, and what is left."""
    def spans(firsts: list[int], counts: list[int]) -> list[tuple[int, int]]:
        out: list[list[int]] = []
        for a, m in sorted(zip(firsts, counts, strict=True)):
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], a + m - 1 + length)
            else:
                out.append([a, a + m - 1 + length])
        return [(a, b - a) for a, b in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, left = [], []
            for text, firsts, counts in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                gone = spans(firsts or [], counts or [])
                edges = [0, *[x for a, m in gone for x in (a, a + m)], len(text)]
                removed.append([{"start": a, "length": m} for a, m in gone])
                left.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
            out = [*batch.columns[:2], pa.array(removed, kind)] + ([pa.array(left, pa.binary())] if kept_too else [])
            yield pa.RecordBatch.from_arrays(out, names=["id", "n_bytes", "spans", "kept"][:len(out)])

    return run


def per_text(rows: DataFrame, texts: DataFrame, columns: list[str]) -> DataFrame:
    """(rid, text, a list of ``columns``) of the texts that have rows; only the lists move."""
    lists = rows.groupBy("rid").agg(F.collect_list(F.struct(*columns)).alias("asked"))
    return texts.join(lists.hint("shuffle_hash"), "rid").select("rid", "text", "asked")


def still_open(rows: DataFrame, settled: DataFrame, ids: list[str], span: str, columns: list[str]) -> DataFrame:
    """``rows`` that are not settled; and, as the same strings may lie in settled ones, one
    row of each settled class whose shared bytes (rank ``span``) are those of an open row."""
    open_ = rows.join(settled.select(*ids), ids, "left_anti").select(*columns, span)
    one = settled.groupBy("rank").agg(F.min(F.struct(*columns, span)).alias("r")).select("r.*")
    one = one.join(open_.select(span).distinct(), span, "left_semi")
    return open_.unionByName(one)


def repeated_starts(texts: DataFrame, length: int) -> DataFrame:
    """Runs of starts (rid, first, n) of strings of ``length`` bytes that start anywhere
    else too, from a stored table (rid, text as bytes) in buckets of rid."""
    k, w = max(1, length // 16), max(1, length * 9 // 20)
    inner = int(log2_of(np.array([-(-(length - (w + k - 1) + 1) // w) - 1]))[0])  # so many places lie in any string
    at = ["rid", "idx"]
    placed = texts.where(F.length("text") >= length).select("rid", "text").mapInArrow(find_anchors(length, k, w, inner), ANCHOR)
    placed = stored(placed)  # a sort by ranges reads its rows twice
    level = stored(ranked(placed, ["hi", "lo"], at, ("first", "n", "lead", "back", "fwd", "core", "reach")))
    blank = [F.lit(None).cast("int").alias(c) for c in ("first", "n", "lead", "back", "fwd", "core")]
    levels, offset = [level], 1
    most = level.agg(F.max("reach")).first()[0] or 0
    for _ in range(most):
        ahead = Window.partitionBy("rid").orderBy("idx").rangeBetween(offset, offset)
        pairs = level.withColumn("rank_then", F.max("rank").over(ahead))
        pairs = pairs.where((F.col("reach") >= len(levels)) & F.col("rank_then").isNotNull())
        level = stored(ranked(pairs, ["rank", "rank_then"], at, ("reach",)))
        levels.append(level)
        offset *= 2
    names = ["idx", "rank", "first", "n", "lead", "back", "fwd", "core"]
    ranks = reduce(DataFrame.unionByName, [
        x.select("rid", F.lit(j).alias("level"), *(names if j == 0 else [*names[:2], *blank])) for j, x in enumerate(levels)])
    standing = stored(ranks.groupBy("rid").agg(F.collect_list(F.struct("level", *names)).alias("s"))
                      .mapInArrow(find_spans(inner), STANDING))
    spans = ["rid", "idx", "first", "n", "lead"]
    covered = stored(ranked(standing.where("from_rank IS NOT NULL AND to_rank IS NOT NULL"),
                            ["from_rank", "to_rank", "back", "fwd"], at, ("first", "n", "lead", "inner")))
    asked = still_open(standing, covered, at, "inner", spans)
    chunks = per_text(asked, texts, ["first", "n", "lead"]).mapInArrow(name_chunks(length), CHUNKS)
    at = ["rid", "first"]
    chunks = stored(ranked(stored(chunks), ["core_hi", "core_lo"], at, ("n", "hi", "lo")).withColumnRenamed("rank", "core"))
    whole = stored(ranked(chunks.where("hi IS NOT NULL"), ["hi", "lo"], at, ("n", "core")))
    asked = still_open(chunks, whole, at, "core", ["rid", "first", "n"])
    starts = per_text(asked, texts, ["first", "n"]).mapInArrow(name_starts(length), "rid long, first int, hi long, lo long")
    single = ranked(stored(starts), ["hi", "lo"], at).withColumn("n", F.lit(1))
    return reduce(DataFrame.unionByName, [x.select("rid", "first", "n") for x in (covered, whole, single)])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                   kept: bool = True) -> DataFrame:
    """Cut out of every text the bytes covered by a string of ``length`` bytes that also
    starts anywhere else, in the same text or another.

    Method: prefix doubling over a sparse suffix array. Places are chosen by content
    (the least hash of every window), so equal strings choose equal places. Spark sorts
    the names of the bytes between neighbouring places, then pairs of ranks at offsets
    of 1, 2, 4 ... places; a place whose rank is alone leaves, and the doubling ends
    when the ranks span the threshold. Two overlapping ranks give any longer span, so a
    last sort of such pairs tells for which places all strings repeat (on both sides of
    the place) and, where the inner span is alone, that none does. Only near the ends of
    repeats the strings themselves are sorted, first by chunks of starts, then one by one.
    Strings are compared by 128-bit names, ranks by whole numbers. Keys that very many
    rows share are dealt to many tasks (see :func:`ranks.ranked`).

    Returns one row per input row: ``id_col``, n_bytes, spans (array of start, length;
    maximal removed runs, in bytes) and, with ``kept``, kept (the remaining bytes). A null
    text is empty; empty and short texts lose nothing. Repeated rows are rows like others:
    each makes the other's bytes go. Ids may be null or repeat. Very long texts are worked
    through in blocks. Other columns, whatever their names, are not read. An empty table
    gives an empty result. There are no ties to break. ``length`` is at least 12."""
    if length < 12:
        raise ValueError("length must be at least 12")
    texts = stored_by(docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text")), "rid")
    runs = repeated_starts(texts, length).groupBy("rid").agg(F.collect_list(F.struct("first", "n")).alias("s"))
    schema = "spans array<struct<start:int,length:int>>" + (", kept binary" if kept else "")
    hit = texts.join(runs.hint("shuffle_hash"), "rid", "left").select(
        "id", F.length("text").cast("long").alias("n_bytes"), "text", "s.first", "s.n")
    kind = dict(texts.dtypes)["id"]
    return hit.mapInArrow(cut(length, kept), f"id {kind}, n_bytes long, " + schema).withColumnRenamed("id", id_col)
