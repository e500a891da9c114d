"""Phrase collocations by Rabin-Karp fingerprints."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .neardup import LOWER, power_table, spread_bits

#: Bytes: 0 is part of a word, 1 parts words, 2 parts pieces.
KIND = np.zeros(256, dtype=np.uint8)
KIND[[32, 9]] = 1
KIND[[*b".,;:!?", 10, 11, 12, 13]] = 2
WORD = re.compile(rb"[^ \t.,;:!?\n\x0b\x0c\r]+")
FLAT = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def slices(texts: list[bytes], words: int, most: int) -> Iterator[list[tuple[int, int, int, int]]]:
    """Batches of about ``most`` bytes of (text number, first byte, byte at which owned
    phrases cease to begin, last byte): a longer text is cut between words, and a slice
    goes on for ``words`` - 1 words behind its end."""
    batch, size = [], 0
    for i, text in enumerate(texts):
        at = 0
        while at < len(text):
            stop = min(len(text), at + most)
            while stop < len(text) and not KIND[text[stop]]:
                stop += 1
            end = stop
            if stop < len(text):
                for j, word in enumerate(WORD.finditer(text, stop)):
                    if j == words - 1:
                        break
                    end = word.end()
            if batch and size + end - at > most:
                yield batch
                batch, size = [], 0
            batch.append((i, at, stop, end))
            size += end - at
            at = stop
    if batch:
        yield batch


def squeezed(text: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=9).compress(text.lower(), asbytes=True)


def opened(data: bytes, size: int) -> bytes:
    return pa.decompress(data, size, "zstd", asbytes=True)


SLICE = "slice long, text binary, ends array<int>, owned array<int>, langs array<string>"


def cut_slices(words: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(lang, text) -> slices: parts of texts with a line end behind each (A-Z lowered
    and compressed, as they are stored and shuffled), where they end, up to where the phrases that begin in
    them are theirs, and their languages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for cuts in slices(texts, words, most):
                ends = np.cumsum([b - a + 1 for _, a, _, b in cuts])
                owned = ends - np.array([b - s + 1 for _, _, s, b in cuts])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([squeezed(b"".join(texts[i][a:b] + b"\n" for i, a, _, b in cuts))], pa.binary()),
                     pa.array([ends.astype(np.int32)]), pa.array([owned.astype(np.int32)]), pa.array([[langs[i] for i, *_ in cuts]])],
                    names=["slice", "text", "ends", "owned", "langs"])
                number += 1

    return run


def equal_bytes(text: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes at a and at b are equal, eight at a time; ``text`` has
    eight bytes more than are asked for."""
    eight = np.ndarray(len(text) - 7, dtype="<u8", buffer=text, strides=(1,))
    same = np.ones(len(a), dtype=bool)
    live, done = np.arange(len(a)), 0
    while len(live):
        left = np.minimum(size[live] - done, 8)
        mask = np.uint64(2**64 - 1) >> (np.uint64(8) * (8 - left).astype(np.uint64))
        ok = ((eight[a[live] + done] ^ eight[b[live] + done]) & mask) == 0
        same[live[~ok]] = False
        done += 8
        live = live[ok & (size[live] > done)]
    return same


def word_places(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every word and the byte past it; the last byte parts pieces."""
    inside = KIND[raw] == 0
    return (np.flatnonzero(inside & np.concatenate(([True], ~inside[:-1]))),
            np.flatnonzero(~inside & np.concatenate(([False], inside[:-1]))))


def grams(text: bytes, ends: np.ndarray, owned: np.ndarray, langs: list[str], words: int,
          bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different phrases of a slice: fingerprint, count and a pointer to the first
    occurrence (number of its first word * ``words`` + its words - 1).

    Words are hashed with one blank between them by differences of one prefix polynomial,
    modulo 2**64. Occurrences of one fingerprint are compared with the first by their
    bytes; those that differ are a phrase of their own."""
    raw = np.frombuffer(text, dtype=np.uint8)
    first, past = word_places(raw)
    piece = np.cumsum(KIND[raw] == 2, dtype=np.int32)[first]
    owner = np.searchsorted(ends, first, side="right")
    mine = first < owned[owner]
    keep = KIND[raw] == 0
    plain = np.where(keep, LOWER[raw], np.uint8(32))
    keep[past] = True  # one blank behind every word
    plain = plain[keep]
    place = np.cumsum(keep, dtype=np.int64) - 1
    lo, hi = place[first], place[past]
    up, down = power_table(len(plain))
    total = np.zeros(len(plain) + 1, dtype=np.uint64)
    np.cumsum((plain.astype(np.uint64) + np.uint64(1)) * up[:len(plain)], out=total[1:])
    numbers: dict[str, int] = {}
    tongue = np.array([numbers.setdefault(x, len(numbers)) for x in langs])[owner]
    salts = np.array([int.from_bytes(x.encode()[:8].ljust(8, b"\0"), "little") for x in numbers], dtype=np.uint64)
    plain = np.concatenate((plain, np.zeros(8, dtype=np.uint8)))
    short = np.uint64((2**64 - 1) >> bits ^ (2**64 - 1))
    out = []
    for n in range(1, min(words, len(first)) + 1):
        here = np.flatnonzero(mine[:len(first) - n + 1] & (piece[:len(first) - n + 1] == piece[n - 1:]))
        a, b = lo[here], hi[here + n - 1]
        mark = spread_bits((total[b] - total[a]) * down[a] + spread_bits(salts[tongue[here]] + np.uint64(n))) & short
        while len(here):
            order = np.argsort(mark, kind="stable")
            new = np.flatnonzero(np.concatenate(([True], mark[order[1:]] != mark[order[:-1]])))
            head = order[new]
            lead = np.empty(len(order), dtype=np.int64)
            lead[order] = np.repeat(head, np.diff(np.append(new, len(order))))
            twin = np.flatnonzero(lead != np.arange(len(lead)))
            same = ((b - a)[twin] == (b - a)[lead[twin]]) & (tongue[here[twin]] == tongue[here[lead[twin]]])
            same[same] = equal_bytes(plain, a[twin[same]], a[lead[twin[same]]], (b - a)[twin[same]])
            count = 1 + np.bincount(lead[twin[same]], minlength=len(here))
            out.append((mark[head], count[head], here[head] * words + n - 1))
            other = twin[~same]  # a collision: round again among themselves
            here, a, b, mark = here[other], a[other], b[other], mark[other]
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def packed(numbers: np.ndarray, width: int) -> np.ndarray:
    """The low bytes of whole numbers, as rows of bytes."""
    return np.ascontiguousarray(numbers.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]


def unpacked(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, dtype=np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


PARTIAL = "bucket int, slice long, once binary, more binary"


def count_grams(words: int, bits: int, spread: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Slices -> per bucket of fingerprints (their first ``spread`` bits) the slice's
    partial counts: 24 further bits and the pointer, and the count where it is not one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                number, text, ends, owned, langs = (batch.column(j)[i].as_py() for j in range(5))
                mark, count, pointer = grams(opened(text, ends[-1]), np.array(ends), np.array(owned), langs, words, bits)
                bucket = (mark >> np.uint64(64 - spread)).astype(np.int32)
                rest = (mark >> np.uint64(40 - spread)) & np.uint64(2**24 - 1)
                cols = []
                for some, parts in ((count == 1, ((rest, 3), (pointer, 3))), (count > 1, ((rest, 3), (pointer, 3), (count, 3)))):
                    some = np.flatnonzero(some)
                    some = some[np.argsort(bucket[some], kind="stable")]
                    rows = np.concatenate([packed(x[some], n) for x, n in parts], axis=1)
                    cuts = np.searchsorted(bucket[some], np.arange(2**spread + 1)) * rows.shape[1]
                    data = rows.tobytes()
                    cols.append([data[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)])
                full = [j for j in range(2**spread) if cols[0][j] or cols[1][j]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int32()), pa.array([number] * len(full), pa.int64()),
                     *[pa.array([c[j] for j in full], pa.binary()) for c in cols]], names=["bucket", "slice", "once", "more"])

    return run


OFTEN = "slice long, once binary, more binary"


def frequent(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Partial counts sorted by bucket -> those, per slice and without the fingerprint,
    whose fingerprint has ``least`` occurrences or more in all slices together."""
    def total(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        sizes = [np.array([len(r[j]) // n for r in rows]) for j, n in ((1, 6), (2, 9))]
        once, more = (np.frombuffer(b"".join(r[j] for r in rows), dtype=np.uint8).reshape(-1, n) for j, n in ((1, 6), (2, 9)))
        mark = np.concatenate([unpacked(x[:, :3].tobytes(), 3) for x in (once, more)])
        count = np.concatenate((np.ones(len(once), dtype=np.int64), unpacked(more[:, 6:].tobytes(), 3).astype(np.int64)))
        order = np.argsort(mark, kind="stable")
        new = np.flatnonzero(np.concatenate(([True], mark[order[1:]] != mark[order[:-1]])))
        often = np.add.reduceat(count[order], new) >= least
        keep = np.empty(len(order), dtype=bool)
        keep[order] = np.repeat(often, np.diff(np.append(new, len(order))))
        cols = []
        for x, kept, size in ((once, keep[:len(once)], sizes[0]), (more, keep[len(once):], sizes[1])):
            at = np.append(0, np.cumsum(kept))[np.append(0, np.cumsum(size))] * (x.shape[1] - 3)
            data = x[kept, 3:].tobytes()
            cols.append([data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)])
        full = pa.array([bool(a or b) for a, b in zip(*cols, strict=True)], pa.bool_())
        batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), *[pa.array(c, pa.binary()) for c in cols]],
                                           names=["slice", "once", "more"])
        return batch.filter(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket = [], None
        for batch in batches:
            for b, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket and held:
                    yield total(held)
                    held = []
                bucket = b
                held.append(row)
        if held:
            yield total(held)

    return run


def read_phrases(words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Slices with their frequent partial counts -> (lang, phrase, count), the phrases from the text itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text, ends, langs, once, more = (batch.column(j)[i].as_py() for j in range(5))
                more = np.frombuffer(b"".join(more), dtype=np.uint8).reshape(-1, 6)
                pointers = np.concatenate((unpacked(b"".join(once), 3), unpacked(more[:, :3].tobytes(), 3))).astype(np.int64)
                counts = np.concatenate((np.ones(len(pointers) - len(more), dtype=np.int64), unpacked(more[:, 3:].tobytes(), 3).astype(np.int64)))
                text = opened(text, ends[-1])
                first, past = word_places(np.frombuffer(text, dtype=np.uint8))
                at = pointers // words
                lo, hi = first[at], past[at + pointers % words]
                tongue = np.searchsorted(ends, lo, side="right")
                flat = text.translate(FLAT)
                phrase = [b" ".join(WORD.findall(flat[a:b])) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([langs[x] for x in tongue.tolist()], pa.string()), pa.array(phrase, pa.binary()).cast(pa.string()),
                     pa.array(counts)], names=["lang", "phrase", "c"])

    return run


def phrase_counts(docs: DataFrame, words: int, least: int, bits: int = 64, most: int = 1 << 20,
                  bucket_bytes: int = 2 << 20) -> tuple[DataFrame, DataFrame]:
    """Exact counts per lang of all phrases of up to ``words`` words that occur ``least``
    times or more (lang, phrase, f), and all word occurrences per lang (lang, n); ``docs``
    has lang and text (bytes). A bucket of fingerprints is that of about ``bucket_bytes``
    of text, so a task's share does not grow with the input."""
    most = min(most, 2**25 // words - 64)  # pointers and counts of three bytes
    parts = stored(docs.mapInArrow(cut_slices(words, most), SLICE))
    n_words = F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09.,;:!?\x0A-\x0D]+")).cast("long")
    totals = stored(docs.groupBy("lang").agg(F.sum(n_words).alias("n")))
    size = parts.agg(F.sum(F.element_at("ends", -1).cast("long"))).first()[0] or 0
    spread = max(4, min(24, int(np.ceil(np.log2(max(1, size) / bucket_bytes + 1)))))
    partial = parts.mapInArrow(count_grams(words, bits, spread), PARTIAL)
    often = partial.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(frequent(least), OFTEN)
    often = often.groupBy("slice").agg(F.collect_list("once").alias("once"), F.collect_list("more").alias("more"))
    found = often.join(parts, "slice").select("text", "ends", "langs", "once", "more").mapInArrow(
        read_phrases(words), "lang string, phrase string, c long")
    counts = found.groupBy("lang", "phrase").agg(F.sum("c").alias("f")).where(F.col("f") >= least)
    return stored(counts), totals


def part(words: Column, start: int | Column, size: int | Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", words: int = 3, least: int = 10,
                 keep: int = 2000, bits: int = 64) -> DataFrame:
    """The best phrases of 2 to ``words`` words of every language.

    Method, Rabin-Karp: numpy prefix polynomials give the fingerprint of every phrase
    occurrence; a slice of some MB of text counts its own and passes on fingerprint, count
    and pointer to one occurrence, packed by bucket of fingerprints; the shuffle brings a
    bucket's together, where they are added up. Only where a fingerprint has ``least``
    occurrences the pointers are followed into the texts, and counts are added anew by
    the phrase's own words, so collisions part; within a slice occurrences of a
    fingerprint are compared byte by byte. ``bits`` narrows fingerprints (for tests); the
    result does not depend on it. A very frequent phrase is one entry per slice from the
    start, so no bucket is hot.

    Words and pieces, f, l, r, n, score: see the query's contract; all arithmetic is on
    whole numbers of up to 38 digits. Returns lang, rank, phrase, a, l, r, n, score: the
    first ``keep`` of each language by score, then a (both descending), then phrase by its
    bytes. A null lang is ``und``, a null text is empty. Empty texts have no phrases; very
    long ones are counted in slices that overlap by ``words`` - 1 words. Repeated rows
    count as often as they occur. Other columns, whatever their names, are not read. An
    empty table gives an empty result."""
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"))
    counts, totals = phrase_counts(texts, words, least, bits)
    split = F.split("phrase", " ")
    counts = counts.withColumn("w", F.size(split))
    several = counts.where("w >= 2").select("lang", "phrase", F.col("f").alias("a"), "w", split.alias("ws"))
    cuts = several.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("w") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.col("ws"), F.lit(1), F.col("k")).alias("head"),
                       part(F.col("ws"), F.col("k") + 1, F.col("w") - F.col("k")).alias("tail"))
    for name, count in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(count)), ["lang", name])
    score = F.expr("(1000000 * cast(a AS decimal(16,0)) * cast(a AS decimal(16,0))) div (cast(l AS decimal(16,0)) * cast(r AS decimal(16,0)))")
    scored = cuts.groupBy("lang", "phrase").agg(
        F.max("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("s"))
    # phrases inside longer ones that occur at least half as often
    inner = [several.where(F.col("w") == w).select(
        "lang", part(F.col("ws"), F.lit(at), F.lit(m)).alias("phrase"), F.col("a").alias("longer"))
        for w in range(3, words + 1) for m in range(2, w) for at in range(1, w - m + 2)]
    if inner:
        held = reduce(DataFrame.unionByName, inner).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        scored = scored.join(held, ["lang", "phrase"], "left").where(
            F.col("longer").isNull() | (100 * F.col("longer") < 50 * F.col("a")))
    best = Window.partitionBy("lang").orderBy(F.desc("s.score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("s.l").alias("l"), F.col("s.r").alias("r"),
        "n", F.col("s.score").cast("long").alias("score"))
