"""Packing token sequences: linear grouping, few-size configurations, best fit."""

from __future__ import annotations

import bisect
import json
import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A run of equal placements: `count` pieces of one length, from rank `first` on, one
#: in each of the sequences `sequence`, `sequence + 1`, ... at `offset`.
Run = tuple[int, int, int, int, int]  # length, first, count, sequence, offset


def linear_groups(hist: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Lengths from the largest on, cut into ``groups`` groups of as equal numbers of
    pieces as possible: lists of (length, count)."""
    total = sum(hist.values())
    out: list[list[tuple[int, int]]] = []
    at, cut = 0, 0
    for length in sorted(hist, reverse=True):
        left = hist[length]
        while left:
            if at == cut:
                out.append([])
                cut = max(at + 1, total * len(out) // groups)
            n = min(left, cut - at)
            out[-1].append((length, n))
            at, left = at + n, left - n
    return out


def fullest(sizes: list[int], left: list[int], first: int, capacity: int) -> dict[int, int]:
    """The configuration that holds one piece of size ``first`` (an index) and fills
    the rest of the sequence as far as the sizes left allow: index -> pieces."""
    room = capacity - sizes[first]
    reach = np.full(room + 1, -2, dtype=np.int64)  # the last size used to reach a sum
    reach[0] = -1
    copies = np.zeros(room + 1, dtype=np.int64)
    for j in range(first, len(sizes)):
        size, have = sizes[j], left[j] - (j == first)
        if size > room or have <= 0:
            continue
        copies[:] = 0
        for _ in range(min(have, room // size)):
            new = np.flatnonzero((reach[size:] == -2) & (reach[:-size] != -2) & (copies[:-size] < have)) + size
            if not len(new):
                break
            reach[new] = j
            copies[new] = np.where(reach[new - size] == j, copies[new - size], 0) + 1
        if reach[room] != -2:
            break
    fill = int(np.flatnonzero(reach != -2).max())
    used = {first: 1}
    while fill:
        j = int(reach[fill])
        used[j] = used.get(j, 0) + 1
        fill -= sizes[j]
    return used


def plan(hist: dict[int, int], capacity: int, groups: int = 2048, small: float = 0.25) -> tuple[list[Run], int]:
    """Placements of ``hist`` (length -> pieces) and the number of sequences.

    Lengths above ``small`` of the capacity are grouped and rounded up to their
    group's largest; sequences are then composed of few sizes, each time the fullest
    configuration around the largest size left, as often as the pieces last. The true
    lengths replace the rounded ones, which leaves gaps, and the small pieces go from
    the largest on into the smallest gap that holds them. Work and memory depend on
    the capacity and the number of groups, never on the number of pieces."""
    runs: list[Run] = []
    used = {length: 0 for length in hist}  # ranks handed out
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, count)
    order: list[int] = []  # the gaps that occur, ascending
    n_seq = 0

    def put(length: int, count: int, sequence: int, offset: int) -> None:
        runs.append((length, used[length], count, sequence, offset))
        used[length] += count

    def leave(gap: int, first: int, count: int) -> None:
        if gap > 0:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(order, gap)
            gaps[gap].append((first, count))

    bar = int(capacity * small)
    grouped = linear_groups({n: c for n, c in hist.items() if n > bar and c}, groups)
    by_size: dict[int, list[list[int]]] = {}
    for g in grouped:  # groups that round to the same size are one
        by_size.setdefault(g[0][0], []).extend([length, n] for length, n in g)
    sizes = sorted(by_size, reverse=True)
    left = [sum(n for _, n in by_size[s]) for s in sizes]
    at = [0] * len(sizes)
    for first in range(len(sizes)):
        while left[first]:
            config = fullest(sizes, left, first, capacity)
            times = min(left[j] // n for j, n in config.items())
            slots = [j for j in sorted(config) for _ in range(config[j])]
            held = []  # per slot the true lengths that `times` pieces have
            for j in slots:
                need, taken = times, []
                while need:
                    run = by_size[sizes[j]][at[j]]
                    n = min(need, run[1])
                    taken.append([run[0], n])
                    run[1] -= n
                    need -= n
                    at[j] += run[1] == 0
                held.append(taken)
                left[j] -= times
            done = 0
            while done < times:
                n = min(t[0][1] for t in held)
                offset = 0
                for t in held:
                    put(t[0][0], n, n_seq + done, offset)
                    offset += t[0][0]
                    t[0][1] -= n
                    if not t[0][1]:
                        t.pop(0)
                leave(capacity - offset, n_seq + done, n)
                done += n
            n_seq += times
    for length in sorted((n for n in hist if n <= bar), reverse=True):
        count = hist[length]
        while count:
            i = bisect.bisect_left(order, length)
            if i == len(order):
                per = capacity // length
                fresh, each = (count // per, per) if count >= per else (1, count)
                for k in range(each):
                    put(length, fresh, n_seq, k * length)
                leave(capacity - each * length, n_seq, fresh)
                n_seq, count = n_seq + fresh, count - fresh * each
                continue
            gap = order[i]
            first, have = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(i)
            n = min(count, have)
            put(length, n, first, capacity - gap)
            leave(gap - length, first, n)
            if have > n:
                leave(gap, first + n, have - n)
            count -= n
    return runs, n_seq


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
           text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Token ids of every document, then ``end_id``, cut to pieces of ``capacity`` ids
    where longer; only the first piece may be shorter. ``tokenizer`` is the path of a
    rank file of the vocabulary (see README), with the JSON file of the same name beside
    it, both present on every machine. Returns ``id_col``, piece, start, length, ids_crc32 (over little-endian 32-bit ids) and, with
    ``keep_ids``, the ids. A null text counts as empty: one piece, the end id."""
    schema = "id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = full_encoder(tokenizer)
        for pdf in batches:
            out = []
            for i, text in zip(pdf["id"].tolist(), pdf["text"].tolist()):
                ids = np.array(encode(text) + [end_id], dtype="<u4")
                first = (len(ids) - 1) % capacity + 1
                ends = range(first, len(ids) + 1, capacity)
                for n, end in enumerate(ends):
                    part = ids[max(0, end - capacity) if n else 0:end]
                    row = (None if i is None or i != i else int(i), n, end - len(part), len(part), zlib.crc32(part.tobytes()))
                    out.append((*row, part.astype(np.int32).tolist()) if keep_ids else row)
            cols = ["id", "piece", "start", "length", "ids_crc32"] + (["ids"] if keep_ids else [])
            frame = pd.DataFrame(out, columns=cols)
            frame["id"] = pd.array([r[0] for r in out], dtype="Int64")
            yield frame

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"))
    out = rows.mapInPandas(cut, schema)
    return out.withColumnRenamed("id", id_col)


#: The white space of the vocabulary's pattern.
PATTERN_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def encoder(tokenizer: str, pattern: str | None = None) -> Callable[[str], list[int]]:
    """The byte-level BPE of a rank file, as a function from text to ids. It knows no
    added tokens and fails on about a million white-space characters in a row."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(tokenizer, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=pattern or public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={}).encode_ordinary


def full_encoder(tokenizer: str, long_run: int = 100_000) -> Callable[[str], list[int]]:
    """The ids that the JSON file of the vocabulary gives, for any text.

    An added token's literal gets its id, and the texts between are encoded each by
    itself (the file's added tokens take no white space or word boundary with them).
    ``long_run`` or more white-space characters in a row are cut out as the pattern
    does: all but the last before a word, all at the text's end, as one piece."""
    with open(os.path.splitext(tokenizer)[0] + ".json", encoding="utf-8") as f:
        added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    literals = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
    runs = re.compile(f"(?<!{PATTERN_SPACE}){PATTERN_SPACE}{{{long_run},}}")
    plain = encoder(tokenizer)
    piece = None

    def between(text: str) -> list[int]:
        nonlocal piece
        ids: list[int] = []
        at = 0
        for run in runs.finditer(text) if len(text) >= long_run else ():
            piece = piece or encoder(tokenizer, r"\s+")  # without lookahead: no stack
            end = run.end() - (run.end() < len(text))
            ids += plain(text[at:run.start()]) + piece(text[run.start():end])
            at = end
        return ids + plain(text[at:]) if at else plain(text)

    def encode(text: str) -> list[int]:
        parts = literals.split(text) if literals else [text]
        if len(parts) == 1:
            return between(text)
        ids: list[int] = []
        for n, part in enumerate(parts):  # every second part is a literal
            if n % 2:
                ids.append(added[part])
            else:
                ids += between(part)
        return ids

    return encode


def pack(parts: DataFrame, capacity: int = 2048, groups: int = 2048, buckets: int = 64, id_col: str = "doc_id") -> DataFrame:
    """Sequence and offset of every piece (columns ``id_col``, piece, length, others
    are kept): as few sequences of at most ``capacity`` tokens as ``plan`` finds.

    Only the number of pieces per length comes to the driver (``capacity`` rows at
    most); the plan is runs of ranks. A piece's rank among those of its length is its
    place in its bucket plus the pieces of the buckets before, so a length that a
    third of all pieces have is numbered by many tasks. Reruns agree. Pieces of length
    0 do not occur (every document has its end id); null and repeated ids are pieces
    like others; an empty table gives an empty result."""
    parts = parts.withColumn("bucket", F.pmod(F.xxhash64(id_col, "piece"), F.lit(buckets)))
    per_bucket = parts.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("bucket")
    starts = per_bucket.select("length", "bucket", (F.sum("n").over(before) - F.col("n")).alias("first"))
    hist = {r["length"]: r["n"] for r in per_bucket.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = plan(hist, capacity, groups)
    runs.sort()
    length_at = np.array([r[0] for r in runs], dtype=np.int64)
    rank_at = np.array([r[1] for r in runs], dtype=np.int64)
    sequence = np.array([r[3] for r in runs], dtype=np.int64)
    offset = np.array([r[4] for r in runs], dtype=np.int64)
    key_at = length_at * (1 << 48) + rank_at

    @F.pandas_udf("struct<sequence_id:long, offset:long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(key_at, length.to_numpy() * (1 << 48) + rank.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": sequence[at] + rank.to_numpy() - rank_at[at], "offset": offset[at]})

    within = W.partitionBy("length", "bucket").orderBy(id_col, "piece", "start")
    return (parts.withColumn("place", F.row_number().over(within) - 1)
            .join(starts, ["length", "bucket"])
            .withColumn("at", place("length", F.col("first") + F.col("place")))
            .select(*[c for c in parts.columns if c != "bucket"], "at.sequence_id", "at.offset"))
