"""Q17: what changed between two versions of a document, line by line."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from itertools import zip_longest

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import content_hash
from ..session import materialize
from .blocks import meet


def longest_increasing(line2: list[int]) -> list[int]:
    """Places of a longest increasing subsequence; of several, the one whose members lie
    furthest back, found from the end."""
    tails: list[int] = []
    piles: list[int] = []  # place of each pile's top
    before = []
    for at, value in enumerate(line2):
        pile = bisect_left(tails, value)
        before.append(piles[pile - 1] if pile else -1)
        if pile == len(tails):
            tails.append(value)
            piles.append(at)
        else:
            tails[pile], piles[pile] = value, at
    out, at = [], piles[-1] if piles else -1
    while at >= 0:
        out.append(at)
        at = before[at]
    return out[::-1]


def line_changes(lines1: list[tuple[int, int]], lines2: list[tuple[int, int]]) -> list[tuple[str, int | None, int | None]]:
    """``(change, line1, line2)`` between two versions' lines ``(number, content)``, in order."""
    once1, once2 = ({h: n for n, h in lines} for lines in (lines1, lines2))
    for once, lines in ((once1, lines1), (once2, lines2)):
        if len(once) < len(lines):
            for h, n in Counter(h for _, h in lines).items():
                if n > 1:
                    del once[h]
    anchors = sorted((n, once2[h]) for h, n in once1.items() if h in once2)
    kept = set(longest_increasing([n for _, n in anchors]))
    out: list = [("moved", *x) for i, x in enumerate(anchors) if i not in kept]
    rest = []  # of each side, the remaining lines after so many of the spine
    for side, lines in enumerate((lines1, lines2)):
        spine = {x[side]: i in kept for i, x in enumerate(anchors)}
        gaps: list[list[tuple[int, int]]] = [[]]
        for n, h in lines:
            at = spine.get(n)
            if at is None:
                gaps[-1].append((n, h))
            elif at:
                gaps.append([])
        rest.append(gaps)
    for gap1, gap2 in zip_longest(*rest, fillvalue=()):
        for x, y in zip_longest(gap1, gap2):
            if x is None:
                out.append(("inserted", None, y[0]))
            elif y is None:
                out.append(("deleted", x[0], None))
            elif x[1] != y[1]:
                out.append(("changed", x[0], y[0]))
    return out


def changed_lines(rows, pairs):
    """The step of a group that aligns the lines of its pairs' documents, each pair once."""
    import numpy as np
    import pyarrow as pa

    kind = pairs.schema.field(0).type
    lists = rows.to_batches()[0].column("lines") if rows.num_rows else pa.array([], pa.list_(pa.struct({"line": pa.int32(), "h": pa.binary()})))
    flat = lists.flatten()
    numbers, codes = flat.field("line").to_pylist(), flat.field("h").dictionary_encode().indices.to_pylist()
    ends = np.cumsum([0, *lists.value_lengths().to_pylist()]).tolist()
    texts = {d: list(zip(numbers[i:j], codes[i:j])) for d, i, j in zip(rows["ref"].to_pylist(), ends, ends[1:])}
    out: list = [[], [], [], [], []]

    def batch():
        b = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (kind, kind, pa.string(), pa.int32(), pa.int32()))],
                                       names=["v1", "v2", "change", "line1", "line2"])
        for column in out:
            column.clear()
        return b

    last = None
    for pair in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()):
        if pair == last:
            continue
        last = pair
        lines1, lines2 = texts.get(pair[0], []), texts.get(pair[1], [])
        if lines1 == lines2:
            continue
        found = line_changes(lines1, lines2)
        out[0] += [pair[0]] * len(found)
        out[1] += [pair[1]] * len(found)
        for i in range(3):
            out[i + 2] += [x[i] for x in found]
        if len(out[0]) >= 50_000:
            yield batch()
    if out[0]:
        yield batch()


def aligned_lines(pairs: DataFrame, documents: DataFrame, id_col: str = "document_id", text_col: str = "text") -> DataFrame:
    """Q17: the lines that differ between versions ``pairs(v1, v2)`` of ``documents``,
    as ``changed``, ``inserted``, ``deleted`` or ``moved``, with their numbers (from 1) in
    both versions. Lines that only shifted, as after an inserted page, do not differ.

    Lines whose content hash occurs once in either version are anchors. Of each pair, the
    longest run of anchors in the same order (numbers only) is the spine; anchors
    off it have moved. Between two neighbours on the spine the remaining lines stand
    against each other in order: equal ones are the same, others have changed, and
    what has no counterpart was inserted or deleted. Empty lines and repeated lines are
    lines like others; a null text has no lines. A document's line hashes are one row, which
    goes to the groups of its pairs (:func:`..blocks.meet`)."""
    lines = documents.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("ref"), F.transform(
        F.split(text_col, "\n", -1), lambda x, i: F.struct((i + 1).alias("line"), F.unhex(content_hash(x)).alias("h"))).alias("lines"))
    # rows that repeat an id are one document
    of = lines.groupBy("ref").agg(F.array_sort(F.flatten(F.collect_list("lines"))).alias("lines"))
    stored = materialize(pairs.select(F.col("v1").alias("a"), F.col("v2").alias("b")))
    kind = dict(pairs.dtypes)["v1"]
    return meet(stored, of, changed_lines, f"v1 {kind}, v2 {kind}, change string, line1 int, line2 int")
