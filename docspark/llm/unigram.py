"""Unigram scores over an existing subword vocabulary, and token counts with them."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stands before every pre-token, as in the vocabulary's own pieces.
MARK = "▁".encode()


def vocabulary(model: str) -> dict[bytes, float]:
    """Pieces (UTF-8) of a public subword model file with natural log probabilities.

    The file's scores only rank the pieces, so they become probabilities by Zipf's
    law, 1 / (rank + 1) normalised, in the file's own order. Control pieces are left
    out; the 256 byte pieces make every byte string writable and come last."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    n = sp.get_piece_size()
    plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    plain.sort(key=lambda i: (-sp.get_score(i), i))
    order = dict.fromkeys(sp.id_to_piece(i).encode() for i in plain)
    for b in range(256):
        order.setdefault(bytes([b]))
    weight = 1.0 / np.arange(2, len(order) + 2)
    return dict(zip(order, np.log(weight / weight.sum()).tolist()))


#: Odd multiplier of the rolling hash of byte strings, modulo 2**64.
BASE = 0x9E3779B97F4A7C15
WRAP = (1 << 64) - 1


class Pieces:
    """A vocabulary as arrays: finds whole batches of substrings by rolling hash.

    Piece hashes are distinct (checked); one bit table turns nearly all other substrings
    away, the rest is looked up in the sorted hashes. A substring of a word that is no
    piece but has a piece's 64-bit hash would be taken for it; no draw of 10**9
    substrings is likely to hold one."""

    BITS = 20

    def __init__(self, scores: dict[bytes, float]) -> None:
        self.lengths = sorted({len(p) for p in scores})
        power = powers(max(self.lengths))[0]
        keys = [sum((b + 1) * int(power[i]) for i, b in enumerate(p)) for p in scores]
        keys = mix(np.array([k & WRAP for k in keys], dtype=np.uint64), np.array([len(p) for p in scores]))
        self.order = np.argsort(keys)  # numbers of the pieces by hash
        self.keys = keys[self.order]
        assert (self.keys[1:] > self.keys[:-1]).all()
        self.scores = np.array(list(scores.values()))
        self.seen = np.zeros(1 << self.BITS, dtype=bool)
        self.seen[keys >> np.uint64(64 - self.BITS)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hashes that are pieces: their places, and the pieces' numbers."""
        at = np.flatnonzero(self.seen[hashes >> np.uint64(64 - self.BITS)])
        some = hashes[at]
        row = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
        hit = self.keys[row] == some
        return at[hit], self.order[row[hit]]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i for i up to n, modulo 2**64, by doubling."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        table = np.ones(1, dtype=np.uint64)
        while len(table) <= n:
            table = np.concatenate((table, table * np.uint64(pow(base, len(table), 1 << 64))))
        out.append(table[:n + 1])
    return out[0], out[1]


def mix(raw: np.ndarray, length) -> np.ndarray:
    """Rolling hashes of strings of a length, spread over all bits."""
    x = (raw ^ (raw >> np.uint64(31))) * (np.uint64(0xBF58476D1CE4E5B9) + np.uint64(2) * np.asarray(length).astype(np.uint64))
    return x ^ (x >> np.uint64(29))


def trie_counts(words: list[bytes], pieces: Pieces, widest: int = 96) -> dict[bytes, int]:
    """Pieces in the best segmentation of every distinct pre-token.

    The sorted pre-tokens are a trie: a row starts a new node at every depth beyond
    the prefix it shares with the row before. Depth by depth, the forward score of
    each new node is the best over the pieces that end there (equal scores: fewer
    pieces) and is computed once; the rows that share the node take it over. The
    counts at the terminal nodes are the result. Words longer than ``widest`` bytes
    form tries of their own, so one long word does not widen all rows."""
    words = sorted(w for w in words if len(w) <= widest) + [w for w in words if len(w) > widest]
    counts: dict[bytes, int] = {}
    at = 0
    while at < len(words):
        end = at + 1
        if len(words[at]) <= widest:
            end = min(len(words), at + 50_000)
            while len(words[end - 1]) > widest:
                end -= 1
        counts.update(zip(words[at:end], trie_block(words[at:end], pieces).tolist()))
        at = end
    return counts


def trie_block(words: list[bytes], pieces: Pieces) -> np.ndarray:
    marked = [MARK + w for w in words]
    size = np.array([len(w) for w in marked])
    m, n = int(size.max()), len(words)
    raw = np.zeros((n, m), dtype=np.uint8)
    raw[np.arange(m) < size[:, None]] = np.frombuffer(b"".join(marked), dtype=np.uint8)
    raw = raw.T
    up, down = powers(m)
    prefix = np.zeros((m + 1, n), dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:m, None], axis=0, out=prefix[1:])
    fresh = np.arange(n) == 0  # rows whose prefix of this depth is new
    best = np.zeros((m + 1, n))
    used = np.zeros((m + 1, n), dtype=np.int32)
    for depth in range(1, m + 1):
        # a shorter word's padding is no prefix, whatever bytes the next word has there
        fresh[1:] |= (raw[depth - 1, 1:] != raw[depth - 1, :-1]) | (size[:-1] < depth)
        alive = size >= depth
        rows = np.flatnonzero(fresh & alive)
        top, few = np.full(len(rows), -np.inf), np.zeros(len(rows), dtype=np.int32)
        for length in pieces.lengths:
            if length > depth:
                break
            start = depth - length
            hashes = mix((prefix[depth, rows] - prefix[start, rows]) * down[start], length)
            hit, piece = pieces.find(hashes)
            if len(hit):
                from_rows = rows[hit]
                score = best[start, from_rows] + pieces.scores[piece]
                n_pieces = used[start, from_rows] + 1
                better = (score > top[hit]) | ((score == top[hit]) & (n_pieces < few[hit]))
                hit = hit[better]
                top[hit], few[hit] = score[better], n_pieces[better]
        node = np.maximum.accumulate(np.where(fresh & alive, np.cumsum(fresh & alive) - 1, 0))
        best[depth], used[depth] = top[node], few[node]
    return used[size, np.arange(n)]


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
                 keep: int = 1_000_000) -> DataFrame:
    """Words and tokens of every document's whole text under the unigram vocabulary.

    Pre-tokens are words between white space. Documents stay in their partition:
    each Arrow batch inserts the distinct pre-tokens that its task has not met yet in
    a trie, and the counts are looked up per document, so nothing is shuffled and no
    word is hot. A task remembers the counts of up to ``keep`` pre-tokens and starts
    afresh beyond; that bounds memory and changes no result.

    Returns ``id_col``, n_words, n_tokens. A null or empty text has none of either;
    repeated rows repeat."""
    scores = vocabulary(model)  # some 32,000 pieces, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        pieces = Pieces(scores)
        for batch in batches:
            texts = batch.column("text")
            n_words, n_tokens = [], []
            for at in range(0, len(texts), 512):
                bags = [Counter((t.as_py() or b"").split()) for t in texts[at:at + 512]]
                fresh = set().union(*bags).difference(known)
                if len(known) + len(fresh) > keep:
                    known = {}
                    fresh = set().union(*bags)
                known.update(trie_counts(list(fresh), pieces))
                n_words += [bag.total() for bag in bags]
                n_tokens += [sum(n * known[w] for w, n in bag.items()) for bag in bags]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=["id", "n_words", "n_tokens"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return rows.mapInArrow(run, "id long, n_words long, n_tokens long").withColumnRenamed("id", id_col)
