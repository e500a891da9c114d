"""Language-model scores: subword lattices over an existing vocabulary, learned words."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .unigram import MARK, Pieces, mix, powers, vocabulary


class Trie:
    """Sorted words, each with the mark before it, as a trie: a row stands for a new node
    at every depth beyond the prefix that it shares with the row before. ``node`` has,
    by depth and row, the row that stands for the node there."""

    def __init__(self, words: list[bytes]) -> None:
        marked, n = [MARK + w for w in words], len(words)
        self.size = np.array([len(w) for w in marked])
        m = int(self.size.max())
        raw = np.zeros((n, m), dtype=np.uint8)
        raw[np.arange(m) < self.size[:, None]] = np.frombuffer(b"".join(marked), dtype=np.uint8)
        raw = raw.T
        self.up, self.down = powers(m)
        self.prefix = np.zeros((m + 1, n), dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[:m, None], axis=0, out=self.prefix[1:])
        self.node = np.zeros((m + 1, n), dtype=np.int32)
        self.new = np.zeros((m + 1, n), dtype=bool)  # rows that stand for a node
        fresh = np.arange(n) == 0
        for depth in range(1, m + 1):
            # a word that has ended shares nothing here, whatever bytes come next
            fresh[1:] |= (raw[depth - 1, 1:] != raw[depth - 1, :-1]) | (self.size[:-1] < depth)
            np.logical_and(fresh, self.size >= depth, out=self.new[depth])
            np.maximum.accumulate(np.where(self.new[depth], np.arange(n), 0), out=self.node[depth])
        self.ends = (self.size, self.node[self.size, np.arange(n)])

    def arcs(self, pieces: Pieces) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """Every piece that ends at a node, looked up once per node, by depth and length:
        depths of its start and end, the rows of both nodes, and which piece."""
        n, prefix, node = self.node.shape[1], self.prefix.ravel(), self.node.ravel()
        places = np.flatnonzero(self.new)  # depth * n + row
        found = []
        for length in pieces.lengths:
            ends = places[np.searchsorted(places, length * n):]
            if not len(ends):
                break
            starts = ends - length * n
            hit, piece = pieces.find(mix((prefix[ends] - prefix[starts]) * self.down[starts // n], length))
            found.append((ends[hit], node[starts[hit]], piece, np.full(len(hit), length)))
        end, a, piece, length = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(end // n, kind="stable")
        end, a, piece, length = end[order], a[order], piece[order], length[order]
        depth = end // n
        cuts = np.flatnonzero((np.diff(depth) != 0) | (np.diff(length) != 0)) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(end)]):
            d = int(depth[i])
            yield d - int(length[i]), d, a[i:j], end[i:j] - d * n, piece[i:j]


def tries(words: list[bytes], cells: int = 2_000_000) -> Iterator[np.ndarray]:
    """The words (their numbers) in sorted blocks, each small enough for one trie. Words
    of very different lengths are kept apart, so a long one does not widen all rows."""
    order = np.array(sorted(range(len(words)), key=words.__getitem__), dtype=np.int64)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))[order]
    width = np.maximum(32, 1 << np.frexp(size)[1].astype(np.int64))  # a power of two above it
    for wide in np.unique(width).tolist():
        part, step = order[width == wide], max(1, cells // wide)
        for at in range(0, len(part), step):
            yield part[at:at + step]


def gathered(batches: Iterator[pd.DataFrame], rows: int = 100_000, size: int = 16 << 20) -> Iterator[pd.DataFrame]:
    """Batches of words put together, since more words share more prefixes, up to a number
    of words or bytes."""
    held, n, n_bytes = [], 0, 0
    for pdf in batches:
        held.append(pdf)
        n, n_bytes = n + len(pdf), n_bytes + sum(map(len, pdf["word"]))
        if n >= rows or n_bytes >= size:
            yield pd.concat(held, ignore_index=True)
            held, n, n_bytes = [], 0, 0
    if held:
        yield pd.concat(held, ignore_index=True)


def marginals(words: list[bytes], pieces: Pieces, stop: float) -> np.ndarray:
    """Natural log of the summed probability of all segmentations of each word, by
    forward recursion in log space over a trie: once per shared prefix.

    A word is pieces drawn one by one (``pieces`` share 1 - ``stop``); after each it
    ends with probability ``stop``, so the marginals of all words add up to one at
    most."""
    out = np.empty(len(words))
    for part in tries(words):
        trie = Trie([words[i] for i in part])
        forward = np.full(trie.node.shape, -np.inf)
        forward[0] = 0.0
        for start, end, a, b, piece in trie.arcs(pieces):
            forward[end, b] = np.logaddexp(forward[end, b], pieces.scores[piece] + forward[start, a])
        out[part] = forward[trie.ends]
    return out + np.log(stop)


def expected_pieces(words: list[bytes], pieces: Pieces) -> np.ndarray:
    """How often each piece occurs in a segmentation of the words, drawn by its
    probability. Over a trie, forward sums are made once per node; a node's backward sum
    adds up, over the words below it, their backward sums there divided by their
    probabilities. An arc's expected count over all words that share it is then
    forward * piece * backward. Every position is scaled by a constant power of its
    depth, so words of usual length neither vanish nor overflow."""
    total = np.zeros(len(pieces.scores))
    per_byte = 1e-2  # about what a byte of a word costs; cancels in every share
    weight = np.exp(pieces.scores)
    for part in tries(words):
        trie = Trie([words[i] for i in part])
        found = list(trie.arcs(pieces))
        forward, backward = np.zeros((2, *trie.node.shape))
        forward[0, 0] = 1.0
        with np.errstate(over="ignore", invalid="ignore"):
            for start, end, a, b, piece in found:
                forward[end, b] += weight[piece] / per_byte ** (end - start) * forward[start, a]
        whole = forward[trie.ends]
        fine = np.isfinite(whole) & (whole > 1e-200)
        np.add.at(backward, tuple(x[fine] for x in trie.ends), 1 / whole[fine])
        for start, end, a, b, piece in reversed(found):
            # all arcs that end further on are done, so backward[end] is complete
            through = weight[piece] / per_byte ** (end - start) * backward[end, b]
            share = np.multiply(forward[start, a], through, out=np.zeros(len(a)), where=through > 0)
            total += np.bincount(piece, share, len(total))
            np.add.at(backward[start], a, through)
        if not fine.all():  # beyond the range of doubles: halve the word at any byte
            halves = [words[i] for i in part[~fine]]
            total += expected_pieces([h for w in halves for h in (w[:len(w) // 2], w[len(w) // 2:])], pieces)
    return total


def each_lgamma(x: np.ndarray) -> np.ndarray:
    return np.array([*map(math.lgamma, x.tolist())], dtype=np.float64)


def learn(lexicon: DataFrame, scores: dict[bytes, float], stop: float, rounds: int) -> tuple[dict[bytes, float], float]:
    """The vocabulary's scores and ``stop`` after ``rounds`` of expectation
    maximisation over the distinct training words, each counting once (they stand in for
    words that training never saw). Tasks add up expected counts per piece, so at most
    one row per piece and task is shuffled and one per piece comes to the driver. Pieces
    that never occur keep a hundredth of an occurrence."""
    order = list(scores)
    for _ in range(rounds):
        now, logs = stop, list(scores.values())

        def expect(batches: Iterator[pd.DataFrame], logs=logs, now=now) -> Iterator[pd.DataFrame]:
            pieces = Pieces(dict(zip(order, logs)))
            pieces.scores = pieces.scores + np.log1p(-now)
            total, n = np.zeros(len(order) + 1), 0
            for pdf in gathered(batches):
                total[:-1] += expected_pieces(pdf["word"].tolist(), pieces)
                n += len(pdf)
            total[-1] = n
            used = np.flatnonzero(total)
            yield pd.DataFrame({"piece": used, "n": total[used]})

        rows = lexicon.where("c > 0").select("word").mapInPandas(expect, "piece long, n double")
        found = {r["piece"]: r["n"] for r in rows.groupBy("piece").agg(F.sum("n").alias("n")).collect()}
        n_words = found.pop(len(order), 0.0)
        if not n_words:
            break
        n = np.full(len(order), 0.01)
        n[list(found)] += list(found.values())
        stop = float(n_words / (n_words + n.sum()))
        scores = dict(zip(order, np.log(n / n.sum()).tolist()))
    return scores, stop


def score(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2,
          stop: float = 0.3, rounds: int = 2, urn: float = 1000.0, block_chars: int = 8_000_000) -> DataFrame:
    """log10 probability of every whole text under a model learned from the training
    documents (crc32 of the id as text modulo ``folds`` is not ``held``).

    Tokens are the words of the text, A to Z lowered, and one end. Each token is the end
    with its training share; otherwise a word. A word's probability is its marginal over
    a lattice: the arc of the whole word, if training saw it, with its count less a
    discount, and what the discounts leave for all segmentations into pieces of the
    existing vocabulary, forward recursion in log space over the vocabulary's scores,
    re-estimated in ``rounds`` of expectation maximisation (0 keeps them as they are).
    Within a document words are drawn from an urn of ``urn`` such draws that grows by
    each word drawn, so words that a text repeats get likelier. All of it is a proper
    distribution over texts; counts are exact, over all training text, and grow with it.

    Plan: documents are dealt to blocks of about ``block_chars`` by a hash of id and
    text, so a source or length cannot make a block hot. A block's distinct words with
    their training counts (combined there, before any shuffle) are added up by word;
    each distinct word's lattice is computed once, in tries that compute shared prefixes
    once; the scores go back to the blocks
    that use the word and meet the texts in a cogroup. A frequent word costs one row
    per block, not one per occurrence.

    Returns ``id_col``, held_out, n_tokens, n_known (tokens with c > 0), train_tokens
    (N), base_score (add-one unigram) and score. A null text is empty: its end only.
    A null id is training data (its crc32 is null). Repeated rows repeat and count as
    often. Without training words the lattice alone decides; without training documents
    the end has share 1/2."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    fold = F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(folds))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("t"),
                       F.coalesce(fold == held, F.lit(False)).alias("held_out"))
    size = rows.agg(F.sum(F.length("t")), F.count_if(~F.col("held_out"))).first()
    blocks, ends = int(max(1, -(-(size[0] or 0) // block_chars))), int(size[1])
    rows = rows.select("id", F.col("t").cast("binary").alias("text"), "held_out",
                       F.pmod(F.xxhash64("id", "t"), F.lit(blocks)).cast("int").alias("block"))

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        train, other = Counter(), set()
        for raw, out in zip(pdf["text"], pdf["held_out"]):
            if out:
                other.update(raw.lower().split())
            else:
                train.update(raw.lower().split())
        other.difference_update(train)
        return pd.DataFrame({"block": int(pdf["block"].iloc[0]), "word": [*train, *other],
                             "n": [*train.values(), *([0] * len(other))]})

    words = stored(rows.groupBy("block").applyInPandas(gather, "block int, word binary, n long"))
    lexicon = stored(words.groupBy("word").agg(F.sum("n").alias("c")))
    seen = lexicon.agg(F.sum("c"), F.count_if(F.col("c") > 0), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first()
    n_words, distinct, once, twice = (int(x or 0) for x in seen)
    n_train, v_train = n_words + ends, distinct + (ends > 0)
    discount = once / (once + 2 * twice) if once and twice else 0.5
    known = np.log(discount * distinct / n_words) if n_words else 0.0  # log of the share left to the pieces
    scores, stop = learn(lexicon, vocabulary(model), stop, rounds)

    def price(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces(scores)
        pieces.scores = pieces.scores + np.log1p(-stop)
        for pdf in gathered(batches):
            c = pdf["c"].to_numpy(dtype=np.float64)
            log_p = marginals(pdf["word"].tolist(), pieces, stop) + known
            arc = np.full(len(c), -np.inf)
            arc[c > 0] = np.log((c[c > 0] - discount) / max(1, n_words))
            yield pd.DataFrame({"word": pdf["word"], "log_p": np.logaddexp(log_p, arc), "c": pdf["c"]})

    priced = words.select("block", "word").join(lexicon.mapInPandas(price, "word binary, log_p double, c long"), "word")
    end_share = ends / n_train if n_train else 0.5
    end_log, word_log = np.log(end_share or 0.5), np.log1p(-end_share) if end_share < 1 else np.log(0.5)
    end_base = np.log10((ends + 1) / (n_train + v_train + 1))
    scale = np.log10(n_train + v_train + 1)

    def total(docs_pdf: pd.DataFrame, prices: pd.DataFrame) -> pd.DataFrame:
        number = dict(zip(prices["word"], range(len(prices)))).__getitem__
        c = prices["c"].to_numpy()
        log_a, base, known_word = prices["log_p"].to_numpy() + np.log(urn), np.log10(c + 1) - scale, c > 0
        which, times, kinds, size = [], [], [], []  # words of all bags, bag after bag
        for raw in docs_pdf["text"]:
            bag = Counter(raw.lower().split())
            which += map(number, bag)
            times += bag.values()
            kinds.append(len(bag))
            size.append(bag.total())
        which, times, size = np.array(which, dtype=np.int64), np.array(times, dtype=np.int64), np.array(size, dtype=np.int64)
        drawn = log_a[which]
        again = np.flatnonzero(times > 1)
        a = np.exp(drawn[again])
        drawn[again] += each_lgamma(times[again] + a) - each_lgamma(1 + a)
        doc = np.repeat(np.arange(len(size)), kinds)
        add = lambda x: np.bincount(doc, x, len(size))
        urns = math.lgamma(urn) - each_lgamma(urn + size)
        return pd.DataFrame({
            "id": docs_pdf["id"].astype("Int64"), "held_out": docs_pdf["held_out"], "n_tokens": size + 1,
            "n_known": add(times * known_word[which]).astype(np.int64) + int(ends > 0), "train_tokens": n_train,
            "base_score": add(times * base[which]) + end_base,
            "score": (add(drawn) + urns + size * word_log + end_log) / math.log(10)})

    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return (rows.groupBy("block").cogroup(priced.groupBy("block")).applyInPandas(total, schema)
            .withColumnRenamed("id", id_col))
