"""Token counts, language-model scores and packing against brute force."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docspark.llm import lm, packing, unigram

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def scores():
    return unigram.vocabulary(MODEL)


def segmentations(text, scores):
    if not text:
        yield ()
    for n in range(1, len(text) + 1):
        if text[:n] in scores:
            for rest in segmentations(text[n:], scores):
                yield (text[:n], *rest)


def viterbi(word, scores):
    marked = unigram.MARK + word
    best = [(0.0, 0)]
    for end in range(1, len(marked) + 1):
        best.append(max((best[a][0] + scores[marked[a:end]], best[a][1] - 1)
                        for a in range(max(0, end - 48), end) if marked[a:end] in scores))
    return -best[-1][1]


def forward(word, scores, stop):
    marked = unigram.MARK + word
    total = [1.0]
    for end in range(1, len(marked) + 1):
        total.append(math.fsum(total[a] * math.exp(scores[marked[a:end]]) * (1 - stop)
                               for a in range(max(0, end - 48), end) if marked[a:end] in scores))
    return total[-1] * stop


def test_vocabulary_is_a_distribution(scores):
    assert sum(map(math.exp, scores.values())) == pytest.approx(1)
    assert all(bytes([b]) in scores for b in range(256))


def test_trie_and_lattice_match_all_segmentations(scores):
    words = [w.encode() for w in "the thing thnt élan zzzq a antihe ß th then".split()]
    pieces = unigram.Pieces(scores)
    counts = unigram.trie_counts([*words, b"y" * 300], pieces)
    shared = unigram.Pieces(scores)
    shared.scores = shared.scores + math.log(0.7)  # pieces share what words' ends leave
    logs = lm.marginals(words, shared, 0.3)
    for word, log in zip(words, logs):
        every = [(sum(scores[p] for p in s), -len(s)) for s in segmentations(unigram.MARK + word, scores)]
        assert counts[word] == -max(every)[1]
        assert log == pytest.approx(math.log(math.fsum(math.exp(s) * 0.7**-n for s, n in every) * 0.3))
    assert counts[b"y" * 300] == viterbi(b"y" * 300, scores)


def test_token_counts_of_documents(documents, no_documents, listed, scores):
    counted = unigram.count_tokens(documents, MODEL, keep=300)  # forgets often, counts alike
    memo: dict = {}
    want = Counter()
    for i, text, _ in listed:
        words = (text or "").encode().split()
        for w in words:
            memo.setdefault(w, viterbi(w, scores)) if w not in memo else None
        want[i, len(words), sum(memo[w] for w in words)] += 1
    assert Counter(tuple(r) for r in counted.collect()) == want
    assert unigram.count_tokens(no_documents, MODEL).count() == 0


def test_scores_of_documents(documents, no_documents, listed, scores):
    split = lambda t: (t or "").encode().lower().split()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter()
    for i, text, _ in listed:
        if not held(i):
            count.update([*split(text), None])
    n, v = sum(count.values()), len(count)
    got = defaultdict(list)
    for r in lm.score(documents, MODEL, rounds=0, block_chars=20_000).collect():
        got[r["doc_id"]].append(tuple(r)[1:])
    memo: dict = {}
    n_words, kinds = n - count[None], v - 1
    once, twice = (sum(c == k for w, c in count.items() if w) for k in (1, 2))
    cut = once / (once + 2 * twice)

    def p(w):
        if w not in memo:
            memo[w] = max(count[w] - cut, 0) / n_words + cut * kinds / n_words * forward(w, scores, 0.3)
        return memo[w]

    def log_score(words):
        total, bag, end = 0.0, Counter(), count[None] / n
        for at, w in enumerate(words):  # the urn, draw by draw
            total += math.log10((1 - end) * (bag[w] + 1000 * p(w)) / (at + 1000))
            bag[w] += 1
        return total + math.log10(end)

    want = defaultdict(list)
    for i, text, _ in listed:
        tokens = [*split(text), None]
        want[i].append((held(i), len(tokens), sum(count[t] > 0 for t in tokens), n,
                        sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens), log_score(tokens[:-1])))
    assert set(got) == set(want)
    for i in want:
        for a, b in zip(sorted(got[i]), sorted(want[i])):
            assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9)
    assert lm.score(no_documents, MODEL).count() == 0


def test_expected_pieces_match_all_segmentations(scores):
    words = [w.encode() for w in "the thing thnt élan antihe th then".split()]
    pieces = unigram.Pieces(scores)
    pieces.scores = pieces.scores + math.log(0.7)
    want = Counter()
    for word in words:
        every = [(math.exp(sum(scores[p] for p in s)) * 0.7 ** len(s), s) for s in segmentations(unigram.MARK + word, scores)]
        total = math.fsum(x for x, _ in every)
        for x, s in every:
            for piece in s:
                want[piece] += x / total
    got = dict(zip(scores, lm.expected_pieces(words, pieces)))
    assert all(got[x] == pytest.approx(want[x], abs=1e-9) for x in scores)


def test_lattice_looks_up_shared_prefixes_once(scores):
    class Counted(unigram.Pieces):
        looked = 0

        def find(self, hashes):
            self.looked += len(hashes)
            return super().find(hashes)

    words = [b"internat" + bytes([c, d]) for c in b"abcdef" for d in b"xyz"]
    pieces = Counted(scores)
    n_nodes = len(unigram.MARK) + 8 + 6 + 18
    assert sum(len(set(w[:i] for w in words)) for i in range(1, 11)) + len(unigram.MARK) == n_nodes
    lm.marginals(words, pieces, 0.3)
    assert pieces.looked <= n_nodes * len([x for x in pieces.lengths if x <= 13])
    assert pieces.looked == sum(sum(x <= d for x in pieces.lengths) * k
                                for d, k in [*((i, 1) for i in range(1, 12)), (12, 6), (13, 18)])


def test_lattice_of_awkward_words(scores):
    rng = np.random.default_rng(4)
    words = [b"the", b"the\0", b"the\0\0", b"the", b"t", b"", b"then", rng.bytes(300), b"y" * 5000, "élan".encode()]
    pieces = unigram.Pieces(scores)
    pieces.scores = pieces.scores + math.log(0.7)
    alone = [lm.marginals([w], pieces, 0.3)[0] for w in words]
    assert lm.marginals(words, pieces, 0.3).tolist() == alone
    assert len(lm.marginals([], pieces, 0.3)) == 0
    together = lm.expected_pieces(words, pieces)
    assert np.isfinite(together).all() and not lm.expected_pieces([], pieces).any()
    assert together == pytest.approx(sum(lm.expected_pieces([w], pieces) for w in words), rel=1e-9, abs=1e-12)


def test_learning_raises_the_likelihood_of_unseen_words(documents):
    def held_score(rounds):
        out = lm.score(documents, MODEL, rounds=rounds).where("held_out").agg({"score": "sum"}).first()
        return out[0]

    assert held_score(2) > held_score(0)


def test_scores_without_training_rows(spark):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    out = lm.score(spark.createDataFrame([(i, "some words") for i in held], "doc_id long, text string"), MODEL).collect()
    assert [(r["held_out"], r["n_known"], r["train_tokens"]) for r in out] == [(True, 0, 0)] * 2
    assert all(math.isfinite(r["score"]) for r in out)


@pytest.mark.parametrize("n,capacity", [(0, 64), (1, 64), (40, 64), (3000, 64), (5000, 2048)])
def test_plan_places_every_piece_once(n, capacity):
    rng = np.random.default_rng(n)
    hist = Counter(rng.integers(1, capacity + 1, n).tolist())
    runs, used = packing.plan(dict(hist), capacity)
    placed, sequences, ranks = Counter(), defaultdict(list), defaultdict(set)
    for length, first, count, sequence, offset in runs:
        placed[length] += count
        for k in range(count):
            sequences[sequence + k].append((offset, length))
            ranks[length].add(first + k)
    assert placed == hist and all(ranks[x] == set(range(hist[x])) for x in hist)
    assert set(sequences) == set(range(used))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    need = -(-sum(k * v for k, v in hist.items()) // capacity)
    assert used <= need + max(2, 0.02 * need)


def test_packed_documents(documents, no_documents, listed):
    capacity = 256
    parts = packing.pieces(documents, RANKS, capacity, keep_ids=True)
    rows = packing.pack(parts, capacity, buckets=4).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, text, _ in listed:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= capacity
    total = sum(n * k[3] for k, n in want.items())
    assert len(sequences) <= 1.02 * total / capacity + 2
    assert packing.pack(packing.pieces(no_documents, RANKS)).count() == 0


def test_tokens_equal_the_json_vocabulary():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    encode = packing.encoder(RANKS)
    for text in ("", "a", " \n\n x", "don't DON'T 123 １２ ½", "é́ ß 漢字 \U0001f600", "\x00\x1c\x85\xa0", "<|endoftext|>", "a" * 5000):
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids, text
    assert re.match("ok", "ok")


def test_ids_are_those_of_the_json_file_for_any_text():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    encode, short = packing.full_encoder(RANKS), packing.full_encoder(RANKS, long_run=3)
    assert encode(f"a {end} b") == [64, 220, 50256, 275]
    for gap in (" ", "\n", "\u3000"):  # the fast encoder fails on these
        text = "x" + gap * 1_100_000 + "y"
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids
    rng = np.random.default_rng(3)
    parts = [end, "<|endoftext", " ", "  ", "\n", "\r\n", "\t", "\x85", "\xa0", "\u3000", "\x1c", "a", "B's", "12", "!?", "é漢"]
    for _ in range(4000):
        text = "".join(rng.choice(parts, rng.integers(0, 14)))
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert encode(text) == want and short(text) == want, text


def test_packed_documents_with_added_tokens_and_long_runs(spark):
    texts = ["a <|endoftext|> b", "<|endoftext|>" * 3, "x" + " " * 1_100_000 + "y"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = set()
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        cuts = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        want |= {(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))}
    rows = packing.pack(packing.pieces(frame, RANKS)).collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == want and len(rows) == len(want)


def test_trie_scores_a_shared_prefix_once():
    """Nodes are scored once: 20 words that share 8 bytes have 9 shared nodes (with the
    word mark) and 20 of their own; a word's end is no prefix of its NUL-padded twin."""
    import public_tokenizers

    from docspark.llm import unigram

    pieces = unigram.Pieces(unigram.vocabulary(public_tokenizers.path("piece_bpe_32k.model")))
    words = [b"sharedxx" + bytes([c]) for c in range(97, 117)] + [b"ab", b"ab\0", b"ab\0\0c"]
    alone = {w: unigram.trie_counts([w], pieces)[w] for w in words}
    asked, find = [], pieces.find

    def counted(hashes):
        asked.append(len(hashes))
        return find(hashes)

    pieces.find = counted
    assert unigram.trie_counts(words, pieces) == alone
    shared, asked[:] = sum(asked), []
    for w in words:
        unigram.trie_counts([w], pieces)
    assert shared < sum(asked) / 3
