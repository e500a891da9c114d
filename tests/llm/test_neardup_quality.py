"""Near-duplicates against all pairs; classifier gradients and held-out accuracy."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from docspark.llm import neardup, quality

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = (text or "").translate(LOWER).encode().split()
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def classes(rows, size, share=(80, 100)):
    """(id, number of shingles, component id) per row, by comparing all distinct sets."""
    sets = defaultdict(list)
    for i, text in rows:
        sets[shingles(text, size)].append(i)
    nodes = [s for s in sets if s]
    parent = {s: s for s in nodes}

    def root(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    for a, b in combinations(nodes, 2):
        both = len(a & b)
        if both and share[1] * both >= share[0] * (len(a) + len(b) - both):
            parent[root(a)] = root(b)
    least = {}
    for s in nodes:
        ids = [i for i in sets[s] if i is not None]
        if ids:
            least[root(s)] = min([*ids, least.get(root(s), min(ids))])
    return Counter((i, len(s), least.get(root(s)) if s else i) for s, ids in sets.items() for i in ids)


def found(frame, **options):
    rows = neardup.near_duplicates(frame, **options).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows)


@pytest.mark.parametrize("size", [4, 5])
def test_classes_match_all_pairs(documents, listed, size):
    assert found(documents, size=size) == classes([(i, t) for i, t, _ in listed], size)


def chained(n, seed):
    """A chain of versions (each near the next, not the last near the first), a hot group
    of near copies and many texts that share a long passage without being near."""
    rng = random.Random(seed)
    word = lambda: "w" + str(rng.randint(0, 10**6))
    rows, text = [], [word() for _ in range(200)]
    for i in range(n):
        text = list(text)
        text[rng.randrange(len(text))] = word()
        rows.append((i, " ".join(text)))
    core = [word() for _ in range(120)]
    for i in range(n, 3 * n):
        near = list(core)
        near[rng.randrange(120)] = word()
        near[rng.randrange(120)] = word()
        rows.append((i, " ".join(near)))
    passage = [word() for _ in range(60)]
    for i in range(3 * n, 5 * n):
        rows.append((i, " ".join(passage + [word() for _ in range(rng.randint(12, 30))])))
    return rows


@pytest.mark.parametrize("few,block", [(8, 256), (0, 256), (0, 10)])
def test_chains_hot_groups_and_passages(spark, few, block):
    rows = chained(40, 2)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(frame, size=4, few=few, block=block) == classes(rows, 4)


def test_representatives_keep_columns_and_one_of_each(documents, no_documents, listed):
    kept = neardup.representatives(documents)
    assert kept.columns == documents.columns
    want, groups = Counter(), defaultdict(list)
    for (i, n, c), times in classes([(i, t) for i, t, _ in listed], 5).items():
        if n:
            groups[c if c is not None else "null"].append(i)
        else:
            want[i] += times  # without words: linked with nothing
    want.update(min(g, key=lambda i: (i is None, i or 0)) for g in groups.values())
    assert Counter(r["doc_id"] for r in kept.select("doc_id").collect()) == want
    assert neardup.representatives(no_documents).count() == 0
    assert neardup.near_duplicates(no_documents).count() == 0


def test_representatives_of_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(80))
    near = [text.replace(f"w{i} ", "") for i in (1,)] + [text + " end", "start " + text]
    rows = [(None, text, "a"), (None, near[0], "a"), (None, near[1], "a"), (None, text, "b"),  # null ids only
            (7, text.upper() + " one two", "a"),
            (9, "x " + text.replace("w", "v"), "a"), (9, text.replace("w", "v"), "b"), (9, text.replace("w", "v"), "a"),
            (20, "", "a"), (20, "", "a"), (None, None, "a"), (None, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = neardup.representatives(docs).collect()
    with_words = Counter(r["doc_id"] for r in got if r["text"])
    assert with_words == {7: 1, 9: 1}
    assert sum(not r["text"] for r in got) == 4  # none of these is anyone's copy
    nulls = neardup.representatives(docs.where("doc_id is null")).collect()
    assert sum(bool(r["text"]) for r in nulls) == 1


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(500, i) for i in range(501, 700)] + [(9, 9)]
    got = {r["node"]: r["component"] for r in
           neardup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(500, 700), 500)}


def test_word_hashes_do_not_depend_on_parts():
    text = np.frombuffer(" Ab\tcd  ab é\x0bx ".encode() * 50, dtype=np.uint8)
    starts, hashes = neardup.word_hashes(text)
    for part in (1, 7, 64):
        s, h = neardup.word_hashes(text, part)
        assert s.tolist() == starts.tolist() and h.tolist() == hashes.tolist()
    assert len(set(hashes[:5].tolist())) == 4  # Ab and ab are one word


def brute_score(net, text):
    """The network, position by position."""
    width, n_filters = net.filters.shape[:2]
    segments = max(1, -(-len(text) // quality.SEGMENT))
    padded = text + bytes(segments * quality.SEGMENT + width - len(text))
    chunks = []
    for c in range(max(1, segments - 1)):
        span = range(c * quality.SEGMENT, min(c + 2, segments) * quality.SEGMENT)
        chunks.append([max(sum(float(net.filters[j, f, padded[p + j]]) for j in range(width)) for p in span)
                       + float(net.bias[f]) for f in range(n_filters)])
    chunks = np.array(chunks)
    fill = 3 * np.log2(1 + min(len(text), 2 * quality.SEGMENT)) / 8
    features = np.concatenate((chunks.max(axis=0), chunks.min(axis=0), chunks.mean(axis=0), [fill]))
    hidden = np.tanh(features @ net.hidden + net.hidden_bias)
    return 1 / (1 + np.exp(-(hidden @ net.out + net.out_bias)))


def test_scores_match_brute_force():
    rng = random.Random(1)
    texts = [bytes(rng.choices(b"abc XYZ!", k=n)) for n in (0, 1, 4, 127, 128, 129, 300, 1000, 70_000)]
    net = quality.train(texts, np.array([0, 1, 0, 1, 0, 1, 0, 1, 1.0]), n_filters=3, width=3, n_hidden=2, steps=6, batch=4)
    assert quality.predict(net, texts).tolist() == pytest.approx([brute_score(net, t) for t in texts], abs=1e-4)


def labelled(spark, n=300):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        words = rng.choices(["some", "plain", "Words", "of", "text", "here"], k=rng.randint(5, 200))
        good = i % 3 > 0
        rows.append((i, " ".join(words if good else [w.upper() + "!!" for w in words]), int(good)))
    return rows


def test_held_out_accuracy(spark):
    rows = labelled(spark)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    out = {r["doc_id"]: r for r in quality.classify(docs, labels, steps=120).collect()}
    right = [out[i]["predicted"] == y for i, _, y in rows if out[i]["held_out"]]
    assert len(out) == len(rows) and sum(right) >= 0.95 * len(right)
    assert all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in out)
    again = {r["doc_id"]: r["score"] for r in quality.classify(docs, labels, steps=120).collect()}
    assert all(abs(again[i] - out[i]["score"]) < 1e-6 for i in out)


def test_awkward_rows_get_scores(spark, documents, no_documents, listed):
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(None, 1), (3, None), (4, 7), (5, 0)], "doc_id long, quality int")
    out = quality.classify(documents, labels, steps=3).collect()
    assert len(out) == len(listed) and all(0 <= r["score"] <= 1 for r in out)
    assert quality.classify(no_documents, labels).count() == 0
    one = quality.classify(documents, labels.where("quality = 1")).collect()
    assert {r["score"] for r in one} == {1.0}
    none = quality.classify(documents, labels.where("quality = 9")).collect()
    assert {r["score"] for r in none} == {0.5}
