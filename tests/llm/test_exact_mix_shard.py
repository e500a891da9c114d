"""Exact dedup, source mixing and sharding against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from docspark.llm import mixture, radix, sharding

SPACE = re.compile(r"[\x20\x09-\x0D]")


@pytest.mark.parametrize("widths", [radix.WIDTHS, (1, 2, 3), ()])
def test_exact_groups_match_brute_force(documents, listed, widths):
    groups = defaultdict(list)
    for i, text, _ in listed:
        groups[SPACE.sub("", text or "")].append((-len(text or ""), i is None, i or 0, i))
    want = Counter()
    for norm, members in groups.items():
        members.sort()
        for n, m in enumerate(members):
            want[m[3], members[0][3], len(members), n == 0, hashlib.sha256(norm.encode()).hexdigest()] += 1
    got = Counter(tuple(r) for r in radix.exact_groups(documents, widths=widths).collect())
    assert got == want


def test_exact_groups_carry_rows_and_empty_table(documents, no_documents):
    out = radix.exact_groups(documents, carry=True)
    assert out.select("doc.*").columns == documents.columns
    assert out.count() == documents.count()
    assert radix.exact_groups(no_documents).count() == 0


def test_targets_share_what_capped_sources_leave():
    sizes, weights = np.array([100.0, 1000.0, 10.0, 0.0]), np.array([5.0, 2.0, 1.0, 5.0])
    target = mixture.capped_targets(sizes, weights, 1.5 * sizes.sum(), 2.0)
    assert target[0] == 200 and target[2] == 20 and target[3] == 0
    assert target.sum() == pytest.approx(1.5 * sizes.sum())
    assert mixture.capped_targets(np.zeros(2), weights[:2], 0, 2.0).tolist() == [0, 0]


def test_apportionment_is_highest_quotients():
    rng = np.random.default_rng(0)
    for n, seats in ((1, 5), (4, 0), (7, 23), (30, 400), (3, 1)):
        votes = rng.integers(0, 1000, n).astype(float) + 1
        got = np.zeros(n, dtype=int)
        for _ in range(seats):
            got[int(np.argmax(votes / (got + 0.5)))] += 1
        assert mixture.apportion(votes, seats).tolist() == got.tolist()
    assert mixture.apportion(np.array([5.0, 5.0, 5.0]), 4).tolist() == [2, 1, 1]


def test_mix_comes_near_targets_and_repeats(documents, listed):
    first = sorted(map(tuple, mixture.mix(documents, shard_words=5000).collect()), key=str)
    again = sorted(map(tuple, mixture.mix(documents.repartition(3), shard_words=5000).collect()), key=str)
    assert first == again and len(first) == len(listed)
    sizes = Counter()
    for _, text, source in listed:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = np.array([(5, 2, 1)[i % 3] for i in range(len(order))], dtype=float)
    target = mixture.capped_targets(np.array([sizes[s] for s in order], dtype=float), weights,
                                    1.5 * sum(sizes.values()), 2.0)
    taken, by_target = Counter(), dict(zip(target.tolist(), order))
    for _, size, source_size, t, n in first:
        assert 0 <= n <= 2 * size
        taken[by_target[t]] += n
    for s, t in zip(order, target):
        assert abs(taken[s] - t) <= 16 * 16 + 0.01 * t  # half a block per tape


def test_mixed_rows_hold_the_taken_words(documents, no_documents):
    count = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    taken, texts = Counter(), Counter()
    for r in mixture.mix(documents, shard_words=5000).collect():
        taken[r["doc_id"]] += r["taken"]
    mixed = mixture.mixed_rows(documents, shard_words=5000)
    assert mixed.columns == documents.columns
    for r in mixed.select("doc_id", "text").collect():
        texts[r["doc_id"]] += count(r["text"])
    assert texts == +taken
    assert mixture.mix(no_documents).count() == 0 and mixture.mixed_rows(no_documents).count() == 0


def test_repeated_rows_have_places_of_their_own(spark):
    rows = [(i, f"w{i} " * (1 + i % 9), "a") for i in range(600)]
    rows += [(None, "same words here " * 5, "a")] * 150 + [(7, "copy of one " * 4, "a")] * 150
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    got = mixture.mix(docs, shard_words=600, spans=True).collect()
    total = sum(r["size"] for r in got)
    assert len(got) == len(rows) and abs(sum(r["taken"] for r in got) - 1.5 * total) <= 16
    for copies in ([r for r in got if r["doc_id"] is None], [r for r in got if r["doc_id"] == 7 and r["size"] == 12]):
        size = copies[0]["size"]
        assert len(copies) == 150 and {r["taken"] // size for r in copies} == {1, 2}
        assert abs(sum(r["taken"] for r in copies) / size - 225) <= 45
    again = mixture.mix(docs.repartition(2), shard_words=600, spans=True).collect()
    assert Counter(map(str, got)) == Counter(map(str, again))
    mixed = mixture.mixed_rows(docs, shard_words=600)
    assert sum(len(r["text"].split()) for r in mixed.collect()) == sum(r["taken"] for r in got)


def test_shares_lose_nothing_to_limits():
    rng = np.random.default_rng(1)
    for n, limit in ((1, 5), (50, 9), (3000, 3), (400, 300)):
        words = rng.integers(0, limit + 1, n)
        for times in (0, 0.3, 1, 1.5, 1.97, 2, 3):
            total = int(times * words.sum())
            got = mixture.shares(words.astype(float), 2 * words, total, 16)
            assert got.sum() == min(total, 2 * words.sum()) and (got >= 0).all() and (got <= 2 * words).all()
    even = mixture.shares(np.array([320.0, 160.0]), np.array([640, 320]), 480, 16)
    assert even.tolist() == [320, 160]


@pytest.mark.parametrize("others", [2000, 20_000])
def test_small_sources_reach_their_targets_in_large_mixes(spark, others):
    rows = [(i, "w " * 10, "a") for i in range(others)]
    rows += [(-1 - i, "w " * (1 + i % 11), "b") for i in range(300)] + [(-1000 - i, "one", "c") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, target = Counter(), {}
    for r in mixture.mix(docs, shard_words=100).collect():
        assert r["taken"] <= 2 * r["size"]
        taken[r["source_size"]] += r["taken"]
        target[r["source_size"]] = r["target"]
    assert len(target) == 3 and all(abs(taken[s] - t) <= 16 for s, t in target.items())


@pytest.mark.parametrize("shards", [1, 4, 40, 500])
def test_shards_have_near_equal_bytes(documents, listed, shards):
    rows = sharding.shard(documents, shards=shards, bins=4).select("doc.doc_id", "doc.text", "size", "shard", "slot").collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((i, t) for i, t, _ in listed)
    total, slots, sizes = 0, defaultdict(list), Counter()
    for r in rows:
        assert r["size"] == 16 + len((r["text"] or "").encode())
        total += r["size"]
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    most = max(r["size"] for r in rows)
    assert all(abs(sizes[s] - total / shards) <= most + 0.002 * total / shards for s in range(shards))


def test_shards_split_equal_texts_and_keep_them_adjacent(spark, no_documents):
    rows = [(i, "same text" if i % 2 else "text " + str(i)) for i in range(4000)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=8)
    got = out.select("doc.text", "size", "shard").collect()
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) < 100
    assert len({r["shard"] for r in got if r["text"] == "same text"}) <= 6
    assert sharding.shard(no_documents).count() == 0


def test_rows_below_boundaries():
    h, i = np.array([1, 1, 1, 2]), np.array([1, 5, 9, 0])
    assert sharding.below(h, i, np.array([0, 1, 1, 1, 2, 3]), np.array([7, 0, 5, 20, -1, 0])).tolist() == [0, 0, 2, 3, 3, 4]
    assert zlib.crc32(b"") == 0
