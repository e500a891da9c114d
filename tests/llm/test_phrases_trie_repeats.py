"""Collocations, the conversation trie and repeated strings against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docspark.llm import phrases, prefixes, suffixes
from docspark.llm.ranks import ranked

# ------------------------------------------------------------------ ranks


def test_ranked_keeps_what_repeats(spark):
    rng = random.Random(2)
    rows = [(rng.choice([0, 0, 0, -5, rng.randint(-50, 50)]), rng.randint(0, 1), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a long, b long, id long").repartition(7)
    got = {r.id: r.rank for r in ranked(df, ["a", "b"], ["id"]).collect()}
    keys = sorted((a, b) for a, b, _ in rows)
    n = Counter(keys)
    assert got == {i: keys.index((a, b)) for a, b, i in rows if n[a, b] > 1}


# ------------------------------------------------------------------ collocations


def collocations(rows, words, least, keep):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            ws = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(ws)
            for n in range(1, words + 1):
                counts[lang].update(tuple(ws[i:i + n]) for i in range(len(ws) - n + 1))
    out = []
    for lang, f in counts.items():
        cand = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        best = []
        for p, a in cand.items():
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * c >= 50 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                         for q, c in cand.items())
            if not inside:
                best.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), a, left, right, totals[lang], -s)
                for i, (s, _, p, a, left, right) in enumerate(sorted(best)[:keep], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def prose(documents):
    extra = [("en", "New York, new york! NEW\tYORK"), ("en", "É x  é x"), (None, "new york"), (None, None), ("de", "")]
    rows = [(r["lang"], r["text"]) for r in documents.select("lang", "text").collect()]
    return rows + extra * 4


@pytest.mark.parametrize("words, least, keep, bits", [(3, 3, 2000, 64), (4, 4, 50, 64), (3, 3, 2000, 9), (2, 2, 7, 64)])
def test_collocations(spark, prose, words, least, keep, bits):
    docs = spark.createDataFrame(prose, "lang string, text string").repartition(4).withColumns(
        {c: F.col("lang") for c in ("phrase", "a", "rank", "n", "slice", "mark")})
    out = phrases.collocations(docs, words=words, least=least, keep=keep, bits=bits)
    assert sorted(tuple(r) for r in out.collect()) == collocations(prose, words, least, keep)


def test_slices_of_long_texts(spark, prose):
    docs = spark.createDataFrame(prose, "lang string, text string").select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    whole, few = (phrases.phrase_counts(docs, 3, 3, most=most)[0].collect() for most in (1 << 20, 700))
    assert len(whole) > 100 and sorted(map(tuple, whole)) == sorted(map(tuple, few))


def test_collisions_part():
    text = b"a b a c a b\n"
    mark, count, pointer = phrases.grams(text, np.array([12]), np.array([11]), ["en"], 2, 1)
    first, past = phrases.word_places(np.frombuffer(text, dtype=np.uint8))
    said = {text[first[p // 2]:past[p // 2 + p % 2]]: c for p, c in zip(pointer.tolist(), count.tolist())}
    assert said == {b"a": 3, b"b": 2, b"c": 1, b"a b": 2, b"b a": 1, b"a c": 1, b"c a": 1} and len(set(mark)) <= 2


def test_no_texts(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


# ------------------------------------------------------------------ trie


def trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        whole[c] = own.get(base, [])[:h] + ts[h:]
    nodes = defaultdict(list)
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            nodes[tuple(ts[:d])].append(c)
    kids = Counter(n[:-1] for n in nodes if n)
    out = []
    for n, members in nodes.items():
        below = [m for m in nodes if m[:len(n)] == n]
        ends = sorted(c for c in members if len(whole[c]) == len(n))
        out.append((min(members), len(n), min(nodes[n[:-1]]) if n else None, len(members), kids[n],
                    sum(not kids[m] for m in below), sum((len(nodes[m]) - 1) * len(m[-1][1].encode()) for m in below if m),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations():
    rng = random.Random(4)
    rows = []
    for c in range(-7, 120):
        if c % 11 == 3:
            continue
        long = [("user", "hello"), ("assistant", "é!")] * 8
        turns = long[:rng.randint(0, 16)] if c % 3 else [(rng.choice(["user", None]), rng.choice(["hi", "ho", None, "hello"]))
                                                         for _ in range(rng.randint(1, 6))]
        rows += [(c, i if rng.random() < 0.9 else None, r, t) for i, (r, t) in enumerate(turns)]
    rows += [(200, None, None, None), (200, None, "user", "x"), (200, 1, "user", "x"), (200, 1, "user", "x"), (None, 1, "user", "x")]
    rows += [(300, i, "user", "long " * 20_000 if i == 3 else str(i % 2)) for i in range(60)]
    return rows


@pytest.mark.parametrize("task_rows", [1, 12, 20_000])
def test_trie(spark, task_rows):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5).withColumns(
        {c: F.col("role") for c in ("key", "depth", "parent", "marks", "place", "ended", "top")})
    got = [tuple(r) for r in prefixes.trie(prefixes.rebuilt(df), task_rows).collect()]
    assert sorted(got, key=str) == trie(rows)


def test_ids_are_hashed_over_many_parts(spark):
    rows = [(c, 0, "user", "same") for c in range(0, 50_000, 5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    got = prefixes.trie(prefixes.rebuilt(df)).collect()
    for r in got:
        ends = [c for c, *_ in rows if r.depth == 1]  # base and own are the same conversation
        assert r.ends_sha256 == hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
    assert {r.depth: r.n_convs for r in got} == {0: 10_000, 1: 10_000}


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefixes.trie(prefixes.rebuilt(none)).count() == 0


# ------------------------------------------------------------------ repeats


def repeats(texts, length):
    starts = Counter(t[p:p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for p in range(len(t) - length + 1):
            if starts[t[p:p + length]] > 1:
                gone[p:p + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([False], gone)).astype(int)))
        out.append((bytes(np.frombuffer(t, dtype=np.uint8)[~gone[:-1]]), [(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2])]))
    return out


@pytest.mark.parametrize("length", [12, 40, 400])
def test_repeats(spark, length):
    rng = random.Random(length)
    shared = ["".join(rng.choices(["ab", "cde", "é", "kk", " "], k=rng.randint(1, length))) for _ in range(6)]
    texts = []
    for _ in range(40):
        parts = [rng.choice(shared)[rng.choice([0, 0, rng.randint(0, 30)]):] if rng.random() < 0.5
                 else "".join(rng.choices("abcdefghijklmnop qrst", k=rng.randint(0, 2 * length))) for _ in range(rng.randint(0, 6))]
        texts.append("".join(parts))
    texts += ["a" * (3 * length), "a" * length, "a" * (length - 1), "ab" * length, None, "", texts[3], texts[3], "xyz" * 9_000]
    rows = [(i if i % 7 else None, t, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes long").repartition(5)
    df = df.withColumns({c: F.col("text") for c in ("rid", "idx", "rank", "lead", "first", "n", "spans", "kept", "id")})
    want = Counter((i if i % 7 else None, len((t or "").encode()), kept, tuple(spans))
                   for (i, t), (kept, spans) in zip(enumerate(texts), repeats([(t or "").encode() for t in texts], length)))
    got = Counter((r.doc_id, r.n_bytes, bytes(r.kept), tuple(map(tuple, r.spans)))
                  for r in suffixes.remove_repeats(df, length=length).collect())
    assert got == want


def spans_of(spark, texts, length):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in suffixes.remove_repeats(df, length=length, kept=False).collect()}
    want = {i: spans for i, (_, spans) in enumerate(repeats([t.encode() for t in texts], length))}
    return {i: (want[i], got[i]) for i in want if want[i] != got[i]}


def test_repeats_little_longer_than_the_limit(spark):
    rng = random.Random(3)  # the place before the repeat stands for starts whose strings hold other numbers of places
    texts = []
    for i in range(300):
        shared = "".join(rng.choices("abcdefghijklm nop", k=40 + i % 5))
        ends = ["", ""] if i % 2 else ["".join(rng.choices("qrstuvwx yz", k=rng.randint(0, 60))) for _ in range(2)]
        texts += ["".join(rng.choices("qrstuvwx yz", k=rng.randint(0, 90))) + shared + end for end in ends]
    assert spans_of(spark, texts, 40) == {}


def test_repeats_of_periodic_texts(spark):
    rng = random.Random(4)  # spans of other lengths may begin and end alike
    texts = []
    for _ in range(300):
        texts.append("".join((unit * 60)[:rng.randint(20, 150)] for unit in (
            "".join(rng.choices("abcdef ", k=rng.randint(1, 30))) for _ in range(rng.randint(1, 3)))))
    assert spans_of(spark, texts, 40) == {}


def test_a_very_common_passage(spark):
    rng = random.Random(1)
    passage = "".join(rng.choices("abcdefgh ", k=500))
    texts = ["".join(rng.choices("ijklmnop ", k=300)) + (passage if i % 3 else "") + str(i) for i in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in suffixes.remove_repeats(df, kept=False).collect()}
    assert got == {i: spans for i, (_, spans) in enumerate(repeats([t.encode() for t in texts], 400))}
    assert all(not spans if i % 3 == 0 else spans[0][0] <= 300 for i, spans in got.items())


def test_repeats_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.remove_repeats(none).count() == 0
    with pytest.raises(ValueError):
        suffixes.remove_repeats(none, length=5)


def test_blocks_choose_the_same_places():
    rng = np.random.default_rng(0)
    text = rng.integers(97, 100, 5_000).astype(np.uint8)
    runs = [suffixes.window_minima(text, 5, 20, block) for block in (1 << 20, 64, 333)]
    for first, place in runs[1:]:
        assert (first == runs[0][0]).all() and (place == runs[0][1]).all()


def test_places_are_chosen_once_per_text(spark, tmp_path, monkeypatch):
    find = suffixes.find_anchors

    def counted(*args):
        run, to = find(*args), str(tmp_path)

        def counting(batches):
            import uuid

            def seen():
                for batch in batches:
                    with open(f"{to}/{uuid.uuid4().hex}", "w") as f:
                        f.write(str(batch.num_rows))
                    yield batch

            yield from run(seen())

        return counting

    monkeypatch.setattr(suffixes, "find_anchors", counted)
    text = "".join(chr(97 + i * i % 23) + str(i) for i in range(60))
    df = spark.createDataFrame([(i, text + "x" * i) for i in range(300)], "doc_id long, text string")
    assert suffixes.remove_repeats(df, length=40, kept=False).where("size(spans) > 0").count() == 300
    assert sum(int(f.read_text()) for f in tmp_path.iterdir()) == 300  # the range sort read the texts twice before


def test_names_are_the_same_numbers_for_equal_bytes():
    got = suffixes.names_of(memoryview(x) for x in (b"a" * 400, b"b", b"a" * 400))
    assert got.shape == (3, 2) and (got[0] == got[2]).all() and (got[0] != got[1]).any()
    assert suffixes.names_of(iter(())).shape == (0, 2)
