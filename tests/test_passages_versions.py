"""Shared passages, aligned versions and amounts per year against brute force."""

import random
import re
from collections import Counter
from difflib import SequenceMatcher

from docspark.operators.analytics import amounts_by_year
from docspark.operators.passages import shared_passages
from docspark.operators.versions import aligned_lines, longest_increasing


def test_every_shared_run_is_covered(spark):
    rng = random.Random(3)
    vocab = ["t" + str(i) for i in range(3000)]
    common = rng.choices(vocab, k=60)
    docs = []
    for i in range(12):
        terms = rng.choices(vocab, k=rng.randint(0, 150))
        at = rng.randint(0, len(terms))
        cut = rng.randint(0, 20)
        docs.append(terms[:at] + common[cut:cut + rng.choice([10, 25, 40])] + terms[at:])
    docs += [docs[3], [], ["one"], common]
    rows = []
    for i, terms in enumerate(docs):  # page ends fall anywhere
        cuts = sorted({0, len(terms), *[rng.randint(0, len(terms)) for _ in range(4)]})
        rows.append((f"d{i:02}", [" ".join(terms[a:b]) for a, b in zip(cuts, cuts[1:])] or [""]))
    passages, members = shared_passages(spark.createDataFrame(rows, "document_id string, texts array<string>"))
    classes = {r.passage_id: r for r in passages.collect()}
    found = members.collect()
    sizes = Counter(r.passage_id for r in found)
    where = {(r.document_id, t) for r in found for t in range(r.start_term, r.start_term + classes[r.passage_id].n_terms)}
    grams = Counter(tuple(d[i:i + 20]) for d in docs for i in range(len(d) - 19))
    for r in found:
        assert sizes[r.passage_id] == classes[r.passage_id].n_members > 1
        i = int(r.document_id[1:])
        first = classes[r.passage_id].passage_id.split("@")
        n = classes[r.passage_id].n_terms
        a = docs[int(first[0][1:])][int(first[1]):int(first[1]) + n]
        assert docs[i][r.start_term:r.start_term + n] == a and len(a) == n  # members say the same
        pages = rows[i][1]
        before = sum(len(p.split()) for p in pages[:r.page_number - 1])
        assert before <= r.start_term < before + len(pages[r.page_number - 1].split())
    for i, d in enumerate(docs):
        for at in range(len(d) - 19):
            if grams[tuple(d[at:at + 20])] > 1:  # a shared run of 20 terms holds 12 covered ones
                assert sum((f"d{i:02}", t) in where for t in range(at, at + 20)) >= 12


def test_a_hot_passage_is_one_class(spark):
    line = " ".join("w" + str(i) for i in range(30))
    rows = [(f"d{i:03}", [f"a{i} b{i} " + line, f"c{i}"]) for i in range(200)]
    passages, members = shared_passages(spark.createDataFrame(rows, "document_id string, texts array<string>"))
    assert max(r.n_members for r in passages.collect()) == 200
    assert members.count() == sum(r.n_members for r in passages.collect())


def test_no_documents(spark):
    none = spark.createDataFrame([], "document_id string, texts array<string>")
    assert [x.count() for x in shared_passages(none)] == [0, 0]


def test_longest_increasing():
    rng = random.Random(1)
    for _ in range(200):
        xs = rng.sample(range(20), rng.randint(0, 9))
        best = max(sum(m >> i & 1 for i in range(len(xs))) for m in range(1 << len(xs))
                   if (s := [x for i, x in enumerate(xs) if m >> i & 1]) == sorted(s))
        got = [xs[i] for i in longest_increasing(xs)]
        assert got == sorted(got) and len(got) == best


def test_aligned_lines(spark):
    rng = random.Random(5)
    old = [f"line {i} {rng.random()}" for i in range(40)] + ["again"] * 3
    new = old[:5] + ["inserted a", "inserted b"] + old[5:20] + old[22:30] + ["other"] + old[31:]
    new.append(new.pop(10))  # one line moved to the end
    docs = [("a", "\n".join(old)), ("b", "\n".join(new)), ("c", None), ("e", ""), ("f", "\n".join(old[1:]))]
    pairs = [("a", "b"), ("a", "a"), ("a", "f"), ("c", "a"), ("e", "a"), ("a", "b")]
    out = aligned_lines(spark.createDataFrame(pairs, "v1 string, v2 string"),
                        spark.createDataFrame(docs, "document_id string, text string"))
    rows = [tuple(r) for r in out.collect()]
    ab = [r[2:] for r in rows if r[:2] == ("a", "b")]
    assert ("moved", old.index(new[-1]) + 1, len(new)) in ab
    assert Counter(r[0] for r in ab) == {"moved": 1, "inserted": 2, "deleted": 2, "changed": 1}
    assert {new[r[2] - 1] for r in ab if r[0] == "inserted"} == {"inserted a", "inserted b"}
    assert not [r for r in rows if r[:2] == ("a", "a")]
    assert [r[2:] for r in rows if r[:2] == ("a", "f")] == [("deleted", 1, None)]  # all others only shifted
    assert Counter(r[2] for r in rows if r[0] == "e") == {"changed": 1, "inserted": len(old) - 1}
    assert Counter(r[2] for r in rows if r[0] == "c") == {"inserted": len(old)}


def test_alignment_explains_the_difference(spark):
    rng = random.Random(8)
    docs, pairs = [], []
    for i in range(15):
        old = [rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 25))]
        new = list(old)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(new) + 1)
            new[at:at + rng.randint(0, 2)] = [rng.choice("xyzXYZ") for _ in range(rng.randint(0, 2))]
        docs += [(f"o{i}", "\n".join(old)), (f"n{i}", "\n".join(new))]
        pairs.append((f"o{i}", f"n{i}"))
    out = aligned_lines(spark.createDataFrame(pairs, "v1 string, v2 string"),
                        spark.createDataFrame(docs, "document_id string, text string")).collect()
    text = {d: t.split("\n") for d, t in docs}
    for a, b in pairs:
        mine = [r for r in out if r.v1 == a]
        gone = {r.line1 for r in mine if r.line1}
        come = {r.line2 for r in mine if r.line2}
        left = [x for i, x in enumerate(text[a], 1) if i not in gone]
        assert left == [x for i, x in enumerate(text[b], 1) if i not in come]  # the rest is equal, in order
        assert bool(mine) == (text[a] != text[b])
        assert SequenceMatcher(None, text[a], text[b]).ratio() < 1 or not mine


def test_amounts_by_year(spark):
    pages = [("a", 1, "5 apples. In 1999 we paid 10 and 2,000.50, in 2001 7"), ("a", 2, "then 3 and 1,999"), ("a", 3, None),
             ("a", 4, "4 in 2020: 1 " + "9" * 60), ("b", 1, "nothing"), ("c", 2, "8"), ("c", 1, "2150 and 1850")]
    got = {(r.document_id, r.year): (r.n_amounts, r.n_unparsed, None if r.total is None else float(r.total))
           for r in amounts_by_year(spark.createDataFrame(pages, "document_id string, page_number int, content string")).collect()}
    want: dict = {}
    for d, p, text in sorted(pages, key=lambda r: r[:2]):
        want.setdefault(d, [None, {}])
        for m in re.findall(r"[0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]+)?|[0-9]+(?:\.[0-9]+)?", text or ""):
            if re.fullmatch(r"(19|20)\d\d", m):
                want[d][0] = int(m)
            else:
                n, bad, total = want[d][1].get(want[d][0], (0, 0, None))
                big = len(m) > 38
                want[d][1][want[d][0]] = (n + 1, bad + big, total if big else (total or 0) + float(m.replace(",", "")))
    assert got == {(d, y): v for d, (_, years) in want.items() for y, v in years.items()}
