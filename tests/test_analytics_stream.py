"""Analytics (Q13, Q15, Q17, Q18, X6, X7) against brute force, and streams equal
to batch (T1-T4), also when a batch is replayed."""

import itertools
import re

from pyspark.sql import functions as F

from docspark.operators import analytics as Q
from docspark.operators import embed as X
from docspark.operators import pages as P
from docspark.operators import summarize as Z
from docspark.sources import corpus
from docspark.streaming import intake as T

SF_SMALL = "/root/testdata/sf0.001"


def _terms(t):
    return re.findall(r"[^\W_]+", t.lower())


DOCS = [
    ("a", "the quick brown fox jumps over the lazy dog"),
    ("b", "the quick brown fox jumps over the lazy dog"),          # exact copy
    ("c", "the quick brown fox jumps over the lazy cat"),          # near copy
    ("d", "completely different words here"),
    ("e", "fox"),
]


def test_similar_sections_equals_brute_force(spark):
    df = spark.createDataFrame(DOCS, "document_id string, text string")
    # exact copies (identical term sets) collapse to the smallest id
    groups = {}
    for did, text in sorted(DOCS):
        groups.setdefault(frozenset(_terms(text)), []).append(did)
    reps = {min(ids): (s, len(ids)) for s, ids in groups.items()}
    dup = {(r.member, r.representative, r.copies) for r in Q.duplicate_groups(df).collect()}
    assert dup == {("a", "a", 2), ("b", "a", 2)}
    for t in (0.5, 0.55, 0.8, 1.0):
        got = {(r.id_a, r.id_b, r.copies_a, r.copies_b) for r in Q.similar_sections(df, t).collect()}
        want = set()
        for (ia, (sa, na)), (ib, (sb, nb)) in itertools.combinations(sorted(reps.items()), 2):
            if len(sa & sb) / len(sa | sb) >= t:
                want.add((ia, ib, na, nb))
        assert got == want, t


def test_mentions_over_pages_and_blocks(spark):
    pages = ["a b c d", "", "e f a b", "c d e"]
    docs = spark.createDataFrame([("x", pages), ("y", [" ".join(["z"] * 3000 + ["a", "b", "c"])]), ("n", None)],
                                 "document_id string, texts array<string>")
    phrases = spark.createDataFrame([(1, "d e"), (2, "a b c"), (3, "c"), (4, "f a b c d")], "pid long, text string")
    for block in (2, 3, 512):
        got = sorted((r.pid, r.document_id, r.term_position, r.page_number, r.context)
                     for r in Q.mentions(phrases, docs, window=1, block=block).collect())
        assert got == [(1, "x", 3, 1, "c d e f"), (1, "x", 9, 4, "c d e"), (2, "x", 0, 1, "a b c d"), (2, "x", 6, 3, "f a b c d"),
                       (2, "y", 3000, 1, "z a b c"), (3, "x", 2, 1, "b c d"), (3, "x", 8, 4, "b c d"), (3, "y", 3002, 1, "b c"),
                       (4, "x", 5, 3, "e f a b c d e")]


def test_amounts_are_grouped_and_never_fail(spark):
    pages = spark.createDataFrame([("d", 1, "$1,234.56 and 1,000,000 or 12345,678 " + "9" * 40)],
                                  "document_id string, page_number int, content string")
    got = {r.mention: r.amount for r in Q.extract_amounts(pages).collect()}
    assert {k: None if v is None else float(v) for k, v in got.items()} == {
        "1,234.56": 1234.56, "1,000,000": 1000000.0, "12345": 12345.0, "678": 678.0, "9" * 40: None}
    total = Q.amounts_by_document(pages).first()
    assert (total.n_amounts, total.n_unparsed, float(total.total)) == (5, 1, 1234.56 + 1000000 + 12345 + 678)


def test_hot_group_of_copies_is_one_row(spark):
    copies = [(f"x{i:04d}", "one two three four five") for i in range(300)] + [("y", "one two three four six")]
    df = spark.createDataFrame(copies, "document_id string, text string")
    pairs = Q.similar_sections(df, 0.6).collect()
    assert [(r.id_a, r.id_b, r.copies_a, r.copies_b) for r in pairs] == [("x0000", "y", 300, 1)]


def test_mentions_equals_brute_force(spark):
    docs = spark.createDataFrame([(d, [t]) for d, t in DOCS], "document_id string, texts array<string>")
    phrases = [(1, "quick brown fox"), (2, "the lazy"), (3, "fox"), (4, "absent phrase")]
    got = {(r.pid, r.document_id, r.term_position) for r in Q.mentions(spark.createDataFrame(phrases, "pid long, text string"), docs).collect()}
    want = set()
    for pid, ph in phrases:
        pt = _terms(ph)
        for did, text in DOCS:
            dt = _terms(text)
            for i in range(len(dt) - len(pt) + 1):
                if dt[i:i + len(pt)] == pt:
                    want.add((pid, did, i))
    assert got == want


def test_section_of_page_two_levels_equals_running_last(spark):
    rows = [("d", p, f"H{p}" if p % 5 == 0 else None) for p in range(1, 23)] + [("e", 1, None), ("e", 2, "x")]
    df = spark.createDataFrame(rows, "document_id string, page_number int, heading string")
    got = {(r.document_id, r.page_number): r.section for r in X.section_of_page(df, block=3).collect()}
    last = {}
    for doc, page, h in rows:
        last[doc] = h if h is not None else last.get(doc)
        assert got[(doc, page)] == last[doc]


def test_version_diff_and_audit(spark):
    pages = spark.createDataFrame(
        [("v1", 1, "a"), ("v1", 2, "b"), ("v1", 3, "c"), ("v2", 1, "a"), ("v2", 2, "B"), ("v2", 4, "d")],
        "document_id string, page_number int, content string")
    pairs = spark.createDataFrame([("v1", "v2")], "v1 string, v2 string")
    got = {r.page_number: r.change for r in Q.diff_versions(pairs, pages).collect()}
    assert got == {1: "same", 2: "changed", 3: "removed", 4: "added"}
    runs = spark.createDataFrame(
        [("x", 1, "completed", "2025-01-01"), ("x", 2, "completed_with_errors", "2025-02-01")],
        "id string, run int, status string, updated_at string")
    a = {r.run: r for r in Q.audit_trail(runs).collect()}
    assert (a[1].attempt, a[1].previous_status, a[1].is_latest) == (1, None, False)
    assert (a[2].attempt, a[2].previous_status, a[2].is_latest) == (2, "completed", True)


def test_streams_equal_batch_and_replay_is_idempotent(spark):
    path = f"{SF_SMALL}/documents*.parquet"
    sink = T.scratch_root(spark, "test-intake")
    T.run_to_completion(T.stream_intake(spark, path, sink))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    batch = Z.summarize_pages(P.split_pages(corpus.documents_corpus(docs)))
    key = lambda df: sorted(map(tuple, df.select("document_id", "page", "status", "summary").collect()))
    streamed = spark.read.parquet(f"{sink}/data")
    assert key(streamed) == key(batch)
    T.run_to_completion(T.stream_intake(spark, path, sink))  # same checkpoint: nothing new, nothing doubled
    assert spark.read.parquet(f"{sink}/data").count() == batch.count()
    dsink = T.scratch_root(spark, "test-dedupe")
    T.run_to_completion(T.stream_dedupe(spark, [path, path], dsink))
    assert spark.read.parquet(f"{dsink}/data").count() == docs.count()
