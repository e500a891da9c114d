"""Chunking (X1, M22), hashed embeddings (X2), retrieval (Q1-Q3, Q10) against brute
force on small fixtures."""

import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from docspark.operators import answer as QA
from docspark.operators import embed as X
from docspark.operators import search as S


def brute_chunks(n, max_tokens, overlap):
    """The proposed loop, stopped once a window reaches the end."""
    out, start = [], 0
    while start < n:
        end = min(start + max_tokens, n)
        out.append((start, end))
        if end == n:
            break
        start = end - overlap
    return out


@pytest.mark.parametrize("max_tokens,overlap", [(5, 0), (5, 2), (7, 6), (10, 3)])
def test_chunk_windows_match_brute_force(spark, max_tokens, overlap):
    rows = [("d", n, " ".join(f"w{i}" for i in range(n))) for n in range(0, 40)]
    df = spark.createDataFrame(rows, "document_id string, page_number int, content string")
    got = {}
    for r in X.chunk_text(df, "content", max_tokens, overlap).collect():
        got.setdefault(r.page_number, []).append((r.chunk_number, r.start_token, r.end_token, r.token_count, r.text))
    for n in range(0, 40):
        want = brute_chunks(n, max_tokens, overlap)
        have = sorted(got.get(n, []))
        assert [(s, e) for _, s, e, _, _ in have] == want
        assert [c for c, *_ in have] == list(range(len(want)))
        for _, s, e, cnt, text in have:
            assert cnt == e - s and text == " ".join(f"w{i}" for i in range(s, e))


def test_chunk_offsets_and_metadata(spark):
    df = spark.createDataFrame([("d", 1, "aa  b\tccc 12 dd")], "document_id string, page_number int, content string")
    rows = X.chunk_metadata(X.chunk_text(df, "content", 2, 1)).orderBy("chunk_number").collect()
    stream = "aa b ccc 12 dd"
    for r in rows:
        assert stream[r.start_offset:r.end_offset] == r.text
    assert [r.contains_numbers for r in rows] == [False, False, True, True]
    with pytest.raises(ValueError):
        X.chunk_text(df, "content", 5, 5)


def _terms(t):
    return re.findall(r"[^\W_]+", t.lower())


def _bucket(term, dim):
    return int(hashlib.md5(term.encode()).hexdigest()[:8], 16) % dim


def _vec(t, dim):
    v = {}
    for term in _terms(t):
        b = _bucket(term, dim)
        v[b] = v.get(b, 0) + 1
    return v


def _cos(a, b):
    dot = sum(a[k] * b.get(k, 0) for k in a)
    na, nb = math.sqrt(sum(x * x for x in a.values())), math.sqrt(sum(x * x for x in b.values()))
    return 0.0 if na == 0 or nb == 0 else dot / (na * nb)


RECS = [
    ("d1_doc", "document", "d1", None, None, "cats and dogs live together"),
    ("d2_doc", "document", "d2", None, None, "stock markets and bonds"),
    ("d1_page_1", "page", "d1", 1, None, "cats purr"),
    ("d1_page_2", "page", "d1", 2, None, "dogs bark loudly"),
    ("d2_page_1", "page", "d2", 1, None, "bonds yield"),
    ("d2_page_2", "page", "d2", 2, None, "cats purr"),          # ties d1_page_1 exactly: id breaks it
    ("d1_page_1_para_0", "paragraph", "d1", 1, 0, "cats purr softly"),
    ("d1_page_2_para_0", "paragraph", "d1", 2, 0, "dogs bark"),
    ("d2_page_1_para_0", "paragraph", "d2", 1, 0, "bonds"),
]
RSCHEMA = "id string, level string, document_id string, page_number int, paragraph_number int, text string"


def test_sparse_search_matches_brute_force(spark):
    dim = 1 << 12
    idx = S.sparse_index(spark.createDataFrame(RECS, RSCHEMA), dim)
    qs = spark.createDataFrame([(1, "cats purr"), (2, "zebra"), (3, "bonds and dogs")], "qid long, text string")
    got = {(r.qid, r.rank): (r.id, round(r.score, 9)) for r in S.search(qs, idx, "page", top=3).collect()}
    for qid, text in [(1, "cats purr"), (3, "bonds and dogs")]:
        scored = [(-_cos(_vec(text, dim), _vec(t, dim)), i) for i, lvl, *_, t in RECS if lvl == "page"]
        want = [(i, round(-s, 9)) for s, i in sorted(scored) if -s > 0][:3]
        assert [got[(qid, k)] for k in range(1, len(want) + 1)] == want
    assert (got[(1, 1)][0], got[(1, 2)][0]) == ("d1_page_1", "d2_page_2")  # equal scores: id order
    assert not [k for k in got if k[0] == 2]  # no shared term, no hit
    only_d2 = S.search(qs, idx, "page", top=3, document_id="d2").select("document_id").distinct().collect()
    assert [r.document_id for r in only_d2] == ["d2"]


def test_multi_level_and_answer(spark):
    idx = S.sparse_index(spark.createDataFrame(RECS, RSCHEMA), 1 << 12)
    qs = spark.createDataFrame([(1, "cats purr"), (2, "zebra")], "qid long, text string")
    ml = S.search_multi_level(qs, idx, k_doc=1, k_page=2, k_para=2).collect()
    assert {r.document_id for r in ml} == {"d1"} and {r.id for r in ml} <= {"d1_page_1_para_0", "d1_page_2_para_0"}
    targets = qs.withColumn("document_id", F.lit("d1"))
    ans = {r.qid: r for r in QA.answer_context(targets, idx, persist=False).collect()}
    assert ans[1].detail_level == "summary" and ans[1].context.startswith("Page 1: cats purr")
    assert (ans[2].detail_level, ans[2].confidence, ans[2].answer) == (None, 0.0, QA.NO_ANSWER)


def test_choose_detail_threshold_is_strict(spark):
    qs = spark.createDataFrame([(1,), (2,), (3,)], "qid long")
    hits = spark.createDataFrame([(1, 0.85), (2, 0.850001)], "qid long, score double")
    got = {r.qid: r for r in QA.choose_detail(qs, hits).collect()}
    assert got[1].detail_level == "detailed" and got[2].detail_level == "summary"
    assert (got[3].detail_level, got[3].confidence, got[3].fixed_answer) == (None, 0.0, QA.NO_ANSWER)


def test_dense_search_brute_force_and_zero_vector(spark):
    vecs = [("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [1.0, 1.0]), ("z", [0.0, 0.0]), ("a2", [2.0, 0.0])]
    v = spark.createDataFrame(vecs, "id string, embedding array<float>")
    q = spark.createDataFrame([(1, [1.0, 0.0])], "qid long, embedding array<float>")
    got = [(r.id, round(r.score, 6)) for r in S.search_dense(q, v, top=4).orderBy("rank").collect()]
    assert got == [("a", 1.0), ("a2", 1.0), ("c", round(1 / math.sqrt(2), 6)), ("b", 0.0)]
    one = S.search_dense(q, v.withColumn("level", F.lit("page")), top=2, level="page", where=F.col("id") != "a", shards=1)
    assert [r.id for r in one.orderBy("rank").collect()] == ["a2", "c"]
    assert S.search_dense(q, v.withColumn("level", F.lit("page")), level="document").count() == 0
