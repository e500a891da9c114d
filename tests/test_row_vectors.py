"""Vectors and terms of one row per record, and flat searches over them by shards."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docspark.operators import embed as X
from docspark.operators import search as S
from test_embed_search import RSCHEMA, _bucket, _cos, _terms, _vec

WORDS = "the a of cat dog bond yield Été ΣΑΣ 12 x".split()


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def texts(n, seed=1):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", "c", None, f"r{i}"]), rng.choice([None, "", "--"] + [" ".join(rng.choices(WORDS, k=rng.randint(1, 30)))] * 6))
            for i in range(n)]


def test_vectors_of_repeated_ids_add_up(spark, small_batches):
    rows = texts(60)
    df = spark.createDataFrame(rows, "id string, text string").withColumn("level", F.lit("page"))
    want = {}
    for i, t in rows:
        if i is not None:
            want.setdefault(i, Counter()).update(_bucket(w, 8) for w in _terms(t or ""))
    got = X.record_vectors(df, "id", "text", 8, keep=("level",)).collect()
    assert len(got) == len({r.id for r in got}) and {r.level for r in got} == {"page"}
    assert {r.id: dict(zip(r.buckets, r.tfs)) for r in got} == {i: dict(c) for i, c in want.items() if c}
    assert all(r.n2 == sum(x * x for x in r.tfs) and r.buckets == sorted(r.buckets) for r in got)


def test_terms_of_repeated_ids_add_up(spark, small_batches):
    rows = texts(60, 2)
    want = {}
    for i, t in rows:
        want.setdefault(i, Counter()).update(_terms(t or ""))
    got = X.record_terms(spark.createDataFrame(rows, "id string, text string"), "id", "text").collect()
    assert len(got) == len(want) and {r.id: dict(zip(r.terms, r.tfs)) for r in got} == {i: dict(c) for i, c in want.items()}


def test_an_index_holds_a_row_per_record_and_a_search_pairs_nothing(spark):
    """A term of a record was a row, and a pair of a question and a record too."""
    recs = [(f"d{i}_page_1", "page", f"d{i}", 1, None, "the cat and the dog number " + str(i)) for i in range(50)]
    idx = S.sparse_index(spark.createDataFrame(recs, RSCHEMA), 1 << 12, persist=True)
    assert idx.rows.count() == 50 and idx.norms.count() == 50 and idx.vectors.count() == 50 * 6
    qs = spark.createDataFrame([(i, "the cat") for i in range(20)], "qid long, text string")
    found = S.best(qs, idx, idx.rows.select("id", "buckets", "tfs", "n2"), 2)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate inline" not in plan and found.count() == 40


@pytest.mark.parametrize("cells,block", [(7, 3), (2_000_000, 4_000_000)])
def test_shards_score_like_a_loop(spark, cells, block):
    import pandas as pd

    rng, dim = random.Random(5), 64
    recs = [(f"r{i:02}", rng.choice(["d1", "d2", None]), " ".join(rng.choices(WORDS, k=rng.randint(1, 6)))) for i in range(40)]
    qs = [(i, " ".join(rng.choices(WORDS + ["zebra"], k=3))) for i in range(9)]

    def frame(rows, key):
        v = [_vec(t, dim) for *_, t in rows]
        return pd.DataFrame({key: [r[0] for r in rows], "buckets": [sorted(x) for x in v], "tfs": [[x[b] for b in sorted(x)] for x in v],
                             "n2": [sum(y * y for y in x.values()) for x in v]})

    vec = frame(recs, "id").assign(document_id=[r[1] for r in recs])
    for group in (None, "document_id"):
        got = S._scorer(2, group, cells, block)(vec, frame(qs, "qid"))
        got = {(r.qid, r.id): round(r.score, 9) for r in got.itertuples()}
        want = {}
        for qid, text in qs:
            for g in ({r[1] for r in recs} if group else [0]):
                hits = [(round(_cos(_vec(text, dim), _vec(t, dim)), 9), i) for i, d, t in recs if not group or d == g]
                hits = [h for h in hits if h[0] > 0]
                bar = sorted((s for s, _ in hits), reverse=True)[:2]
                want |= {(qid, i): s for s, i in hits if s >= bar[-1]}
        assert got == want


def test_topics_of_many_rows_per_record(spark, small_batches):
    """Terms that one record alone has are in no table of frequencies, and count as one."""
    rows = [("a", "cat cat dog"), ("b", "dog bird"), ("a", "fish fish fish"), (None, "cat"), ("e", None)]
    got = {(r.id, r.rank): (r.term, round(r.score, 6)) for r in X.topics(spark.createDataFrame(rows, "id string, text string"), "id", "text", 2).collect()}
    assert got == {("a", 1): ("fish", 4.158883), ("a", 2): ("cat", 1.386294), ("b", 1): ("bird", 1.386294), ("b", 2): ("dog", 0.693147),
                   (None, 1): ("cat", 0.693147)}
