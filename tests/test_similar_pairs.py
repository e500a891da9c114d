"""Similar records and their versions as groups of pairs, against brute force."""

import itertools
import random
from collections import Counter

from docspark.operators import analytics as Q
from docspark.operators.blocks import meet
from docspark.operators.versions import aligned_lines
from docspark.plans import queries
from docspark.session import materialize

SCHEMA = "document_id string, text string"


def near_copies(rng, n, size, changed):
    words = [f"w{rng.randrange(10**9)}" for _ in range(size)]
    out = []
    for _ in range(n):
        mine = list(words)
        for i in rng.sample(range(size), changed):
            mine[i] = f"x{rng.randrange(10**9)}"
        out.append(" ".join(mine))
    return out


def jaccard(a, b):
    x, y = set(a.split()), set(b.split())
    return len(x & y) / len(x | y) if x | y else 0


def test_pairs_of_all_sizes_equal_brute_force(spark):
    rng = random.Random(7)
    vocab = [f"v{i}" for i in range(300)]
    texts = [" ".join(rng.sample(vocab, rng.randint(1, 9))) for _ in range(150)]
    for size, changed in ((4, 1), (10, 1), (60, 3), (200, 12), (700, 40), (1500, 80)):  # past every sketch's size
        texts += near_copies(rng, 6, size, changed)
    texts += texts[::9]  # exact copies
    rows = [(f"d{i:04}", t) for i, t in enumerate(texts)]
    for threshold in (0.8, 0.55):
        want = {(a, b) for (a, x), (b, y) in itertools.combinations(rows, 2) if jaccard(x, y) >= threshold}
        got = Counter((r.id_a, r.id_b) for r in Q.similar_records(spark.createDataFrame(rows, SCHEMA), threshold, chunk=2).collect())
        assert set(got) == want and max(got.values()) == 1


def test_a_pair_meets_at_few_of_the_terms_that_it_shares(spark):
    """Near copies gave a row for every prefix term that a pair shares, 15 or so here."""
    rows = [(i, t) for i, t in enumerate(near_copies(random.Random(2), 60, 100, 3))]
    sets = Q.term_sets(spark.createDataFrame(rows, "document_id long, text string")).selectExpr("rid", "transform(s, t -> xxhash64(t)) AS h")
    pref = Q.rarest_terms(sets, 0.8).select("term", "n", "rid", "r", "prev", "bits")
    found = pref.repartition("term").sortWithinPartitions("term", "n").mapInArrow(Q.meeting_pairs(0.8, 500), "a long, b long, n long").collect()
    n = 60 * 59 // 2
    assert len({(r.a, r.b) for r in found}) == n and len(found) < 4 * n


def test_rows_go_to_the_groups_of_their_pairs(spark):
    rng = random.Random(3)
    pairs = sorted({tuple(sorted(rng.sample(range(40), 2))) for _ in range(300)})
    stored = materialize(spark.createDataFrame(pairs, "a long, b long"))
    rows = spark.createDataFrame([(i, i * i) for i in range(60)], "ref long, v long")

    def run(rows, pairs):
        import pyarrow as pa

        v = dict(zip(rows["ref"].to_pylist(), rows["v"].to_pylist()))
        out = [(a, b, v[a] + v[b]) for a, b in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["a", "b", "v"])

    for options in ({}, {"per": 7, "hot": 10}, {"per": 20, "labels": False}):
        got = sorted(tuple(r) for r in meet(stored, rows, run, "a long, b long, v long", **options).collect())
        assert got == [(a, b, a * a + b * b) for a, b in pairs]


def test_page_changes_are_those_of_a_full_outer_join(spark):
    pages = [("a", 1, "x"), ("a", 2, "y"), ("a", None, "z"), ("b", 1, "x"), ("b", 1, "q"), ("b", 3, None), ("c", 2, "y"), ("c", 1, "x")]
    pairs = [("a", "b"), ("a", "b"), ("c", "a"), ("a", "none"), ("c", "c")]
    got = Counter(tuple(r) for r in Q.diff_versions(spark.createDataFrame(pairs, "v1 string, v2 string"),
                                                    spark.createDataFrame(pages, "document_id string, page_number int, content string")).collect())
    left = [(p, n, t) for p in pairs for d, n, t in pages if d == p[0]]
    right = [(p, n, t) for p in pairs for d, n, t in pages if d == p[1]]
    want = Counter((*p, n, "same" if (t or "") == (u or "") else "changed") for p, n, t in left for q, m, u in right if p == q and n == m and n is not None)
    want += Counter((*p, n, "removed") for p, n, _ in left if n is None or not any(q == p and m == n for q, m, _ in right))
    want += Counter((*p, n, "added") for p, n, _ in right if n is None or not any(q == p and m == n for q, m, _ in left))
    assert got == want


def test_version_steps_send_no_line_or_page_per_pair(spark):
    """Each pair's lines and pages were rows of their own that met in joins and windows."""
    pairs = spark.createDataFrame([("a", "b")], "v1 string, v2 string")
    plans = [aligned_lines(pairs, spark.createDataFrame([("a", "x\ny")], SCHEMA)),
             Q.diff_versions(pairs, spark.createDataFrame([("a", 1, "x")], "document_id string, page_number int, content string"))]
    for df in plans:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "FullOuter" not in plan and "MapInArrow" in plan


def tables(spark, path):
    line = [f"line {i} of words{i}" for i in range(25)]
    swapped = [line[1], line[0], *line[2:]]  # the same terms on other lines
    texts = ["\n".join(line), "\n".join(line), "\n".join(swapped), "\n".join([*line, "more"]), "\n".join([*line, "more"]), "something else"]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts, 1)],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return {(f"doc-{a}", f"doc-{b}") for a, b in itertools.combinations(range(1, 6), 2)}


def test_version_diff_has_the_pairs_of_copies(spark, tmp_path):
    """only one record of each term set had its pages compared."""
    want = tables(spark, tmp_path)
    got = {(r.v1, r.v2): 0 for r in queries.q_version_diff(spark, str(tmp_path)).collect()}
    assert set(got) == want


def test_version_lines_has_the_pairs_of_copies(spark, tmp_path):
    """only one record of each term set had its lines aligned."""
    want = tables(spark, tmp_path) - {("doc-1", "doc-2"), ("doc-4", "doc-5")}  # the same text
    rows = queries.q_version_lines(spark, str(tmp_path)).collect()
    assert {(r.v1, r.v2) for r in rows} == want
    assert [tuple(r[2:]) for r in rows if (r.v1, r.v2) == ("doc-2", "doc-5")] == [("inserted", None, 26)]
    assert Counter(r.change for r in rows if (r.v1, r.v2) == ("doc-1", "doc-3")) == {"moved": 1}
