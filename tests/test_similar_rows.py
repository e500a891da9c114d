"""Near-duplicate pairs by sketched prefixes, and the grams that mentions look for."""

import random

from docspark.operators import analytics as Q

SCHEMA = "document_id string, text string"


def test_records_that_repeat_an_id_lose_no_pair(spark):
    """Two rows of one id shortened its prefix to terms that its partners did not share."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for d in range(12):
        base = rng.sample(words, 60)
        rows += [(f"a{d}", " ".join(base)), (f"b{d}", " ".join(base[:-6] + rng.sample(words, 6)))]
    rows += rows[::4]
    want = set()
    for i, t in set(rows):
        for j, u in set(rows):
            x, y = set(t.split()), set(u.split())
            if i < j and x != y and len(x & y) / len(x | y) >= 0.7:
                want.add((i, j))
    got = Q.similar_sections(spark.createDataFrame(rows, SCHEMA), 0.7).collect()
    assert {(r.id_a, r.id_b) for r in got} == want and len(want) >= 12


def test_prefixes_of_any_sketch_give_the_same_pairs(spark):
    sets = spark.createDataFrame([("a", [5, -7, 9, 11, 13]), ("b", [5, -7, 9, 11, 14]), ("c", [1 << 62, 5])], "rid string, h array<long>")
    for slots in (1, 4, 1 << 20):
        rows = Q.rarest_terms(sets, 0.6, slots).collect()
        assert {(r.rid, r.n) for r in rows} == {("a", 5), ("b", 5), ("c", 2)}
        assert sorted(r.r for r in rows if r.rid == "a") == [1, 2, 3]
        assert {r.term for r in rows if r.rid == "a"} & {r.term for r in rows if r.rid == "b"}


def test_mentions_build_only_grams_as_long_as_a_phrase(spark):
    docs = spark.createDataFrame([("d", ["a b c d a b"])], "document_id string, texts array<string>")
    for phrases, grams in (([(1, "a b"), (2, "c d")], 2), ([(1, "b c d a")], 3)):
        found = Q.mentions(spark.createDataFrame(phrases, "pid int, text string"), docs)
        plan = found._jdf.queryExecution().analyzed().toString()
        assert f"array({grams})" in plan
        assert found.count() == {2: 3, 3: 1}[grams]
    assert Q.mentions(spark.createDataFrame([], "pid int, text string"), docs).count() == 0
