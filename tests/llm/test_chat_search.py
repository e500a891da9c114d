"""Chat formatting as an exact round trip; exact search against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from docspark.llm import chat, knn

TEXTS = ["", "plain", "<turn x>\n</turn>\n", r"\### Assistant: </turn> ok", "&lt; & &amp;lt; <", "a\nb > c", "x" * 1000, "\U0001f600é", None]


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(4)
    rows = []
    for c in range(30):
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "odd <role>", None]), rng.choice(TEXTS)))
    rows += [(50, 0, "user", "tie"), (50, 0, "user", "tie"), (50, 0, "assistant", "tie"), (None, 0, "user", "no id"),
             (51, None, "assistant", "no turn"), (51, 0, "user", "first")]
    return rows


def test_round_trip(spark, conversations):
    frame = spark.createDataFrame(conversations, "conv_id long, turn long, role string, text string")
    frame = frame.withColumns({"msg": F.lit(1), "seq": F.lit("x"), "kind": F.lit("edit")})
    events = chat.as_events(frame)
    got = {r["conv_id"]: r for r in chat.parse(chat.render(chat.fold(events))).collect()}
    want = defaultdict(list)
    for c, t, role, text in conversations:
        want[c].append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        read = [(t["role"], t["text"]) for t in got[c]["turns"]]
        if c == 50:
            assert Counter(read) == Counter(t[1:] for t in turns)
        else:
            assert read == [t[1:] for t in sorted(turns, key=lambda t: t[0])]
        assert got[c]["learned"] == "".join(text for role, text in read if role == "assistant")
        assert got[c]["formatted"].count("<") == 2 * len(turns)


def test_events_fold_in_order(spark):
    log = [(1, 1, 5, "delta", "assistant", "c"), (1, 1, 1, "start", "assistant", None), (1, 1, 2, "delta", "assistant", "a"),
           (1, 1, 3, "regenerate", "assistant", "ignored"), (1, 1, 4, "delta", "assistant", "b"),
           (1, 0, 0, "delta", "user", "old"), (1, 0, 9, "edit", "user", "new"), (1, 0, 10, "delta", "user", "er"),
           (2, 0, 0, None, None, "x"), (3, 0, 1, "delta", "user", "r"), (3, 0, 1, "delta", "user", "r")]
    events = spark.createDataFrame(log, "conv_id long, msg long, seq long, kind string, role string, payload string")
    got = {(r["conv_id"], r["msg"]): (r["first_seq"], r["role"], r["text"]) for r in chat.fold(events).collect()}
    assert got == {(1, 1): (1, "assistant", "bc"), (1, 0): (0, "user", "newer"), (2, 0): (0, "", ""), (3, 0): (1, "user", "rr")}
    assert chat.render(chat.fold(events.where("conv_id > 9"))).count() == 0


def test_formatting_runs_no_python(spark, conversations):
    frame = spark.createDataFrame(conversations, "conv_id long, turn long, role string, text string")
    plan = chat.parse(chat.render(chat.fold(chat.as_events(frame))))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def brute(rows, k, every, scale):
    import math

    clean = [(i, [math.floor(x * scale) for x in v]) for i, v in rows
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for q, (i, v) in enumerate(clean):
        if i % every == 0:
            hits = sorted((-sum(a * b for a, b in zip(v, w)), j) for p, (j, w) in enumerate(clean) if p != q and len(w) == len(v))[:k]
            out.update((i, r + 1, j, -s) for r, (s, j) in enumerate(hits))
    return out


@pytest.mark.parametrize("options", [{}, {"shard_rows": 40, "leaf": 4, "block_shards": 2}, {"shard_rows": 7, "leaf": 1, "k": 3}])
def test_top_k_matches_brute_force(spark, options):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(6)]) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(60)]  # a hot vector: ties everywhere
    rows += [(400, [0.0] * 6), (401, [1e5, -1e5] * 3), (402, [3.0e9] + [0.0] * 5)]
    rows += [(500, None), (510, []), (520, [1.0, None] * 3), (530, [float("nan")] * 6), (540, [float("inf")] + [0.0] * 5),
             (None, [9.0] * 6), (550, [1.0, 2.0]), (560, [0.5, 0.25]), (570, [0.1])]
    rows += [rows[0], rows[100], rows[100], (100, rows[7][1]), (5, rows[100][1])]  # repeated queries, one with another vector
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    frame = frame.withColumns({"row": F.lit(1), "shard": F.lit("x"), "dim": F.lit(1), "v": F.lit(2)}).repartition(6)
    got = Counter(tuple(r) for r in knn.top_k(frame, every=10, **options).collect())
    assert got == brute(rows, options.get("k", 10), 10, 1024)


def test_top_k_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert knn.top_k(empty).count() == 0
    one = spark.createDataFrame([(100, [1.0])], "vec_id long, embedding array<float>")
    assert knn.top_k(one).count() == 0
