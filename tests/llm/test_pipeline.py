"""The pipeline's stages against brute force, and its registered twins."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from docspark.llm import mixture, quality
from docspark.llm.common import read, stored

from .test_neardup_quality import classes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = read(spark, SF, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        docs, given = stored(stage(spark, docs, SF)), docs
        out.append((given, docs))
    return out


def rows(frame, *names):
    return [tuple(r) for r in frame.select(*names).collect()]


def test_all_but_the_last_return_documents(stages):
    assert all(after.columns == stages[0][0].columns for _, after in stages[:-1])
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_quality_stage_keeps_what_scores_well(spark, stages):
    given, after = stages[0]
    net = quality.fit(given, read(spark, SF, "labels"))
    want = []
    for i, text in rows(given, "doc_id", "text"):
        if quality.predict(net, [(text or "").encode()])[0] >= corpus_pipeline.THRESHOLD:
            want.append(i)
    assert sorted(want) == sorted(i for i, in rows(after, "doc_id"))


def test_exact_stage_keeps_the_longest_then_first(stages):
    given, after = stages[1]
    best: dict = {}
    for i, text in rows(given, "doc_id", "text"):
        key = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        best[key] = min(best.get(key, (1, 0)), (-len(text or ""), i))
    assert sorted(i for i, in rows(after, "doc_id")) == sorted(i for _, i in best.values())


def test_near_stage_keeps_one_of_each_class(stages):
    given, after = stages[2]
    want = [i for i, _, c in classes(rows(given, "doc_id", "text"), 5) if i == c]
    assert sorted(i for i, in rows(after, "doc_id")) == sorted(want)


def test_mix_stage_meets_its_targets(stages):
    given, after = stages[3]
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken, own, whole = Counter(), Counter(), Counter(), {}
    for i, text, source in rows(given, "doc_id", "text", "source"):
        sizes[source] += count(text)
        whole[i] = text
    for i, text, source in rows(after, "doc_id", "text", "source"):
        taken[source] += count(text)
        own[i] += count(text)
        assert text == whole[i] or count(text) < count(whole[i])
    assert all(n <= 2 * count(whole[i]) for i, n in own.items())
    order = sorted(sizes)
    target = mixture.capped_targets(np.array([sizes[s] for s in order], dtype=float),
                                    np.array([(5, 2, 1)[k % 3] for k in range(len(order))], dtype=float), 1.5 * sizes.total(), 2.0)
    assert all(abs(taken[s] - t) <= 16 for s, t in zip(order, target))


def test_pack_stage_fills_sequences(stages):
    given, after = stages[4]
    sequences, docs = defaultdict(list), Counter()
    for i, piece, length, sequence, offset in rows(after, "doc_id", "piece", "length", "sequence_id", "offset"):
        sequences[sequence].append((offset, length))
        docs[i] += piece == 0
    assert docs == Counter(i for i, in rows(given, "doc_id"))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048


def test_run_is_the_stages_and_entry_knows_them(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == stages[-1][1].columns
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(rows(got, *names)) == sorted(rows(stages[-1][1], *names))
    known = __spark_entry__.queries()
    assert "pipeline" in known and {x.split("_")[0] for x in known if x.startswith("op")} == {f"op{n}" for n in range(1, 14)}


def test_empty_documents_pass_through(spark, no_documents):
    docs = no_documents
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF))
    assert docs.count() == 0
