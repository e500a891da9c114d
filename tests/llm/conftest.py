import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents with every awkward case: null ids, texts and sources, empty and blank
    texts, ties, repeated rows, equal texts, near copies, one very long text and columns
    whose names the operators use themselves."""
    rng = random.Random(5)
    vocab = ["w" + str(i) for i in range(400)] + ["the", "The", "é", "ß", "naïve", "x" * 120]
    rows = []
    for i in range(150):
        words = rng.choices(vocab, k=rng.randint(1, 120))
        rows.append((i, " ".join(words), "en", "src" + str(i % 3), 0))
    base = rows[7][1].split() * 3
    for i in range(150, 170):  # near copies of each other
        near = list(base)
        near[i % len(near)] = "new" + str(i)
        rows.append((i, " ".join(near), "en", "src0", 0))
    rows += [(200 + i, rows[3][1] + " " * i, "de", "src1", 0) for i in range(6)]  # equal but for white space
    rows += [(300, None, None, None, None), (301, "", "en", "src9", 0), (302, " \t\n\x0b\f\r ", "en", "src9", 0),
             (303, "one", "en", None, 0), (304, "One", "en", "src9", 0), (305, "a b c", "en", "src9", 0)]
    rows += [(None, "null id text", "en", "src2", 0), (None, rows[3][1], "en", "src2", 0)]
    rows += [rows[5], rows[5]]  # repeated rows
    rows.append((400, " ".join(rng.choices(vocab, k=40_000)), "en", "src2", 0))
    rows.append((401, "  no\u0085break\x1c here", "en", "src2", 0))
    out = [(*r[:4], None if r[1] is None else len(r[1])) for r in rows]
    frame = spark.createDataFrame(out, SCHEMA).repartition(5, "doc_id")
    clash = {c: frame[d] for c, d in {"id": "source", "kept": "lang", "rid": "text", "n": "n_chars", "size": "lang",
                                      "shard": "lang", "bin": "lang", "cls": "lang", "block": "lang", "doc": "text",
                                      "word": "lang", "piece": "lang", "score": "lang", "t": "lang"}.items()}
    return frame.withColumns(clash)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def listed(documents):
    return [(r["doc_id"], r["text"], r["source"]) for r in documents.select("doc_id", "text", "source").collect()]
