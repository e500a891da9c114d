"""Property tests: the Column text rules agree with Python's own string methods."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docspark.functions.text import is_blank, py_strip, sentences

# whitespace-heavy alphabet: ASCII and Unicode spaces, separators, letters, terminators
ALPHABET = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0        　​ab.!?é"
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=12), min_size=1, max_size=40)


@settings(max_examples=5, deadline=None)
@given(TEXTS)
def test_blank_and_strip_match_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", is_blank(F.col("t")).alias("b"), py_strip(F.col("t")).alias("s")).collect()
    for r in got:
        assert r.b == (not r.t.strip()), repr(r.t)
        assert r.s == r.t.strip(), repr(r.t)


@settings(max_examples=5, deadline=None)
@given(TEXTS)
def test_sentences_match_python_regex(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", sentences(F.col("t")).alias("s")).collect():
        want = [re.sub(r"[ \t\n\r]+", " ", m).strip(" ") for m in re.findall(r"[^ \t\n\r.!?][^.!?]*[.!?]*", r.t)]
        assert r.s == want, repr(r.t)
