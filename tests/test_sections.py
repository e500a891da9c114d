"""Sections as intervals, the bucketed interval join and the year filter against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from docspark.operators import search as S
from docspark.operators.sections import page_heading, page_years, pages_within, sections
from docspark.plans.store import build_index_tables, read_index_tables

PAGES = "document_id string, page_number int, content string"


@pytest.fixture(scope="module")
def listed():
    rng = random.Random(3)
    rows = []
    for d in range(6):
        for p in range(1, rng.choice((1, 5, 40, 300))):
            first = rng.choice(("Intro", "The end of it", "", "one two three four five six seven", "costs in 1999", " "))
            rows.append((f"d{d}", p, first + "\nbody of " + rng.choice(("1850", "1999", "2004 and 1999", "2,004", "19990", "none"))))
    return rows + [("gap", 5, "Late\nx"), ("gap", 900, "x " * 9), ("gap", 2000, "Next\n2020"), (None, 1, "Lost\n2001"), ("d0", None, "Lost")]


def naive_sections(rows):
    out = []
    for d in {r[0] for r in rows if r[0]}:
        pages = sorted(r[1:] for r in rows if r[0] == d and r[1] is not None)
        heads = [(p, t.split("\n")[0].strip(" ")) for p, t in pages if 1 <= len(t.split("\n")[0].split()) <= 6]
        ends = [p for p, _ in heads[1:]] + [pages[-1][0] + 1]
        out += [(d, h, p, e) for (p, h), e in zip(heads, ends)]
    return sorted(out)


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_sections_match_a_loop(spark, listed, block):
    got = sections(spark.createDataFrame(listed, PAGES).repartition(5), page_heading(), block)
    assert sorted(tuple(r) for r in got.where("document_id is not null").collect()) == naive_sections(listed)
    assert sections(spark.createDataFrame([], PAGES), page_heading()).count() == 0


@pytest.mark.parametrize("width", [1, 16, 1000])
def test_interval_join_matches_a_loop(spark, width):
    rng = random.Random(width)
    pages = [(rng.choice("ab"), rng.randint(0, 200), i) for i in range(300)] + [(None, 3, 300), ("a", None, 301)]
    spans = [(d, a, a + rng.randint(-2, 90)) for d in "abc" for a in rng.sample(range(200), 4)] + [("a", None, 9), (None, 0, 900)]
    got = pages_within(spark.createDataFrame(pages, "document_id string, page_number int, in_bucket int"),
                       spark.createDataFrame(spans, "document_id string, start_page int, end_page int"), width)
    want = [i for d, p, i in pages if p is not None and any(d == e and None not in (a, d) and a <= p < b for e, a, b in spans)]
    assert sorted(r["in_bucket"] for r in got.collect()) == sorted(want)


def test_years_of_pages(spark, listed):
    got = {tuple(r) for r in page_years(spark.createDataFrame(listed, PAGES)).collect()}
    assert {y for _, _, y in got} == {1999, 2004, 2001, 2020}
    assert ("gap", 2000, 2020) in got and not any(p == 900 for _, p, _ in got)


def test_search_by_section_and_year(spark, listed):
    kept = [r for r in listed if r[0] and r[1] is not None]
    pages = spark.createDataFrame(kept, PAGES)
    empty = F.lit(None)
    records = pages.select(
        F.concat_ws("-", "document_id", "page_number").alias("id"), F.lit("page").alias("level"), "document_id", "page_number",
        empty.cast("int").alias("paragraph_number"), F.col("content").alias("text"), empty.cast("boolean").alias("has_tables"),
        empty.cast("boolean").alias("contains_numbers"), empty.cast("int").alias("start_offset"), empty.cast("int").alias("end_offset"))
    topics = spark.createDataFrame([], "document_id string, topics array<string>")
    index = read_index_tables(spark, build_index_tables(records, topics, 1 << 12, pages), 1 << 12)
    question = spark.createDataFrame([(1, "body of")], "qid int, text string")
    named = {(d, p) for d, h, a, b in naive_sections(kept) if "costs" in h for p in range(a, b)}

    def found(**options):
        return {(r["document_id"], r["page_number"]) for r in S.metadata_search(question, index, top=10_000, **options).collect()}

    everything = found()
    assert everything and found(section=F.col("section").contains("costs")) == everything & named
    dated = {(d, p) for d, p, t in kept if "2004 and" in t}
    assert found(year_range=(2000, 2010)) == everything & dated
    assert found(section=F.col("section").contains("costs"), year_range=(2000, 2010)) == everything & named & dated
    assert not found(year_range=(1700, 1800))
