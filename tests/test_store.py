"""Index builds are explicit, apart from each other, and shared only within a session."""

from pyspark.sql import functions as F

from docspark.plans.store import build_index_tables, read_index_tables, session_index

SCHEMA = ("id string, level string, document_id string, page_number int, paragraph_number int, text string, "
          "has_tables boolean, contains_numbers boolean, start_offset int, end_offset int")


def test_builds_have_their_own_folders_and_sessions_reuse_theirs(spark):
    records = spark.createDataFrame([("d_doc", "document", "d", None, None, "alpha beta", None, False, None, None)], SCHEMA)
    topics = spark.createDataFrame([("d", ["alpha"])], "document_id string, topics array<string>")
    first, second = build_index_tables(records, topics, 64), build_index_tables(records, topics, 64)
    assert first != second
    index = read_index_tables(spark, first, 64)
    assert index.vectors.filter(F.col("level") == "document").count() == 2
    assert index.norms.first()["n2"] == 2 and index.about("alpha").count() == 1 and index.about("x").count() == 0
    builds = []

    def build():
        builds.append(1)
        return records, topics

    for key in ("one", "one", "two"):
        session_index(spark, f"test-{key}", build, 64)
    assert len(builds) == 2
