"""Documents move while their pages finish; stalls and restarts."""

from docspark.streaming import progress as TP

REQUEST = "document_id string, total_pages int, ts timestamp"
PAGE = "document_id string, page int, ts timestamp"


def test_progress_moves_stalls_and_recovers(spark, tmp_path):
    import datetime as dt

    def at(minute):
        return dt.datetime(2025, 1, 1, 12) + dt.timedelta(minutes=minute)

    asked, done, sink = (f"file://{tmp_path}/{x}" for x in ("requests", "pages", "sink"))

    def run(requests, pages):
        spark.createDataFrame(requests, REQUEST).coalesce(1).write.mode("append").parquet(asked)
        spark.createDataFrame(pages, PAGE).coalesce(1).write.mode("append").parquet(done)
        query = TP.stream_page_progress(spark, asked, done, sink, delay="1 minute", stall_minutes=30)
        query.awaitTermination()
        assert query.exception() is None
        return {r.document_id: (r.completed_pages, r.total_pages, r.status) for r in TP.read_page_progress(spark, sink).collect()}

    first = run([("a", 3, at(0)), ("b", 2, at(0)), (None, 1, at(0))],
                [("a", 1, at(1)), ("a", 1, at(1)), ("c", 2, at(1)), ("b", None, at(1))])
    assert first == {"a": (1, 3, "running"), "b": (0, 2, "running"), "c": (1, None, "waiting")}
    second = run([("c", 2, at(3))], [("a", 2, at(4)), ("a", 3, at(4)), ("c", 1, at(4))])  # after a restart
    assert second == {"a": (3, 3, "complete"), "b": (0, 2, "running"), "c": (2, 2, "complete")}
    third = run([("z", 1, at(100))], [("z", 1, at(100))])  # time passes: b stalls, a and c stay complete
    assert third == {"a": (3, 3, "complete"), "b": (0, 2, "stalled"), "c": (2, 2, "complete"), "z": (1, 1, "complete")}
    fourth = run([], [("b", 1, at(101)), ("b", 2, at(101))])
    assert fourth["b"] == (2, 2, "complete")


def test_progress_of_documents_that_share_a_state(spark, tmp_path):
    import datetime as dt

    def at(minute):
        return dt.datetime(2025, 1, 1, 12) + dt.timedelta(minutes=minute)

    asked, done, sink = (f"file://{tmp_path}/{x}" for x in ("requests", "pages", "sink"))

    def run(requests, pages):
        spark.createDataFrame(requests, REQUEST).coalesce(1).write.mode("append").parquet(asked)
        spark.createDataFrame(pages, PAGE).coalesce(1).write.mode("append").parquet(done)
        query = TP.stream_page_progress(spark, asked, done, sink, delay="1 minute", stall_minutes=30, groups=2)
        query.awaitTermination()
        assert query.exception() is None
        return {r.document_id: (r.completed_pages, r.total_pages, r.status) for r in TP.read_page_progress(spark, sink).collect()}

    many = [f"d{i}" for i in range(200)]
    first = run([(d, 2, at(0)) for d in many], [(d, 1, at(1)) for d in many])
    assert first == {d: (1, 2, "running") for d in many}
    later = run([], [(d, 2, at(20)) for d in many[:50]])  # some end
    assert later == {d: (2, 2, "complete") if d in many[:50] else (1, 2, "running") for d in many}
    silent = run([("late", 1, at(45))], [("late", 1, at(45))])  # 44 minutes of silence for some, 25 for the others
    assert silent == {d: (2, 2, "complete") if d in many[:50] else (1, 2, "stalled") for d in many} | {"late": (1, 1, "complete")}
    back = run([], [(many[60], 2, at(46))])
    assert back == silent | {many[60]: (2, 2, "complete")}


def test_progress_calls_python_once_per_group_of_documents(spark, tmp_path, monkeypatch):
    asked, done, sink = (f"file://{tmp_path}/{x}" for x in ("requests", "pages", "sink"))
    spark.sql("SELECT 'd' || id AS document_id, 1 AS total_pages, timestamp '2025-01-01' AS ts FROM range(20000)").write.parquet(asked)
    spark.sql("SELECT 'd' || id AS document_id, 1 AS page, timestamp '2025-01-01' AS ts FROM range(20000)").write.parquet(done)
    folder = tmp_path / "calls"
    folder.mkdir()
    follow = TP.follow

    def counted(stall_ms):
        step, to = follow(stall_ms), str(folder)

        def run(key, events, state):
            import uuid

            open(f"{to}/{uuid.uuid4().hex}", "w").close()
            yield from step(key, events, state)

        return run

    monkeypatch.setattr(TP, "follow", counted)
    query = TP.stream_page_progress(spark, asked, done, sink)
    query.awaitTermination()
    assert query.exception() is None
    rows = TP.read_page_progress(spark, sink)
    assert rows.count() == rows.where("status = 'complete' AND completed_pages = 1").count() == 20000
    assert len(list(folder.iterdir())) <= 4096  # a call per document before
