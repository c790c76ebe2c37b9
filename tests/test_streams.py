from datetime import datetime, timedelta


from pyspark.sql import functions as F

from tidemark.streaming import streams

T0 = datetime(2024, 1, 1)
SCHEMA = "id int, user int, ts timestamp, kind string"


def drop(spark, folder, name, rows):
    data = [(i, u, T0 + timedelta(minutes=m), k) for i, u, m, k in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


def live(spark, folder):
    return streams.drop_folder(spark, f"{folder}/*", SCHEMA, files_per_batch=1)


def test_latest_over_batches_and_compaction(spark, tmp_path):
    src, log = str(tmp_path / "in"), str(tmp_path / "log")
    drop(spark, src, "a", [(1, 1, 0, "x"), (2, 2, 5, "x")])
    run = lambda: streams.stream_latest(live(spark, src), log, ["user"], ["ts", "id"], str(tmp_path / "cp"))
    run()
    drop(spark, src, "b", [(3, 1, 10, "y"), (4, 2, 1, "old")])
    run()
    run()  # nothing new
    newest = lambda path: sorted((r.user, r.id) for r in streams.read_latest(spark, path, ["user"], ["ts", "id"]).collect())
    assert newest(log) == [(1, 3), (2, 2)]
    streams.compact_log(spark, log, str(tmp_path / "compact"), ["user"], ["ts", "id"])
    assert newest(str(tmp_path / "compact")) == [(1, 3), (2, 2)]


def test_dedupe_across_batches_keeps_late_rows(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    day = 24 * 60
    for name, rows in (("a", [(1, 1, 10 * day, "x")] * 2), ("b", [(3, 1, 11 * day, "x"), (1, 1, 10 * day, "x")]), ("c", [(4, 1, 12 * day, "x")]), ("d", [(2, 1, day, "x")])):
        drop(spark, src, name, rows)
        streams.dedupe_to_log(live(spark, src), out, "id", ["ts"], str(tmp_path / "cp"))
    assert sorted(r.id for r in streams.read_deduped(spark, out, "id", ["ts"]).collect()) == [1, 2, 3, 4]


def test_open_windows_come_from_a_batch_read(spark):
    rows = spark.createDataFrame([(1, 1, T0 + timedelta(minutes=m), "x") for m in (0, 70, 80)], SCHEMA)
    got = streams.open_counts(rows, "ts", ["kind"], F.lit(T0 + timedelta(minutes=61)))
    assert [(r.window_start, r.rows) for r in got.collect()] == [(T0 + timedelta(hours=1), 2)]


def test_windows_close_after_the_delay_and_leave_late_rows_out(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    stream = streams.tumbling_counts(live(spark, src), "ts", ["kind"], "1 hour", "10 minutes")
    drop(spark, src, "a", [(1, 1, 0, "x"), (2, 1, 30, "x"), (3, 1, 75, "x")])
    streams.run_to_table(stream, out, str(tmp_path / "cp"))
    drop(spark, src, "b", [(4, 1, 20, "x"), (5, 1, 150, "x")])  # id 4 is too late
    streams.run_to_table(stream, out, str(tmp_path / "cp"))
    got = sorted((r.window_start, r.rows) for r in spark.read.parquet(out).collect())
    assert got == [(T0, 2), (T0 + timedelta(hours=1), 1)]


def test_sessions(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    stream = streams.sessions(live(spark, src), "ts", "user", "30 minutes", "1 minute")
    drop(spark, src, "a", [(1, 1, 0, "x"), (2, 1, 20, "x"), (3, 1, 90, "x"), (4, 2, 300, "x")])
    streams.run_to_table(stream, out, str(tmp_path / "cp"))
    got = sorted((r.user, r.session_start, r.contacts) for r in spark.read.parquet(out).select("user", "session_start", "contacts").collect())
    assert got == [(1, T0, 2), (1, T0 + timedelta(minutes=90), 1)]


def test_whole_results_across_a_restart(spark, tmp_path):
    """Closed windows and sessions from the stream, open ones from the log: each once, before and after a restart."""
    src = str(tmp_path / "in")
    flow = {
        "counts": lambda: streams.tumbling_counts(live(spark, src), "ts", ["kind"], "1 hour", "10 minutes"),
        "sessions": lambda: streams.sessions(live(spark, src), "ts", "user", "30 minutes", "1 minute"),
    }
    out = {n: (str(tmp_path / n), str(tmp_path / f"{n}-cp")) for n in flow}

    def whole(name):
        path, checkpoint = out[name]
        until = streams.handed_over(spark, checkpoint)
        log = spark.read.schema(SCHEMA).parquet(f"{src}/*")
        if name == "counts":
            df = streams.whole_counts(spark.read.parquet(path), log, "ts", ["kind"], until).select("window_start", "kind", "rows")
        else:
            df = streams.whole_sessions(spark.read.parquet(path), log, "ts", "user", until, "30 minutes").select("user", "session_start", "contacts")
        return sorted(map(tuple, df.collect()))

    at = lambda m: T0 + timedelta(minutes=m)
    drop(spark, src, "a", [(1, 1, 0, "x"), (2, 1, 40, "x"), (3, 1, 75, "x"), (4, 2, 130, "y"), (5, 2, 140, "y")])
    for name, stream in flow.items():
        streams.run_to_table(stream(), *out[name])
    assert whole("counts") == [(at(0), "x", 2), (at(60), "x", 1), (at(120), "y", 2)]
    assert whole("sessions") == [(1, at(0), 1), (1, at(40), 1), (1, at(75), 1), (2, at(130), 2)]
    drop(spark, src, "b", [(6, 2, 155, "y"), (7, 1, 400, "x"), (8, 1, 410, "z")])
    for name, stream in flow.items():  # a new query goes on from the checkpoint
        streams.run_to_table(stream(), *out[name])
    assert whole("counts") == [(at(0), "x", 2), (at(60), "x", 1), (at(120), "y", 3), (at(360), "x", 1), (at(360), "z", 1)]
    assert whole("sessions") == [(1, at(0), 1), (1, at(40), 1), (1, at(75), 1), (1, at(400), 2), (2, at(130), 3)]
    for name, stream in flow.items():  # nothing new
        streams.run_to_table(stream(), *out[name])
    assert len(whole("counts")) == 5 and len(whole("sessions")) == 5
    assert streams.handed_over(spark, str(tmp_path / "none"))._jc is not None
