from pyspark.sql import functions as F

from tidemark.queries.registry import query
from tidemark.sources.lake import work_dir
from tidemark.streaming import streams


def _live(t):
    """The events table read as a stream of its files."""
    return t.spark.readStream.schema(t.events.schema).parquet(f"{t.sf_dir}/events.parquet*")


@query(
    "stream_latest_version",
    """SELECT user_id, event_id, ts, event_type FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(t):
    root = work_dir(t.spark, "stream-latest")
    rows, keys, order = _live(t).select("user_id", "event_id", "ts", "event_type"), ["user_id"], ["ts", "event_id"]
    streams.stream_latest(rows, f"{root}/log", keys, order, f"{root}/checkpoint")
    return streams.read_latest(t.spark, f"{root}/log", keys, order)


@query("stream_dedupe", "SELECT event_id, user_id, ts, event_type FROM events")
def _(t):
    root = work_dir(t.spark, "stream-dedupe")
    seen = _live(t).withColumn("ts", F.col("ts").cast("timestamp"))
    # every row arrives twice
    twice = seen.select("event_id", "user_id", "ts", "event_type", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")).drop("copy")
    streams.dedupe_to_log(twice, f"{root}/out", "event_id", ["ts"], f"{root}/checkpoint")
    found = streams.read_deduped(t.spark, f"{root}/out", "event_id", ["ts"])
    return found.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "stream_hourly_counts",
    """WITH h AS (SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS rows FROM events GROUP BY 1, 2)
       SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, rows FROM h
       WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
)
def _(t):
    root = work_dir(t.spark, "stream-hourly")
    seen = _live(t).withColumn("ts", F.col("ts").cast("timestamp"))
    streams.run_to_table(streams.tumbling_counts(seen, "ts", ["event_type"]), f"{root}/out", f"{root}/checkpoint")
    out = t.spark.read.parquet(f"{root}/out")
    return out.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"), "event_type", "rows",
    )


@query(
    "stream_sessions",
    """WITH s AS (SELECT *, sum(CASE WHEN p IS NULL OR ts >= p + INTERVAL 24 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS n
                  FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events))
       SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 24 HOUR AS session_end, count(*) AS contacts FROM s GROUP BY user_id, n
       HAVING session_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
)
def _(t):
    root = work_dir(t.spark, "stream-sessions")
    seen = _live(t).withColumn("ts", F.col("ts").cast("timestamp"))
    streams.run_to_table(streams.sessions(seen, "ts", "user_id"), f"{root}/out", f"{root}/checkpoint")
    out = t.spark.read.parquet(f"{root}/out")
    return out.select(
        "user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
        F.col("session_end").cast("timestamp_ntz").alias("session_end"), "contacts",
    )


@query(
    "stream_hourly_whole",
    """SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS rows
       FROM events GROUP BY ALL""",
)
def _(t):
    """Closed windows from the stream, open ones from the table: all windows."""
    root = work_dir(t.spark, "stream-hourly")
    seen = _live(t).withColumn("ts", F.col("ts").cast("timestamp"))
    streams.run_to_table(streams.tumbling_counts(seen, "ts", ["event_type"]), f"{root}/out", f"{root}/checkpoint")
    rows = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    until = streams.handed_over(t.spark, f"{root}/checkpoint")
    out = streams.whole_counts(t.spark.read.parquet(f"{root}/out"), rows, "ts", ["event_type"], until)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query(
    "stream_sessions_whole",
    """WITH s AS (SELECT *, sum(CASE WHEN p IS NULL OR ts >= p + INTERVAL 24 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS n
                  FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events))
       SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 24 HOUR AS session_end, count(*) AS contacts FROM s GROUP BY user_id, n""",
)
def _(t):
    """Closed sessions from the stream, open ones from the table: all sessions."""
    root = work_dir(t.spark, "stream-sessions")
    seen = _live(t).withColumn("ts", F.col("ts").cast("timestamp"))
    streams.run_to_table(streams.sessions(seen, "ts", "user_id"), f"{root}/out", f"{root}/checkpoint")
    rows = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    until = streams.handed_over(t.spark, f"{root}/checkpoint")
    out = streams.whole_sessions(t.spark.read.parquet(f"{root}/out"), rows, "ts", "user_id", until)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})
