"""Structured Streaming versions of the ingest and event-log operators."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_version, nth_by
from tidemark.sources.lake import children, read_text


def drop_folder(spark: SparkSession, folder: str, schema, fmt: str = "parquet", files_per_batch: int = 100) -> DataFrame:
    """A folder that receives files, read as a stream (stands for a queue or file drop)."""
    return (
        spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(folder)
    )


def run_to_table(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> None:
    """Process everything available now into an append-only Parquet table."""
    writer = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start(path).awaitTermination()


def stream_latest(
    stream: DataFrame, path: str, keys: Sequence[str], newest_by: Sequence[str], checkpoint: str
) -> None:
    """Append the newest row per key of every micro-batch to a version log.

    A batch costs what the batch holds, not what the table holds: the newest row
    over all batches is taken on reading (``read_latest``).  Each batch owns a
    folder, so one that runs again after a failure replaces its own rows.
    """

    def append(batch: DataFrame, epoch: int) -> None:
        newest = latest_version(batch, keys, newest_by)
        newest.write.mode("overwrite").parquet(f"{path}/_batch={epoch}")

    query = (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_latest(spark: SparkSession, path: str, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """Newest row per key over all batches of a version log."""
    log = spark.read.parquet(f"{path}/_batch=*")
    return latest_version(log, keys, newest_by)


def compact_log(
    spark: SparkSession, path: str, compacted: str, keys: Sequence[str], newest_by: Sequence[str]
) -> None:
    """Write the log's newest rows as the single batch of another log, to read from and append to instead."""
    read_latest(spark, path, keys, newest_by).write.mode("overwrite").parquet(f"{compacted}/_batch=-1")


def dedupe_to_log(stream: DataFrame, path: str, row_id: str, first_by: Sequence[str], checkpoint: str) -> None:
    """Append the first row per id of every micro-batch to a log, however late it comes.

    Replays across batches go on reading (``read_deduped``), so no state is kept and no late row is lost.
    """

    def append(batch: DataFrame, epoch: int) -> None:
        nth_by(batch, [row_id], [F.col(c).asc_nulls_last() for c in first_by], 1).write.mode("overwrite").parquet(f"{path}/_batch={epoch}")

    query = (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_deduped(spark: SparkSession, path: str, row_id: str, first_by: Sequence[str]) -> DataFrame:
    """One row per id over all batches of the log: the first by ``first_by``."""
    log = spark.read.parquet(f"{path}/_batch=*")
    return nth_by(log, [row_id], [F.col(c).asc_nulls_last() for c in first_by], 1)


def tumbling_counts(stream: DataFrame, ts: str, keys: Sequence[str], width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Counts per closed window and key; rows later than the delay are left out.

    Windows still open when the stream ends are not there; ``whole_counts`` adds them from a batch read.
    """
    counted = stream.withWatermark(ts, delay).groupBy(F.window(ts, width), *keys).agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "rows")


def open_counts(rows: DataFrame, ts: str, keys: Sequence[str], since: Column, width: str = "1 hour") -> DataFrame:
    """The counts of the windows that end after ``since``, from the stored rows: a stream's last windows."""
    counted = rows.groupBy(F.window(ts, width), *keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("window.end") > since)
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "rows")


def handed_over(spark: SparkSession, checkpoint: str) -> Column:
    """Up to which time a stream has closed its windows: the watermark of the last batch that it committed.

    It is read from the checkpoint, which says what was written even if the driver was lost right after.  Before
    the first batch nothing is closed.
    """
    done = [int(n) for n, _ in children(spark, f"{checkpoint}/commits") if n.isdigit()]
    if not done:
        return F.timestamp_millis(F.lit(0))
    batch = read_text(spark, f"{checkpoint}/offsets/{max(done)}").split("\n")[1]
    return F.timestamp_millis(F.lit(json.loads(batch)["batchWatermarkMs"]))


def whole_counts(
    closed: DataFrame, rows: DataFrame, ts: str, keys: Sequence[str], closed_until: Column, width: str = "1 hour"
) -> DataFrame:
    """All windows, each once: those the stream has closed, and the others counted from the stored rows.

    ``closed`` is what ``tumbling_counts`` wrote, ``closed_until`` its hand-over (``handed_over``).  Rows that the stream left
    out as too late belong to closed windows and stay out.
    """
    return closed.unionByName(open_counts(rows, ts, keys, closed_until, width))


def sessions(stream: DataFrame, ts: str, key: str, gap: str = "24 hours", delay: str = "1 hour") -> DataFrame:
    """Contacts of a key that follow each other within the gap, as closed sessions; open ones come when they close."""
    grouped = stream.withWatermark(ts, delay).groupBy(F.session_window(ts, gap), key)
    return grouped.agg(F.count(F.lit(1)).alias("contacts")).select(
        key, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "contacts"
    )


def open_sessions(closed: DataFrame, rows: DataFrame, ts: str, key: str, closed_until: Column, gap: str = "24 hours") -> DataFrame:
    """The sessions that a stream has not closed yet, from the stored rows.

    An open session begins after the last closed one of its key, so only rows since then are looked at; what ends
    by ``closed_until`` was closed, or left out as too late.
    """
    last = closed.groupBy(F.col(key).alias("_k")).agg(F.max("session_end").alias("_until"))
    joined = rows.select(ts, key).join(last, F.col(key).eqNullSafe(F.col("_k")), "left")
    since = joined.where(F.col("_until").isNull() | (F.col(ts) >= F.col("_until")))
    # the end is computed from the rows: a filter on the window's own end would be pushed below the merging of sessions
    grouped = since.groupBy(F.session_window(ts, gap), key).agg(F.count(F.lit(1)).alias("contacts"), F.max(ts).alias("_last"))
    found = grouped.select(
        key, F.col("session_window.start").alias("session_start"), (F.col("_last") + F.expr(f"interval {gap}")).alias("session_end"), "contacts"
    )
    return found.where(F.col("session_end") > closed_until)


def whole_sessions(closed: DataFrame, rows: DataFrame, ts: str, key: str, closed_until: Column, gap: str = "24 hours") -> DataFrame:
    """All sessions, each once: those the stream has closed and those still open."""
    return closed.unionByName(open_sessions(closed, rows, ts, key, closed_until, gap))
