"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a frequent key in a join even when the next step then shuffles again
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # merge the sessions of a frequent key before they are shuffled
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # listing the folders of a table with very many appends: few tasks of many folders each
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
    "spark.ui.enabled": "false",
}

# On a cluster an exchange begins with many partitions, which adaptive execution
# puts together as the sizes come in; it cannot split those of an aggregate or
# a window.  20,000 parts of an exchange of 10 TB hold 500 MB each.
CLUSTER = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "500",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    wide = {} if master and master.startswith("local") else CLUSTER
    for key, value in {**DEFAULTS, **wide, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
