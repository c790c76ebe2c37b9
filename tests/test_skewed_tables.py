"""A third of the rows under one key, and keys cut into tiny slices: same results as the SQL."""

import shutil
from pathlib import Path

import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = Path("/root/testdata/sf0.001")
NAMES = [
    "version_numbering", "repeat_24h", "transfer_detection", "suspension_intervals", "dual_ranking", "asof_validity",
    "prev_event_max", "recurrence_90d", "clipped_days", "positional_pairing", "string_agg_sorted", "inbound_calls",
    "kpi_analytic", "dq_mutually_exclusive_ranges", "rank_within_key", "link_pairs_flags",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    if not SF.exists():
        pytest.skip("no test tables")
    out = tmp_path_factory.mktemp("skewed")
    for f in SF.glob("*.parquet"):
        if f.stem not in ("events", "orders"):
            shutil.copy(f, out / f.name)
    third = lambda key, col, hot: F.when(F.col(key) % 3 == 0, F.lit(hot)).otherwise(F.col(col)).cast("bigint")
    tables = {"events": ("event_id", "user_id", 1), "orders": ("o_orderkey", "o_custkey", 7)}
    for name, (key, col, hot) in tables.items():
        df = spark.read.parquet(str(SF / f"{name}.parquet")).withColumn(col, third(key, col, hot))
        df.toPandas().to_parquet(out / f"{name}.parquet", coerce_timestamps="us")
    spark.conf.set("spark.tidemark.hotRows", "40")
    yield str(out)
    spark.conf.unset("spark.tidemark.hotRows")


@pytest.mark.parametrize("name", NAMES)
def test_skewed(spark, skewed, name):
    assert compare(entry.queries()[name](spark, skewed), connect(skewed), entry.oracle_sql()[name]) is None
