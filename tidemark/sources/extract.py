"""Contract-driven extraction: high watermarks, bounded full loads, slices, cadences, file drops."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableContract:
    """How one source table is extracted.  No incremental column means a full read."""

    schema: str
    table: str
    cadences: Sequence[str] = ("daily",)
    incremental_col: str | None = None
    inclusive: bool = True
    full_where: str | None = None
    write_mode: str = "append"


def incremental_read(df: DataFrame, col: str | Column, hwm, inclusive: bool = True) -> DataFrame:
    """Rows at or after (or strictly after) the last loaded value; a literal watermark is pushed down."""
    c = F.col(col) if isinstance(col, str) else col
    mark = hwm if isinstance(hwm, Column) else F.lit(hwm)
    return df.where(c >= mark if inclusive else c > mark)


def full_read(df: DataFrame, predicate: str | Column | None = None) -> DataFrame:
    return df if predicate is None else df.where(predicate)


def extract(df: DataFrame, contract: TableContract, hwm=None) -> DataFrame:
    """Apply a contract: incremental above the watermark, else its bounded or plain full read."""
    if contract.incremental_col and hwm is not None:
        return incremental_read(df, contract.incremental_col, hwm, contract.inclusive)
    return full_read(df, contract.full_where)


def due_tables(contracts: Sequence[TableContract], cadence: str) -> list[TableContract]:
    """The contracts that run at this cadence."""
    return [c for c in contracts if cadence in c.cadences]


def time_slices(spark: SparkSession, start: Column, end: Column, n: int) -> DataFrame:
    """``n`` equal, adjoining half-open slices of [start, end)."""
    low = F.unix_micros(start.cast("timestamp"))
    width = F.unix_micros(end.cast("timestamp")) - low
    at = lambda i: F.timestamp_micros(low + F.floor(width * i / n)).cast("timestamp_ntz")
    return spark.range(n).select(
        F.col("id").alias("slice_no"),
        at(F.col("id")).alias("slice_start"),
        at(F.col("id") + 1).alias("slice_end"),
    )


def slice_number(col: str, start: Column, end: Column, n: int) -> Column:
    """Which of the ``n`` slices of [start, end) a time falls in; NULL outside."""
    low = F.unix_micros(start.cast("timestamp"))
    width = F.unix_micros(end.cast("timestamp")) - low
    x = F.unix_micros(F.col(col).cast("timestamp")) - low
    return F.when((x >= 0) & (x < width), F.floor(x * n / width))


def read_file_drop(
    spark: SparkSession, folder: str, prefix: str, schema: str, date_pattern: str = r"(\d{8})", date_format: str = "yyyyMMdd"
) -> DataFrame:
    """CSV drops with a name prefix; the date in the file name becomes the version column."""
    raw = spark.read.option("pathGlobFilter", f"{prefix}*").csv(folder, header=True, schema=schema)
    name = F.col("_metadata.file_name")
    found = F.regexp_extract(name, date_pattern, 1)
    return raw.select("*", F.try_to_date(found, date_format).alias("_file_generation_date"))


def jdbc_predicates(col: str, bounds: Sequence[str]) -> list[str]:
    """WHERE clauses for a partitioned ``spark.read.jdbc(predicates=...)`` that together read every row once.

    Rows before the first bound and NULLs come with the first slice, rows from the last bound on with the last.
    """
    first, last = f"{col} < '{bounds[0]}' OR {col} IS NULL", f"{col} >= '{bounds[-1]}'"
    return [first, *[f"{col} >= '{a}' AND {col} < '{b}'" for a, b in zip(bounds, bounds[1:])], last]


def read_export(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
    """Files that a warehouse or document store exported (Parquet, ORC or JSON)."""
    reader = spark.read.format(fmt).options(**(options or {}))
    return (reader.schema(schema) if schema else reader).load(path)
