"""Columns that follow from arrays of (kind, start, end)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def digest(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, and all spans as text."""
    joined = lambda column: F.array_join(
        F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    counts = [count(kind).alias(f"n_{kind}") for kind in base]
    own = F.filter("spans", lambda s: s["kind"].isin(*base))
    return found.select(
        "doc_id", *counts, F.sha2(joined(own).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
