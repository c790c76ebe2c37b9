"""Declarative stage views: latest version, renames, safe casts and null markers from one spec."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import NULL_MARKERS, null_markers
from tidemark.operators.latest import latest_version


@dataclass(frozen=True)
class StageSpec:
    """``columns`` maps source column to (output name, type or None to keep)."""

    columns: Mapping[str, tuple[str, str | None]]
    keys: Sequence[str] = ()
    newest_by: Sequence[str] = ()
    marked_null: Sequence[str] = ()
    trimmed: Sequence[str] = ()
    distinct: bool = False
    markers: Sequence[str] = field(default=NULL_MARKERS)


def stage(df: DataFrame, spec: StageSpec) -> DataFrame:
    newest = latest_version(df, spec.keys, spec.newest_by) if spec.keys else df
    out = []
    for source, (name, kind) in spec.columns.items():
        c = F.col(source)
        if source in spec.marked_null:
            c = null_markers(c, spec.markers)
        if source in spec.trimmed:
            c = F.nullif(F.trim(c), F.lit(""))
        out.append((c.try_cast(kind) if kind else c).alias(name))
    shaped = newest.select(*out)
    return shaped.distinct() if spec.distinct else shaped
