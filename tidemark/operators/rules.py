"""Ordered rules as data: the first that holds counts, and one pass says what each rule takes and hides."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    tag: str
    condition: Column


def rule_table(rows: Iterable[tuple[int, str, str]]) -> list[Rule]:
    """Rules out of a table of (order, condition as SQL, tag)."""
    return [Rule(tag, F.expr(condition)) for _, condition, tag in sorted(rows, key=lambda r: r[0])]


def rule_number(rules: Sequence[Rule]) -> Column:
    """Number, from 1, of the first rule that holds; NULL if none does."""
    out = F
    for i, rule in enumerate(rules):
        out = out.when(rule.condition, F.lit(i + 1))
    return out.otherwise(None)


def tag_of(number: Column, rules: Sequence[Rule], default: str | None = None) -> Column:
    return F.coalesce(F.get(F.array(*[F.lit(r.tag) for r in rules]), number - 1), F.lit(default))


def first_rule(rules: Sequence[Rule], default: str | None = None) -> Column:
    """Tag of the first rule that holds."""
    return tag_of(rule_number(rules), rules, default)


def first_rule_per_key(
    df: DataFrame, keys: Sequence[str], rules: Sequence[Rule], out: str, default: str | None = None
) -> DataFrame:
    """One tag per key: that of the first rule which holds on any of its rows.

    Rows meet as rule numbers and only the smallest is kept, map-side, so a key may have any number of rows.
    """
    lowest = df.select(*keys, rule_number(rules).alias("_no")).groupBy(*keys).agg(F.min("_no").alias("_no"))
    return lowest.select(*keys, tag_of(F.col("_no"), rules, default).alias(out))


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: rows it takes, and rows on which it holds but an earlier one counts (shadowed).

    All rules are counted in one aggregation of one scan.
    """
    holds = F.array(*[F.coalesce(r.condition, F.lit(False)) for r in rules])
    judged = df.select(holds.alias("_holds"), F.array_position(holds, True).alias("_no"))
    counts = judged.agg(
        *[F.count_if(F.col("_no") == i + 1).alias(f"_taken{i}") for i in range(len(rules))],
        *[F.count_if(F.col("_holds")[i]).alias(f"_held{i}") for i in range(len(rules))],
    )
    rows = [
        F.struct(
            F.lit(i + 1).alias("rule"), F.lit(r.tag).alias("tag"), F.col(f"_taken{i}").alias("taken"),
            (F.col(f"_held{i}") - F.col(f"_taken{i}")).alias("shadowed"),
        )
        for i, r in enumerate(rules)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")
