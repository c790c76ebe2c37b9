"""Voluntary churn: monthly grid per contract with look-back counts, payment recency and clusters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import days_between, whole_months_between
from tidemark.functions.text import bucketize, rule_ladder, speed_mbps
from tidemark.operators.joins import asof_last, lookback_counts
from tidemark.operators.reshape import month_ends
from tidemark.operators.skew import parts_for

TENURE = ([3, 6, 12, 24], ["0-3", "4-6", "7-12", "13-24", "25+"])
RECENCY = ([30, 60, 90, 120, 150], ["30", "60", "90", "120", "150", "150+"])


LOYALTY = ([3, 6], ["up to 3 months", "4-6 months", "over 6 months"])
POSITION = ([4, 10, 15, 20], ["under 5", "5-10", "11-15", "16-20", "over 20"])


def churn_grid(
    contracts: DataFrame, contacts: DataFrame, invoices: DataFrame, first: Column, last: Column, kinds: Mapping[str, Column],
    days: int = 60, *, loyalty: DataFrame, services: DataFrame, slow: float = 300, above: int = 5,
) -> DataFrame:
    """One row per contract and month end while it lived.

    The months are exploded per contract; contacts are looked back ``days`` days
    under each condition, and the last payment and invoice are those as of the month end.
    ``loyalty`` (contract_id, loyal_until) binds a contract as long as its greatest end is not
    before the month end, so one maximum per contract serves all its months.  ``services``
    (contract_id, speed, final_price, list_price; a row per contract) says how fast and how far above its list
    price a contract is.
    """
    bound = loyalty.groupBy("contract_id").agg(F.max("loyal_until").alias("_until"))
    served = services.select(
        "contract_id", speed_mbps("speed").alias("mbps"), F.round(F.col("final_price") - F.col("list_price")).cast("long").alias("above")
    )
    lived = (F.col("activated") <= F.col("ref")) & (F.col("cancelled").isNull() | (F.col("cancelled") >= F.trunc("ref", "MM")))
    months = F.explode(month_ends(first, last)).alias("ref")
    keys = contracts.select("contract_id", "activated", "cancelled", months).where(lived).select("contract_id", "ref")
    # what a contract has is joined once for all its months
    told = contracts.join(bound, "contract_id", "left").join(served, "contract_id", "left")
    grid = told.select("contract_id", "segment", "balance", "activated", "cancelled", "_until", "mbps", "above", months).where(lived)
    counts = lookback_counts(keys, contacts, ["contract_id"], "ref", "day", days, kinds)
    paid = invoices.where(F.col("paid_on").isNotNull()).select("contract_id", "paid_on")
    last_paid = asof_last(keys, paid, ["contract_id"], "ref", "paid_on", "last_payment")
    last_issued = asof_last(keys, invoices.select("contract_id", "issued"), ["contract_id"], "ref", "issued", "last_invoice")
    # the joins work in parts that do not grow with the rows
    on = ["contract_id", "ref"]
    parts = parts_for(4 * keys.count())
    wide = grid.repartition(parts, *on)
    for part in (counts, last_paid, last_issued):
        wide = wide.join(part.repartition(parts, *on), on, "left")
    wide = wide.withColumn("loyal_until", F.when(F.col("_until") >= F.col("ref"), F.col("_until")))
    since = days_between("last_payment", "ref")
    flags = {f"{n}_flag": (F.col(n) >= 1).cast("int") for n in kinds}
    repeats = {f"{n}_repeat": (F.col(n) > 1).cast("int") for n in kinds}
    no = F.lit(False)
    out = F.coalesce(F.col("above") >= above, no) | F.coalesce(F.col("mbps") < slow, no)
    return wide.select(
        "contract_id", "ref", "segment",
        (F.trunc("cancelled", "MM") == F.trunc("ref", "MM")).alias("_left"),
        bucketize(whole_months_between("activated", "ref"), *TENURE).alias("tenure"),
        bucketize("balance", [0, 2500, 5000, 7500], ["A", "B", "C", "D", "E"]).alias("price_band"),
        bucketize(since, *RECENCY, missing="none").alias("payment_band"),
        *kinds,
        *[c.alias(n) for n, c in {**flags, **repeats}.items()],
        sum(flags.values(), F.lit(0)).alias("flags_total"),
        "loyal_until", bucketize(whole_months_between("ref", "loyal_until"), *LOYALTY, missing="none").alias("loyalty"),
        "mbps", "above", bucketize("above", *POSITION).alias("price_position"), out.cast("int").alias("out_of_position"), "last_invoice",
    ).select("*", F.coalesce("_left", F.lit(False)).cast("int").alias("left_in_month")).drop("_left")


def churn_cluster(grid: DataFrame, repeat_order: Sequence[tuple[str, str]]) -> DataFrame:
    """Cluster codes per grid row: by number of flags, by the first repeated kind of contact, by loyalty and position."""
    flags, old = F.col("flags_total"), F.col("tenure").isin("25+", "13-24", "7-12")
    main = rule_ladder(
        [
            ((flags == 0) & old & (F.col("price_band") == "A"), "1.1"),
            ((flags == 0) & old & (F.col("price_band") == "B"), "1.2"),
            ((flags == 0) & (F.col("price_band") == "E"), "1.4"),
            (flags == 0, "1.5"),
            (flags == 1, "2.1"),
            (flags == 2, "2.2"),
        ],
        "2.3",
    )
    repeated = rule_ladder([(F.col(c) == 1, code) for c, code in repeat_order])
    free, fair = F.col("loyalty") == "none", F.col("out_of_position") == 0
    tied = F.concat(F.lit("3.1."), F.when(free, "1").otherwise("2"), F.when(fair, ".1").otherwise(".2"))
    return grid.select(
        "contract_id", "ref", main.alias("cluster"), repeated.alias("repeat_cluster"), tied.alias("loyalty_cluster")
    )
