"""Sales: sales fact with discount and channel rules, hourly sales of the last days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import discounted_value, weighted_ticket
from tidemark.functions.text import first_match
from tidemark.operators.joins import flag_in
from tidemark.operators.latest import nth_by


def sales_fact(
    sales: DataFrame, campaigns: DataFrame, coupons: DataFrame, sellers: DataFrame, channel_rules: Sequence[tuple[str, str]]
) -> DataFrame:
    """Sales with their first campaign discount, price after it, yearly mean ticket, channel and coupon check.

    ``sales``: sale_id, contract_id, client_id, seller_id, sold, price, team;
    ``campaigns``: contract_id, campaign_id, begun, percent, months.
    """
    first = nth_by(campaigns, ["contract_id"], [F.asc("begun"), F.asc("campaign_id")], 1).select(
        "contract_id", "campaign_id", "percent", "months"
    )
    priced = sales.join(first, "contract_id", "left").join(sellers, "seller_id", "left")
    percent = F.coalesce("percent", F.lit(0.0))
    fact = priced.select(
        "sale_id", "contract_id", "client_id", "sold", "price", "campaign_id", "seller",
        discounted_value("price", percent).alias("final_price"),
        weighted_ticket("price", percent, "months").alias("mean_ticket"),
        F.coalesce("months", F.lit(0)).alias("discount_months"),
        first_match("team", channel_rules, "DIGITAL").alias("channel"),
    )
    return flag_in(fact, coupons, "client_id", "coupon_valid")


def hourly_sales(events: DataFrame, sale: Column, as_of: Column, days: int, rules: Sequence[tuple[str, str]], team: str) -> DataFrame:
    """Sales per hour and channel over the last ``days`` full days before ``as_of``."""
    since, until = F.date_sub(as_of, days).cast("timestamp_ntz"), as_of.cast("timestamp_ntz")
    recent = events.where(sale & (F.col("ts") >= since) & (F.col("ts") < until))
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return recent.groupBy(hour.alias("hour"), first_match(team, rules, "DIGITAL").alias("channel")).agg(
        F.count(F.lit(1)).alias("sales"), F.count_distinct("user_id").alias("clients")
    )
