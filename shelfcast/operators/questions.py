"""The four standing business questions over the published marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfcast.functions.columns import display_round, ratio
from shelfcast.operators.advice import MIN_PROMOTION_ROWS
from shelfcast.operators.marts import lift_percent
from shelfcast.operators.planning import HEALTHY, INSUFFICIENT, MONITOR, REORDER


def store_share(stores: DataFrame) -> DataFrame:
    """Which stores account for demand? The total is a scalar subquery, not a window."""
    overall = stores.agg(F.sum("total_sales")).scalar()
    volume = F.col("total_sales")
    return stores.orderBy(F.desc("total_sales"), "store_nbr").select(
        "store_nbr",
        "observed_days",
        display_round(volume, 2).alias("demand_volume"),
        display_round(F.col("average_daily_sales"), 2).alias("average_daily_demand"),
        display_round(ratio(100.0 * volume, overall), 1).alias("volume_share_pct"),
    )


def promotion_within_store(daily: DataFrame) -> DataFrame:
    """Is promoted demand higher within a store and family? Needs five rows on both sides."""
    promoted, volume = F.col("promoted"), F.col("sales")
    groups = daily.groupBy("store_nbr", "family").agg(
        F.count_if(promoted).alias("promoted_rows"),
        F.count_if(~promoted).alias("nonpromoted_rows"),
        F.avg(F.when(promoted, volume)).alias("promoted_mean"),
        F.avg(F.when(~promoted, volume)).alias("nonpromoted_mean"),
    )
    enough = F.least("promoted_rows", "nonpromoted_rows") >= MIN_PROMOTION_ROWS
    difference = lift_percent(F.col("promoted_mean"), F.col("nonpromoted_mean"))
    return (
        groups.where(enough)
        .orderBy("family", "store_nbr")
        .select(
            "store_nbr", "family", "promoted_rows", "nonpromoted_rows", "promoted_mean",
            "nonpromoted_mean", display_round(difference, 1).alias("descriptive_difference_pct"),
        )
    )


def family_variability(volatility: DataFrame) -> DataFrame:
    """Which families vary most relative to their mean? Undefined ratios come last."""
    return volatility.orderBy(F.desc_nulls_last("coefficient_of_variation"), "family").select(
        "family",
        display_round(F.col("daily_mean"), 2).alias("average_daily_demand"),
        display_round(F.col("daily_std"), 2).alias("daily_standard_deviation"),
        display_round(F.col("coefficient_of_variation"), 3).alias("cv"),
    )


def review_queue(plan: DataFrame) -> DataFrame:
    """What belongs in the review queue? Everything not healthy, missing history first."""
    risk = F.col("risk")
    urgency = (
        F.when(risk == INSUFFICIENT, 1).when(risk == REORDER, 2).when(risk == MONITOR, 3).otherwise(4)
    )
    return (
        plan.where(risk != HEALTHY)
        .orderBy(urgency, "store_nbr", "family")
        .select(
            "store_nbr", "family", "forecast_date", "inventory_source", "coverage", "risk",
            display_round(F.col("inventory_on_hand"), 1).alias("stock"),
            display_round(F.col("reorder_point"), 1).alias("reorder_point"),
            display_round(F.col("reorder_quantity"), 1).alias("scenario_quantity"),
        )
    )


def top_store_share(stores: DataFrame) -> DataFrame:
    """The store with the highest volume and its unrounded share of the total."""
    overall = stores.agg(F.sum("total_sales")).scalar()
    return (
        stores.orderBy(F.desc("total_sales"), "store_nbr")
        .limit(1)
        .select("store_nbr", "total_sales", ratio(F.col("total_sales"), overall).alias("share"))
    )
