"""Datasets behind the report visuals, built on the star joins and the measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfcast.operators.measures import (
    demand_measures, planning_measures, select_demand, select_plan,
)

OVERVIEW_FAMILIES = 10
TREND_FAMILIES = 4


def daily_demand(daily: DataFrame, **selection) -> DataFrame:
    return demand_measures(daily, ["date"], ["total_demand"], **selection)


def top_families(daily: DataFrame, count: int = OVERVIEW_FAMILIES, **selection) -> DataFrame:
    """The families with the highest demand in the selection; ties go by name."""
    return (
        demand_measures(daily, ["family"], ["total_demand"], **selection)
        .orderBy(F.desc("total_demand"), "family")
        .limit(count)
    )


def weekly_top_families(star: DataFrame, count: int = TREND_FAMILIES, **selection) -> DataFrame:
    """Weekly demand of the top families, summed from daily rows so date filters stay exact.

    One read of the star: a family carries its weeks, at most some 30,000 by the limits of dates,
    while the leaders are chosen by their totals.
    """
    weekly = (
        select_demand(star, **selection)
        .groupBy("week_start", "family")
        .agg(F.sum("sales").alias("total_demand"))
    )
    leaders = (
        weekly.groupBy("family")
        .agg(
            F.sum("total_demand").alias("family_demand"),
            F.collect_list(F.struct("week_start", "total_demand")).alias("weeks"),
        )
        .orderBy(F.desc("family_demand"), "family")
        .limit(count)
    )
    return leaders.select("family", F.inline("weeks")).select("week_start", "family", "total_demand")


def weekday_demand(star: DataFrame, **selection) -> DataFrame:
    return (
        demand_measures(star, ["weekday_number", "weekday"], ["average_daily_demand"], **selection)
        .orderBy("weekday_number")
    )


def day_type_demand(daily: DataFrame, **selection) -> DataFrame:
    return demand_measures(daily, ["day_type"], ["average_daily_demand"], **selection)


def store_demand(daily: DataFrame, **selection) -> DataFrame:
    return (
        demand_measures(daily, ["store_nbr"], ["total_demand"], **selection)
        .orderBy(F.desc("total_demand"), "store_nbr")
    )


def family_promotion(daily: DataFrame, **selection) -> DataFrame:
    wanted = [
        "average_promoted_row_demand", "average_nonpromoted_row_demand", "promotion_lift",
        "promoted_row_count", "nonpromoted_row_count",
    ]
    return demand_measures(daily, ["family"], wanted, **selection).select("family", *wanted)


def risk_series(plan: DataFrame, **selection) -> DataFrame:
    return planning_measures(plan, ["risk"], **selection).select("risk", "planning_series_count")


def planning_detail(plan: DataFrame, **selection) -> DataFrame:
    """Plan rows of a selection by store, family, risk class and stock source."""
    return select_plan(plan, **selection).select(
        "store_nbr", "family", "recent_average", "demand_std", "coverage", "forecast_quality",
        "inventory_source", "inventory_on_hand", "days_of_supply", "safety_stock",
        "reorder_point", "target_stock_level", "reorder_quantity", "risk", "forecast_date",
    )
