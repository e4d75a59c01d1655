"""Daily, weekly, store, family, promotion and volatility marts.

``sales`` means the validated fact, one row per date, store and family. ``daily`` means
the same rows with the promotion flag and calendar features of ``daily_sales``. Store and
family marts start from per-day sums, which keep their distinct dates exact: a distinct
date is a row there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.functions.columns import day_type, ratio, week_start, weekday_number
from shelfcast.operators.quality import with_promotion_column
from shelfcast.schemas import GOLD_COLUMNS


def daily_sales(sales: DataFrame) -> DataFrame:
    """Typed fact plus a three-valued promotion flag (null when the count is unknown)."""
    date = F.col("date")
    return (
        sales.withColumns({"date": date.cast("date"), "promoted": F.col("onpromotion") > 0})
        .withColumns({"weekday_number": weekday_number(date), "day_type": day_type(date)})
        .select(*GOLD_COLUMNS["daily_sales"])
    )


def weekly_sales(daily: DataFrame) -> DataFrame:
    """Volume and row count per Monday week and series; boundary weeks may be partial."""
    return daily.groupBy(week_start(F.col("date")).alias("week"), "store_nbr", "family").agg(
        F.sum("sales").alias("sales"), F.count(F.lit(1)).alias("observed_days")
    )


def store_days(daily: DataFrame) -> DataFrame:
    """Volume per store and date: all that the store figures need from the fact."""
    return daily.groupBy("date", "store_nbr").agg(F.sum("sales").alias("sales"))


def family_days(daily: DataFrame) -> DataFrame:
    """Volume per family and date, split by promotion.

    Family totals, volatility, promotion impact and the run totals all start here, so a
    run reads the fact once for them. Its size is families times dates.
    """
    promoted = F.col("promoted")
    return daily.groupBy("date", "family").agg(
        F.sum("sales").alias("sales"),
        F.sum(F.when(promoted, F.col("sales"))).alias("promoted_sales"),
        F.sum(F.when(~promoted, F.col("sales"))).alias("nonpromoted_sales"),
        F.count_if(promoted).alias("promoted_rows"),
        F.count_if(~promoted).alias("nonpromoted_rows"),
        F.count(F.lit(1)).alias("rows"),
    )


def store_performance(by_store_day: DataFrame) -> DataFrame:
    """Volume per store; the average divides by observed dates, not by fact rows."""
    return (
        by_store_day.groupBy("store_nbr")
        .agg(F.sum("sales").alias("total_sales"), F.count(F.lit(1)).alias("observed_days"))
        .withColumn("average_daily_sales", F.col("total_sales") / F.col("observed_days"))
    )


def family_performance(by_family_day: DataFrame) -> DataFrame:
    return by_family_day.groupBy("family").agg(
        F.sum("sales").alias("total_sales"), F.count(F.lit(1)).alias("observed_days")
    )


def lift_percent(promoted: Column, nonpromoted: Column) -> Column:
    """Relative difference of two means in percentage points; null for a zero base."""
    return 100.0 * (ratio(promoted, nonpromoted) - 1.0)


def promotion_impact(by_family_day: DataFrame) -> DataFrame:
    """Promoted against nonpromoted row means per family; rows of unknown promotion are in
    neither group, and without both groups there is no lift."""
    groups = by_family_day.groupBy("family").agg(
        F.sum("promoted_sales").alias("promoted_sales"),
        F.sum("nonpromoted_sales").alias("nonpromoted_sales"),
        F.sum("promoted_rows").alias("promoted_rows"),
        F.sum("nonpromoted_rows").alias("nonpromoted_rows"),
    )
    means = groups.withColumns(
        {
            "promoted_average": ratio(F.col("promoted_sales"), F.col("promoted_rows")),
            "nonpromoted_average": ratio(F.col("nonpromoted_sales"), F.col("nonpromoted_rows")),
        }
    )
    lift = lift_percent(F.col("promoted_average"), F.col("nonpromoted_average"))
    return means.withColumn("lift_pct", lift).select(*GOLD_COLUMNS["promotion_impact"])


def demand_volatility(by_family_day: DataFrame) -> DataFrame:
    """Spread of each family's daily total across stores, over the dates it was observed."""
    return (
        by_family_day.groupBy("family")
        .agg(F.avg("sales").alias("daily_mean"), F.stddev_samp("sales").alias("daily_std"))
        .withColumn("coefficient_of_variation", ratio(F.col("daily_std"), F.col("daily_mean")))
    )


def most_variable_family(volatility: DataFrame) -> DataFrame:
    """The family with the highest coefficient of variation; undefined ones do not compete."""
    return (
        volatility.where(F.col("coefficient_of_variation").isNotNull())
        .orderBy(F.desc("coefficient_of_variation"), "family")
        .limit(1)
    )


def run_totals(by_store_day: DataFrame, by_family_day: DataFrame) -> DataFrame:
    """One row of run totals. Promoted volume is null only if promotion is unknown throughout."""
    known_rows = F.sum(F.col("promoted_rows") + F.col("nonpromoted_rows"))
    promoted_volume = F.coalesce(F.sum("promoted_sales"), F.lit(0.0))
    stores = by_store_day.agg(F.count_distinct("store_nbr")).scalar()
    return by_family_day.agg(
        F.sum("sales").alias("total_sales"),
        F.count_distinct("date").alias("days"),
        F.count_distinct("family").alias("families"),
        F.min("date").alias("start"),
        F.max("date").alias("end"),
        F.when(known_rows > 0, promoted_volume).alias("promoted_sales"),
    ).select(
        "total_sales",
        ratio(F.col("total_sales"), F.col("days")).alias("average_daily_sales"),
        stores.alias("stores"), "families", "start", "end", "promoted_sales",
    )


def kpis(sales: DataFrame) -> DataFrame:
    """Run totals straight from a fact, with or without a promotion column."""
    daily = daily_sales(with_promotion_column(sales))
    return run_totals(store_days(daily), family_days(daily))


def promotion_summary(sales: DataFrame) -> DataFrame:
    """Promotion impact straight from a fact."""
    return promotion_impact(family_days(daily_sales(with_promotion_column(sales))))
