"""Trailing calendar-window demand baseline, one row per series."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.config import PlanningConfig
from shelfcast.schemas import MONTH, SERIES


def with_coverage(known: DataFrame, as_of: Column, window: Column, lead: Column) -> DataFrame:
    """Add what follows from mean and observed days; the parameters may differ by row."""
    days = F.col("observed_days")
    return known.withColumns(
        {
            "coverage": days / window.cast("double"),
            "forecast_date": as_of,
            "expected_lead_time_demand": F.col("recent_average") * lead.cast("double"),
            "forecast_quality": F.when(days == window, F.lit("Full window")).otherwise(
                F.lit("Incomplete history")
            ),
        }
    )


def newest_date(sales: DataFrame) -> datetime.date | None:
    """The newest date; of a mart partitioned by month only the newest month's dates are read."""
    if MONTH in sales.columns:
        sales = sales.where(F.col(MONTH) == F.lit(sales.agg(F.max(MONTH)).first()[0]))
    return sales.agg(F.max("date")).first()[0]


def forecast_demand(
    sales: DataFrame, config: PlanningConfig, series: DataFrame | None = None,
    newest: datetime.date | None = None,
) -> DataFrame:
    """Mean, spread and coverage over the last ``window_days`` calendar days.

    Calling this reads the newest date, from the date column alone, unless ``newest`` gives it. Only
    the window is then read for the statistics: its first day is a literal that reaches the scan, and
    months before it are not opened where the demand is partitioned by month. ``series`` lists the series to report, for instance the weekly mart;
    without it they are read from the two key columns of the fact. A series without a recent
    row keeps its row with count 0 and null statistics. The grain is one row per date and
    series, hence counting rows counts distinct days.
    """
    as_of = F.lit(newest if newest is not None else newest_date(sales)).cast("date")
    first_day = F.date_sub(as_of, config.window_days - 1)
    in_window = F.col("date") >= first_day
    if MONTH in sales.columns:
        in_window &= F.col(MONTH) >= F.date_format(first_day, "yyyy-MM")
    keys = (sales if series is None else series).select(*SERIES).distinct()
    recent = (
        sales.where(in_window)
        .select("date", *SERIES, "sales")
        .groupBy(*SERIES)
        .agg(
            F.avg("sales").alias("recent_average"),
            F.stddev_samp("sales").alias("demand_std"),
            F.count(F.lit(1)).alias("recent_days"),
            F.max("date").alias("last_observed_date"),
        )
    )
    known = (
        keys.join(recent, list(SERIES), "left")
        .withColumn("observed_days", F.coalesce("recent_days", F.lit(0)))
        .drop("recent_days")
    )
    return with_coverage(known, as_of, F.lit(config.window_days), F.lit(config.lead_time_days))
