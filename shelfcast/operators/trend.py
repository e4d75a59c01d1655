"""Weekly index per family over complete weeks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shelfcast.functions.columns import ratio

DAYS_PER_WEEK = 7


def complete_weeks(weekly: DataFrame, plan: DataFrame) -> DataFrame:
    """Weeks in which every planned series has all seven days.

    At most one row per calendar week of the supported date range, some 31,000 rows.
    """
    expected = plan.agg(F.count(F.lit(1))).scalar()
    return (
        weekly.groupBy("week")
        .agg(F.count(F.lit(1)).alias("series"), F.min("observed_days").alias("min_days"))
        .where((F.col("series") == expected) & (F.col("min_days") == DAYS_PER_WEEK))
    )


def weekly_trend_index(weekly: DataFrame, complete: DataFrame) -> DataFrame:
    """Each family's weekly volume relative to its first complete week, which is 100."""
    volumes = (
        weekly.join(F.broadcast(complete.select("week")), "week", "left_semi")
        .groupBy("week", "family")
        .agg(F.sum("sales").alias("volume"))
    )
    by_week = Window.partitionBy("family").orderBy("week")  # one row per week in a family
    return volumes.withColumn(
        "volume_index", 100.0 * ratio(F.col("volume"), F.first("volume").over(by_week))
    )
