"""Lookups of the reporting model and the five joins that use them.

Store and family lookups filter both the daily fact and the plan; the date lookup filters
the daily fact only, so a date selection never touches the planning snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfcast.functions.columns import day_type, week_start, weekday_number
from shelfcast.schemas import SERIES
from shelfcast.session import cut_lineage


def series_keys(sales: DataFrame) -> DataFrame:
    return sales.select(*SERIES).distinct()


def dim_store(daily: DataFrame) -> DataFrame:
    return daily.select("store_nbr").distinct()


def dim_family(daily: DataFrame) -> DataFrame:
    return daily.select("family").distinct()


def dim_date(daily: DataFrame) -> DataFrame:
    """Every day of every calendar year the fact touches, with its week and weekday.

    Input dates lie between 1677 and 2262, so this has at most some 214,000 rows.
    """
    return _calendar(daily.agg(F.year(F.min("date")).alias("first"), F.year(F.max("date")).alias("last")))


def _calendar(years: DataFrame) -> DataFrame:
    first_day = F.make_date("first", F.lit(1), F.lit(1))
    last_day = F.make_date("last", F.lit(12), F.lit(31))
    days = years.where("first IS NOT NULL").select(
        F.explode(F.sequence(first_day, last_day)).alias("date")
    )
    date = F.col("date")
    return days.select(
        "date",
        week_start(date).alias("week_start"),
        weekday_number(date).alias("weekday_number"),
        F.date_format(date, "EEEE").alias("weekday"),
        day_type(date).alias("day_type"),
    )


def lookups(daily: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Store, family and date lookups from one scan of the fact, those of stores and families written.

    A written lookup has a known size: Spark sends it to the fact where that size is below
    ``spark.sql.autoBroadcastJoinThreshold``, so the fact stays where it is, and joins a larger one by key.
    """
    series = cut_lineage(
        daily.groupBy(*SERIES).agg(F.year(F.min("date")).alias("first"), F.year(F.max("date")).alias("last"))
    )
    years = series.agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return cut_lineage(dim_store(series)), cut_lineage(dim_family(series)), _calendar(years)


def star_demand(
    daily: DataFrame, stores: DataFrame, families: DataFrame, dates: DataFrame
) -> DataFrame:
    """Daily fact joined to its three lookups; filtered lookups restrict the fact. Take stored
    ones, as ``lookups`` writes them: the fact is then moved for those beyond the broadcast size only."""
    calendar = dates.select("date", "week_start", "weekday")
    return (
        daily.join(F.broadcast(calendar), "date")  # bounded by the calendar, see dim_date
        .join(stores, "store_nbr")
        .join(families, "family")
    )


def star_plan(plan: DataFrame, stores: DataFrame, families: DataFrame) -> DataFrame:
    """Planning snapshot joined to store and family, never to dates."""
    return plan.join(stores, "store_nbr").join(families, "family")
