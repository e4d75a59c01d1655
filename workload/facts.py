"""Demand facts that Spark derives from the driver's tables, each from the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


# Columns used of each table; a given schema saves the job that would infer it.
SCHEMAS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_discount double, "
        "l_tax double, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "part": "p_partkey long, p_type string, p_size int",
    "supplier": "s_suppkey long, s_nationkey int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# An event of at least this value counts as promoted.
PROMOTED_VALUE = 60


def events_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense fact for weekly trends: five stores of users, one family per event type, 30 days."""
    events = table(spark, sf_dir, "events")
    return events.groupBy(
        F.to_date("ts").alias("date"),
        (F.col("user_id") % 5 + 1).cast("bigint").alias("store_nbr"),
        F.col("event_type").alias("family"),
    ).agg(
        F.sum("value").alias("sales"),
        F.count_if(F.col("value") >= PROMOTED_VALUE).cast("double").alias("onpromotion"),
    )


def edge_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse fact whose series grow with the data: every user is a store, every event type a
    family. Days without events are gaps, many series have no recent row, volumes are whole tens
    and often zero, and errors carry no promotion information."""
    kind = F.col("event_type")
    promoted = F.count_if(F.col("value") >= PROMOTED_VALUE).cast("double")
    return table(spark, sf_dir, "events").groupBy(
        F.to_date("ts").alias("date"), (F.col("user_id") + 1).alias("store_nbr"), kind.alias("family")
    ).agg(
        F.sum(F.floor(F.col("value") / 10)).cast("double").alias("sales"),
        F.when(kind != "error", promoted).alias("onpromotion"),
    )


def stock_snapshot(edge: DataFrame) -> DataFrame:
    """Stock counts of every third store from 29 January on: one stale day, one as-of day."""
    counted = (F.col("date") >= F.lit("2024-01-29").cast("date")) & (F.col("store_nbr") % 3 == 1)
    return edge.where(counted).select(
        "date", "store_nbr", "family", (F.col("sales") * 10 + 100).alias("inventory_on_hand")
    )


def orders_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discounted volume by supplier and order: as many families as orders. Orders without a
    discount have zero demand; lines that are still open have no promotion information."""
    discounted = F.round(F.col("l_quantity") * F.col("l_discount") * 100)
    taxed = F.count_if(F.col("l_tax") >= 0.05).cast("double")
    return table(spark, sf_dir, "lineitem").groupBy(
        F.to_date("l_shipdate").alias("date"), F.col("l_suppkey").alias("store_nbr"),
        F.concat(F.lit("order "), F.col("l_orderkey")).alias("family"),
    ).agg(
        F.sum(discounted).alias("sales"),
        F.when(F.min("l_linestatus") != "O", taxed).alias("onpromotion"),
    )


def lineitem_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven years of shipped quantity by nation group and part type.

    No join is hinted: supplier and part grow with the data, so Spark decides by size.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier")
    part = table(spark, sf_dir, "part")
    return (
        lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(
            F.to_date("l_shipdate").alias("date"),
            (F.col("s_nationkey") % 3 + 1).cast("bigint").alias("store_nbr"),
            F.col("p_type").alias("family"),
        )
        .agg(
            F.sum("l_quantity").alias("sales"),
            F.count_if(F.col("l_discount") >= 0.09).cast("double").alias("onpromotion"),
        )
    )


def unchecked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one unvalidated text row; some event types carry broken values."""
    kind, user = F.col("event_type"), F.col("user_id")
    day = F.to_date("ts").cast("string")
    return table(spark, sf_dir, "events").select(
        F.when((kind == "error") & (user % 7 == 3), F.lit("2024-02-30"))
        .when((kind == "signup") & (user % 11 == 7), F.lit(" "))
        .when((kind == "view") & (user % 7 == 4), F.replace(day, F.lit("-"), F.lit("/")))
        .otherwise(day)
        .alias("date"),
        F.when((kind == "click") & (user % 11 == 5), F.lit("0"))
        .when((kind == "click") & (user % 11 == 6), F.lit("2.5"))
        .when((kind == "view") & (user % 13 == 7), F.lit(None))
        .otherwise((user % 5 + 1).cast("string"))
        .alias("store_nbr"),
        F.when((kind == "signup") & (user % 13 == 2), F.lit("  "))
        .otherwise(F.concat(F.lit(" "), kind, F.lit("\t")))
        .alias("family"),
        F.when((kind == "purchase") & (user % 5 == 1), F.lit("-1"))
        .when((kind == "purchase") & (user % 5 == 2), F.lit("1,5"))
        .when((kind == "purchase") & (user % 5 == 3), F.lit("1e999"))
        .otherwise(F.col("value").cast("string"))
        .alias("sales"),
    )


def oil_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The highest event value of each day as a price in text; Saturdays have none, on Sundays it
    is a word and on Mondays the word for an infinite number."""
    day = F.to_date("ts")
    price = F.max("value").cast("string")
    weekday = F.weekday("date")
    return table(spark, sf_dir, "events").groupBy(day.alias("date")).agg(price.alias("price")).select(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.when(weekday == 5, F.lit("")).when(weekday == 6, F.lit("closed")).when(weekday == 0, F.lit("inf"))
        .otherwise(F.col("price")).alias("dcoilwtico"),
    )


def text_rows(fact: DataFrame) -> DataFrame:
    """A valid fact as a CSV file would deliver it: all text, padded family, ``1.0`` ids."""
    return fact.select(
        F.date_format("date", "yyyy-M-d").alias("date"),
        F.concat(F.col("store_nbr"), F.lit(".0")).alias("store_nbr"),
        F.concat(F.lit("  "), F.col("family"), F.lit(" \t")).alias("family"),
        F.concat(F.lit(" "), F.col("sales").cast("string")).alias("sales"),
        F.col("onpromotion").cast("string").alias("onpromotion"),
    )
