"""Gapless global row numbers without gathering rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shelfcast.session import cut_lineage

_SHIFT = 33  # monotonically_increasing_id(): partition number above, place in it below


def number_rows(df: DataFrame, *order: str, name: str = "row_number") -> DataFrame:
    """The rows with their place (from 0) in the order of the given columns, nulls first.

    The rows are range-partitioned, sorted and written once; a partition's first number is the
    sum of the counts of the partitions before it (one row each). Rows that agree in all order
    columns are numbered in any order, so name enough columns that such rows are equal.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("_place", _SHIFT).alias("_part")
    counts = placed.groupBy(part).agg(F.count("*").alias("rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_before"))
    within = F.col("_place").bitwiseAND(F.lit((1 << _SHIFT) - 1))
    return (
        placed.withColumn("_part", F.shiftright("_place", _SHIFT))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + within)
        .drop("_place", "_part", "_before")
    )
