"""Replenishment plan: safety stock, reorder point, target, stock, quantity and risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.config import PlanningConfig
from shelfcast.functions.columns import at_least_zero, ratio
from shelfcast.schemas import GOLD_COLUMNS, SERIES
from shelfcast.session import cut_lineage

# Stock as a multiple of the reorder point, by series position modulo four.
SCENARIO_FACTORS = (0.5, 1.05, 1.4, 4.0)

# Risk classes and stock provenance labels.
INSUFFICIENT = "Insufficient history"
REORDER = "Reorder now"
MONITOR = "Monitor"
HEALTHY = "Healthy"
OVERSTOCK = "Overstock risk"
SIMULATED = "Simulated scenario"
PROVIDED = "Provided as-of snapshot (not independently verified)"

# monotonically_increasing_id keeps the partition above this bit and the row number below.
_PARTITION_SHIFT = 33


def risk_column(stock: Column, reorder_point: Column, target: Column) -> Column:
    """Risk class by the first rule that holds."""
    return (
        F.when(stock < reorder_point, F.lit(REORDER))
        .when(stock <= 1.1 * reorder_point, F.lit(MONITOR))
        .when(stock > 1.5 * target, F.lit(OVERSTOCK))
        .otherwise(F.lit(HEALTHY))
    )


def with_series_position(series: DataFrame) -> DataFrame:
    """Add ``series_position``: the row's place, from 0, in (store, family) order.

    A window over all series, or over one store, would sort an unbounded group in one
    task. Here a range shuffle cuts the order into even partitions, each partition counts
    its own rows, and only the row counts per partition are summed up in one task. The
    positions must not change between the two passes, so the sorted rows are written to
    the checkpoint folder first.
    """
    ordered = cut_lineage(
        series.repartitionByRange(*SERIES)
        .sortWithinPartitions(*SERIES)
        .withColumn("slot", F.monotonically_increasing_id())
    )
    partition = F.shiftright("slot", _PARTITION_SHIFT).alias("slot_partition")
    # One row per partition: bounded by the shuffle partition count, not by the data.
    before = Window.orderBy("slot_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy(partition)
        .agg(F.count(F.lit(1)).alias("partition_rows"))
        .select(
            "slot_partition",
            F.coalesce(F.sum("partition_rows").over(before), F.lit(0)).alias("rows_before"),
        )
    )
    within = F.col("slot").bitwiseAND(F.lit((1 << _PARTITION_SHIFT) - 1))
    return (
        ordered.withColumn("slot_partition", partition)
        .join(F.broadcast(offsets), "slot_partition")
        .withColumn("series_position", F.col("rows_before") + within)
        .drop("slot", "slot_partition", "rows_before")
    )


def with_targets(forecasts: DataFrame, lead: Column, review: Column, z: Column) -> DataFrame:
    """Add safety stock, reorder point and target level; the parameters may differ by row."""
    mean, buffer = F.col("recent_average"), z.cast("double") * F.col("demand_std")
    protected = (lead + review).cast("double")
    return forecasts.withColumn("safety_stock", buffer * F.sqrt(lead)).withColumns(
        {
            "reorder_point": F.col("expected_lead_time_demand") + F.col("safety_stock"),
            "target_stock_level": mean * protected + buffer * F.sqrt(protected),
        }
    )


def with_stock(targets: DataFrame, snapshot: DataFrame | None) -> DataFrame:
    """Scenario stock by series position, replaced where a snapshot of exactly the as-of date
    has the series. The date is read from ``targets``, which start from written rows."""
    factors = F.array(*[F.lit(f) for f in SCENARIO_FACTORS])
    slot = (F.col("series_position") % len(SCENARIO_FACTORS) + 1).cast("int")
    planned = targets.withColumn("scenario_stock", F.col("reorder_point") * F.element_at(factors, slot))
    if snapshot is None:
        return planned.withColumns(
            {"inventory_on_hand": F.col("scenario_stock"), "inventory_source": F.lit(SIMULATED)}
        )
    as_of = planned.agg(F.max("forecast_date")).scalar()
    current = snapshot.where(F.col("date") == as_of).select(
        *SERIES, F.col("inventory_on_hand").alias("counted_stock")
    )
    counted = F.col("counted_stock")
    return planned.join(current, list(SERIES), "left").withColumns(
        {
            "inventory_on_hand": F.coalesce(counted, F.col("scenario_stock")),
            "inventory_source": F.when(counted.isNotNull(), F.lit(PROVIDED)).otherwise(F.lit(SIMULATED)),
        }
    )


def with_decision(stocked: DataFrame, window: Column) -> DataFrame:
    """Add days of supply, quantity and risk; quantities are withheld where history is incomplete."""
    mean, stock = F.col("recent_average"), F.col("inventory_on_hand")
    target = F.col("target_stock_level")
    full = F.col("observed_days") == window
    return stocked.withColumns(
        {
            "days_of_supply": F.when(mean > 0, ratio(stock, mean)),
            "reorder_quantity": F.when(full, at_least_zero(target - stock)),
            "risk": F.when(full, risk_column(stock, F.col("reorder_point"), target)).otherwise(
                F.lit(INSUFFICIENT)
            ),
        }
    )


def plan_inventory(
    forecasts: DataFrame, config: PlanningConfig, snapshot: DataFrame | None = None
) -> DataFrame:
    """Plan for every forecast series; quantities are withheld where history is incomplete.

    Calling this runs the forecast once (see ``with_series_position``); what it returns is
    lazy and starts from those written rows.
    """
    targets = with_targets(
        forecasts, F.lit(config.lead_time_days), F.lit(config.review_days), F.lit(float(config.z_score))
    )
    stocked = with_stock(with_series_position(targets), snapshot)
    return with_decision(stocked, F.lit(config.window_days)).select(*GOLD_COLUMNS["reorder_risk"])


def risk_counts(plan: DataFrame) -> DataFrame:
    """Series per risk class in review order, zero where a class is empty.

    All five classes are reported, so the counts cover every planned series; any other class
    is an error rather than a silently missing row.
    """
    classes = (INSUFFICIENT, REORDER, MONITOR, HEALTHY, OVERSTOCK)
    counted = plan.groupBy("risk").agg(F.count(F.lit(1)).alias("found"))
    known = F.coalesce(F.col("risk").isin(*classes), F.lit(False))
    if not counted.where(~known).isEmpty():
        raise ValueError("the risk classes do not cover every planned series")
    order = plan.sparkSession.createDataFrame(list(enumerate(classes)), "position int, risk string")
    return (
        order.join(counted, "risk", "left")
        .orderBy("position")
        .select("risk", F.coalesce("found", F.lit(0)).alias("series"))
    )
