"""Run report, KPI overview and quality summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfcast.config import PlanningConfig

# Labels and notices of the run report.
SAMPLE_LABEL = "Synthetic demo data"
RAW_LABEL = "User-provided retail CSVs; provenance must be verified"
INCOMPLETE_WARNING = (
    "Some store/family series have incomplete trailing history; "
    "actionable reorder quantities are suppressed."
)

_KEEP_NULLS = {"ignoreNullFields": "false"}


def run_report(
    by_family_day: DataFrame,
    plan: DataFrame,
    kpi_row: DataFrame,
    config: PlanningConfig,
    source: str,
    warnings: Sequence[str],
) -> DataFrame:
    """One row with ``report_json``: source, label, row count, KPIs, planning, warnings, as-of.

    Row count and newest date come from the family days, so the fact is not read again.
    """
    label = SAMPLE_LABEL if source == "sample" else RAW_LABEL
    planning = config.as_dict()
    notices = F.array(*[F.lit(w) for w in warnings]).cast("array<string>")
    facts = by_family_day.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"), F.max("date").alias("as_of")
    )
    incomplete = plan.agg(F.bool_or(F.col("coverage") < 1)).scalar()
    all_notices = F.when(
        incomplete, F.concat(notices, F.array(F.lit(INCOMPLETE_WARNING)))
    ).otherwise(notices)
    kpi_struct = kpi_row.select(F.struct("*")).scalar()
    return facts.select(
        F.to_json(
            F.struct(
                F.lit(source).alias("source"),
                F.lit(label).alias("data_label"),
                F.col("row_count").alias("rows"),
                kpi_struct.alias("kpis"),
                F.struct(*[F.lit(v).alias(k) for k, v in planning.items()]).alias("planning"),
                all_notices.alias("warnings"),
                F.col("as_of"),
            ),
            _KEEP_NULLS,
        ).alias("report_json")
    )


def quality_summary(report: DataFrame) -> DataFrame:
    """Report keys unpivoted to (check, value); nested values stay JSON text."""
    fields = F.from_json("report_json", T.MapType(T.StringType(), T.StringType()))
    return report.select(F.explode(fields).alias("check", "value"))


def report_value(summary: DataFrame, check: str) -> Column:
    """Value stored for one report key, as a scalar subquery."""
    return summary.where(F.col("check") == check).select("value").scalar()


def report_labels(report: DataFrame) -> DataFrame:
    """The two text cards of the report: data source and planning assumptions."""
    summary = quality_summary(report)
    return report.select(
        report_value(summary, "data_label").alias("data_source_label"),
        report_value(summary, "planning").alias("planning_assumptions"),
    )


def overview_kpis(families: DataFrame, stores: DataFrame, plan: DataFrame) -> DataFrame:
    """Four named totals, one per row. The class match ignores case and outer spaces."""
    family_totals = families.agg(
        F.round(F.sum("total_sales"), 2).alias("volume"),
        F.count_distinct("family").alias("families"),
    ).select(
        F.explode(
            F.create_map(
                F.lit("Total demand volume"), F.coalesce("volume", F.lit(0.0)),
                F.lit("Product families"), F.col("families").cast("double"),
            )
        ).alias("metric", "value")
    )
    store_total = stores.agg(F.count_distinct("store_nbr").cast("double").alias("value"))
    if "risk" in plan.columns:
        urgent = F.lower(F.trim(F.col("risk"))) == "reorder now"
        urgent_total = plan.agg(F.count_if(urgent).cast("double").alias("value"))
    else:
        urgent_total = stores.agg(F.lit(0.0).alias("value"))
    return family_totals.unionByName(
        store_total.select(F.lit("Stores").alias("metric"), "value")
    ).unionByName(urgent_total.select(F.lit("Reorder now series").alias("metric"), "value"))
