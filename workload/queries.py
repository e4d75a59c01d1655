"""Registered queries: every operator run over whole tables at one scale factor.

Names ending in ``_edge`` or ``_lineitem`` run the same operator on another fact.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from shelfcast.config import PlanningConfig
from shelfcast.functions.columns import display_round
from shelfcast.operators import (
    advice, forecast, marts, measures, pages, planning, quality, questions, report, star, trend, whatif,
)
from shelfcast.schemas import CONTEXT_TABLES, GRAIN, SALES
from shelfcast.session import cut_lineage, new_folder
from shelfcast.sources import csv_tables, sql_functions
from shelfcast.sources.runs import RunFolder, write_csv
from workload import facts

Query = Callable[[SparkSession, str], DataFrame]

DEFAULT = PlanningConfig()
# Few users have events on many days in a row: two days keep all five risk classes in the plan.
SPARSE = PlanningConfig(window_days=2)
TWO_WEEKS = PlanningConfig(window_days=14, lead_time_days=5, review_days=3, z_score=1.28)
ONE_WEEK = PlanningConfig(window_days=7)
# Twenty settings: five windows, two lead times, two factors.
GRID = tuple(
    PlanningConfig(window, lead, review, z)
    for window in (2, 7, 14, 21, 28) for lead, review in ((5, 3), (7, 7)) for z in (1.28, 1.65)
)
SELECTION = {
    "start": datetime.date(2024, 1, 8),
    "end": datetime.date(2024, 1, 21),
    "stores": [1, 2, 3],
    "families": ["click", "view"],
}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Double columns to six decimals, so that summation order cannot change a result hash."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({name: display_round(F.col(name), digits) for name in doubles})


def positioned(ordered: DataFrame) -> DataFrame:
    """Add each row's place, from 1, in the order in which an operator returned its rows."""
    placed = cut_lineage(ordered.withColumn("slot", F.monotonically_increasing_id()))
    part = F.shiftright("slot", 33)
    before = Window.orderBy("slot_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(part.alias("slot_partition")).agg(F.count("*").alias("partition_rows")).select(
        "slot_partition", F.coalesce(F.sum("partition_rows").over(before), F.lit(0)).alias("rows_before")
    )
    within = F.col("slot").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("slot_partition", part)
        .join(F.broadcast(offsets), "slot_partition")  # a row per partition
        .withColumn("position", F.col("rows_before") + within + 1)
        .drop("slot", "slot_partition", "rows_before")
    )


def _daily(fact: Callable[[SparkSession, str], DataFrame]) -> Query:
    return lambda spark, sf_dir: marts.daily_sales(fact(spark, sf_dir))


def shared(query: Query) -> Query:
    """The query's rows written once, for results that read them more than once."""
    return lambda spark, sf_dir: cut_lineage(query(spark, sf_dir))


# Facts are grouped from raw tables; what reads one more than once starts from its written rows.
edge_once = shared(facts.edge_fact)
events_once = shared(facts.events_fact)
lineitem_once = shared(facts.lineitem_fact)
events_daily = _daily(facts.events_fact)
edge_daily = _daily(facts.edge_fact)
lineitem_daily = _daily(facts.lineitem_fact)
orders_daily = _daily(facts.orders_fact)


def _mart(daily: Query, mart: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(mart(daily(spark, sf_dir)))


def _family_mart(daily: Query, mart: Callable[[DataFrame], DataFrame]) -> Query:
    return _mart(daily, lambda rows: mart(marts.family_days(rows)))


def _store_mart(daily: Query, mart: Callable[[DataFrame], DataFrame]) -> Query:
    return _mart(daily, lambda rows: mart(marts.store_days(rows)))


def _plan(fact: DataFrame, config: PlanningConfig, snapshot: DataFrame | None = None) -> DataFrame:
    return planning.plan_inventory(forecast.forecast_demand(fact, config), config, snapshot)


def edge_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(edge_once(spark, sf_dir), SPARSE)


def stocked_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = edge_once(spark, sf_dir)
    return _plan(fact, SPARSE, facts.stock_snapshot(fact))


def lineitem_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(lineitem_once(spark, sf_dir), DEFAULT)


def weekly_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: seven-day plan of the events fact."""
    return rounded(_plan(events_once(spark, sf_dir), ONE_WEEK))


# --- validation -----------------------------------------------------------------------


def dq_counts(spark, sf_dir):
    return quality.quality_counts(facts.unchecked_rows(spark, sf_dir), SALES)


def dq_duplicates(spark, sf_dir):
    """Repeated keys after typing: padded and untyped texts of one key are the same key."""
    rows = quality.typed_table(facts.unchecked_rows(spark, sf_dir), SALES)
    return quality.duplicate_keys(rows, GRAIN)


def silver_sales(spark, sf_dir):
    rows = facts.text_rows(events_once(spark, sf_dir))
    return rounded(quality.validate_sales(rows))


def silver_from_files(spark, sf_dir):
    """Demand as a folder of CSV parts, landed in Bronze as text, validated into bucketed Silver."""
    folder = new_folder(spark)
    write_csv(facts.text_rows(events_once(spark, sf_dir)), f"{folder}/data/raw/train.csv")
    run = RunFolder.create(spark, f"{folder}/output")
    try:
        layers = csv_tables.load_layers(spark, "auto", f"{folder}/data", run)
        assert layers.selected == "raw"
    finally:
        run.close()
    return rounded(run.read("silver", "sales"))


def context_from_files(spark, sf_dir):
    """Inventory counts and oil prices as CSV, landed and validated by their contracts; a price
    that is no finite number is null."""
    folder = new_folder(spark)
    run = RunFolder.create(spark, f"{folder}/output")
    tables = {
        "inventory": facts.stock_snapshot(facts.edge_fact(spark, sf_dir)), "oil": facts.oil_rows(spark, sf_dir),
    }
    silver = {}
    for spec in CONTEXT_TABLES:
        if spec.name in tables:
            write_csv(tables[spec.name], f"{folder}/{spec.name}.csv")
            bronze = csv_tables.land_bronze(spark, f"{folder}/{spec.name}.csv", spec.name, run)
            silver[spec.name] = csv_tables.silver_context(spec, bronze, run)
    stock = silver["inventory"].select(
        F.lit("inventory").alias("source"), "date", "store_nbr", "family", F.col("inventory_on_hand").alias("amount")
    )
    oil = silver["oil"].select(
        F.lit("oil").alias("source"), "date", F.lit(None).cast("bigint").alias("store_nbr"),
        F.lit(None).cast("string").alias("family"), F.col("dcoilwtico").alias("amount"),
    )
    return rounded(stock.unionByName(oil))


def daily_sales_unknown_promo(spark, sf_dir):
    rows = facts.events_fact(spark, sf_dir).drop("onpromotion")
    return rounded(marts.daily_sales(quality.with_promotion_column(rows)))


def plan_orphans(spark, sf_dir):
    """Series of the users' plan that the dense fact of five stores does not have."""
    return quality.orphan_series(edge_plan(spark, sf_dir), facts.events_fact(spark, sf_dir))


def reconcile_totals(spark, sf_dir):
    daily = marts.daily_sales(edge_once(spark, sf_dir))
    totals = quality.reconcile_totals(
        daily,
        marts.weekly_sales(daily),
        marts.store_performance(marts.store_days(daily)),
        marts.family_performance(marts.family_days(daily)),
    )
    # Adding zero turns a rounded -0.0 into 0.0.
    return rounded(totals).withColumn("difference", F.col("difference") + 0.0)


# --- marts, forecast and plan ---------------------------------------------------------


def _forecast(fact, config: PlanningConfig) -> Query:
    return lambda spark, sf_dir: rounded(forecast.forecast_demand(fact(spark, sf_dir), config))


def _rounded(query: Query) -> Query:
    return lambda spark, sf_dir: rounded(query(spark, sf_dir))


def reorder_risk_w14(spark, sf_dir):
    return rounded(_plan(events_once(spark, sf_dir), TWO_WEEKS))


def reorder_risk_grid(spark, sf_dir):
    return rounded(whatif.plan_grid(events_once(spark, sf_dir), GRID))


def scenario_index(spark, sf_dir):
    """Position of every supplier and part pair that ever shipped, in key order."""
    pairs = facts.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("store_nbr"), F.col("l_partkey").cast("string").alias("family")
    )
    return planning.with_series_position(star.series_keys(pairs))


def risk_boundaries(spark, sf_dir):
    """Shipped quantity against part size: whole numbers that meet every class boundary."""
    rows = facts.table(spark, sf_dir, "lineitem").join(
        facts.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    size = F.col("p_size").cast("double")
    risk = planning.risk_column(F.col("l_quantity"), size, size * 2)
    return rows.groupBy(risk.alias("risk"), F.col("l_quantity").alias("stock")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def _advice(fact, config: PlanningConfig, snapshot=None) -> Query:
    def query(spark, sf_dir):
        sales = cut_lineage(fact(spark, sf_dir))
        daily = marts.daily_sales(sales)
        stock = snapshot(sales) if snapshot else None
        return advice.recommendations(
            _plan(sales, config, stock),
            marts.store_performance(marts.store_days(daily)),
            marts.promotion_impact(marts.family_days(daily)),
        )

    return query


def recommendations_scope(spark, sf_dir):
    suggestions = _advice(facts.edge_fact, SPARSE)(spark, sf_dir)
    return advice.with_scope_text(suggestions, "Store 1")


# --- business questions ---------------------------------------------------------------


def _stores(daily: Query) -> Query:
    """Store mart, written once: the share needs both its rows and their total."""
    return shared(lambda spark, sf_dir: marts.store_performance(marts.store_days(daily(spark, sf_dir))))


def _volatility(daily: Query) -> Query:
    return lambda spark, sf_dir: marts.demand_volatility(marts.family_days(daily(spark, sf_dir)))


def bq_store_share(spark, sf_dir):
    return positioned(questions.store_share(_stores(edge_daily)(spark, sf_dir)))


def bq_promo_within_store(spark, sf_dir):
    return positioned(rounded(questions.promotion_within_store(edge_daily(spark, sf_dir))))


def bq_family_variability(spark, sf_dir):
    return positioned(questions.family_variability(_volatility(lineitem_daily)(spark, sf_dir)))


def bq_family_variability_orders(spark, sf_dir):
    return questions.family_variability(_volatility(orders_daily)(spark, sf_dir))


def bq_review_queue(spark, sf_dir):
    return positioned(rounded(questions.review_queue(edge_plan(spark, sf_dir))))


def most_variable_family(spark, sf_dir):
    return rounded(marts.most_variable_family(_volatility(edge_daily)(spark, sf_dir)))


def top_store_share(spark, sf_dir):
    return rounded(questions.top_store_share(_stores(edge_daily)(spark, sf_dir)))


# --- trend ----------------------------------------------------------------------------


def complete_weeks(spark, sf_dir):
    sales = events_once(spark, sf_dir)
    weekly = marts.weekly_sales(marts.daily_sales(sales))
    return trend.complete_weeks(weekly, _plan(sales, DEFAULT))


def weekly_trend_index(spark, sf_dir):
    sales = events_once(spark, sf_dir)
    weekly = cut_lineage(marts.weekly_sales(marts.daily_sales(sales)))
    complete = trend.complete_weeks(weekly, _plan(sales, DEFAULT))
    return rounded(trend.weekly_trend_index(weekly, complete))


def risk_counts(spark, sf_dir):
    return positioned(planning.risk_counts(edge_plan(spark, sf_dir)))


# --- star model, measures and pages ---------------------------------------------------


def _star(spark, sf_dir):
    daily = marts.daily_sales(edge_once(spark, sf_dir))
    return star.star_demand(daily, *star.lookups(daily))


def star_demand(spark, sf_dir):
    return rounded(_star(spark, sf_dir))


def star_plan(spark, sf_dir):
    sales = edge_once(spark, sf_dir)
    plan = _plan(sales, SPARSE, facts.stock_snapshot(sales))
    return rounded(star.star_plan(plan, star.dim_store(sales), star.dim_family(sales)))


def _measures(daily: Query, *group_by: str, **selection) -> Query:
    return lambda spark, sf_dir: rounded(
        measures.demand_measures(daily(spark, sf_dir), group_by, **selection)
    )


def _plan_measures(*group_by: str, **selection) -> Query:
    return lambda spark, sf_dir: rounded(
        measures.planning_measures(stocked_plan(spark, sf_dir), group_by, **selection)
    )


def sql_measures_filtered(spark, sf_dir):
    """The selection of measures_filtered as arguments of a SQL table function."""
    edge_daily(spark, sf_dir).createOrReplaceTempView("workload_daily")
    sql_functions.register_functions(spark, "workload_daily", None, None, prefix="workload_")
    arguments = (
        f"DATE'{SELECTION['start']}', DATE'{SELECTION['end']}', "
        f"array({', '.join(f'{n}L' for n in SELECTION['stores'])}), "
        f"array({', '.join(repr(f) for f in SELECTION['families'])})"
    )
    return rounded(spark.sql(f"SELECT * FROM workload_demand_measures_by_family({arguments})"))


def sql_measures_total(spark, sf_dir):
    edge_daily(spark, sf_dir).createOrReplaceTempView("workload_daily")
    sql_functions.register_functions(spark, "workload_daily", None, None, prefix="workload_")
    return rounded(spark.sql("SELECT * FROM workload_demand_measures()"))


def sql_plan_measures_filtered(spark, sf_dir):
    """The selection of plan_measures_filtered as arguments of a SQL table function."""
    stocked_plan(spark, sf_dir).createOrReplaceTempView("workload_plan")
    sql_functions.register_functions(spark, None, "workload_plan", None, prefix="workload_")
    chosen = f"stores => array(1L, 2L), sources => array('{planning.PROVIDED}')"
    return rounded(spark.sql(f"SELECT * FROM workload_planning_measures_by_family({chosen})"))


def avg_volatility(spark, sf_dir):
    return rounded(measures.average_volatility(_volatility(edge_daily)(spark, sf_dir)))


def weekly_top_families(spark, sf_dir):
    return rounded(pages.weekly_top_families(_star(spark, sf_dir)))


def page_weekday(spark, sf_dir):
    return positioned(rounded(pages.weekday_demand(_star(spark, sf_dir))))


def page_risk(spark, sf_dir):
    return pages.risk_series(stocked_plan(spark, sf_dir), stores=[1, 3, 4])


def page_plan_filtered(spark, sf_dir):
    return rounded(pages.planning_detail(
        stocked_plan(spark, sf_dir), families=["click", "view"],
        risks=[planning.INSUFFICIENT, planning.REORDER], sources=[planning.SIMULATED],
    ))


def _ordered(query: Query) -> Query:
    return lambda spark, sf_dir: positioned(query(spark, sf_dir))


# --- run report -----------------------------------------------------------------------


def run_report(spark, sf_dir):
    sales = edge_once(spark, sf_dir)
    daily = marts.daily_sales(sales)
    by_store_day, by_family_day = cut_lineage(marts.store_days(daily)), cut_lineage(marts.family_days(daily))
    totals = rounded(marts.run_totals(by_store_day, by_family_day))
    return report.run_report(by_family_day, _plan(sales, SPARSE), totals, SPARSE, "raw", ["checked"])


def quality_summary(spark, sf_dir):
    return report.quality_summary(run_report(spark, sf_dir))


def report_labels(spark, sf_dir):
    return report.report_labels(run_report(spark, sf_dir))


def overview_kpis(spark, sf_dir):
    sales = edge_once(spark, sf_dir)
    daily = marts.daily_sales(sales)
    return report.overview_kpis(
        marts.family_performance(marts.family_days(daily)),
        marts.store_performance(marts.store_days(daily)),
        _plan(sales, SPARSE),
    )


REGISTRY: dict[str, Query] = {
    "dq_counts": dq_counts,
    "dq_duplicates": dq_duplicates,
    "silver_sales": silver_sales,
    "silver_from_files": silver_from_files,
    "context_from_files": context_from_files,
    "daily_sales": _rounded(events_daily),
    "daily_sales_edge": _rounded(edge_daily),
    "daily_sales_unknown_promo": daily_sales_unknown_promo,
    "weekly_sales": _mart(edge_daily, marts.weekly_sales),
    "weekly_sales_lineitem": _mart(lineitem_daily, marts.weekly_sales),
    "store_performance": _store_mart(edge_daily, marts.store_performance),
    "store_performance_lineitem": _store_mart(lineitem_daily, marts.store_performance),
    "family_performance": _family_mart(edge_daily, marts.family_performance),
    "family_performance_lineitem": _family_mart(lineitem_daily, marts.family_performance),
    "promotion_impact": _family_mart(edge_daily, marts.promotion_impact),
    "promotion_impact_lineitem": _ordered(_family_mart(
        lineitem_daily, lambda days: marts.promotion_impact(days).orderBy("lift_pct")
    )),
    "promotion_impact_orders": _family_mart(orders_daily, marts.promotion_impact),
    "demand_volatility": _family_mart(edge_daily, marts.demand_volatility),
    "demand_volatility_lineitem": _family_mart(lineitem_daily, marts.demand_volatility),
    "demand_volatility_orders": _family_mart(orders_daily, marts.demand_volatility),
    "kpis": lambda spark, sf_dir: rounded(marts.kpis(edge_once(spark, sf_dir))),
    "forecast": _forecast(edge_once, SPARSE),
    "forecast_lineitem": _forecast(lineitem_once, DEFAULT),
    "reorder_risk": _rounded(edge_plan),
    "reorder_risk_actual": _rounded(stocked_plan),
    "reorder_risk_w14": reorder_risk_w14,
    "reorder_risk_grid": reorder_risk_grid,
    "reorder_risk_lineitem": _rounded(lineitem_plan),
    "scenario_index": scenario_index,
    "risk_boundaries": risk_boundaries,
    "recommendations": _advice(facts.edge_fact, SPARSE, facts.stock_snapshot),
    "recommendations_lineitem": _advice(facts.lineitem_fact, DEFAULT),
    "recommendations_scope": recommendations_scope,
    "plan_orphans": plan_orphans,
    "reconcile_totals": reconcile_totals,
    "bq_store_share": bq_store_share,
    "bq_promo_within_store": bq_promo_within_store,
    "bq_family_variability": bq_family_variability,
    "bq_family_variability_orders": bq_family_variability_orders,
    "bq_review_queue": bq_review_queue,
    "most_variable_family": most_variable_family,
    "top_store_share": top_store_share,
    "complete_weeks": complete_weeks,
    "weekly_trend_index": weekly_trend_index,
    "risk_counts": risk_counts,
    "series_keys": lambda spark, sf_dir: star.series_keys(facts.lineitem_fact(spark, sf_dir)),
    "dim_store": lambda spark, sf_dir: star.dim_store(lineitem_daily(spark, sf_dir)),
    "dim_family": lambda spark, sf_dir: star.dim_family(lineitem_daily(spark, sf_dir)),
    "dim_date": lambda spark, sf_dir: star.dim_date(lineitem_daily(spark, sf_dir)),
    "star_demand": star_demand,
    "star_plan": star_plan,
    "store_family_cube": _mart(edge_daily, measures.store_family_matrix),
    "store_family_cube_lineitem": _mart(lineitem_daily, measures.store_family_matrix),
    "measures_total": _measures(edge_daily),
    "measures_by_store": _measures(edge_daily, "store_nbr"),
    "measures_by_weekday": _measures(edge_daily, "weekday_number", "day_type"),
    "measures_filtered": _measures(edge_daily, "family", **SELECTION),
    "measures_lineitem": _measures(lineitem_daily, "family"),
    "sql_measures_total": sql_measures_total,
    "sql_measures_filtered": sql_measures_filtered,
    "avg_volatility": avg_volatility,
    "plan_measures_total": _plan_measures(),
    "plan_measures_by_store": _plan_measures("store_nbr"),
    "plan_measures_filtered": _plan_measures("family", stores=[1, 2], sources=[planning.PROVIDED]),
    "sql_plan_measures_filtered": sql_plan_measures_filtered,
    "page_daily": _mart(edge_daily, pages.daily_demand),
    "top_families": _ordered(_mart(orders_daily, pages.top_families)),
    "weekly_top_families": weekly_top_families,
    "page_weekday": page_weekday,
    "page_day_type": _mart(edge_daily, pages.day_type_demand),
    "page_store": _ordered(_mart(edge_daily, pages.store_demand)),
    "page_promo": _mart(edge_daily, pages.family_promotion),
    "page_promo_orders": _mart(orders_daily, pages.family_promotion),
    "page_risk": page_risk,
    "page_plan_detail": lambda spark, sf_dir: rounded(
        pages.planning_detail(stocked_plan(spark, sf_dir))
    ),
    "page_plan_filtered": page_plan_filtered,
    "run_report": run_report,
    "quality_summary": quality_summary,
    "report_labels": report_labels,
    "overview_kpis": overview_kpis,
}
