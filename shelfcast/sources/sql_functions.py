"""Measures for plain SQL: table functions over the published views, filters as arguments.

    SELECT * FROM demand_measures(first_day => DATE'2024-01-08', stores => array(1L, 3L));
    SELECT family, promotion_lift FROM demand_measures_by_family() ORDER BY family;
    SELECT * FROM planning_measures_by_store(risks => array('Reorder now'));

An argument that is left out, or null, filters nothing. Constant arguments are folded into the
scan's filters: dates, the partition's month, and the least and greatest member of a list. The
results are those of ``demand_measures`` and ``planning_measures``, by the same merged words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from shelfcast.operators.measures import DAY_BIT, DAY_WORD, STORE_BIT, STORE_WORD, demand_measures, planning_measures
from shelfcast.operators.planning import HEALTHY, INSUFFICIENT, MONITOR, OVERSTOCK, REORDER
from shelfcast.schemas import MONTH

DEMAND_KEYS = {
    "": (), "_by_store": ("store_nbr",), "_by_family": ("family",), "_by_date": ("date",),
    "_by_weekday": ("weekday_number", "day_type"), "_by_series": ("store_nbr", "family"),
}
PLANNING_KEYS = {
    "": (), "_by_store": ("store_nbr",), "_by_family": ("family",), "_by_risk": ("risk",),
    "_by_source": ("inventory_source",),
}
DEMAND_ARGUMENTS = (
    "first_day DATE DEFAULT NULL, last_day DATE DEFAULT NULL, "
    "stores ARRAY<BIGINT> DEFAULT NULL, families ARRAY<STRING> DEFAULT NULL"
)
PLANNING_ARGUMENTS = (
    "stores ARRAY<BIGINT> DEFAULT NULL, families ARRAY<STRING> DEFAULT NULL, "
    "risks ARRAY<STRING> DEFAULT NULL, sources ARRAY<STRING> DEFAULT NULL"
)


def _among(column: str, argument: str) -> str:
    """Member of a list; its bounds are plain comparisons, which the scan can use."""
    return (
        f"({argument} IS NULL OR ({column} >= array_min({argument}) AND {column} <= array_max({argument}) "
        f"AND array_contains({argument}, {column})))"
    )


def _demand_filter(months: bool) -> str:
    conditions = [
        "(first_day IS NULL OR date >= first_day)", "(last_day IS NULL OR date <= last_day)",
        _among("store_nbr", "stores"), _among("family", "families"),
    ]
    if months:  # the published mart is partitioned by month
        conditions += [
            f"(first_day IS NULL OR {MONTH} >= date_format(first_day, 'yyyy-MM'))",
            f"(last_day IS NULL OR {MONTH} <= date_format(last_day, 'yyyy-MM'))",
        ]
    return " AND ".join(conditions)


def _listed(*names: str) -> str:
    return ", ".join(n for n in names if n)


def _demand_text(view: str, keys: Sequence[str], months: bool) -> str:
    """Cells of 64 days, 64 stores and a family; each kind of member merged apart; then measures."""
    group = ", ".join(keys)
    sets = ", ".join(f"({_listed(group, kind)})" for kind in ("day_word", "store_word", "member_family"))
    head = f"{group}, " if group else ""
    return f"""
WITH cells AS (
  SELECT {head}{DAY_WORD} AS day_word, {STORE_WORD} AS store_word, family AS member_family,
    BIT_OR({DAY_BIT}) AS day_bits, BIT_OR({STORE_BIT}) AS store_bits,
    SUM(sales) AS volume, COUNT(onpromotion) AS known,
    SUM(CASE WHEN promoted THEN sales END) AS promoted_sum,
    COUNT(CASE WHEN promoted THEN sales END) AS promoted_volumes,
    SUM(CASE WHEN NOT promoted THEN sales END) AS other_sum,
    COUNT(CASE WHEN NOT promoted THEN sales END) AS other_volumes,
    COUNT_IF(promoted) AS promoted_rows, COUNT_IF(NOT promoted) AS other_rows
  FROM {view} WHERE {_demand_filter(months)}
  GROUP BY {head}{DAY_WORD}, {STORE_WORD}, family
),
members AS (
  SELECT {head}day_word, store_word,
    GROUPING(day_word) = 0 AS of_days, GROUPING(store_word) = 0 AS of_stores, GROUPING(member_family) = 0 AS of_families,
    BIT_OR(day_bits) AS day_bits, BIT_OR(store_bits) AS store_bits,
    SUM(volume) AS volume, SUM(known) AS known, SUM(promoted_sum) AS promoted_sum,
    SUM(promoted_volumes) AS promoted_volumes, SUM(other_sum) AS other_sum, SUM(other_volumes) AS other_volumes,
    SUM(promoted_rows) AS promoted_rows, SUM(other_rows) AS other_rows
  FROM cells GROUP BY {head}day_word, store_word, member_family GROUPING SETS ({sets})
),
totals AS (
  SELECT {head}SUM(volume) FILTER (WHERE of_days) AS total_demand,
    COALESCE(SUM(IF(day_word IS NULL, 1, BIT_COUNT(day_bits))) FILTER (WHERE of_days), 0) AS observed_days,
    COALESCE(SUM(IF(store_word IS NULL, 1, BIT_COUNT(store_bits))) FILTER (WHERE of_stores), 0) AS store_count,
    COUNT_IF(of_families) AS family_count,
    COALESCE(SUM(known) FILTER (WHERE of_days), 0) AS known,
    SUM(promoted_sum) FILTER (WHERE of_days) AS promoted_sum,
    TRY_DIVIDE(SUM(promoted_sum) FILTER (WHERE of_days), SUM(promoted_volumes) FILTER (WHERE of_days)) AS promoted_mean,
    TRY_DIVIDE(SUM(other_sum) FILTER (WHERE of_days), SUM(other_volumes) FILTER (WHERE of_days)) AS other_mean,
    COALESCE(SUM(promoted_rows) FILTER (WHERE of_days), 0) AS promoted_rows,
    COALESCE(SUM(other_rows) FILTER (WHERE of_days), 0) AS other_rows
  FROM members {f'GROUP BY {group}' if group else ''}
)
SELECT {head}total_demand, observed_days, TRY_DIVIDE(total_demand, observed_days),
  TRY_DIVIDE(total_demand, observed_days), store_count, family_count, known,
  IF(known > 0, promoted_sum, NULL), TRY_DIVIDE(IF(known > 0, promoted_sum, NULL), total_demand),
  promoted_rows, other_rows, promoted_mean, other_mean, TRY_DIVIDE(promoted_mean - other_mean, other_mean)
FROM totals"""


def _planning_text(view: str, keys: Sequence[str]) -> str:
    group = ", ".join(keys)
    classes = ", ".join(
        f"COUNT_IF(risk = '{risk}')" for risk in (REORDER, MONITOR, HEALTHY, OVERSTOCK, INSUFFICIENT)
    )
    chosen = " AND ".join(
        _among(*pair) for pair in (
            ("store_nbr", "stores"), ("family", "families"), ("risk", "risks"), ("inventory_source", "sources"))
    )
    return f"""
SELECT {f'{group}, ' if group else ''}AVG(days_of_supply), AVG(reorder_point), COUNT(*), {classes},
  COUNT_IF(risk IN ('{REORDER}', '{MONITOR}', '{OVERSTOCK}')), SUM(reorder_quantity), MAX(forecast_date)
FROM {view} WHERE {chosen} {f'GROUP BY {group}' if group else ''}"""


def _create(spark: SparkSession, name: str, arguments: str, like: DataFrame, body: str) -> str:
    returned = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in like.schema.fields)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE ({returned}) RETURN {body}")
    return name


def register_functions(
    spark: SparkSession, demand: str | None = "daily_sales", plan: str | None = "reorder_risk",
    volatility: str | None = "demand_volatility", prefix: str = "",
) -> list[str]:
    """Create the table functions over the views of ``register_views``, or others; returns their names.
    A view given as None has none."""
    names = []
    if demand:
        daily = spark.table(demand)
        for suffix, keys in DEMAND_KEYS.items():
            body = _demand_text(demand, keys, MONTH in daily.columns)
            names.append(
                _create(spark, f"{prefix}demand_measures{suffix}", DEMAND_ARGUMENTS, demand_measures(daily, keys), body)
            )
    if plan:
        for suffix, keys in PLANNING_KEYS.items():
            like = planning_measures(spark.table(plan), keys)
            names.append(
                _create(spark, f"{prefix}planning_measures{suffix}", PLANNING_ARGUMENTS, like, _planning_text(plan, keys))
            )
    if volatility:
        name = f"{prefix}average_demand_volatility"
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}() RETURNS TABLE (average_demand_volatility double) "
            f"RETURN SELECT AVG(daily_std) FROM {volatility}"
        )
        names.append(name)
    return names
