"""Independent SQL for every registered query, over the raw tables.

The facts are common table expressions; each statement then states the result in plain
SQL rather than following the DataFrame code.
"""

from __future__ import annotations

EVENTS = """
f AS (
  SELECT CAST(ts AS DATE) AS date, CAST(user_id % 5 + 1 AS BIGINT) AS store_nbr, event_type AS family,
         sum(value) AS sales, CAST(count(*) FILTER (WHERE value >= 60) AS DOUBLE) AS onpromotion
  FROM events GROUP BY 1, 2, 3)"""

EDGE = """
f AS (
  SELECT CAST(ts AS DATE) AS date, user_id + 1 AS store_nbr, event_type AS family,
         sum(floor(value / 10)) AS sales,
         CASE WHEN event_type <> 'error' THEN CAST(sum(CASE WHEN value >= 60 THEN 1 ELSE 0 END) AS DOUBLE) END
           AS onpromotion
  FROM events GROUP BY 1, 2, 3)"""

ORDERS = """
f AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS store_nbr, 'order ' || l_orderkey AS family,
         sum(round(l_quantity * l_discount * 100)) AS sales,
         CASE WHEN min(l_linestatus) <> 'O' THEN CAST(count(*) FILTER (WHERE l_tax >= 0.05e0) AS DOUBLE) END AS onpromotion
  FROM lineitem GROUP BY 1, 2, 3)"""

LINEITEM = """
f AS (
  SELECT CAST(l_shipdate AS DATE) AS date, CAST(s_nationkey % 3 + 1 AS BIGINT) AS store_nbr,
         p_type AS family, sum(l_quantity) AS sales,
         CAST(count(*) FILTER (WHERE l_discount >= 0.09e0) AS DOUBLE) AS onpromotion
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3)"""

STOCK = """,
stock AS (
  SELECT date, store_nbr, family, sales * 10 + 100 AS inventory_on_hand
  FROM f WHERE date >= DATE '2024-01-29' AND store_nbr % 3 = 1)"""

DAILY = """,
daily AS (
  SELECT date, store_nbr, family, sales, onpromotion,
         onpromotion > 0 AS promoted,
         (dayofweek(date) + 6) % 7 + 1 AS weekday_number,
         CASE WHEN dayofweek(date) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type
  FROM f)"""

UNCHECKED = """
f AS (
  SELECT CASE WHEN event_type = 'error' AND user_id % 7 = 3 THEN '2024-02-30'
              WHEN event_type = 'signup' AND user_id % 11 = 7 THEN ' '
              WHEN event_type = 'view' AND user_id % 7 = 4 THEN strftime(ts, '%Y/%m/%d')
              ELSE strftime(ts, '%Y-%m-%d') END AS date,
         CASE WHEN event_type = 'click' AND user_id % 11 = 5 THEN '0'
              WHEN event_type = 'click' AND user_id % 11 = 6 THEN '2.5'
              WHEN event_type = 'view' AND user_id % 13 = 7 THEN NULL
              ELSE CAST(user_id % 5 + 1 AS VARCHAR) END AS store_nbr,
         CASE WHEN event_type = 'signup' AND user_id % 13 = 2 THEN '  '
              ELSE ' ' || event_type || chr(9) END AS family,
         event_type, user_id
  FROM events)"""


def _round(*names: str, digits: int = 6) -> str:
    return ", ".join(f"round({name}, {digits}) AS {name}" for name in names)


def _forecast(window: int = 28, lead: int = 7) -> str:
    return f""",
hi AS (SELECT max(date) AS d FROM f),
recent AS (
  SELECT store_nbr, family, avg(sales) AS a, stddev_samp(sales) AS s,
         count(DISTINCT date) AS n, max(date) AS last_day
  FROM f, hi WHERE date BETWEEN hi.d - {window - 1} AND hi.d GROUP BY store_nbr, family),
fc AS (
  SELECT k.store_nbr, k.family, a AS recent_average, s AS demand_std,
         coalesce(n, 0) AS observed_days, last_day AS last_observed_date,
         coalesce(n, 0) / {window}e0 AS coverage, hi.d AS forecast_date,
         a * {lead} AS expected_lead_time_demand,
         CASE WHEN n = {window} THEN 'Full window' ELSE 'Incomplete history' END AS forecast_quality
  FROM (SELECT DISTINCT store_nbr, family FROM f) k CROSS JOIN hi
  LEFT JOIN recent r ON r.store_nbr = k.store_nbr AND r.family = k.family)"""


def _plan(window: int = 28, lead: int = 7, review: int = 7, z: str = "1.65e0", stock: bool = False) -> str:
    counted = "c.inventory_on_hand" if stock else "CAST(NULL AS DOUBLE)"
    join = (
        "LEFT JOIN stock c ON c.date = t.forecast_date AND c.store_nbr = t.store_nbr AND c.family = t.family"
        if stock
        else ""
    )
    return _forecast(window, lead) + f""",
targets AS (
  SELECT *, {z} * demand_std * sqrt({lead}) AS safety_stock,
         expected_lead_time_demand + {z} * demand_std * sqrt({lead}) AS reorder_point,
         recent_average * {lead + review} + {z} * demand_std * sqrt({lead + review}) AS target_stock_level,
         (row_number() OVER (ORDER BY store_nbr, family) - 1) % 4 AS slot
  FROM fc),
stocked AS (
  SELECT t.*,
         coalesce({counted}, reorder_point * CASE slot WHEN 0 THEN 0.5e0 WHEN 1 THEN 1.05e0
                                                       WHEN 2 THEN 1.4e0 ELSE 4e0 END) AS inventory_on_hand,
         CASE WHEN {counted} IS NULL THEN 'Simulated scenario'
              ELSE 'Provided as-of snapshot (not independently verified)' END AS inventory_source
  FROM targets t {join}),
plan AS (
  SELECT store_nbr, family, recent_average, demand_std, observed_days, last_observed_date, coverage,
         forecast_date, expected_lead_time_demand, forecast_quality, safety_stock, reorder_point,
         target_stock_level, inventory_on_hand, inventory_source,
         CASE WHEN recent_average > 0 THEN inventory_on_hand / recent_average END AS days_of_supply,
         CASE WHEN observed_days = {window} THEN
           CASE WHEN target_stock_level > inventory_on_hand THEN target_stock_level - inventory_on_hand
                ELSE 0e0 END END AS reorder_quantity,
         CASE WHEN observed_days < {window} THEN 'Insufficient history'
              WHEN inventory_on_hand < reorder_point THEN 'Reorder now'
              WHEN inventory_on_hand <= 1.1e0 * reorder_point THEN 'Monitor'
              WHEN inventory_on_hand > 1.5e0 * target_stock_level THEN 'Overstock risk'
              ELSE 'Healthy' END AS risk
  FROM stocked)"""


PLAN_ROWS = (
    "SELECT store_nbr, family, observed_days, last_observed_date, forecast_date, forecast_quality, "
    "inventory_source, risk, "
    + _round(
        "recent_average", "demand_std", "coverage", "expected_lead_time_demand", "safety_stock",
        "reorder_point", "target_stock_level", "inventory_on_hand", "days_of_supply", "reorder_quantity",
    )
    + " FROM plan"
)

FORECAST_ROWS = (
    "SELECT store_nbr, family, observed_days, last_observed_date, forecast_date, forecast_quality, "
    + _round("recent_average", "demand_std", "coverage", "expected_lead_time_demand")
    + " FROM fc"
)

DAILY_ROWS = (
    "SELECT date, store_nbr, family, round(sales, 6) AS sales, onpromotion, promoted, weekday_number, "
    "day_type FROM daily"
)

WEEKLY = """,
weekly AS (
  SELECT date - CAST(isodow(date) - 1 AS INTEGER) AS week, store_nbr, family, sum(sales) AS sales,
         count(DISTINCT date) AS observed_days
  FROM f GROUP BY 1, 2, 3)"""
WEEKLY_ROWS = "SELECT week, store_nbr, family, round(sales, 6) AS sales, observed_days FROM weekly"

STORES = """,
stores AS (
  SELECT *, total_sales / observed_days AS average_daily_sales
  FROM (SELECT store_nbr, sum(sales) AS total_sales, count(DISTINCT date) AS observed_days
        FROM f GROUP BY store_nbr) s)"""
STORE_ROWS = "SELECT store_nbr, observed_days, " + _round("total_sales", "average_daily_sales") + " FROM stores"

FAMILIES = """,
families AS (
  SELECT family, sum(sales) AS total_sales, count(DISTINCT date) AS observed_days
  FROM f GROUP BY family)"""
FAMILY_ROWS = "SELECT family, observed_days, round(total_sales, 6) AS total_sales FROM families"

PROMOTIONS = """,
promotions AS (
  SELECT *, (promoted_average - nonpromoted_average) * 100 / nullif(nonpromoted_average, 0) AS lift_pct
  FROM (
    SELECT family, avg(sales) FILTER (WHERE onpromotion > 0) AS promoted_average,
           avg(sales) FILTER (WHERE onpromotion = 0) AS nonpromoted_average,
           count(*) FILTER (WHERE onpromotion > 0) AS promoted_rows,
           count(*) FILTER (WHERE onpromotion = 0) AS nonpromoted_rows
    FROM f GROUP BY family) g)"""
PROMOTION_ROWS = (
    "SELECT family, promoted_rows, nonpromoted_rows, "
    + _round("promoted_average", "nonpromoted_average", "lift_pct")
    + " FROM promotions"
)

VOLATILITY = """,
volatility AS (
  SELECT *, CASE WHEN daily_mean <> 0 THEN daily_std / daily_mean END AS coefficient_of_variation
  FROM (SELECT family, avg(day_sales) AS daily_mean, stddev_samp(day_sales) AS daily_std
        FROM (SELECT date, family, sum(sales) AS day_sales FROM f GROUP BY date, family) d
        GROUP BY family) v)"""
VOLATILITY_ROWS = (
    "SELECT family, " + _round("daily_mean", "daily_std", "coefficient_of_variation") + " FROM volatility"
)

KPIS = """,
kpis AS (
  SELECT sum(sales) AS total_sales, sum(sales) / count(DISTINCT date) AS average_daily_sales,
         count(DISTINCT store_nbr) AS stores, count(DISTINCT family) AS families,
         min(date) AS "start", max(date) AS "end",
         CASE WHEN count(onpromotion) > 0
              THEN coalesce(sum(sales) FILTER (WHERE onpromotion > 0), 0e0) END AS promoted_sales
  FROM f)"""

ADVICE = """,
advice AS (
  SELECT 'Store ' || store_nbr || ' / ' || family AS scope,
         CASE WHEN risk = 'Reorder now'
              THEN inventory_source || printf('; stock %.1f < reorder point %.1f', inventory_on_hand, reorder_point)
              ELSE 'Recent daily coefficient of variation exceeds 0.5' END AS evidence,
         CASE WHEN risk = 'Reorder now'
              THEN 'Review replenishment under these planning assumptions; this is not an observed stockout.'
              ELSE 'Monitor variability and investigate demand spikes before changing safety stock.'
         END AS recommendation
  FROM plan
  WHERE risk = 'Reorder now' OR (recent_average > 0 AND demand_std / recent_average > 0.5e0)
  UNION ALL
  SELECT 'Store ' || store_nbr, 'Highest observed sales volume: ' || format('{:,.1f}', total_sales),
         'Prioritize replenishment review; volume alone does not establish profitability or persistent performance.'
  FROM (SELECT * FROM stores ORDER BY total_sales DESC, store_nbr LIMIT 1) top
  UNION ALL
  SELECT family, printf('Observed promotion lift %.1f%%', lift_pct),
         'Review promotion timing, store mix and margin before deciding whether to continue promotions.'
  FROM promotions
  WHERE lift_pct <= 0 AND promoted_rows >= 5 AND nonpromoted_rows >= 5)"""

STAR = """,
star AS (
  SELECT *, date - CAST(isodow(date) - 1 AS INTEGER) AS week_start, dayname(date) AS weekday
  FROM daily)"""


def _measures(source: str, key: str | None = None, where: str = "TRUE") -> str:
    select = f"{key}, " if key else ""
    group = f" GROUP BY {key}" if key else ""
    return (
        f"SELECT {select}observed_days, store_count, family_count, known_promotion_rows, "
        "promoted_row_count, nonpromoted_row_count, "
        + _round(
            "total_demand", "promoted_demand", "average_promoted_row_demand",
            "average_nonpromoted_row_demand",
        )
        + ", round(total_demand / nullif(observed_days, 0), 6) AS average_daily_demand, "
        "round(total_demand / nullif(observed_days, 0), 6) AS average_daily_sales, "
        "round(promoted_demand / nullif(total_demand, 0), 6) AS promotion_share, "
        "round((average_promoted_row_demand - average_nonpromoted_row_demand) "
        "/ nullif(average_nonpromoted_row_demand, 0), 6) AS promotion_lift "
        f"FROM (SELECT {select}sum(sales) AS total_demand, count(DISTINCT date) AS observed_days, "
        "count(DISTINCT store_nbr) AS store_count, count(DISTINCT family) AS family_count, "
        "count(onpromotion) AS known_promotion_rows, "
        "sum(sales) FILTER (WHERE promoted) AS promoted_demand, "
        "count(*) FILTER (WHERE promoted) AS promoted_row_count, "
        "count(*) FILTER (WHERE NOT promoted) AS nonpromoted_row_count, "
        "avg(sales) FILTER (WHERE promoted) AS average_promoted_row_demand, "
        "avg(sales) FILTER (WHERE NOT promoted) AS average_nonpromoted_row_demand "
        f"FROM {source} WHERE {where}{group}) m"
    )


def _plan_measures(key: str | None = None, where: str = "TRUE") -> str:
    select = f"{key}, " if key else ""
    group = f" GROUP BY {key}" if key else ""
    return (
        f"SELECT {select}round(avg(days_of_supply), 6) AS average_days_of_supply, "
        "round(avg(reorder_point), 6) AS average_reorder_point, count(*) AS planning_series_count, "
        "count(*) FILTER (WHERE risk = 'Reorder now') AS reorder_now_count, "
        "count(*) FILTER (WHERE risk = 'Monitor') AS monitor_count, "
        "count(*) FILTER (WHERE risk = 'Healthy') AS healthy_count, "
        "count(*) FILTER (WHERE risk = 'Overstock risk') AS overstock_risk_count, "
        "count(*) FILTER (WHERE risk = 'Insufficient history') AS insufficient_history_count, "
        "count(*) FILTER (WHERE risk IN ('Reorder now', 'Monitor', 'Overstock risk')) "
        "AS series_requiring_attention, "
        "round(sum(reorder_quantity), 6) AS total_recommended_reorder_quantity, "
        f"max(forecast_date) AS snapshot_as_of FROM plan WHERE {where}{group}"
    )


CUBE_ROWS = """
SELECT store_nbr, family, CAST(grouping(store_nbr, family) AS INTEGER) AS level,
       round(sum(sales), 6) AS total_demand, count(DISTINCT date) AS observed_days,
       round(sum(sales) / count(DISTINCT date), 6) AS average_daily_demand
FROM f GROUP BY CUBE (store_nbr, family)"""

REPORT = """,
report AS (
  SELECT 'raw' AS source, 'User-provided retail CSVs; provenance must be verified' AS data_label,
         (SELECT count(*) FROM f) AS "rows",
         {'total_sales': round(total_sales, 6), 'average_daily_sales': round(average_daily_sales, 6),
          'stores': stores, 'families': families, 'start': "start", 'end': "end",
          'promoted_sales': round(promoted_sales, 6)} AS kpis,
         {'window_days': 2, 'lead_time_days': 7, 'review_days': 7, 'z_score': 1.65e0} AS planning,
         CASE WHEN (SELECT bool_or(coverage < 1) FROM plan) THEN
           ['checked', 'Some store/family series have incomplete trailing history; actionable reorder quantities are suppressed.']
         ELSE ['checked'] END AS warnings,
         "end" AS as_of
  FROM kpis)"""

COMPLETE = """,
complete AS (
  SELECT week, count(*) AS series, min(observed_days) AS min_days FROM weekly GROUP BY week
  HAVING count(*) = (SELECT count(*) FROM (SELECT DISTINCT store_nbr, family FROM f) k)
     AND min(observed_days) = 7)"""


def _with(*parts: str) -> str:
    *ctes, body = parts
    return "WITH " + "".join(ctes).strip() + "\n" + body


def _plan_grid() -> str:
    """Twenty plans, each worked out by itself."""
    settings = [(w, *lr, z) for w in (2, 7, 14, 21, 28) for lr in ((5, 3), (7, 7)) for z in ("1.28e0", "1.65e0")]
    rows = [
        f"SELECT {i} AS setting, {w} AS window_days, {lead} AS lead_time_days, {review} AS review_days, {z} AS z_score, * "
        f"FROM ({_with(EVENTS, _plan(w, lead, review, z), PLAN_ROWS)})"
        for i, (w, lead, review, z) in enumerate(settings)
    ]
    return "\nUNION ALL ".join(rows)


EDGE_PLAN = _plan(2)
STOCKED_PLAN = STOCK + _plan(2, stock=True)

ORACLES: dict[str, str] = {
    "dq_counts": _with(
        UNCHECKED,
        """SELECT count(*) AS "rows", count(*) FILTER (WHERE trim(date) = '') AS missing_date,
       count(*) FILTER (WHERE store_nbr IS NULL) AS missing_store_nbr,
       count(*) FILTER (WHERE trim(family) = '') AS missing_family,
       count(*) FILTER (WHERE NOT coalesce(regexp_full_match(date, '\\d{4}-\\d\\d?-\\d\\d?')
                                           AND try_cast(date AS DATE) IS NOT NULL, false)) AS invalid_date,
       count(*) FILTER (WHERE event_type = 'purchase' AND user_id % 5 IN (1, 2, 3)) AS invalid_sales,
       count(*) FILTER (WHERE store_nbr IS NULL OR store_nbr IN ('0', '2.5')) AS invalid_store_nbr
FROM f""",
    ),
    "dq_duplicates": _with(
        UNCHECKED,
        """SELECT CASE WHEN regexp_full_match(date, '\\d{4}-\\d\\d?-\\d\\d?') THEN try_cast(date AS DATE) END AS date,
       CASE WHEN store_nbr NOT IN ('0', '2.5') THEN CAST(store_nbr AS BIGINT) END AS store_nbr,
       trim(replace(family, chr(9), '')) AS family, count(*) AS "rows"
FROM f GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    ),
    "silver_sales": _with(
        EVENTS, "SELECT date, store_nbr, family, round(sales, 6) AS sales, onpromotion FROM f"
    ),
    "silver_from_files": _with(
        EVENTS, "SELECT date, store_nbr, family, round(sales, 6) AS sales, onpromotion FROM f"
    ),
    "context_from_files": _with(
        EDGE,
        STOCK,
        """,
days AS (SELECT CAST(ts AS DATE) AS date, max(value) AS price FROM events GROUP BY 1)
SELECT 'inventory' AS source, date, store_nbr, family, round(inventory_on_hand, 6) AS amount FROM stock
UNION ALL
SELECT 'oil', date, NULL, NULL, CASE WHEN dayofweek(date) IN (2, 3, 4, 5) THEN round(price, 6) END FROM days""",
    ),
    "daily_sales": _with(EVENTS, DAILY, DAILY_ROWS),
    "daily_sales_edge": _with(EDGE, DAILY, DAILY_ROWS),
    "daily_sales_unknown_promo": _with(
        EVENTS,
        DAILY,
        "SELECT date, store_nbr, family, round(sales, 6) AS sales, CAST(NULL AS DOUBLE) AS onpromotion, "
        "CAST(NULL AS BOOLEAN) AS promoted, weekday_number, day_type FROM daily",
    ),
    "weekly_sales": _with(EDGE, WEEKLY, WEEKLY_ROWS),
    "weekly_sales_lineitem": _with(LINEITEM, WEEKLY, WEEKLY_ROWS),
    "store_performance": _with(EDGE, STORES, STORE_ROWS),
    "store_performance_lineitem": _with(LINEITEM, STORES, STORE_ROWS),
    "family_performance": _with(EDGE, FAMILIES, FAMILY_ROWS),
    "family_performance_lineitem": _with(LINEITEM, FAMILIES, FAMILY_ROWS),
    "promotion_impact": _with(EDGE, PROMOTIONS, PROMOTION_ROWS),
    "promotion_impact_lineitem": _with(
        LINEITEM,
        PROMOTIONS,
        PROMOTION_ROWS.replace("SELECT ", "SELECT row_number() OVER (ORDER BY promotions.lift_pct) AS position, ", 1),
    ),
    "promotion_impact_orders": _with(ORDERS, PROMOTIONS, PROMOTION_ROWS),
    "demand_volatility_orders": _with(ORDERS, VOLATILITY, VOLATILITY_ROWS),
    "demand_volatility": _with(EDGE, VOLATILITY, VOLATILITY_ROWS),
    "demand_volatility_lineitem": _with(LINEITEM, VOLATILITY, VOLATILITY_ROWS),
    "kpis": _with(
        EDGE,
        KPIS,
        'SELECT stores, families, "start", "end", '
        + _round("total_sales", "average_daily_sales", "promoted_sales")
        + " FROM kpis",
    ),
    "forecast": _with(EDGE, _forecast(2), FORECAST_ROWS),
    "forecast_lineitem": _with(LINEITEM, _forecast(), FORECAST_ROWS),
    "reorder_risk": _with(EDGE, EDGE_PLAN, PLAN_ROWS),
    "reorder_risk_actual": _with(EDGE, STOCKED_PLAN, PLAN_ROWS),
    "reorder_risk_w14": _with(EVENTS, _plan(14, 5, 3, "1.28e0"), PLAN_ROWS),
    "reorder_risk_grid": _plan_grid(),
    "reorder_risk_lineitem": _with(LINEITEM, _plan(), PLAN_ROWS),
    "scenario_index": """
SELECT l_suppkey AS store_nbr, part_text AS family,
       row_number() OVER (ORDER BY l_suppkey, part_text) - 1 AS series_position
FROM (SELECT DISTINCT l_suppkey, CAST(l_partkey AS VARCHAR) AS part_text FROM lineitem) pairs""",
    "risk_boundaries": """
SELECT CASE WHEN l_quantity < size THEN 'Reorder now'
            WHEN l_quantity <= 1.1e0 * size THEN 'Monitor'
            WHEN l_quantity > 1.5e0 * (2 * size) THEN 'Overstock risk'
            ELSE 'Healthy' END AS risk,
       l_quantity AS stock, count(*) AS "rows"
FROM (SELECT l_quantity, CAST(p_size AS DOUBLE) AS size
      FROM lineitem JOIN part ON l_partkey = p_partkey) s
GROUP BY 1, 2""",
    "recommendations": _with(
        EDGE, STOCKED_PLAN, STORES, PROMOTIONS, ADVICE, "SELECT scope, evidence, recommendation FROM advice"
    ),
    "recommendations_lineitem": _with(
        LINEITEM, _plan(), STORES, PROMOTIONS, ADVICE, "SELECT scope, evidence, recommendation FROM advice"
    ),
    "recommendations_scope": _with(
        EDGE,
        EDGE_PLAN,
        STORES,
        PROMOTIONS,
        ADVICE,
        "SELECT scope, evidence, recommendation FROM advice WHERE contains(scope, 'Store 1')",
    ),
    "plan_orphans": _with(
        EDGE,
        EDGE_PLAN,
        "SELECT store_nbr, family FROM plan p WHERE (store_nbr, family) NOT IN "
        "(SELECT (user_id % 5 + 1, event_type) FROM events)",
    ),
    "reconcile_totals": _with(
        EDGE,
        "SELECT mart, round(total, 6) AS total_sales, 0e0 AS difference "
        "FROM (SELECT sum(sales) AS total FROM f) t, "
        "(VALUES ('daily_sales'), ('weekly_sales'), ('store_performance'), ('family_performance')) m(mart)",
    ),
    "bq_store_share": _with(
        EDGE,
        STORES,
        "SELECT store_nbr, observed_days, round(total_sales, 2) AS demand_volume, "
        "round(average_daily_sales, 2) AS average_daily_demand, "
        "round(100e0 * total_sales / (SELECT sum(sales) FROM f), 1) AS volume_share_pct, "
        "row_number() OVER (ORDER BY total_sales DESC, store_nbr) AS position FROM stores",
    ),
    "bq_promo_within_store": _with(
        EDGE,
        """SELECT store_nbr, family, promoted_rows, nonpromoted_rows, round(promoted_mean, 6) AS promoted_mean,
       round(nonpromoted_mean, 6) AS nonpromoted_mean,
       round(100e0 * (promoted_mean / nullif(nonpromoted_mean, 0) - 1), 1)
         AS descriptive_difference_pct,
       row_number() OVER (ORDER BY family, store_nbr) AS position
FROM (SELECT store_nbr, family, count(*) FILTER (WHERE onpromotion > 0) AS promoted_rows,
             count(*) FILTER (WHERE onpromotion = 0) AS nonpromoted_rows,
             avg(sales) FILTER (WHERE onpromotion > 0) AS promoted_mean,
             avg(sales) FILTER (WHERE onpromotion = 0) AS nonpromoted_mean
      FROM f GROUP BY store_nbr, family) g
WHERE promoted_rows >= 5 AND nonpromoted_rows >= 5""",
    ),
    "bq_family_variability": _with(
        LINEITEM,
        VOLATILITY,
        "SELECT family, round(daily_mean, 2) AS average_daily_demand, "
        "round(daily_std, 2) AS daily_standard_deviation, round(coefficient_of_variation, 3) AS cv, "
        "row_number() OVER (ORDER BY coefficient_of_variation DESC NULLS LAST, family) AS position "
        "FROM volatility",
    ),
    "bq_family_variability_orders": _with(
        ORDERS,
        VOLATILITY,
        "SELECT family, round(daily_mean, 2) AS average_daily_demand, "
        "round(daily_std, 2) AS daily_standard_deviation, round(coefficient_of_variation, 3) AS cv "
        "FROM volatility",
    ),
    "bq_review_queue": _with(
        EDGE,
        EDGE_PLAN,
        "SELECT store_nbr, family, forecast_date, inventory_source, round(coverage, 6) AS coverage, risk, "
        "round(inventory_on_hand, 1) AS stock, round(reorder_point, 1) AS reorder_point, "
        "round(reorder_quantity, 1) AS scenario_quantity, "
        "row_number() OVER (ORDER BY CASE risk WHEN 'Insufficient history' THEN 1 WHEN 'Reorder now' THEN 2 "
        "WHEN 'Monitor' THEN 3 ELSE 4 END, store_nbr, family) AS position FROM plan WHERE risk <> 'Healthy'",
    ),
    "most_variable_family": _with(
        EDGE, VOLATILITY, VOLATILITY_ROWS + " ORDER BY volatility.coefficient_of_variation DESC, family LIMIT 1"
    ),
    "top_store_share": _with(
        EDGE,
        STORES,
        "SELECT store_nbr, round(total_sales, 6) AS total_sales, "
        "round(total_sales / (SELECT sum(total_sales) FROM stores), 6) AS share "
        "FROM stores ORDER BY stores.total_sales DESC, store_nbr LIMIT 1",
    ),
    "complete_weeks": _with(EVENTS, WEEKLY, COMPLETE, "SELECT week, series, min_days FROM complete"),
    "weekly_trend_index": _with(
        EVENTS,
        WEEKLY,
        COMPLETE,
        """SELECT week, family, round(volume, 6) AS volume,
       round(100 * volume / nullif(base, 0), 6) AS volume_index
FROM (SELECT v.*, first_value(volume) OVER (PARTITION BY family ORDER BY week) AS base
      FROM (SELECT week, family, sum(sales) AS volume FROM weekly
            WHERE week IN (SELECT week FROM complete) GROUP BY week, family) v) b""",
    ),
    "risk_counts": _with(
        EDGE,
        EDGE_PLAN,
        "SELECT c.risk, count(p.risk) AS series, c.position "
        "FROM (VALUES ('Insufficient history', 1), ('Reorder now', 2), ('Monitor', 3), ('Healthy', 4), "
        "('Overstock risk', 5)) c(risk, position) LEFT JOIN plan p ON p.risk = c.risk GROUP BY c.risk, c.position",
    ),
    "series_keys": _with(LINEITEM, "SELECT DISTINCT store_nbr, family FROM f"),
    "dim_store": _with(LINEITEM, "SELECT DISTINCT store_nbr FROM f"),
    "dim_family": _with(LINEITEM, "SELECT DISTINCT family FROM f"),
    "dim_date": _with(
        LINEITEM,
        """SELECT d AS date, CAST(date_trunc('week', d) AS DATE) AS week_start, isodow(d) AS weekday_number,
       dayname(d) AS weekday, CASE WHEN isodow(d) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type
FROM (SELECT CAST(unnest(generate_series(date_trunc('year', lo),
                                         date_trunc('year', hi) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                                         INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT min(date) AS lo, max(date) AS hi FROM f) r) days""",
    ),
    "star_demand": _with(
        EDGE,
        DAILY,
        STAR,
        "SELECT date, store_nbr, family, round(sales, 6) AS sales, onpromotion, promoted, weekday_number, "
        "day_type, week_start, weekday FROM star",
    ),
    "star_plan": _with(EDGE, STOCKED_PLAN, PLAN_ROWS),
    "store_family_cube": _with(EDGE, CUBE_ROWS),
    "store_family_cube_lineitem": _with(LINEITEM, CUBE_ROWS),
    "measures_total": _with(EDGE, DAILY, _measures("daily")),
    "measures_by_store": _with(EDGE, DAILY, _measures("daily", "store_nbr")),
    "measures_by_weekday": _with(EDGE, DAILY, _measures("daily", "weekday_number, day_type")),
    "measures_filtered": _with(
        EDGE,
        DAILY,
        _measures(
            "daily",
            "family",
            "date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21' AND store_nbr IN (1, 2, 3) "
            "AND family IN ('click', 'view')",
        ),
    ),
    "measures_lineitem": _with(LINEITEM, DAILY, _measures("daily", "family")),
    "avg_volatility": _with(
        EDGE, VOLATILITY, "SELECT round(avg(daily_std), 6) AS average_demand_volatility FROM volatility"
    ),
    "plan_measures_total": _with(EDGE, STOCKED_PLAN, _plan_measures()),
    "plan_measures_by_store": _with(EDGE, STOCKED_PLAN, _plan_measures("store_nbr")),
    "plan_measures_filtered": _with(
        EDGE,
        STOCKED_PLAN,
        _plan_measures(
            "family",
            "store_nbr IN (1, 2) AND inventory_source = 'Provided as-of snapshot (not independently verified)'",
        ),
    ),
    "page_daily": _with(EDGE, "SELECT date, round(sum(sales), 6) AS total_demand FROM f GROUP BY date"),
    "top_families": _with(
        ORDERS,
        "SELECT family, round(total, 6) AS total_demand, row_number() OVER (ORDER BY total DESC, family) AS position "
        "FROM (SELECT family, sum(sales) AS total FROM f GROUP BY family ORDER BY total DESC, family LIMIT 10) t",
    ),
    "weekly_top_families": _with(
        EDGE,
        DAILY,
        STAR,
        "SELECT week_start, family, round(sum(sales), 6) AS total_demand FROM star WHERE family IN "
        "(SELECT family FROM f GROUP BY family ORDER BY sum(sales) DESC, family LIMIT 4) "
        "GROUP BY week_start, family",
    ),
    "page_weekday": _with(
        EDGE,
        DAILY,
        STAR,
        "SELECT weekday_number, weekday, round(sum(sales) / count(DISTINCT date), 6) AS average_daily_demand, "
        "row_number() OVER (ORDER BY weekday_number) AS position "
        "FROM star GROUP BY weekday_number, weekday",
    ),
    "page_day_type": _with(
        EDGE,
        DAILY,
        "SELECT day_type, round(sum(sales) / count(DISTINCT date), 6) AS average_daily_demand "
        "FROM daily GROUP BY day_type",
    ),
    "page_store": _with(
        EDGE,
        "SELECT store_nbr, round(sum(sales), 6) AS total_demand, "
        "row_number() OVER (ORDER BY sum(sales) DESC, store_nbr) AS position FROM f GROUP BY store_nbr",
    ),
    "page_promo": _with(
        EDGE,
        PROMOTIONS,
        "SELECT family, round(promoted_average, 6) AS average_promoted_row_demand, "
        "round(nonpromoted_average, 6) AS average_nonpromoted_row_demand, "
        "round((promoted_average - nonpromoted_average) / nullif(nonpromoted_average, 0), 6) AS promotion_lift, "
        "promoted_rows AS promoted_row_count, nonpromoted_rows AS nonpromoted_row_count FROM promotions",
    ),
    "page_promo_orders": _with(
        ORDERS,
        PROMOTIONS,
        "SELECT family, round(promoted_average, 6) AS average_promoted_row_demand, "
        "round(nonpromoted_average, 6) AS average_nonpromoted_row_demand, "
        "round((promoted_average - nonpromoted_average) / nullif(nonpromoted_average, 0), 6) AS promotion_lift, "
        "promoted_rows AS promoted_row_count, nonpromoted_rows AS nonpromoted_row_count FROM promotions",
    ),
    "page_risk": _with(
        EDGE,
        STOCKED_PLAN,
        "SELECT risk, count(*) AS planning_series_count FROM plan WHERE store_nbr IN (1, 3, 4) GROUP BY risk",
    ),
    "page_plan_detail": _with(
        EDGE,
        STOCKED_PLAN,
        "SELECT * EXCLUDE (observed_days, last_observed_date, expected_lead_time_demand) FROM ("
        + PLAN_ROWS
        + ") detail",
    ),
    "page_plan_filtered": _with(
        EDGE,
        STOCKED_PLAN,
        "SELECT * EXCLUDE (observed_days, last_observed_date, expected_lead_time_demand) FROM ("
        + PLAN_ROWS
        + ") detail WHERE family IN ('click', 'view') AND inventory_source = 'Simulated scenario' "
        "AND risk IN ('Insufficient history', 'Reorder now')",
    ),
    "run_report": _with(
        EDGE, EDGE_PLAN, KPIS, REPORT, "SELECT CAST(to_json(report) AS VARCHAR) AS report_json FROM report"
    ),
    "quality_summary": _with(
        EDGE,
        EDGE_PLAN,
        KPIS,
        REPORT,
        """SELECT 'source' AS "check", source AS "value" FROM report
UNION ALL SELECT 'data_label', data_label FROM report
UNION ALL SELECT 'rows', CAST("rows" AS VARCHAR) FROM report
UNION ALL SELECT 'kpis', CAST(to_json(kpis) AS VARCHAR) FROM report
UNION ALL SELECT 'planning', CAST(to_json(planning) AS VARCHAR) FROM report
UNION ALL SELECT 'warnings', CAST(to_json(warnings) AS VARCHAR) FROM report
UNION ALL SELECT 'as_of', CAST(as_of AS VARCHAR) FROM report""",
    ),
    "report_labels": _with(
        EDGE,
        EDGE_PLAN,
        KPIS,
        REPORT,
        "SELECT data_label AS data_source_label, CAST(to_json(planning) AS VARCHAR) AS planning_assumptions "
        "FROM report",
    ),
    "overview_kpis": _with(
        EDGE,
        EDGE_PLAN,
        """SELECT 'Total demand volume' AS metric, round(sum(sales), 2) AS "value" FROM f
UNION ALL SELECT 'Product families', CAST(count(DISTINCT family) AS DOUBLE) FROM f
UNION ALL SELECT 'Stores', CAST(count(DISTINCT store_nbr) AS DOUBLE) FROM f
UNION ALL SELECT 'Reorder now series', CAST(count(*) FILTER (WHERE risk = 'Reorder now') AS DOUBLE) FROM plan""",
    ),
}

# The same results from SQL table functions.
ORACLES |= {
    f"sql_{name}": ORACLES[name] for name in ("measures_total", "measures_filtered", "plan_measures_filtered")
}
