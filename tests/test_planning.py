"""Forecast, plan, scenario order and recommendations."""

import datetime
import random
import statistics

import pytest
from pyspark.sql import Window, functions as F

from shared import SALES_SCHEMA
from shelfcast.config import PlanningConfig
from shelfcast.operators import advice, forecast, planning

STOCK_SCHEMA = "date date, store_nbr long, family string, inventory_on_hand double"


def plan_of(sales, config, snapshot=None):
    return planning.plan_inventory(forecast.forecast_demand(sales, config), config, snapshot)


def test_classes_meet_at_their_limits(spark):
    """Reorder point 40, target 50: each limit belongs to the class below it in the rule order."""
    stocks = [0.0, 39.999, 40.0, 44.0, 44.001, 75.0, 75.001, 1e6]
    rows = spark.createDataFrame([(s,) for s in stocks], "stock double").select(
        "stock", planning.risk_column(F.col("stock"), F.lit(40.0), F.lit(50.0)).alias("risk")
    )
    found = [r["risk"] for r in rows.orderBy("stock").collect()]
    assert found == [planning.REORDER] * 2 + [planning.MONITOR] * 2 + [planning.HEALTHY] * 2 + [planning.OVERSTOCK] * 2


@pytest.mark.parametrize("lead,review,z", [(3, 4, 0.0), (9, 16, 2.0), (1, 1, 1.28)])
def test_targets_follow_mean_and_spread(sales, lead, review, z):
    row = plan_of(sales, PlanningConfig(4, lead, review, z)).first()
    spread = statistics.stdev([8, 30, 16, 42])
    assert row["recent_average"] == 24 and row["demand_std"] == pytest.approx(spread)
    assert row["safety_stock"] == pytest.approx(z * spread * lead**0.5)
    assert row["reorder_point"] == pytest.approx(24 * lead + z * spread * lead**0.5)
    target = 24 * (lead + review) + z * spread * (lead + review) ** 0.5
    assert row["target_stock_level"] == pytest.approx(target)
    assert row["reorder_quantity"] == pytest.approx(max(0.0, target - row["inventory_on_hand"]))
    assert row["forecast_date"] == row["last_observed_date"] == datetime.date(2024, 3, 10)


def test_a_gap_suppresses_the_action(sales):
    gap = sales.where(F.dayofmonth("date") != 8)
    row = plan_of(gap, PlanningConfig(window_days=4)).first()
    assert row["coverage"] == 0.75 and row["risk"] == "Insufficient history"
    assert row["reorder_quantity"] is None
    assert row["inventory_on_hand"] is not None and row["days_of_supply"] is not None


@pytest.mark.parametrize(
    "day,stock,source,risk",
    [(10, 7.0, planning.PROVIDED, planning.OVERSTOCK), (10, 0.0, planning.PROVIDED, planning.MONITOR),
     (9, 7.0, planning.SIMULATED, planning.MONITOR), (11, 7.0, planning.SIMULATED, planning.MONITOR)],
)
def test_only_stock_of_the_newest_day_counts(spark, sales, day, stock, source, risk):
    """Without demand every target is zero, and days of supply are undefined."""
    idle = sales.withColumn("sales", F.col("sales") * 0)
    counted = spark.createDataFrame([(datetime.date(2024, 3, day), 5, "TEA", stock)], STOCK_SCHEMA)
    row = plan_of(idle, PlanningConfig(window_days=3), counted).first()
    assert (row["inventory_source"], row["risk"], row["days_of_supply"]) == (source, risk, None)
    assert row["inventory_on_hand"] == (stock if source == planning.PROVIDED else 0.0)


def test_window_is_calendar_days(sales):
    assert forecast.forecast_demand(sales, PlanningConfig(window_days=2)).first()["recent_average"] == 29


def test_a_series_without_recent_rows_stays(spark, sales):
    late = spark.createDataFrame([(datetime.date(2024, 5, 1), 2, "B", 5.0, 0.0)], SALES_SCHEMA)
    rows = plan_of(sales.unionByName(late), PlanningConfig()).collect()
    old = next(r for r in rows if r["family"] == "TEA")
    assert old["observed_days"] == 0 and old["coverage"] == 0 and old["recent_average"] is None
    assert old["risk"] == "Insufficient history" and old["inventory_on_hand"] is None
    assert old["forecast_quality"] == "Incomplete history"


@pytest.mark.parametrize("name", ["window_days", "lead_time_days", "review_days"])
@pytest.mark.parametrize("days", [0, -4, 2.0, "7", None, False])
def test_days_must_be_whole_and_positive(name, days):
    with pytest.raises(ValueError):
        PlanningConfig(**{name: days})


@pytest.mark.parametrize("z", [-0.1, float("-inf"), float("nan"), None])
def test_service_factor_must_be_finite(z):
    with pytest.raises(ValueError):
        PlanningConfig(z_score=z)


def test_one_day_has_no_spread():
    with pytest.raises(ValueError):
        PlanningConfig(window_days=1)


def random_sales(spark, seed=7, days=40):
    draw = random.Random(seed)
    rows = [
        (datetime.date(2024, 1, 1) + datetime.timedelta(days=d), store, family, round(draw.uniform(0, 50), 2), 0.0)
        for store in range(1, 8)
        for family in ("a", "b", "c", "d", "e")
        for d in range(days)
        if draw.random() < 0.8 and not (store == 3 and d > 5)
    ]
    return spark.createDataFrame(rows, SALES_SCHEMA).repartition(6)


def test_forecast_equals_filter_and_join_form(spark):
    sales = random_sales(spark)
    config = PlanningConfig(window_days=14)
    last = sales.agg(F.max("date")).first()[0]
    recent = sales.where(F.col("date") >= last - datetime.timedelta(days=13))
    stats = recent.groupBy("store_nbr", "family").agg(
        F.avg("sales").alias("m"), F.stddev_samp("sales").alias("s"),
        F.count_distinct("date").alias("n"), F.max("date").alias("d"),
    )
    keys = sales.select("store_nbr", "family").distinct()
    expected = keys.join(stats, ["store_nbr", "family"], "left").select(
        "store_nbr", "family", F.round("m", 9), F.round("s", 9), F.coalesce("n", F.lit(0)), "d"
    )
    found = forecast.forecast_demand(sales, config).select(
        "store_nbr", "family", F.round("recent_average", 9), F.round("demand_std", 9),
        "observed_days", "last_observed_date",
    )
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_positions_match_a_global_order_over_many_partitions(spark, partitions):
    """One store holds most series; AQE is kept from merging the range partitions."""
    rows = [(1 if i % 3 else 2 + i % 5, f"family {i * 7919 % 1000:04d}") for i in range(1000)]
    series = spark.createDataFrame(rows, "store_nbr long, family string").distinct()
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = planning.with_series_position(series)
        wanted = F.row_number().over(Window.orderBy("store_nbr", "family")) - 1
        assert found.withColumn("wanted", wanted).where("series_position <> wanted").isEmpty()
        assert found.count() == series.count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_scenario_factors_follow_the_series_order(spark):
    plan = plan_of(random_sales(spark), PlanningConfig(window_days=7))
    rows = plan.orderBy("store_nbr", "family").collect()
    for position, row in enumerate(rows):
        if row["reorder_point"]:
            factor = planning.SCENARIO_FACTORS[position % 4]
            assert row["inventory_on_hand"] == pytest.approx(row["reorder_point"] * factor)


def test_risk_counts(spark):
    plan = spark.createDataFrame([("Monitor",), ("Monitor",), ("Insufficient history",)], "risk string")
    assert [tuple(r) for r in planning.risk_counts(plan).collect()] == [
        ("Insufficient history", 1), ("Reorder now", 0), ("Monitor", 2), ("Healthy", 0), ("Overstock risk", 0)]
    for odd in ("Unknown", None):
        with pytest.raises(ValueError):
            planning.risk_counts(plan.unionByName(spark.createDataFrame([(odd,)], "risk string")))


def test_given_series_are_reported(spark, sales):
    keys = spark.createDataFrame([(5, "TEA"), (6, "TEA")], "store_nbr long, family string")
    rows = forecast.forecast_demand(sales, PlanningConfig(window_days=4), keys).collect()
    assert {(r["store_nbr"], r["observed_days"]) for r in rows} == {(5, 4), (6, 0)}


PLAN_SCHEMA = (
    "store_nbr long, family string, risk string, inventory_source string, inventory_on_hand double, "
    "reorder_point double, recent_average double, demand_std double"
)


def test_recommendation_rules_and_order(spark):
    plan = spark.createDataFrame(
        [
            (2, "B", "Healthy", "S", 1.0, 1.0, 10.0, 6.0),
            (2, "A", "Reorder now", "S", 1234.25, 2000.0, 10.0, 9.0),
            (10, "A", "Insufficient history", "S", 1.0, 1.0, 10.0, 5.1),
            (3, "A", "Healthy", "S", 1.0, 1.0, 10.0, 5.0),
            (3, "B", "Healthy", "S", 1.0, 1.0, 0.0, 5.0),
            (3, "C", "Insufficient history", "S", None, None, None, None),
        ],
        PLAN_SCHEMA,
    )
    stores = spark.createDataFrame([(3, 5000.0), (2, 5000.0), (1, 10.0)], "store_nbr long, total_sales double")
    promotions = spark.createDataFrame(
        [("Z", 0.0, 5, 5), ("A", -1.25, 9, 9), ("B", -1.0, 4, 9), ("C", 0.1, 9, 9), ("D", None, 9, 9)],
        "family string, lift_pct double, promoted_rows long, nonpromoted_rows long",
    )
    rows = advice.recommendations(plan, stores, promotions).collect()
    assert [(r["scope"], r["evidence"]) for r in rows] == [
        ("Store 2 / A", "S; stock 1234.2 < reorder point 2000.0"),
        ("Store 2 / B", "Recent daily coefficient of variation exceeds 0.5"),
        ("Store 10 / A", "Recent daily coefficient of variation exceeds 0.5"),
        ("Store 2", "Highest observed sales volume: 5,000.0"),
        ("A", "Observed promotion lift -1.2%"),
        ("Z", "Observed promotion lift 0.0%"),
    ]


def test_no_recommendation_is_legal(spark):
    plan = spark.createDataFrame([], PLAN_SCHEMA)
    stores = spark.createDataFrame([], "store_nbr long, total_sales double")
    promotions = spark.createDataFrame(
        [], "family string, lift_pct double, promoted_rows long, nonpromoted_rows long")
    empty = advice.recommendations(plan, stores, promotions)
    assert empty.columns == ["scope", "evidence", "recommendation"] and empty.count() == 0
