"""Marts, run totals and column helpers on tiny frames."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from shared import SALES_SCHEMA
from shelfcast.functions import columns
from shelfcast.operators import marts
from shelfcast.operators.quality import reconcile_totals, with_promotion_column


def impact(sales):
    return marts.promotion_summary(sales).first()


def test_run_totals_of_two_stores(spark, sales_rows):
    other = [(day, 9, "RICE", 2 * volume, None) for day, _, _, volume, _ in sales_rows[1:]]
    row = marts.kpis(spark.createDataFrame(sales_rows + other, SALES_SCHEMA)).first()
    assert (row["total_sales"], row["promoted_sales"]) == (96 + 176, 72)
    assert row["average_daily_sales"] == 68 and (row["stores"], row["families"]) == (2, 2)
    assert (row["start"], row["end"]) == (datetime.date(2024, 3, 7), datetime.date(2024, 3, 10))


def test_promoted_total_is_zero_when_known_and_null_when_unknown(sales):
    assert marts.kpis(sales.withColumn("onpromotion", F.lit(0.0))).first()["promoted_sales"] == 0.0
    unknown = with_promotion_column(sales.drop("onpromotion"))
    assert marts.kpis(unknown).first()["promoted_sales"] is None
    assert marts.kpis(sales.drop("onpromotion")).first()["promoted_sales"] is None


@pytest.mark.parametrize("factor,lift", [(1.0, 200.0), (0.5, 50.0), (1 / 3, 0.0), (0.0, -100.0)])
def test_lift_follows_the_promoted_mean(sales, factor, lift):
    changed = sales.withColumn("sales", F.col("sales") * F.when(F.col("onpromotion") > 0, factor).otherwise(1.0))
    row = impact(changed)
    assert row["lift_pct"] == pytest.approx(lift, abs=1e-9) and row["nonpromoted_average"] == 12
    assert row["promoted_average"] == pytest.approx(36 * factor)
    assert (row["promoted_rows"], row["nonpromoted_rows"]) == (2, 2)


def test_lift_is_undefined_without_a_comparison(sales):
    row = impact(sales.withColumn("onpromotion", F.lit(1.0)))
    assert row["lift_pct"] is None and row["nonpromoted_rows"] == 0
    zero_base = sales.withColumn("sales", F.when(F.col("onpromotion") > 0, F.col("sales")).otherwise(0.0))
    assert impact(zero_base)["lift_pct"] is None
    row = impact(sales.withColumn("onpromotion", F.lit(None).cast("double")))
    assert row["lift_pct"] is None and row["promoted_average"] is None
    assert row["promoted_rows"] == row["nonpromoted_rows"] == 0


def test_daily_features(spark):
    rows = [
        (datetime.date(2024, 1, 5), 1, "A", 1.0, None),
        (datetime.date(2024, 1, 6), 1, "A", 1.0, 0.5),
        (datetime.date(2024, 1, 7), 1, "A", 1.0, 0.0),
    ]
    found = marts.daily_sales(spark.createDataFrame(rows, SALES_SCHEMA)).orderBy("date").collect()
    assert [r["promoted"] for r in found] == [None, True, False]
    assert [r["weekday_number"] for r in found] == [5, 6, 7]
    assert [r["day_type"] for r in found] == ["Weekday", "Weekend", "Weekend"]


def test_average_divides_by_distinct_dates(spark):
    day = datetime.date(2024, 1, 1)
    rows = [(day, 1, "A", 10.0, 0.0), (day, 1, "B", 20.0, 0.0), (day, 2, "A", 5.0, 0.0)]
    daily = marts.daily_sales(spark.createDataFrame(rows, SALES_SCHEMA))
    stores = {r["store_nbr"]: r for r in marts.store_performance(marts.store_days(daily)).collect()}
    assert stores[1]["observed_days"] == 1 and stores[1]["average_daily_sales"] == 30.0
    families = {r["family"]: r for r in marts.family_performance(marts.family_days(daily)).collect()}
    assert families["A"]["observed_days"] == 1 and families["A"]["total_sales"] == 15.0


def test_volatility_uses_daily_totals(spark):
    first, second = datetime.date(2024, 1, 1), datetime.date(2024, 1, 3)
    rows = [(first, 1, "A", 1.0, 0.0), (first, 2, "A", 2.0, 0.0), (second, 1, "A", 5.0, 0.0),
            (first, 1, "B", 0.0, 0.0), (second, 1, "B", 0.0, 0.0), (first, 1, "C", 4.0, 0.0)]
    daily = marts.daily_sales(spark.createDataFrame(rows, SALES_SCHEMA))
    volatility = marts.demand_volatility(marts.family_days(daily))
    found = {r["family"]: r for r in volatility.collect()}
    assert found["A"]["daily_mean"] == 4.0 and found["A"]["daily_std"] == pytest.approx(math.sqrt(2))
    assert found["B"]["coefficient_of_variation"] is None
    assert found["C"]["daily_std"] is None
    assert marts.most_variable_family(volatility).first()["family"] == "A"


def test_totals_reconcile(sales):
    daily = marts.daily_sales(sales)
    rows = reconcile_totals(
        daily, marts.weekly_sales(daily), marts.store_performance(marts.store_days(daily)),
        marts.family_performance(marts.family_days(daily)),
    ).collect()
    assert len(rows) == 4 and all(r["total_sales"] == 96 and r["difference"] == 0 for r in rows)


@pytest.mark.parametrize("value", [0.25, 0.35, -0.04, 1234567.85, 2.5, -1.05, 99.95, 1e9 + 0.25])
def test_number_text_matches_python(spark, value):
    row = spark.range(1).select(
        columns.fixed_text(F.lit(value)).alias("plain"),
        columns.fixed_text(F.lit(value), thousands=True).alias("grouped"),
    ).first()
    assert row["plain"] == f"{value:.1f}" and row["grouped"] == f"{value:,.1f}"


def test_display_round_keeps_low_ties_low(spark):
    row = spark.range(1).select(
        columns.display_round(F.lit(1.005), 2), columns.display_round(F.lit(2.5), 0),
        columns.display_round(F.lit(-2.5), 0), columns.display_round(F.lit(None).cast("double"), 1),
    ).first()
    assert tuple(row) == (1.0, 3.0, -3.0, None)
