"""Physical plans: what would not scale must not appear in any registered query."""

import datetime
import re

import pytest

import __spark_entry__ as contract
from shared import DATA_DIR
from shelfcast.config import PlanningConfig
from shelfcast import session
from shelfcast.operators import forecast, marts, measures, pages, planning, star
from workload import facts, queries

SMALL = str(DATA_DIR / "sf0.001")
FORBIDDEN = re.compile(
    r"PythonUDF|BatchEvalPython|ArrowEvalPython|InPandas|InArrow|CartesianProduct|BroadcastNestedLoopJoin"
)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def executed(monkeypatch):
    """Plans of all tables that a query writes on its way, in order."""
    plans = []

    def recording(df):
        plans.append(plan_text(df))
        return session.cut_lineage(df)

    for module in (queries, planning, star):
        monkeypatch.setattr(module, "cut_lineage", recording)
    return plans


@pytest.mark.parametrize("name", sorted(queries.REGISTRY))
def test_no_python_no_cross_join_no_global_window(spark, executed, name):
    """Holds for every plan that runs: the tables written on the way and the result."""
    result = plan_text(queries.REGISTRY[name](spark, SMALL))
    for text in [*executed, result]:
        assert not FORBIDDEN.search(text)
        # The only window in one task runs over the row counts of the range partitions.
        for line in text.splitlines():
            window = re.search(r"\bWindow \[(.*)", line)
            if window and not re.search(r"\], \[family", line):
                assert "partition_rows" in line or "slot_partition" in line


@pytest.mark.parametrize("name", ["silver_sales", "kpis", "forecast", "reorder_risk", "risk_counts", "measures_total"])
def test_a_raw_table_is_read_once(spark, executed, name):
    result = plan_text(queries.REGISTRY[name](spark, SMALL))
    raw = [line for text in [*executed, result] for line in text.splitlines() if "FileScan" in line and "events.parquet" in line]
    assert len(raw) == 1


@pytest.mark.parametrize("name", ["measures_total", "measures_by_store", "measures_lineitem"])
def test_measures_do_not_expand_the_fact(spark, executed, name):
    result = plan_text(queries.REGISTRY[name](spark, SMALL))
    assert "Expand" not in result


def moves_and_reads(df):
    """Shuffles and file reads of a plan, from the result down."""
    return re.findall(r"Exchange (?:hash|range|single)\w*|FileScan parquet", plan_text(df))


@pytest.fixture
def stored_daily(spark, tmp_path, sales):
    path = str(tmp_path / "daily")
    marts.daily_sales(sales).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("keys", [(), ("store_nbr",), ("weekday_number", "day_type"), ("date",)])
def test_all_measures_come_from_one_scan(stored_daily, keys):
    assert moves_and_reads(measures.demand_measures(stored_daily, keys)).count("FileScan parquet") == 1


def test_the_matrix_comes_from_one_scan(stored_daily):
    assert moves_and_reads(measures.store_family_matrix(stored_daily)).count("FileScan parquet") == 1


def test_stored_lookups_leave_the_fact_in_place(stored_daily):
    joined = star.star_demand(stored_daily, *star.lookups(stored_daily))
    assert "Exchange" not in "".join(m for m in moves_and_reads(joined) if m.startswith("Exchange"))
    assert joined.count() == stored_daily.count()


def test_top_families_read_the_star_once(stored_daily):
    weekly = pages.weekly_top_families(star.star_demand(stored_daily, *star.lookups(stored_daily)))
    text = plan_text(weekly)
    assert sum("FileScan parquet" in line and "sales#" in line for line in text.splitlines()) == 1


def test_forecast_reads_only_its_window(spark, tmp_path):
    events = facts.table(spark, SMALL, "events")
    path = str(tmp_path / "fact")
    events.selectExpr(
        "to_date(ts) AS date", "user_id AS store_nbr", "event_type AS family", "value AS sales"
    ).write.parquet(path)
    text = plan_text(forecast.forecast_demand(spark.read.parquet(path), PlanningConfig()))
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    wide = [line for line in scans if "sales#" in line]
    assert len(wide) == 1 and "GreaterThanOrEqual(date" in wide[0].split("PushedFilters")[1]
    keys = [line for line in scans if "store_nbr#" in line and "sales#" not in line]
    assert len(keys) == 1 and "date#" not in keys[0].split("]")[0]
    assert len(scans) == 2


def test_forecast_opens_only_its_months(spark, tmp_path):
    from shelfcast.schemas import MONTH

    rows = spark.range(400).selectExpr(
        "date'2023-01-15' + cast(id AS int) AS date", "id % 3 AS store_nbr", "'TEA' AS family", "id * 0.5D AS sales"
    )
    path = str(tmp_path / "months")
    rows.selectExpr("*", f"date_format(date, 'yyyy-MM') AS {MONTH}").write.partitionBy(MONTH).parquet(path)
    months, config = spark.read.parquet(path), PlanningConfig(window_days=40)
    newest = rows.agg({"date": "max"}).first()[0]
    assert forecast.newest_date(months) == newest
    assert forecast.newest_date(months.where("false")) is None
    series = rows.select("store_nbr", "family")
    found = forecast.forecast_demand(months, config, series)
    scan = next(line for line in plan_text(found).splitlines() if "FileScan parquet" in line)
    assert f"{newest - datetime.timedelta(days=39):%Y-%m}" in scan.split("PartitionFilters: [")[1].split("]")[0]
    plain = sorted(map(str, forecast.forecast_demand(rows, config).collect()))
    assert sorted(map(str, found.collect())) == plain
    assert sorted(map(str, forecast.forecast_demand(months, config, series, newest).collect())) == plain


def test_date_and_store_filters_reach_the_scan(spark, tmp_path, sales):
    path = str(tmp_path / "daily")
    marts.daily_sales(sales).write.parquet(path)
    daily = spark.read.parquet(path)
    text = plan_text(
        measures.demand_measures(daily, (), ["total_demand"], start=datetime.date(2024, 3, 8), stores=[5])
    )
    assert "GreaterThanOrEqual(date,2024-03-08)" in text and "EqualTo(store_nbr,5)" in text
    assert re.search(r"ReadSchema: struct<date:date,store_nbr:bigint,sales:double>", text)
    assert "Expand" not in text


def test_entry_returns_the_published_plan_columns(spark):
    from shelfcast.schemas import GOLD_COLUMNS

    plan = contract.entry(spark)
    assert tuple(plan.columns) == GOLD_COLUMNS["reorder_risk"] and plan.count() == 25
