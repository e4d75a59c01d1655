"""A grid of settings equals as many plans, from one scan of the demand."""

import datetime

import pytest

from shared import SALES_SCHEMA
from shelfcast.config import PlanningConfig
from shelfcast.operators import forecast, planning, whatif
from shelfcast.schemas import GOLD_COLUMNS, SERIES
from shelfcast.session import cut_lineage
from test_plans import plan_text

CONFIGS = [PlanningConfig(w, lead, 3, z) for w in (2, 5, 9) for lead in (4, 7) for z in (0.0, 1.65)]


@pytest.fixture
def demand(spark):
    """Series with full, broken, single and no recent history, and one of large, nearly equal volumes."""
    first = datetime.date(2024, 2, 1)
    rows = []
    for store, days in ((1, range(20)), (2, [0, 1, 2, 11, 14, 19]), (3, [19]), (4, range(5)), (5, range(10, 20))):
        for i in days:
            volume = 1e9 + i * 0.25 if store == 5 else float((i * 7 + store) % 11)
            rows.append((first + datetime.timedelta(days=i), store, "TEA", volume, 0.0))
    return cut_lineage(spark.createDataFrame(rows, SALES_SCHEMA))


def plain(rows, columns):
    return sorted(str([round(v, 6) if isinstance(v, float) else v for v in (r[c] for c in columns)]) for r in rows)


@pytest.mark.parametrize("given", [False, True])
def test_grid_equals_single_plans(spark, demand, given):
    series = demand.select(*SERIES).distinct() if given else None
    snapshot = spark.createDataFrame(
        [(datetime.date(2024, 2, 20), 2, "TEA", 17.0), (datetime.date(2024, 2, 19), 1, "TEA", 1.0)],
        "date date, store_nbr long, family string, inventory_on_hand double",
    )
    grid = whatif.plan_grid(demand, CONFIGS, series, snapshot).collect()
    assert len(grid) == len(CONFIGS) * 5
    columns = GOLD_COLUMNS["reorder_risk"]
    for i, config in enumerate(CONFIGS):
        single = planning.plan_inventory(forecast.forecast_demand(demand, config, series), config, snapshot)
        rows = [r for r in grid if r.setting == i]
        assert plain(rows, columns) == plain(single.collect(), columns)
        assert {(r.window_days, r.lead_time_days, r.review_days, r.z_score) for r in rows} == {
            (config.window_days, config.lead_time_days, config.review_days, config.z_score)}


def test_one_scan_for_all_windows(demand, monkeypatch):
    written = []
    monkeypatch.setattr(planning, "cut_lineage", lambda df: written.append(plan_text(df)) or cut_lineage(df))
    result = plan_text(whatif.plan_grid(demand, CONFIGS))
    assert "sales#" not in result and sum(text.count("FileScan") for text in written) == 1
    written.clear()
    whatif.plan_grid(demand, CONFIGS, series=demand)
    scans = [line for line in written[0].splitlines() if "FileScan" in line and "sales#" in line]
    assert len(scans) == 1 and "GreaterThanOrEqual(date,2024-02-12)" in scans[0]


def test_missing_volumes_and_empty_demand(spark, demand):
    empty = whatif.plan_grid(demand.limit(0), CONFIGS)
    assert empty.count() == 0
    with pytest.raises(ValueError, match="at least one"):
        whatif.plan_grid(demand, [])
