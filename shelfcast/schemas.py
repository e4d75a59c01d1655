"""Input table specs and the published column contract."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class TableSpec:
    """What a valid input table looks like; everything not named here is kept as is."""

    name: str
    required: tuple[str, ...]
    keys: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()

    def with_numbers(self, *extra: str) -> "TableSpec":
        return replace(self, numbers=self.numbers + extra)


GRAIN = ("date", "store_nbr", "family")
SERIES = ("store_nbr", "family")

SALES = TableSpec(
    "sales",
    required=GRAIN + ("sales",),
    keys=GRAIN,
    numbers=("sales",),
    dates=("date",),
)

# Optional context tables and their contracts, in the order their warnings are reported.
CONTEXT_TABLES = (
    TableSpec("stores", required=("store_nbr",), keys=("store_nbr",)),
    TableSpec(
        "transactions",
        required=("date", "store_nbr", "transactions"),
        keys=("date", "store_nbr"),
        numbers=("transactions",),
        dates=("date",),
    ),
    TableSpec("oil", required=("date", "dcoilwtico"), keys=("date",), dates=("date",)),
    TableSpec(
        "holidays_events",
        required=("date", "type", "locale", "locale_name", "description", "transferred"),
        dates=("date",),
    ),
    TableSpec(
        "inventory",
        required=GRAIN + ("inventory_on_hand",),
        keys=GRAIN,
        numbers=("inventory_on_hand",),
        dates=("date",),
    ),
)

# Column by which the published daily mart is partitioned.
MONTH = "year_month"

# Published tables and their column order.
GOLD_COLUMNS = {
    "daily_sales": (
        "date", "store_nbr", "family", "sales", "onpromotion", "promoted",
        "weekday_number", "day_type",
    ),
    "weekly_sales": ("week", "store_nbr", "family", "sales", "observed_days"),
    "store_performance": ("store_nbr", "total_sales", "observed_days", "average_daily_sales"),
    "family_performance": ("family", "total_sales", "observed_days"),
    "promotion_impact": (
        "family", "promoted_average", "nonpromoted_average", "promoted_rows",
        "nonpromoted_rows", "lift_pct",
    ),
    "demand_volatility": ("family", "daily_mean", "daily_std", "coefficient_of_variation"),
    "reorder_risk": (
        "store_nbr", "family", "recent_average", "demand_std", "observed_days",
        "last_observed_date", "coverage", "forecast_date", "expected_lead_time_demand",
        "forecast_quality", "safety_stock", "reorder_point", "target_stock_level",
        "inventory_on_hand", "inventory_source", "days_of_supply", "reorder_quantity", "risk",
    ),
    "recommendations": ("scope", "evidence", "recommendation"),
}

# Row order of a table that is written as one CSV file; suggestions come in review order already.
CSV_ORDER = {
    "daily_sales": GRAIN,
    "weekly_sales": ("week", *SERIES),
    "store_performance": ("store_nbr",),
    "family_performance": ("family",),
    "promotion_impact": ("family",),
    "demand_volatility": ("family",),
    "reorder_risk": SERIES,
    "recommendations": (),
}
