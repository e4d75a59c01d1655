"""Plans under many settings at once: one pass over the demand, however many windows differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.config import PlanningConfig
from shelfcast.operators.forecast import with_coverage
from shelfcast.operators.planning import with_decision, with_series_position, with_stock, with_targets
from shelfcast.schemas import GOLD_COLUMNS, SERIES

SETTING = ("setting", "window_days", "lead_time_days", "review_days", "z_score")
_OLDER = -1  # ring of rows before the longest window


def window_moments(sales: DataFrame, as_of: Column, windows: Sequence[int], series: DataFrame | None) -> DataFrame:
    """(store, family, rings): count, sum, squared deviations and newest date by ring, per series.

    Ring k holds the days that window k has and window k - 1 has not (windows ascending), so the
    statistics of every window merge from the rings up to its own. A series has at most as
    many rings as there are windows. Without ``series`` the same scan also finds the series that
    have no recent row; with it, only the longest window is read.
    """
    age = F.datediff(as_of, F.col("date"))
    ring = F.lit(_OLDER)
    for k, window in reversed(list(enumerate(windows))):
        ring = F.when(age < window, F.lit(k)).otherwise(ring)
    rows = sales.select("date", *SERIES, "sales")
    if series is not None:
        rows = rows.where(F.col("date") >= F.date_sub(as_of, windows[-1] - 1))
    n = F.count(F.lit(1))
    rings = rows.groupBy(*SERIES, ring.alias("ring")).agg(
        n.alias("days"), F.count("sales").alias("n"), F.sum("sales").alias("total"),
        (F.var_pop("sales") * F.count("sales")).alias("squares"), F.max("date").alias("newest"),
    )
    moments = F.struct("ring", "days", "n", "total", "squares", "newest")
    found = rings.groupBy(*SERIES).agg(F.collect_list(moments).alias("rings"))
    if series is None:
        return found
    return series.select(*SERIES).distinct().join(found, list(SERIES), "left")


def _statistics(limit: Column) -> dict[str, Column]:
    """Mean, sample deviation, days and newest date over the rings 0 to ``limit``.

    Squared deviations are merged around the merged mean, which keeps their precision.
    """
    rings = F.filter("rings", lambda r: r["ring"].between(0, limit))
    def total(value, kind):
        return F.aggregate(rings, F.lit(0).cast(kind), lambda sum_, r: sum_ + F.coalesce(value(r), F.lit(0).cast(kind)))
    n = total(lambda r: r["n"], "long")
    mean = F.when(n > 0, total(lambda r: r["total"], "double") / n)
    def apart(r):
        return r["squares"] + r["n"] * F.pow(r["total"] / F.when(r["n"] > 0, r["n"]) - mean, 2)
    return {
        "recent_average": mean,
        "demand_std": F.when(n > 1, F.sqrt(total(apart, "double") / (n - 1))),
        "observed_days": F.coalesce(total(lambda r: r["days"], "long"), F.lit(0)),
        "last_observed_date": F.array_max(F.transform(rings, lambda r: r["newest"])),
    }


def plan_grid(
    sales: DataFrame, configs: Sequence[PlanningConfig], series: DataFrame | None = None,
    snapshot: DataFrame | None = None,
) -> DataFrame:
    """The published plan of every setting: its columns behind SETTING, a row per setting and series.

    ``setting`` numbers ``configs`` from 0. Equal to ``plan_inventory`` of each setting by itself, but
    the demand is read once for all windows, and the series are ordered once: their position does
    not depend on a setting. Calling this reads the newest date and writes the moments per series.
    """
    if not configs:
        raise ValueError("at least one setting is needed")
    as_of = F.lit(sales.agg(F.max("date")).first()[0]).cast("date")
    windows = sorted({c.window_days for c in configs})
    settings = F.array(*[
        F.struct(
            F.lit(i).alias("setting"), F.lit(c.window_days).alias("window_days"),
            F.lit(c.lead_time_days).alias("lead_time_days"), F.lit(c.review_days).alias("review_days"),
            F.lit(float(c.z_score)).alias("z_score"), F.lit(windows.index(c.window_days)).alias("limit"),
        )
        for i, c in enumerate(configs)
    ])
    placed = with_series_position(window_moments(sales, as_of, windows, series))
    each = placed.select("*", F.explode(settings).alias("s")).select("*", "s.*").drop("s")
    known = each.withColumns(_statistics(F.col("limit")))
    window, lead, review, z = (F.col(c) for c in SETTING[1:])
    forecasts = with_coverage(known, as_of, window, lead)
    stocked = with_stock(with_targets(forecasts, lead, review, z), snapshot)
    return with_decision(stocked, window).select(*SETTING, *GOLD_COLUMNS["reorder_risk"])
