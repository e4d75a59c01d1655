"""Filter-aware measures: one aggregate per call, recomputed for every selection.

Filters intersect. Date filters exist for demand only: the plan is a snapshot.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.functions.columns import ratio
from shelfcast.operators.planning import HEALTHY, INSUFFICIENT, MONITOR, OVERSTOCK, REORDER
from shelfcast.schemas import MONTH


def _selection(column: str, values: Iterable | None) -> list[Column]:
    return [] if values is None else [F.col(column).isin(list(values))]


def _restrict(df: DataFrame, conditions: Sequence[Column]) -> DataFrame:
    for condition in conditions:
        df = df.where(condition)
    return df


def select_demand(
    daily: DataFrame,
    start: datetime.date | None = None,
    end: datetime.date | None = None,
    stores: Iterable[int] | None = None,
    families: Iterable[str] | None = None,
) -> DataFrame:
    """Rows of the daily fact inside the selection; plain predicates that reach the scan."""
    conditions = _selection("store_nbr", stores) + _selection("family", families)
    months = MONTH in daily.columns  # the published mart is partitioned by month
    if start is not None:
        conditions.append(F.col("date") >= F.lit(start))
        if months:
            conditions.append(F.col(MONTH) >= f"{start:%Y-%m}")
    if end is not None:
        conditions.append(F.col("date") <= F.lit(end))
        if months:
            conditions.append(F.col(MONTH) <= f"{end:%Y-%m}")
    return _restrict(daily, conditions)


def select_plan(
    plan: DataFrame,
    stores: Iterable[int] | None = None,
    families: Iterable[str] | None = None,
    risks: Iterable[str] | None = None,
    sources: Iterable[str] | None = None,
) -> DataFrame:
    return _restrict(
        plan,
        _selection("store_nbr", stores)
        + _selection("family", families)
        + _selection("risk", risks)
        + _selection("inventory_source", sources),
    )


DEMAND_MEASURES = (
    "total_demand", "observed_days", "average_daily_demand", "average_daily_sales", "store_count",
    "family_count", "known_promotion_rows", "promoted_demand", "promotion_share",
    "promoted_row_count", "nonpromoted_row_count", "average_promoted_row_demand",
    "average_nonpromoted_row_demand", "promotion_lift",
)
# Distinct members counted per group: the column, and the measures that need the count.
_MEMBERS = {
    "observed_days": ("date", {"observed_days", "average_daily_demand", "average_daily_sales"}),
    "store_count": ("store_nbr", {"store_count"}),
    "family_count": ("family", {"family_count"}),
}
# 64 neighbouring days or stores are the bits of one word: its number and a row's bit. Words merge by
# OR at any level, so members stay distinct in totals, and a cell of words stands for many rows.
_WORDS = {
    "date": ("shiftright(unix_date(date), 6)", "shiftleft(1L, unix_date(date) & 63)"),
    "store_nbr": ("shiftright(store_nbr, 6)", "shiftleft(1L, cast(store_nbr & 63 AS int))"),
}
(DAY_WORD, DAY_BIT), (STORE_WORD, STORE_BIT) = _WORDS["date"], _WORDS["store_nbr"]


def _in_word(word: Column, bits: Column) -> Column:
    """Members in a merged word; rows without a value count as one member, like a distinct null."""
    return F.when(word.isNull(), F.lit(1)).otherwise(F.bit_count(bits))


def _sums(wanted: set[str]) -> dict[str, Column]:
    """The sums behind the wanted measures. They add up over any split of the rows."""
    promoted, volume = F.col("promoted"), F.col("sales")
    known = "known_promotion_rows"
    sums = {
        "total_demand": (F.sum(volume), {"total_demand", "average_daily_demand", "average_daily_sales", "promotion_share"}),
        known: (F.count("onpromotion"), {known, "promoted_demand", "promotion_share"}),
        "promoted_sum": (
            F.sum(F.when(promoted, volume)),
            {"promoted_demand", "promotion_share", "average_promoted_row_demand", "promotion_lift"},
        ),
        "promoted_volumes": (F.count(F.when(promoted, volume)), {"average_promoted_row_demand", "promotion_lift"}),
        "other_sum": (F.sum(F.when(~promoted, volume)), {"average_nonpromoted_row_demand", "promotion_lift"}),
        "other_volumes": (F.count(F.when(~promoted, volume)), {"average_nonpromoted_row_demand", "promotion_lift"}),
        "promoted_row_count": (F.count_if(promoted), {"promoted_row_count"}),
        "nonpromoted_row_count": (F.count_if(~promoted), {"nonpromoted_row_count"}),
    }
    return {name: column for name, (column, users) in sums.items() if users & wanted}


_COUNTS = {"known_promotion_rows", "promoted_volumes", "other_volumes", "promoted_row_count", "nonpromoted_row_count"}


def _merged(name: str) -> Column:
    """A sum over partial sums; a count over no rows is 0."""
    total = F.sum(name)
    return (F.coalesce(total, F.lit(0)) if name in _COUNTS else total).alias(name)


def _grouped(
    rows: DataFrame, group_by: Sequence[str], members: Sequence[str], sums: dict[str, Column]
) -> DataFrame:
    """Sums and distinct counts per group from one scan.

    The rows are first combined to cells of (group, 64 days, 64 stores, family), as far as these
    are counted. A cell then stands once for each kind of member, its sums with the first kind only,
    and merges with its equals: words by OR, families by being one row. Several exact distinct
    counts in one aggregate would expand every row of the fact instead.
    """
    if not members:
        return rows.groupBy(*group_by).agg(*[c.alias(n) for n, c in sums.items()] or [F.count(F.lit(1))])
    columns = {m: _MEMBERS[m][0] for m in members}
    words = {c: _WORDS[c] for c in columns.values() if c in _WORDS}
    cells = rows.groupBy(
        *group_by,
        *[(F.expr(words[c][0]) if c in words else F.col(c)).alias(f"member_{c}") for c in columns.values()],
    ).agg(
        *[F.bit_or(F.expr(bit)).alias(f"bits_{c}") for c, (_, bit) in words.items()],
        *[c.alias(n) for n, c in sums.items()],
    )

    def only(condition: bool, name: str) -> Column:
        return (F.col(name) if condition else F.when(F.lit(False), F.col(name))).alias(name)

    kinds = [
        F.struct(
            F.lit(m).alias("member"),
            *[only(c == own, f"member_{c}") for c in columns.values()],
            (F.col(f"bits_{own}") if own in words else F.lit(None).cast("bigint")).alias("member_bits"),
            *[only(m == members[0], n) for n in sums],
        )
        for m, own in columns.items()
    ]
    keys = ["member", *[f"member_{c}" for c in columns.values()]]
    merged = cells.select(*group_by, F.inline(F.array(*kinds)))
    if len(members) > 1:
        merged = merged.groupBy(*group_by, *keys).agg(
            F.bit_or("member_bits").alias("member_bits"), *[F.sum(n).alias(n) for n in sums]
        )
    of = F.col("member")
    counts = {
        m: F.coalesce(F.sum(F.when(of == m, _in_word(F.col(f"member_{c}"), F.col("member_bits")))), F.lit(0))
        if c in words else F.count_if(of == m)
        for m, c in columns.items()
    }
    return merged.groupBy(*group_by).agg(
        *[_merged(n) for n in sums], *[c.alias(m) for m, c in counts.items()]
    )


def demand_measures(
    daily: DataFrame, group_by: Sequence[str] = (), measures: Iterable[str] | None = None, **selection
) -> DataFrame:
    """Demand and promotion measures per group, or in total without ``group_by``, from one scan.

    ``measures`` names the wanted ones, in the order of DEMAND_MEASURES; columns and steps that only
    others need are left out.
    """
    wanted = [m for m in DEMAND_MEASURES if measures is None or m in set(measures)]
    needed = [m for m, (_, users) in _MEMBERS.items() if users & set(wanted)]
    counted = [m for m in needed if _MEMBERS[m][0] not in group_by]
    base = _grouped(select_demand(daily, **selection), group_by, counted, _sums(set(wanted)))
    # A grouped column has one value per group.
    base = base.withColumns({m: F.lit(1).cast("bigint") for m in needed if m not in counted})
    with_promotion = ratio(F.col("promoted_sum"), F.col("promoted_volumes"))
    without = ratio(F.col("other_sum"), F.col("other_volumes"))
    # The sum is already null when no row is promoted or promotion is unknown.
    promoted_demand = F.when(F.col("known_promotion_rows") > 0, F.col("promoted_sum"))
    derived = {
        "promoted_demand": lambda: promoted_demand,
        "average_daily_demand": lambda: ratio(F.col("total_demand"), F.col("observed_days")),
        "average_daily_sales": lambda: ratio(F.col("total_demand"), F.col("observed_days")),
        "promotion_share": lambda: ratio(promoted_demand, F.col("total_demand")),
        "average_promoted_row_demand": lambda: with_promotion,
        "average_nonpromoted_row_demand": lambda: without,
        # A fraction, unlike the mart's lift in percentage points.
        "promotion_lift": lambda: ratio(with_promotion - without, without),
    }
    return base.select(
        *group_by, *[derived[m]().alias(m) if m in derived else F.col(m) for m in wanted]
    )


def planning_measures(plan: DataFrame, group_by: Sequence[str] = (), **selection) -> DataFrame:
    """Snapshot measures per group; class counts are 0, not blank, for an empty class."""

    def series_in(risk: str) -> Column:
        return F.count_if(F.col("risk") == risk)

    return (
        select_plan(plan, **selection)
        .groupBy(*group_by)
        .agg(
            F.avg("days_of_supply").alias("average_days_of_supply"),
            F.avg("reorder_point").alias("average_reorder_point"),
            F.count(F.lit(1)).alias("planning_series_count"),
            series_in(REORDER).alias("reorder_now_count"),
            series_in(MONITOR).alias("monitor_count"),
            series_in(HEALTHY).alias("healthy_count"),
            series_in(OVERSTOCK).alias("overstock_risk_count"),
            series_in(INSUFFICIENT).alias("insufficient_history_count"),
            (series_in(REORDER) + series_in(MONITOR) + series_in(OVERSTOCK)).alias(
                "series_requiring_attention"
            ),
            F.sum("reorder_quantity").alias("total_recommended_reorder_quantity"),
            F.max("forecast_date").alias("snapshot_as_of"),
        )
    )


def average_volatility(volatility: DataFrame) -> DataFrame:
    """Plain mean of the families' daily standard deviations over the full run."""
    return volatility.agg(F.avg("daily_std").alias("average_demand_volatility"))


def store_family_matrix(daily: DataFrame) -> DataFrame:
    """Demand by store and family with subtotals and a grand total, from one scan.

    The average in a total row divides by the distinct dates of that total. ``level`` is
    0 for a cell, 1 for a store total, 2 for a family total and 3 for the grand total.

    A cube with a distinct count would shuffle the whole fact for the cells. Instead the fact is
    summed to (store, family, 64-day word) with a bit per day; the totals merge the words by OR.
    """
    store, family, word = F.col("store_nbr"), F.col("family"), F.col("day_word")
    words = daily.groupBy("store_nbr", "family", F.expr(DAY_WORD).alias("day_word")).agg(
        F.sum("sales").alias("volume"), F.bit_or(F.expr(DAY_BIT)).alias("day_bits")
    )
    totals = words.groupingSets(
        [[store, family, word], [store, word], [family, word], [word]], store, family, word
    ).agg(
        F.grouping_id("store_nbr", "family", "day_word").alias("totalled"),
        F.sum("volume").alias("volume"),
        F.bit_or("day_bits").alias("day_bits"),
    )
    level = F.shiftright("totalled", 1).cast("int")  # without the bit of the word, which is never totalled
    return totals.groupBy("store_nbr", "family", level.alias("level")).agg(
        F.sum("volume").alias("total_demand"),
        F.sum(_in_word(word, F.col("day_bits"))).alias("observed_days"),
    ).withColumn("average_daily_demand", ratio(F.col("total_demand"), F.col("observed_days")))
