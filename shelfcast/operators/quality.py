"""Table validation: one aggregate scan for the value rules, one grouping for the grain.

The first rule that fails, in a fixed order, names the error: required columns, empty
table, missing keys, dates, numbers, store numbers, duplicates.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfcast.functions import parsing
from shelfcast.schemas import SALES, SERIES, TableSpec


class DataValidationError(ValueError):
    """An input table breaks its contract."""


class ReconciliationError(RuntimeError):
    """The marts of one run contradict each other."""


def sales_spec(df: DataFrame) -> TableSpec:
    """The demand contract; the promotion count is checked only where it exists."""
    return SALES.with_numbers("onpromotion") if "onpromotion" in df.columns else SALES


def require_columns(df: DataFrame, spec: TableSpec) -> None:
    absent = sorted(set(spec.required) - set(df.columns))
    if absent:
        raise DataValidationError(f"Missing required columns: {', '.join(absent)}")


def _checked_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    """Columns with a value rule, in the order their errors are reported."""
    store = ["store_nbr"] if "store_nbr" in df.columns else []
    return [*spec.dates, *spec.numbers, *store]


def _parsed_name(column: str) -> str:
    return f"{column}__parsed"


def _parse(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, dict[str, Column]]:
    """The table with a parsed copy next to each checked column, and the typed
    value per column, null where it breaks a rule. The typed values belong in a later
    projection: that keeps Spark from copying the parsing to each mention of its result."""
    dtypes = {field.name: field.dataType for field in df.schema.fields}
    checked = _checked_columns(df, spec)
    read, typed = {}, {}
    for c in checked:
        value, parsed = F.col(c), F.col(_parsed_name(c))
        if c in spec.dates:
            read[_parsed_name(c)] = parsing.read_date(value, dtypes[c])
            typed[c] = parsing.valid_date(parsed)
        else:
            read[_parsed_name(c)] = parsing.read_number(value, dtypes[c])
            typed[c] = (
                parsing.valid_store_number(parsed, value, dtypes[c])
                if c == "store_nbr"
                else parsing.valid_count(parsed)
            )
    if "family" in dtypes:
        read[_parsed_name("family")] = parsing.strip_text(F.col("family").cast("string"))
        typed["family"] = F.col(_parsed_name("family"))
    return df.withColumns(read), typed


def typed_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The table with typed columns; a value that breaks its rule is null."""
    parsed, typed = _parse(df, spec)
    return parsed.withColumns(typed).drop(*[_parsed_name(c) for c in typed])


def _with_findings(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, list[str]]:
    """The typed keys with one flag per rule that can fail on a row, and the flags' names.

    Only a value that did not parse is looked at again to tell blank from broken.
    """
    dtypes = {field.name: field.dataType for field in df.schema.fields}
    parsed, typed = _parse(df, spec)
    missing = {}
    for c in spec.keys:
        absent = parsing.is_absent(F.col(c), dtypes[c])
        if c == "family":
            absent = parsing.is_absent_text(F.col(_parsed_name(c)))
        elif c in typed and dtypes[c] == T.StringType():
            absent = F.col(_parsed_name(c)).isNull() & absent
        missing[f"missing_{c}"] = absent
    checked = _checked_columns(df, spec)
    used = dict.fromkeys((*spec.keys, *checked))
    rows = parsed.select(
        *[typed.get(c, F.col(c)).alias(c) for c in used],
        *[flag.alias(name) for name, flag in missing.items()],
    ).select(
        *spec.keys, *missing, *[F.col(c).isNull().alias(f"invalid_{c}") for c in checked]
    )
    return rows, [*missing, *[f"invalid_{c}" for c in checked]]


def _counts(flags: Sequence[str]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(f)).alias(f) for f in flags]]


def quality_counts(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row: the row count and, per rule, how many rows break it."""
    rows, flags = _with_findings(df, spec)
    return rows.agg(*_counts(flags))


def first_failure(counts: Mapping[str, int], spec: TableSpec) -> str | None:
    """Message of the first broken rule, or None for a clean table. The messages."""
    if counts["rows"] == 0:
        return "Table has no rows"
    for column in spec.keys:
        if counts[f"missing_{column}"]:
            return f"Missing {column} values"
    for column in spec.dates:
        if counts[f"invalid_{column}"]:
            return f"Invalid dates in {column}; use YYYY-MM-DD"
    for column in spec.numbers:
        if counts[f"invalid_{column}"]:
            return f"{column} must contain finite nonnegative numbers"
    if counts.get("invalid_store_nbr"):
        return "store_nbr must contain positive integers"
    return None


def coerce_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Check every rule but the grain, then return the table with typed columns."""
    require_columns(df, spec)
    failure = first_failure(quality_counts(df, spec).first().asDict(), spec)
    if failure:
        raise DataValidationError(failure)
    return typed_table(df, spec)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key tuples that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def check_grain(df: DataFrame, keys: Sequence[str]) -> None:
    """Copies of a key are combined before the shuffle, so a large group of them is no load."""
    if keys and not duplicate_keys(df, keys).isEmpty():
        raise DataValidationError(f"Duplicate rows at grain {', '.join(keys)}")


def clean_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Validated, typed table; raises DataValidationError for the first broken rule."""
    typed = coerce_table(df, spec)
    check_grain(typed, spec.keys)
    return typed


def validate_sales(df: DataFrame) -> DataFrame:
    return clean_table(df, sales_spec(df))


def with_promotion_column(sales: DataFrame) -> DataFrame:
    """Where the source has no promotion column, promotion is unknown, not zero."""
    if "onpromotion" in sales.columns:
        return sales
    return sales.withColumn("onpromotion", F.lit(None).cast("double"))


def coerce_oil_price(oil: DataFrame) -> DataFrame:
    """Unparsable prices are allowed and become null."""
    dtype = oil.schema["dcoilwtico"].dataType
    return oil.withColumn(
        "dcoilwtico", parsing.read_number(F.col("dcoilwtico"), dtype)
    ).withColumn("dcoilwtico", parsing.finite(F.col("dcoilwtico")))


def orphan_series(plan: DataFrame, sales: DataFrame) -> DataFrame:
    """Planned series that no demand row backs; empty for a consistent run.

    The demand side is reduced to its distinct series before it is shuffled for the join.
    """
    return plan.select(*SERIES).join(sales.select(*SERIES).distinct(), list(SERIES), "left_anti")


def reconcile_totals(
    daily: DataFrame, weekly: DataFrame, stores: DataFrame, families: DataFrame
) -> DataFrame:
    """Total volume as each mart sees it, next to its difference from the daily fact."""
    totals = [
        frame.agg(F.sum(column).alias("total_sales")).withColumn("mart", F.lit(mart))
        for mart, frame, column in (
            ("daily_sales", daily, "sales"),
            ("weekly_sales", weekly, "sales"),
            ("store_performance", stores, "total_sales"),
            ("family_performance", families, "total_sales"),
        )
    ]
    combined = totals[0]
    for other in totals[1:]:
        combined = combined.unionByName(other)
    # Four rows meet in one, so that the daily total is at hand without another read of the fact.
    together = combined.agg(F.collect_list(F.struct("mart", "total_sales")).alias("marts")).select(
        "marts", F.filter("marts", lambda m: m["mart"] == "daily_sales")[0]["total_sales"].alias("expected")
    )
    return together.select("expected", F.inline("marts")).select(
        "mart", "total_sales", (F.col("total_sales") - F.col("expected")).alias("difference")
    )


# Relative difference that the order of summing doubles may make; volumes are never negative.
SUM_TOLERANCE = 1e-9


def mart_totals(mart: str) -> dict[str, Column]:
    """What ``check_totals`` compares of a mart, as aggregates that can be observed while it is written."""
    volume = {"volume": F.coalesce(F.sum("sales"), F.lit(0.0))}
    return {
        "daily_sales": {**volume, "rows": F.count(F.lit(1))},
        "weekly_sales": {**volume, "rows": F.coalesce(F.sum("observed_days"), F.lit(0))},
        "store_performance": {"volume": F.coalesce(F.sum("total_sales"), F.lit(0.0))},
        "family_performance": {"volume": F.coalesce(F.sum("total_sales"), F.lit(0.0))},
    }.get(mart, {})


def check_totals(totals: Mapping[str, Mapping[str, float]]) -> None:
    """Raise if a mart's total differs from the daily mart's: volumes up to the order of summing, rows exactly."""
    expected = totals["daily_sales"]
    faults = []
    for mart, found in totals.items():
        for name, value in found.items():
            room = SUM_TOLERANCE * abs(expected[name]) if name == "volume" else 0
            if not abs(value - expected[name]) <= room:  # a NaN is a fault, too
                faults.append(f"{mart}: {name} {value} instead of {expected[name]}")
    if faults:
        raise ReconciliationError("Marts do not add up to the daily mart. " + "; ".join(faults))


def check_orphans(plan: DataFrame, weekly: DataFrame) -> None:
    """Raise if a planned series has no row in the weekly mart, which holds every series of the fact."""
    orphan = orphan_series(plan, weekly).first()
    if orphan is not None:
        raise ReconciliationError(f"Planned series without demand: store {orphan['store_nbr']}, family {orphan['family']}")
