"""Validation rules, their order and their messages."""

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import parsing
from shelfcast.operators.quality import (
    DataValidationError, check_grain, clean_table, duplicate_keys, orphan_series, typed_table,
    validate_sales,
)
from shelfcast.schemas import CONTEXT_TABLES, SALES

TEXT = "date string, store_nbr string, family string, sales string, onpromotion string"
GOOD = ("2024-01-01", "1", "A", "10", "0")
POSITION = dict(zip(("date", "store_nbr", "family", "sales", "onpromotion"), range(5)))


def text_rows(spark, **changes):
    """One good row and one with the given columns changed."""
    row = list(GOOD)
    row[0] = "2024-01-02"
    for column, value in changes.items():
        row[POSITION[column]] = value
    return spark.createDataFrame([GOOD, tuple(row)], TEXT)


def test_missing_column_is_named(sales):
    with pytest.raises(DataValidationError, match="Missing required columns: family, sales"):
        validate_sales(sales.drop("sales", "family"))


def test_empty_table(spark):
    with pytest.raises(DataValidationError, match="Table has no rows"):
        validate_sales(spark.createDataFrame([], TEXT))


@pytest.mark.parametrize("value", [-1.0, float("inf"), float("nan"), None])
def test_typed_bad_sales(sales, value):
    broken = sales.withColumn("sales", F.when(F.dayofmonth("date") > 7, F.col("sales")).otherwise(F.lit(value)))
    with pytest.raises(DataValidationError, match="sales must contain finite nonnegative numbers"):
        validate_sales(broken)


@pytest.mark.parametrize("value", ["-1", "inf", "NaN", "1,000", "0x10", "1_0", "1d", "abc", "1e999", ""])
def test_text_bad_sales(spark, value):
    with pytest.raises(DataValidationError, match="sales must"):
        validate_sales(text_rows(spark, sales=value))


@pytest.mark.parametrize("value,number", [(" 1 ", 1.0), ("1e3", 1000.0), (".5", 0.5), ("+2.", 2.0), ("\t3\n", 3.0)])
def test_text_good_sales(spark, value, number):
    rows = validate_sales(text_rows(spark, sales=value)).orderBy("date").collect()
    assert rows[1]["sales"] == number


@pytest.mark.parametrize(
    "value",
    ["2024-02-30", " 2024-01-02", "2024-01", "20240102", "2024-01-02 00:00:00", "0024-01-02",
     "1677-09-21", "2262-04-12", "2024/01/02", "2024-13-01", "x"],
)
def test_bad_date(spark, value):
    with pytest.raises(DataValidationError, match="Invalid dates in date; use YYYY-MM-DD"):
        validate_sales(text_rows(spark, date=value))


@pytest.mark.parametrize("value", ["2024-1-2", "1677-09-22", "2262-04-11", "2024-02-29"])
def test_good_date(spark, value):
    cleaned = validate_sales(text_rows(spark, date=value))
    year, month, day = (int(part) for part in value.split("-"))
    assert cleaned.schema["date"].dataType.simpleString() == "date"
    assert cleaned.where((F.year("date") == year) & (F.month("date") == month) & (F.dayofmonth("date") == day)).count() == 1


@pytest.mark.parametrize("value", ["0", "-3", "1.5", "abc", "inf"])
def test_bad_store_number(spark, value):
    with pytest.raises(DataValidationError, match="store_nbr must contain positive integers"):
        validate_sales(text_rows(spark, store_nbr=value))


def test_store_number_is_whole_and_exact(spark):
    rows = validate_sales(text_rows(spark, store_nbr="9007199254740993")).collect()
    assert {r["store_nbr"] for r in rows} == {1, 9007199254740993}
    rows = validate_sales(text_rows(spark, store_nbr="7.0")).collect()
    assert {r["store_nbr"] for r in rows} == {1, 7}


@pytest.mark.parametrize(
    "column,value,message",
    [("family", "  ", "Missing family values"), ("family", "  ", "Missing family values"),
     ("store_nbr", None, "Missing store_nbr values"), ("date", "", "Missing date values"),
     ("onpromotion", "-1", "onpromotion must contain"), ("onpromotion", None, "onpromotion must contain")],
)
def test_missing_keys_and_bad_promotion(spark, column, value, message):
    with pytest.raises(DataValidationError, match=message):
        validate_sales(text_rows(spark, **{column: value}))


def test_a_typed_key_that_is_not_a_number_is_missing(sales):
    odd = sales.withColumn("store_nbr", F.lit(float("nan")))
    with pytest.raises(DataValidationError, match="Missing store_nbr values"):
        validate_sales(odd)
    infinite = sales.withColumn("store_nbr", F.lit(float("inf")))
    with pytest.raises(DataValidationError, match="store_nbr must contain positive integers"):
        validate_sales(infinite)
    halves = sales.withColumn("store_nbr", F.lit(2.0))
    assert validate_sales(halves).first()["store_nbr"] == 2


def test_duplicate_after_trim(spark):
    rows = text_rows(spark, date="2024-01-01", family=" A ")
    with pytest.raises(DataValidationError, match="Duplicate rows at grain date, store_nbr, family"):
        validate_sales(rows)


def test_first_broken_rule_names_the_error(spark):
    everything = text_rows(spark, date="x", store_nbr="0", family="A", sales="-1")
    with pytest.raises(DataValidationError, match="Invalid dates"):
        validate_sales(everything)
    with pytest.raises(DataValidationError, match="Missing family"):
        validate_sales(text_rows(spark, date="x", family=" "))
    with pytest.raises(DataValidationError, match="sales must"):
        validate_sales(text_rows(spark, store_nbr="0", sales="-1"))


def test_extra_columns_survive_and_keys_are_optional(spark):
    extra = text_rows(spark).withColumn("note", F.lit(" kept "))
    assert validate_sales(extra).first()["note"] == " kept "
    holidays = next(spec for spec in CONTEXT_TABLES if spec.name == "holidays_events")
    row = ("2024-01-01", "Holiday", "National", "X", "New year", "False")
    table = spark.createDataFrame([row, row], [*holidays.required])
    assert clean_table(table, holidays).count() == 2


def test_grain_helpers(sales):
    doubled = sales.unionByName(sales.limit(1))
    assert duplicate_keys(doubled, SALES.keys).collect()[0]["rows"] == 2
    check_grain(sales, SALES.keys)
    check_grain(doubled, ())


def test_orphans(spark, sales):
    plan = spark.createDataFrame([(5, "TEA"), (5, "RICE")], "store_nbr long, family string")
    assert [tuple(r) for r in orphan_series(plan, sales).collect()] == [(5, "RICE")]


def test_strip_matches_python(spark):
    samples = ["a", " a ", " a ", "\ta b\n", "\x1ca\x1f", "", " 　", "a\u0085", "é "]
    found = spark.createDataFrame([(s,) for s in samples], "s string").select(
        parsing.strip_text(F.col("s"))
    ).collect()
    assert [r[0] for r in found] == [s.strip() for s in samples]


def test_copies_are_combined_before_the_grain_shuffle(spark):
    """A third of the rows is one key: each input partition sends it once."""
    copies = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    rows = spark.range(90_000).select(
        F.lit("2024-01-01").alias("date"), (copies + 1).cast("string").alias("store_nbr"),
        F.lit("A").alias("family"), F.lit("1").alias("sales"),
    )
    plan = duplicate_keys(rows, SALES.keys)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange")  # the partial step is below
    with pytest.raises(DataValidationError, match="Duplicate rows"):
        clean_table(rows, SALES)
    assert clean_table(rows.dropDuplicates(["store_nbr"]), SALES).count() == 60_001


def test_typed_table_merges_texts_of_one_key(spark):
    rows = text_rows(spark, date="2024-1-1", store_nbr="1.0", family=" A\t")
    assert duplicate_keys(rows, SALES.keys).isEmpty()
    assert duplicate_keys(typed_table(rows, SALES), SALES.keys).first()["rows"] == 2
