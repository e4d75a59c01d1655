"""Strict text-to-value rules for files whose columns all arrive as strings.

Demand files have billions of rows, so every value is parsed once: ``read_*`` belongs in a
projection of its own, and the ``valid_*`` checks that mention it repeatedly in the next.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Texts that a CSV field may hold to mean "missing".
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# First and last calendar day an input date may name.
FIRST_DATE, LAST_DATE = "1677-09-22", "2262-04-11"

# The characters that count as whitespace around a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The cast to DOUBLE also takes words, type suffixes and hexadecimal; decimal text has only these.
_NUMBER_TEXT = r"^[\s0-9+\-.eE]+\z"
_DATE_TEXT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
LARGEST_BIGINT = float(2**63)


def strip_text(value: Column) -> Column:
    """Remove leading and trailing whitespace of any Unicode kind (``trim`` knows spaces only)."""
    return F.btrim(value, F.lit(WHITESPACE))


def missing_to_null(value: Column) -> Column:
    return F.when(~value.isin(*MISSING_TOKENS), value)


def is_absent_text(stripped: Column) -> Column:
    return stripped.isNull() | (stripped == "")


def is_absent(value: Column, dtype: T.DataType) -> Column:
    """True for null and, in text, for blank values."""
    if isinstance(dtype, T.StringType):
        return is_absent_text(strip_text(value))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def read_number(value: Column, dtype: T.DataType) -> Column:
    """DOUBLE, or null where the text is no plain decimal number."""
    if isinstance(dtype, T.StringType):
        return F.when(value.rlike(_NUMBER_TEXT), value.try_cast("double"))
    if isinstance(dtype, T.NumericType):
        return value.cast("double")
    return F.lit(None).cast("double")


def finite(number: Column) -> Column:
    """The number, or null for NaN and the infinities; NaN sorts above infinity."""
    return F.when((number > float("-inf")) & (number < float("inf")), number)


def valid_count(number: Column) -> Column:
    """The number where it is finite and at least zero, else null."""
    return F.when((number >= 0) & (number < float("inf")), number)


def valid_store_number(number: Column, value: Column, dtype: T.DataType) -> Column:
    """Positive BIGINT, else null. Text such as ``1.0`` is a whole number too."""
    if isinstance(dtype, INTEGERS):
        return F.when(value > 0, value.cast("bigint"))
    whole = (number > 0) & (number < LARGEST_BIGINT) & (number % 1 == 0)
    converted = number.cast("bigint")
    if isinstance(dtype, T.StringType):
        # Integer text is cast directly: beyond 2**53 a double is too coarse.
        converted = F.coalesce(value.try_cast("bigint"), converted)
    return F.when(whole, converted)


def read_date(value: Column, dtype: T.DataType) -> Column:
    """DATE, or null where the text is not year-month-day or no such day exists."""
    if isinstance(dtype, T.DateType):
        return value
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return value.cast("date")
    if isinstance(dtype, T.StringType):
        return F.when(value.rlike(_DATE_TEXT), value.try_cast("date"))
    return F.lit(None).cast("date")


def valid_date(date: Column) -> Column:
    first, last = F.lit(FIRST_DATE).cast("date"), F.lit(LAST_DATE).cast("date")
    return F.when((date >= first) & (date <= last), date)
