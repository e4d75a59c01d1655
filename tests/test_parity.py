"""Text parsing against pandas on random strings: the accepted values must be the same."""

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

from shelfcast.functions import parsing


def test_numbers(spark):
    draw = random.Random(11)
    alphabets = ("0123456789+-.eE xdDfFnNaiI,_\t", "0123456789.e-")
    texts = {"".join(draw.choice(draw.choice(alphabets)) for _ in range(draw.randint(1, 7))) for _ in range(3000)}
    texts |= {"nan", "inf", "Infinity", "1e308", "1e309", "1e-400", "0x10", "1L", "True", "1.", "+.5", "1 2",
              "--1", "1e", "e1", "1e+2", ".", "+", "-", "00012", " 7", "7 ", "7\n", "7\x0b", "1e 5", "٣", "１"}
    # Zero with a huge exponent is the one text pandas calls an overflow.
    texts = sorted(t for t in texts if not t.startswith(("0e", "0.e")))
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = dict(rows.select("i", parsing.read_number(F.col("text"), T.StringType())).collect())
    for i, text in enumerate(texts):
        expected = pd.to_numeric(pd.Series([text], dtype=object), errors="coerce").iloc[0]
        usable = not isinstance(expected, (bool, np.bool_)) and np.isfinite(expected)
        assert (found[i] is not None and np.isfinite(found[i])) == usable, repr(text)
        if usable:
            assert found[i] == float(expected) or np.isclose(found[i], float(expected), rtol=1e-14), repr(text)


def test_dates(spark):
    draw = random.Random(5)
    years = ("2024", "1999", "1677", "2262", "0024", "24", "20240", "1600", "2300")
    parts = ("1", "01", "02", "2", "12", "13", "0", "00", "9", "11", "4", "009", "21", "22", "28", "29", "30", "31", "32")
    texts = sorted(
        {
            draw.choice(("", "", "", " ")) + draw.choice(years) + sep + draw.choice(parts) + sep + draw.choice(parts)
            + draw.choice(("", "", "", " ", "T00:00", "Z", "\n"))
            for _ in range(4000)
            for sep in (draw.choice("---/ "),)
        }
    )
    expected = pd.to_datetime(pd.Series(texts), format="%Y-%m-%d", errors="coerce")
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn(
        "day", parsing.read_date(F.col("text"), T.StringType())
    )
    found = dict(rows.select("i", parsing.valid_date(F.col("day"))).collect())
    for i, text in enumerate(texts):
        assert found[i] == (None if pd.isna(expected[i]) else expected[i].date()), repr(text)
