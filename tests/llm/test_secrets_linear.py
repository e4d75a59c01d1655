"""Long runs and many matches in one text take time in proportion to its length."""

import itertools
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import secrets


def test_codes_of_every_character(spark):
    text = secrets.ALPHABET + "é \U0001f600a" + secrets.ALPHABET[::-1]
    codes = spark.range(1).select(secrets._codes(F.lit(text)).alias("c"), secrets._codes(F.lit("x")).alias("one"),
                                  secrets._codes(F.lit("")).alias("none")).first()
    place = lambda c: secrets.ALPHABET.find(c) + 1
    assert codes.c == [(place(a) - 1) * secrets.SYMBOLS + place(b) if place(a) and place(b) else 0
                       for a, b in zip(text, text[1:])]
    assert codes.one is None and codes.none is None


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 128, 4096, 4097, 9000])
def test_running_values_over_blocks(spark, n):
    values = spark.range(1).select(F.slice(F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: i * 7 % 11), 1, n).alias("v"))
    out = values.select(secrets._running(F.col("v"), lambda a, b: a + b), secrets._running(F.col("v"), F.greatest)).first()
    plain = [i * 7 % 11 for i in range(n)]
    assert out[0] == list(itertools.accumulate(plain))
    assert out[1] == list(itertools.accumulate(plain, max))


def test_a_megabyte_within_a_minute(spark, make_docs):
    rnd = random.Random(2)
    run = "".join(rnd.choices(secrets.ALPHABET, k=1_000_000))
    many = " ".join(f"token={rnd.randrange(10**9):09d}é" for _ in range(100_000))
    plain = ["The secretary keeps variable_names here."] * 20 + [f"token={'ab3' * 4}{i}" for i in range(20)]
    docs = make_docs([run, many, *plain])
    start = time.perf_counter()
    rows = {r.doc_id: r.found for r in secrets.find_secrets(docs).collect()}
    masked = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert time.perf_counter() - start < 60
    assert any((s.start, s["end"]) == (0, 1_000_000) for s in rows[0]) and masked[0] == secrets.MASK
    expected = [m.span() for m in re.finditer(secrets.ASSIGN, many)]
    assert [(s.start, s["end"]) for s in rows[1] if s.kind == 0] == expected
    assert masked[1] == " ".join([f"{secrets.MASK}é"] * 100_000)
