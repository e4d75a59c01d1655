"""Measures and matrix from merged day words against plain sets, on odd facts."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import marts, measures, pages

SCHEMA = "date date, store_nbr long, family string, sales double, onpromotion double"
GROUPS = [(), ("store_nbr",), ("family",), ("date",), ("weekday_number", "day_type"), ("store_nbr", "family"),
          ("store_nbr", "family", "date")]


def odd_rows():
    """Days around 1970 and at both ends of the allowed dates, sparse and dense series, nulls in any column."""
    rng = random.Random(5)
    first = datetime.date(1969, 10, 1)
    days = [first + datetime.timedelta(days=rng.randrange(400)) for _ in range(120)]
    days += [datetime.date(1677, 9, 22), datetime.date(2262, 4, 11), datetime.date(1969, 12, 31), datetime.date(1970, 1, 1)]
    rows = {(d, rng.choice([1, 2, 2**40, -3]), rng.choice(["A", "B", ""])) for d in days for _ in range(3)}
    rows |= {(None, 1, "A"), (days[0], None, "A"), (days[1], 2, None), (None, None, None)}
    values, flags = [0.0, 1.5, 7.0, None], [None, 0.0, 2.0]
    return [(*key, rng.choice(values), rng.choice(flags)) for key in sorted(rows, key=str)]


def plain(rows, keys):
    """The measures of each group from sets and lists."""
    groups = {} if keys else {(): []}
    for row in rows:
        groups.setdefault(tuple(row[k] for k in keys), []).append(row)

    def mean(values):
        return sum(values) / len(values) if values else None

    def over(a, b):
        return None if a is None or not b else a / b

    answer = {}
    for key, members in groups.items():
        volumes = [r["sales"] for r in members if r["sales"] is not None]
        total = sum(volumes) if volumes else None
        known = sum(r["onpromotion"] is not None for r in members)
        yes = [r["sales"] for r in members if r["promoted"] and r["sales"] is not None]
        no = [r["sales"] for r in members if r["promoted"] is False and r["sales"] is not None]
        sizes = [len({r[c] for r in members}) for c in ("date", "store_nbr", "family")]
        promoted = sum(yes) if yes and known else None
        with_promotion, without = mean(yes), mean(no)
        lift = None if with_promotion is None or without is None else over(with_promotion - without, without)
        answer[key] = [
            total, sizes[0], over(total, sizes[0]), over(total, sizes[0]), *sizes[1:], known, promoted,
            over(promoted, total), sum(r["promoted"] is True for r in members),
            sum(r["promoted"] is False for r in members), with_promotion, without, lift,
        ]
    return answer


@pytest.fixture(scope="module")
def odd(spark):
    return marts.daily_sales(spark.createDataFrame(odd_rows(), SCHEMA)).cache()


def found(df, keys):
    return {tuple(r[k] for k in keys): [r[m] for m in measures.DEMAND_MEASURES] for r in df.collect()}


@pytest.mark.parametrize("keys", GROUPS)
def test_measures_equal_plain_sets(odd, keys):
    expected = plain(odd.collect(), keys)
    got = found(measures.demand_measures(odd, keys), keys)
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        assert got[key] == pytest.approx(values), key


@pytest.mark.parametrize("measure", measures.DEMAND_MEASURES)
def test_each_measure_alone_equals_all_together(odd, measure):
    everything = {r["family"]: r[measure] for r in measures.demand_measures(odd, ["family"]).collect()}
    alone = {r["family"]: r[measure] for r in measures.demand_measures(odd, ["family"], [measure]).collect()}
    assert alone == pytest.approx(everything)


def test_an_empty_selection(odd):
    nothing = measures.demand_measures(odd, stores=[999]).collect()
    assert found(measures.demand_measures(odd, stores=[999]), ()) == plain([], ()) and len(nothing) == 1
    assert measures.demand_measures(odd, ["family"], stores=[999]).count() == 0
    assert measures.store_family_matrix(odd.where("false")).count() == 0


def test_matrix_equals_plain_sets(odd):
    rows = odd.collect()
    expected = {}
    for level, keys in enumerate((("store_nbr", "family"), ("store_nbr",), ("family",), ())):
        for key, values in plain(rows, keys).items():
            named = dict(zip(keys, key))
            expected[(named.get("store_nbr"), named.get("family"), level)] = (values[0], values[1], values[2])
    got = {
        (r["store_nbr"], r["family"], r["level"]): (r["total_demand"], r["observed_days"], r["average_daily_demand"])
        for r in measures.store_family_matrix(odd).collect()
    }
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        assert got[key] == pytest.approx(values), key


def test_weekly_leaders_equal_plain_sums(odd):
    star = odd.withColumn("week_start", F.trunc("date", "week")).where("family IS NOT NULL")
    totals, weeks = {}, {}
    for r in star.collect():
        totals[r["family"]] = totals.get(r["family"], 0) + (r["sales"] or 0)
        weeks.setdefault((r["week_start"], r["family"]), []).append(r["sales"])
    best = sorted(totals, key=lambda name: (-totals[name], name))[:2]
    expected = {
        k: sum(v for v in values if v is not None) if any(v is not None for v in values) else None
        for k, values in weeks.items() if k[1] in best
    }
    got = {(r["week_start"], r["family"]): r["total_demand"] for r in pages.weekly_top_families(star, 2).collect()}
    assert got == pytest.approx(expected)
