"""One ordered CSV file per mart, and exports in that form."""

import csv
import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from sample_data import write_sample
from shelfcast.plans.batch import parse_arguments, run_job
from shelfcast.plans.export import export_reporting, export_set
from shelfcast.schemas import CSV_ORDER, GOLD_COLUMNS
from shelfcast.sources import files
from shelfcast.sources.runs import RunFolder, write_csv_file


def rows_of(path):
    with open(path, newline="") as lines:
        return list(csv.reader(lines))


def test_rows_of_many_parts_are_in_order_behind_one_header(spark, tmp_path):
    frame = spark.range(5000).select(
        ((F.col("id") * 7919) % 5000).alias("n"), F.concat(F.lit('a "q", '), F.col("id")).alias('odd, "name"'),
        (F.col("id") % 2 == 0).alias("flag"), (F.col("id") * 1e12).alias("big"),
    ).repartition(13)
    path = tmp_path / "out" / "x.csv"
    for _ in range(2):  # the second one takes the first one's place
        write_csv_file(frame, str(path), ["n"])
    assert path.is_file() and sorted(p.name for p in path.parent.iterdir() if not p.name.startswith(".")) == ["x.csv"]
    head, *rows = rows_of(path)
    assert head == ["n", 'odd, "name"', "flag", "big"]
    assert [int(r[0]) for r in rows] == list(range(5000))
    by_n = {r["n"]: r for r in frame.collect()}
    assert all(r[1] == by_n[int(r[0])][1] and r[2] == str(by_n[int(r[0])]["flag"]) for r in rows)
    assert not any("E" in r[3] for r in rows)


def test_an_empty_table_is_a_header(spark, tmp_path):
    write_csv_file(spark.range(0).select("id", F.lit(1.5).alias("v")), str(tmp_path / "e.csv"), ["id"])
    assert rows_of(tmp_path / "e.csv") == [["id", "v"]]


def test_a_failed_file_leaves_the_earlier_one_and_no_parts(spark, tmp_path, monkeypatch):
    path = tmp_path / "x.csv"
    write_csv_file(spark.range(3), str(path), ["id"])
    monkeypatch.setattr(files, "concatenate", lambda *a: (_ for _ in ()).throw(OSError("full")))
    with pytest.raises(OSError, match="full"):
        write_csv_file(spark.range(9), str(path), ["id"])
    assert rows_of(path) == [["id"], ["0"], ["1"], ["2"]]
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_parts")]


def test_dates_and_numbers_are_ordered_as_such(spark, tmp_path):
    days = [datetime.date(2024, 1, 1) + datetime.timedelta(days=k) for k in range(12)]
    frame = spark.createDataFrame([(d, s) for d in reversed(days) for s in (10, 9, 2)], "day date, store long")
    write_csv_file(frame, str(tmp_path / "d.csv"), ["day", "store"])
    assert rows_of(tmp_path / "d.csv")[1:] == [[str(d), str(s)] for d in days for s in (2, 9, 10)]


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("files")
    write_sample(base / "data" / "sample")
    run_job(spark, "sample", str(base / "data"), str(base / "out"), csv="files")
    return base, RunFolder.published(spark, str(base / "out"))


def test_a_run_writes_one_ordered_file_per_mart(spark, published):
    base, run = published
    con = duckdb.connect()
    for name, columns in GOLD_COLUMNS.items():
        path = f"{run.root}/csv/{name}.csv"
        head, *rows = rows_of(path)
        assert head == list(columns)
        assert len(rows) == run.read("gold", name).count()
        if CSV_ORDER[name]:
            keys = con.execute(f"SELECT {', '.join(CSV_ORDER[name])} FROM read_csv('{path}', parallel = false)").fetchall()
            assert keys == sorted(keys)
    total = sum(float(r[3]) for r in rows_of(f"{run.root}/csv/daily_sales.csv")[1:])
    assert total == pytest.approx(run.read("gold", "daily_sales").agg(F.sum("sales")).first()[0])


def test_exports_of_single_files(spark, published):
    base, run = published
    paths = export_reporting(spark, str(base / "out"), str(base / "exports"), single=True)
    shown = export_set(spark, str(base / "out"), str(base / "sets"), single=True)
    assert len(paths) == len(shown) == 10
    for path in paths:
        name = path.rpartition("/")[2].removesuffix(".csv")
        assert rows_of(path) == rows_of(shown[name])
    want = [list(r) for r in run.read("work", "suggestions").orderBy("section", "store_nbr", "family").select("scope", "evidence", "recommendation").collect()]
    assert rows_of(shown["recommendations"])[1:] == want


def test_command_line_names_the_form():
    assert parse_arguments([]).csv == "folders" and parse_arguments(["--csv", "files"]).csv == "files"
