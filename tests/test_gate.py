"""What must not become visible: marts that contradict each other, and half an export."""

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import marts, planning, quality
from shelfcast.plans import export
from shelfcast.plans.batch import run_job
from shelfcast.sources import files
from shelfcast.sources.runs import PublishConflictError, RunFolder

NAMES = 10


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("gate")
    raw = base / "data" / "raw"
    raw.mkdir(parents=True)
    first = datetime.date(2024, 1, 1)
    lines = [
        f"{first + datetime.timedelta(days=i)},{store},{family},{(i * 7 + store) % 11}.25,{i % 2}"
        for i in range(20) for store in (1, 2) for family in ("A", "B")
    ]
    (raw / "train.csv").write_text("\n".join(["date,store_nbr,family,sales,onpromotion", *lines]) + "\n")
    run_job(spark, "raw", str(base / "data"), str(base / "out"))
    return base


def loses_a_store(rows):
    return marts_store_performance(rows).where("store_nbr <> 2")


def counts_twice(daily):
    once = marts_weekly_sales(daily)
    return once.unionByName(once)


def drops_a_day(daily):
    return marts_weekly_sales(daily.where("sales > 0 OR store_nbr <> 1"))


marts_store_performance, marts_weekly_sales = marts.store_performance, marts.weekly_sales


@pytest.mark.parametrize("mart,broken,message", [
    ("store_performance", loses_a_store, "store_performance: volume"),
    ("weekly_sales", counts_twice, "weekly_sales: volume .*weekly_sales: rows 160 instead of 80"),
])
def test_a_broken_mart_is_not_published(spark, published, monkeypatch, mart, broken, message):
    out = str(published / "out")
    before, folders = RunFolder.published(spark, out).run_id, files.names(spark, f"{out}/runs")
    monkeypatch.setattr(marts, mart, broken)
    with pytest.raises(quality.ReconciliationError, match=message):
        run_job(spark, "raw", str(published / "data"), out)
    assert RunFolder.published(spark, out).run_id == before and files.names(spark, f"{out}/runs") == folders


def test_lost_rows_without_volume_are_found(spark):
    rows = [(datetime.date(2024, 1, d), 1, "A", float(d % 2), 0.0) for d in range(1, 8)]
    daily = marts.daily_sales(spark.createDataFrame(rows, "date date, store_nbr long, family string, sales double, onpromotion double"))
    totals = {"daily_sales": daily, "weekly_sales": drops_a_day(daily)}
    seen = {k: df.agg(*[c.alias(n) for n, c in quality.mart_totals(k).items()]).first().asDict() for k, df in totals.items()}
    with pytest.raises(quality.ReconciliationError, match="rows 4 instead of 7") as raised:
        quality.check_totals(seen)
    assert "volume" not in str(raised.value)


def test_a_plan_without_demand_is_not_published(spark, published, monkeypatch):
    plain = planning.plan_inventory
    monkeypatch.setattr(planning, "plan_inventory", lambda *args: plain(*args).withColumn(
        "family", F.when(F.col("store_nbr") == 2, F.lit("Z")).otherwise(F.col("family"))))
    out = str(published / "out")
    before = RunFolder.published(spark, out).run_id
    with pytest.raises(quality.ReconciliationError, match="store 2, family Z"):
        run_job(spark, "raw", str(published / "data"), out)
    assert RunFolder.published(spark, out).run_id == before


@pytest.mark.parametrize("volumes,fault", [((1e15, 1e15 + 1), False), ((1.0, 1.0001), True), ((0.0, 0.0), False), ((5.0, float("nan")), True)])
def test_tolerance(volumes, fault):
    totals = {"daily_sales": {"volume": volumes[0]}, "weekly_sales": {"volume": volumes[1]}}
    if fault:
        with pytest.raises(quality.ReconciliationError):
            quality.check_totals(totals)
    else:
        quality.check_totals(totals)


def test_totals_are_gathered_while_writing(spark, published, tmp_path):
    run = RunFolder.create(spark, str(tmp_path))
    rows = spark.range(0, 10_000, 1, 16).selectExpr("id", "id % 5 AS part")
    stored = run.write("gold", "t", rows, "part", {"rows": F.count(F.lit(1)), "total": F.sum("id")})
    assert run.totals == {"t": {"rows": 10_000, "total": 49_995_000}} and stored.count() == 10_000


def failing_after(count, monkeypatch):
    plain, calls = export.write_csv, []

    def write(df, path):
        calls.append(path)
        if len(calls) > count:
            raise OSError("storage is gone")
        plain(df, path)

    monkeypatch.setattr(export, "write_csv", write)


def contents(folder):
    return {p.relative_to(folder): p.read_bytes() for p in sorted(Path(folder).rglob("part-*"))}


def test_a_failed_export_leaves_the_old_files(spark, published, tmp_path, monkeypatch):
    out, target = str(published / "out"), str(tmp_path / "exports")
    paths = export.export_reporting(spark, out, target)
    before = contents(target)
    failing_after(5, monkeypatch)
    with pytest.raises(OSError, match="storage is gone"):
        export.export_reporting(spark, out, target)
    assert contents(target) == before and len(paths) == NAMES
    assert not files.names(spark, f"{target}/_staged")


def test_a_set_becomes_current_at_once(spark, published, tmp_path, monkeypatch):
    out, target = str(published / "out"), str(tmp_path / "exports")
    with pytest.raises(FileNotFoundError, match="CURRENT"):
        export.exported(spark, target)
    first = export.export_set(spark, out, target)
    assert len(first) == NAMES and export.exported(spark, target) == first
    assert all(Path(p).is_dir() for p in first.values())
    with monkeypatch.context() as patched:
        failing_after(5, patched)
        with pytest.raises(OSError, match="storage is gone"):
            export.export_set(spark, out, target)
    assert export.exported(spark, target) == first and len(files.names(spark, f"{target}/sets")) == 1
    second = export.export_set(spark, out, target)
    assert export.exported(spark, target) == second and second != first
    assert export.prune_sets(spark, target, keep=1) == [Path(first["daily_sales"]).parent.name]
    assert export.exported(spark, target) == second and Path(second["reorder_risk"]).is_dir()


def test_the_second_of_two_exports_loses(spark, published, tmp_path, monkeypatch):
    out, target = str(published / "out"), str(tmp_path / "exports")
    plain, winner = export.write_csv, []

    def write(df, path):
        if not winner:  # another export starts and ends while this one writes
            winner.append(None)
            winner.append(export.export_set(spark, out, target))
        plain(df, path)

    monkeypatch.setattr(export, "write_csv", write)
    with pytest.raises(PublishConflictError, match="version 1 was taken by another export"):
        export.export_set(spark, out, target)
    assert export.exported(spark, target) == winner[1]
    assert len(files.names(spark, f"{target}/sets")) == 1
