"""The batch job end to end: a sample against plain SQL, source files, failed runs, exports."""

import datetime
import json
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from sample_data import write_sample
from shelfcast.config import PlanningConfig
from shelfcast.operators import advice, marts, measures, planning, questions, star, trend
from shelfcast.operators.quality import DataValidationError, orphan_series
from shelfcast.plans.batch import parse_arguments, run_job
from shelfcast.plans.export import export_reporting
from shelfcast.schemas import GOLD_COLUMNS, MONTH
from shelfcast.sources import csv_tables, files
from shelfcast.sources.runs import RunFolder, prune_runs, register_views, write_csv
from workload import oracles, queries


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    """One published run of the sample and its report."""
    base = tmp_path_factory.mktemp("sample")
    write_sample(base / "data" / "sample")
    report = run_job(spark, "sample", str(base / "data"), str(base / "out"))
    return base, report, RunFolder.published(spark, str(base / "out"))


@pytest.fixture(scope="module")
def demand(sample):
    """The same file in DuckDB, for figures that plain SQL states."""
    base, _, _ = sample
    con = duckdb.connect()
    con.execute(f"""CREATE VIEW demand AS SELECT CAST(date AS DATE) AS date, CAST(store_nbr AS BIGINT) AS store_nbr, family,
        CAST(sales AS DOUBLE) AS sales, CAST(onpromotion AS DOUBLE) AS onpromotion
        FROM read_csv('{base}/data/sample/train.csv', all_varchar = true)""")
    fact = "f AS (SELECT * FROM demand)"

    def rows(*parts):
        answer = con.execute(oracles._with(fact, *parts))
        return sorted_rows([d[0] for d in answer.description], answer.fetchall())

    return rows


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=str)


def found(df):
    df = queries.rounded(df)
    return sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def value(df):
    return df.first()[0]


def read_csv(spark, path):
    return spark.read.option("header", True).option("escape", '"').csv(str(path))


PLAN = oracles._plan()
MARTS = {
    "daily_sales": (oracles.DAILY, oracles.DAILY_ROWS),
    "weekly_sales": (oracles.WEEKLY, oracles.WEEKLY_ROWS),
    "store_performance": (oracles.STORES, oracles.STORE_ROWS),
    "family_performance": (oracles.FAMILIES, oracles.FAMILY_ROWS),
    "promotion_impact": (oracles.PROMOTIONS, oracles.PROMOTION_ROWS),
    "demand_volatility": (oracles.VOLATILITY, oracles.VOLATILITY_ROWS),
    "reorder_risk": (PLAN, oracles.PLAN_ROWS),
    "recommendations": (
        PLAN, oracles.STORES, oracles.PROMOTIONS, oracles.ADVICE,
        "SELECT scope, evidence, recommendation FROM advice",
    ),
}


@pytest.mark.parametrize("name", sorted(MARTS))
def test_published_mart_equals_plain_sql(sample, demand, name):
    _, _, run = sample
    stored = run.read("gold", name)
    assert tuple(stored.columns) == GOLD_COLUMNS[name] + ((MONTH,) if name == "daily_sales" else ())
    assert found(stored.select(*GOLD_COLUMNS[name])) == demand(*MARTS[name])


def test_report(sample, demand):
    _, report, _ = sample
    assert list(report) == ["source", "data_label", "rows", "kpis", "planning", "warnings", "as_of"]
    assert report["source"] == "sample" and report["data_label"] == "Synthetic demo data"
    assert report["rows"] == 5 * 4 * 84 and report["as_of"] == "2023-05-28"
    assert report["planning"] == PlanningConfig().as_dict()
    (total, average, promoted), = demand(
        oracles.KPIS, "SELECT total_sales AS a, average_daily_sales AS b, promoted_sales AS c FROM kpis")
    kpis = report["kpis"]
    assert kpis["total_sales"] == pytest.approx(total) and kpis["average_daily_sales"] == pytest.approx(average)
    assert kpis["promoted_sales"] == pytest.approx(promoted)
    assert (kpis["stores"], kpis["families"], kpis["start"], kpis["end"]) == (4, 5, "2023-03-06", "2023-05-28")
    assert report["warnings"] == [f"Optional {n}.csv absent." for n in ("transactions", "oil", "holidays_events", "inventory")]


def test_plan_covers_every_series(sample):
    _, _, run = sample
    plan = run.read("gold", "reorder_risk")
    counts = {r["risk"]: r["series"] for r in planning.risk_counts(plan).collect()}
    assert counts == {"Insufficient history": 0, "Reorder now": 5, "Monitor": 5, "Healthy": 5, "Overstock risk": 5}
    assert orphan_series(plan, run.read("silver", "sales")).isEmpty()


def test_questions(sample, demand):
    _, _, run = sample
    daily, plan = run.read("gold", "daily_sales"), run.read("gold", "reorder_risk")
    shares = questions.store_share(run.read("gold", "store_performance")).collect()
    by_total = [r[0] for r in demand("SELECT list(store_nbr ORDER BY total DESC) FROM (SELECT store_nbr, sum(sales) AS total FROM f GROUP BY 1)")]
    assert [r["store_nbr"] for r in shares] == by_total[0]
    enough = demand("""SELECT store_nbr, family FROM f GROUP BY ALL
        HAVING count(*) FILTER (onpromotion > 0) >= 5 AND count(*) FILTER (onpromotion = 0) >= 5""")
    within = questions.promotion_within_store(daily).collect()
    assert sorted((r["family"], r["store_nbr"]) for r in within) == [(r["family"], r["store_nbr"]) for r in within]
    assert sorted_rows(["store_nbr", "family"], [(r["store_nbr"], r["family"]) for r in within]) == enough
    queue = [r["risk"] for r in questions.review_queue(plan).collect()]
    assert queue == ["Reorder now"] * 5 + ["Monitor"] * 5 + ["Overstock risk"] * 5
    complete = trend.complete_weeks(run.read("gold", "weekly_sales"), plan)
    assert complete.count() == 12
    index = trend.weekly_trend_index(run.read("gold", "weekly_sales"), complete)
    assert index.count() == 60
    assert {r["volume_index"] for r in index.where("week = DATE '2023-03-06'").collect()} == {100.0}


@pytest.mark.parametrize("keys", [(), ("store_nbr",), ("family",), ("date",), ("weekday_number", "day_type")])
def test_measures_equal_plain_sql(sample, demand, keys):
    _, _, run = sample
    daily = run.read("gold", "daily_sales")
    assert found(measures.demand_measures(daily, keys)) == demand(
        oracles.DAILY, oracles._measures("daily", ", ".join(keys) or None))


def test_selected_measures_and_dates(sample, demand):
    _, _, run = sample
    daily = run.read("gold", "daily_sales")
    start, end = datetime.date(2023, 4, 20), datetime.date(2023, 5, 2)
    some = measures.demand_measures(daily, ["family"], ["store_count", "total_demand"], start=start, end=end, stores=[2, 7])
    assert some.columns == ["family", "total_demand", "store_count"]
    where = "date BETWEEN DATE '2023-04-20' AND DATE '2023-05-02' AND store_nbr IN (2, 7)"
    assert found(some) == demand(
        f"SELECT family, round(sum(sales), 6) AS total_demand, count(DISTINCT store_nbr) AS store_count FROM f WHERE {where} GROUP BY 1")
    text = some._jdf.queryExecution().executedPlan().toString()
    assert f"({MONTH}" in text.split("PartitionFilters")[1].split("PushedFilters")[0]
    planned = measures.planning_measures(run.read("gold", "reorder_risk")).first()
    assert planned["series_requiring_attention"] == 15 and planned["planning_series_count"] == 20
    assert star.dim_date(daily).count() == 365


def test_matrix_equals_plain_sql(sample, demand):
    _, _, run = sample
    assert found(measures.store_family_matrix(run.read("gold", "daily_sales"))) == demand(oracles.CUBE_ROWS)


def test_published_run_answers_sql(spark, sample):
    base, _, _ = sample
    assert set(register_views(spark, str(base / "out"))) == set(GOLD_COLUMNS) | {"run_metadata"}
    rows = spark.sql(
        "SELECT s.store_nbr, any_value(s.total_sales) AS volume, count(r.family) AS queue FROM store_performance s "
        "JOIN reorder_risk r ON r.store_nbr = s.store_nbr WHERE r.risk <> 'Healthy' GROUP BY s.store_nbr ORDER BY 1"
    ).collect()
    assert [r["store_nbr"] for r in rows] == [2, 4, 7, 11] and sum(r["queue"] for r in rows) == 15


def test_exports(spark, sample, demand, tmp_path):
    base, report, run = sample
    paths = export_reporting(spark, str(base / "out"), str(tmp_path / "exports"))
    assert {Path(p).stem for p in paths} == set(GOLD_COLUMNS) | {"overview_kpis", "quality_summary"}
    tables = {Path(p).stem: read_csv(spark, p) for p in paths}
    for name, columns in GOLD_COLUMNS.items():
        assert tuple(tables[name].columns) == columns
        assert tables[name].count() == run.read("gold", name).count()
    overview = {r["metric"]: float(r["value"]) for r in tables["overview_kpis"].collect()}
    (total,), = demand("SELECT round(sum(sales), 2) AS total FROM f")
    assert overview == {
        "Total demand volume": total, "Product families": 5, "Stores": 4, "Reorder now series": 5}
    quality = {r["check"]: r["value"] for r in tables["quality_summary"].collect()}
    assert quality["data_label"] == "Synthetic demo data" and int(quality["rows"]) == report["rows"]
    assert json.loads(quality["planning"]) == report["planning"]
    assert json.loads(quality["kpis"]) == report["kpis"]
    assert {r["promoted"] for r in tables["daily_sales"].select("promoted").distinct().collect()} == {"True", "False"}
    assert len(export_reporting(spark, str(base / "out"), str(tmp_path / "exports"))) == 10
    stored = json.loads(files.read_text(spark, f"{run.root}/quality_report.json"))
    assert stored == report


def test_csv_keeps_the_review_order_over_many_files(spark, sample, tmp_path):
    """Without merging, every sort partition becomes a file; the files in name order are sorted."""
    base, _, _ = sample
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        paths = export_reporting(spark, str(base / "out"), str(tmp_path / "exports"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    folder = Path(next(p for p in paths if "recommendations" in p))
    parts = sorted(folder.glob("part-*.csv"))
    scopes = [line.split(",")[0] for part in parts for line in part.read_text().splitlines()[1:]]
    _, _, run = sample
    ordered = advice.in_review_order(run.read("work", "suggestions")).collect()
    assert len(parts) > 1 and scopes == [r["scope"] for r in ordered] and len(scopes) > 5


def test_export_names_the_missing_mart(spark, sample, tmp_path):
    with pytest.raises(FileNotFoundError, match="CURRENT"):
        export_reporting(spark, str(tmp_path / "nothing"), str(tmp_path / "exports"))
    empty = RunFolder(spark, str(tmp_path / "out"), "r1")
    empty.publish()
    with pytest.raises(FileNotFoundError, match="daily_sales"):
        export_reporting(spark, str(tmp_path / "out"), str(tmp_path / "exports"))


def test_series_work_needs_no_shuffle_on_the_bucketed_fact(spark, sample, tmp_path):
    base, _, _ = sample
    run = RunFolder.create(spark, str(tmp_path / "out"))
    try:
        layers = csv_tables.load_layers(spark, "sample", str(base / "data"), run)
        fact = layers.silver["sales"]
        daily = marts.daily_sales(fact)
        weekly = marts.weekly_sales(daily)
        grain = fact.groupBy("date", "store_nbr", "family").count()
        for frame in (weekly, grain):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "FileScan" in plan
    finally:
        run.close()


def raw_folder(tmp_path, lines, header="date,store_nbr,family,sales,onpromotion"):
    raw = tmp_path / "data" / "raw"
    raw.mkdir(parents=True, exist_ok=True)
    (raw / "train.csv").write_text("\n".join([header, *lines]) + "\n")
    return raw


ROWS = ["2024-01-01,1,A,10,0", "2024-01-02,1,A,20,0", "2024-01-03,1,A,20,1", "2024-01-04,1,A,40,1"]


def test_optional_files_promotion_and_failed_run(spark, tmp_path):
    raw = raw_folder(tmp_path, ROWS)
    (raw / "stores.csv").write_text("unexpected\n1\n")
    (raw / "oil.csv").write_text("date,dcoilwtico\n2024-01-01,NA\n2024-01-02,71.5\n2024-01-03,x\n")
    (raw / "holidays_events.csv").write_text("")
    (raw / "transactions.csv").write_text("date,store_nbr,transactions\n2024-01-01,1,5,9\n")
    (raw / "inventory.csv").write_text(
        "date,store_nbr,family,inventory_on_hand\n2024-01-04,1,A,500\n2024-01-03,1,A,1\n")
    data, out = str(tmp_path / "data"), str(tmp_path / "out")
    report = run_job(spark, "auto", data, out, PlanningConfig(window_days=4))
    assert report["source"] == "raw"
    assert report["warnings"] == [
        "Ignored optional stores: Missing required columns: store_nbr",
        "Ignored optional transactions: Records with more than the 3 fields of the header",
        "Oil retained as context; missing oil prices are allowed; no causal model uses oil.",
        "Ignored optional holidays_events: No columns to parse from file",
    ]
    run = RunFolder.published(spark, out)
    assert run.read("gold", "promotion_impact").first()["lift_pct"] == pytest.approx(100)
    assert run.read("bronze", "stores").columns == ["unexpected"]
    for layer, table in (("silver", "stores"), ("bronze", "transactions"), ("silver", "transactions")):
        with pytest.raises(FileNotFoundError):
            run.read(layer, table)
    assert [r["dcoilwtico"] for r in run.read("silver", "oil").orderBy("date").collect()] == [None, 71.5, None]
    plan = run.read("gold", "reorder_risk").first()
    assert plan["inventory_on_hand"] == 500 and plan["inventory_source"] == planning.PROVIDED

    raw_folder(tmp_path, [line.rsplit(",", 1)[0] for line in ROWS], "date,store_nbr,family,sales")
    report = run_job(spark, "raw", data, out)
    assert report["kpis"]["promoted_sales"] is None
    assert report["warnings"][0] == "onpromotion absent: promotion analysis unavailable."
    assert report["warnings"][-1].startswith("Some store/family series have incomplete trailing history")
    export_reporting(spark, out, str(tmp_path / "exports"))
    daily = read_csv(spark, tmp_path / "exports" / "daily_sales.csv")
    assert daily.where("onpromotion IS NOT NULL OR promoted IS NOT NULL").isEmpty()
    promotion = read_csv(spark, tmp_path / "exports" / "promotion_impact.csv").first()
    assert promotion["lift_pct"] is None and promotion["promoted_average"] is None
    plan = read_csv(spark, tmp_path / "exports" / "reorder_risk.csv").first()
    assert plan["risk"] == "Insufficient history" and plan["reorder_quantity"] is None

    before = RunFolder.published(spark, out).run_id
    folders = set(files.names(spark, f"{out}/runs"))
    for broken in ("2024-01-01,1,A,-1,0", ROWS[1]):
        raw_folder(tmp_path, [broken, *ROWS[1:]])
        with pytest.raises(DataValidationError):
            run_job(spark, "auto", data, out)
    published = RunFolder.published(spark, out)
    assert published.run_id == before
    assert set(files.names(spark, f"{out}/runs")) == folders  # failed runs leave nothing
    assert value(published.read("gold", "daily_sales").agg(F.sum("sales"))) == 90


PARTS = {
    "part-0.csv": "date,store_nbr,family,sales,onpromotion\n2024-01-01,1,A,5,0\n",
    "part-1.csv": "date,store_nbr,family,onpromotion,sales\n2024-01-02,1,A,3,700\n",
}


def layers_of(spark, tmp_path):
    run = RunFolder.create(spark, str(tmp_path / "out"))
    try:
        return csv_tables.load_layers(spark, "raw", str(tmp_path / "data"), run), run
    finally:
        run.close()


def test_parts_are_read_by_column_name(spark, tmp_path):
    folder = tmp_path / "data" / "raw" / "train.csv"
    folder.mkdir(parents=True)
    for name, text in PARTS.items():
        (folder / name).write_text(text)
    (folder / "part-2.csv").write_text("")
    (folder / "part-3.csv").write_text("family,date,sales,store_nbr\nA,2024-01-03,0,1\n")
    run = RunFolder.create(spark, str(tmp_path / "out"))
    landed = csv_tables.land_bronze(spark, str(folder), "sales", run)
    rows = {str(r["date"]): (r["sales"], r["onpromotion"]) for r in landed.collect()}
    assert {k[:10]: v for k, v in rows.items()} == {"2024-01-01": ("5", "0"), "2024-01-02": ("700", "3"), "2024-01-03": ("0", None)}
    (folder / "part-3.csv").unlink()
    report = run_job(spark, "raw", str(tmp_path / "data"), str(tmp_path / "out"))
    assert report["kpis"]["total_sales"] == 705 and report["kpis"]["promoted_sales"] == 700


def test_headers_that_differ_by_case_and_odd_names(spark, tmp_path):
    raw = raw_folder(tmp_path, ["2024-01-01,1,A,10,7,x,y"], "date,store_nbr,family,sales,Sales,a`b,a.b")
    (raw / "stores.csv").write_text("store_nbr,na`me\n1,NA\n")
    layers, run = layers_of(spark, tmp_path)
    row = run.read("silver", "sales").first()
    assert (row["sales"], row["Sales.1"], row["a`b"], row["a.b"]) == (10.0, "7", "x", "y")
    assert run.read("silver", "stores").first()["na`me"] is None
    assert not [w for w in layers.warnings if "stores" in w]


def test_context_fields_may_hold_line_breaks(spark, tmp_path):
    raw = raw_folder(tmp_path, ROWS)
    columns = "date,type,locale,locale_name,description,transferred"
    (raw / "holidays_events.csv").write_text(f'{columns}\n2024-01-01,Holiday,National,X,"New\nyear, first",False\n')
    layers, run = layers_of(spark, tmp_path)
    assert run.read("silver", "holidays_events").first()["description"] == "New\nyear, first"


def test_numbers_are_written_without_exponents(spark, tmp_path):
    values = [370370347.5, 1e7, 1.5e-5, 0.1, 123.0, 1e22, -2.5e8, None, 12345678.9, 1e300]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double").coalesce(1)
    write_csv(frame, str(tmp_path / "x.csv"))
    texts = {int(r["i"]): r["x"] for r in read_csv(spark, tmp_path / "x.csv").collect()}
    assert [texts[i] for i in (0, 1, 2, 3, 4, 6, 8)] == [
        "370370347.5", "10000000.0", "0.000015", "0.1", "123.0", "-250000000.0", "12345678.9"]
    assert texts[5] == "1" + "0" * 22 and texts[7] is None
    assert all(float(texts[i]) == v for i, v in enumerate(values) if v is not None)


def test_superseded_runs_can_be_removed(spark, tmp_path):
    raw_folder(tmp_path, ROWS)
    out = str(tmp_path / "out")
    for _ in range(3):
        run_job(spark, "raw", str(tmp_path / "data"), out)
    names = sorted(files.names(spark, f"{out}/runs"))
    assert prune_runs(spark, out, keep=1) == names[:2]
    assert files.names(spark, f"{out}/runs") == [RunFolder.published(spark, out).run_id]


def test_silver_keeps_extra_columns_and_normalises(spark, tmp_path):
    raw_folder(
        tmp_path,
        ['7,2024-1-1,1.0," A, B ",10,0,"say ""hi"""', "8,2024-01-02,1,C ,1e1,2,NULL"],
        "id,date,store_nbr,family,sales,onpromotion,a.note",
    )
    run = RunFolder.create(spark, str(tmp_path / "out"))
    try:
        layers = csv_tables.load_layers(spark, "auto", str(tmp_path / "data"), run)
        rows = layers.silver["sales"].orderBy("date").collect()
        assert [r["family"] for r in rows] == ["A, B", "C"]
        assert [r["a.note"] for r in rows] == ['say "hi"', None]
        assert [r["store_nbr"] for r in rows] == [1, 1] and [r["sales"] for r in rows] == [10.0, 10.0]
        assert [r["a.note"] for r in layers.bronze["sales"].orderBy("id").collect()] == ['say "hi"', "NULL"]
    finally:
        run.close()


def test_source_selection(spark, tmp_path):
    data = str(tmp_path / "data")
    with pytest.raises(ValueError, match="auto, raw, or sample"):
        csv_tables.select_source(spark, "other", data)
    assert csv_tables.select_source(spark, "auto", data) == "sample"
    raw_folder(tmp_path, ROWS)
    assert csv_tables.select_source(spark, "auto", data) == "raw"
    with pytest.raises(FileNotFoundError, match="sample/train.csv"):
        run_job(spark, "sample", data, str(tmp_path / "out"))


@pytest.mark.parametrize("content,error", [
    ("", csv_tables.SourceParseError), ("date,store_nbr,family,sales\n", DataValidationError),
    ("date,store_nbr,family,sales\n2024-01-01,1,A,1,5\n", csv_tables.SourceParseError)])
def test_unusable_demand_file(spark, tmp_path, content, error):
    raw = raw_folder(tmp_path, [])
    (raw / "train.csv").write_text(content)
    with pytest.raises(error):
        run_job(spark, "raw", str(tmp_path / "data"), str(tmp_path / "out"))


def test_arguments():
    args = parse_arguments(["--source", "raw", "--window", "14", "--z-score", "2"])
    assert (args.source, args.window, args.lead_time, args.review_days, args.z_score) == ("raw", 14, 7, 7, 2.0)
