"""The batch job: source CSVs to a published run. Submit with ``spark-submit`` or ``python -m``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession, functions as F

from shelfcast.config import PlanningConfig
from shelfcast.operators import advice, forecast, marts, planning, quality, report
from shelfcast.schemas import CSV_ORDER, GOLD_COLUMNS, MONTH
from shelfcast.session import build_session, drop_tables, sized_shuffles
from shelfcast.sources import files
from shelfcast.sources.csv_tables import Layers, find_sales, load_layers
from shelfcast.sources.runs import RunFolder

REPORT_FILE = "quality_report.json"


def run_job(
    spark: SparkSession,
    source: str = "auto",
    data_dir: str = "data",
    output_dir: str = "output",
    config: PlanningConfig | None = None,
    csv: str = "folders",
) -> dict:
    """Build and publish one run; returns its report. Any error leaves the last run published
    and removes the folder of the failed one. ``csv`` is "folders" of parts, or "files": one
    ordered file per mart, where the store can join files."""
    config = config or PlanningConfig()
    _, sales_path = find_sales(spark, source, data_dir)
    run = RunFolder.create(spark, output_dir)
    try:
        with sized_shuffles(spark, files.size_in_bytes(spark, sales_path)):
            layers = load_layers(spark, source, data_dir, run)
            published = build_gold(layers, config, run, csv)
        run.publish()
        return published
    except BaseException:
        run.remove()
        raise
    finally:
        run.close()
        drop_tables(spark)


def build_gold(layers: Layers, config: PlanningConfig, run: RunFolder, csv: str = "folders") -> dict:
    sales = layers.silver["sales"]
    daily = marts.daily_sales(sales)
    # Two small day-level tables carry the fact into all store, family and total figures.
    by_store_day = run.write("work", "store_days", marts.store_days(daily))
    by_family_day = run.write("work", "family_days", marts.family_days(daily))
    gold = {
        "daily_sales": daily.withColumn(MONTH, F.date_format("date", "yyyy-MM")),
        "weekly_sales": marts.weekly_sales(daily),
        "store_performance": marts.store_performance(by_store_day),
        "family_performance": marts.family_performance(by_family_day),
        "promotion_impact": marts.promotion_impact(by_family_day),
        "demand_volatility": marts.demand_volatility(by_family_day),
    }
    totals = {name: quality.mart_totals(name) for name in gold}
    totals["daily_sales"]["newest"] = F.max("date")
    stored = {
        name: run.write("gold", name, df, MONTH if name == "daily_sales" else None, totals[name])
        for name, df in gold.items()
    }
    newest = run.totals["daily_sales"].pop("newest")
    quality.check_totals(run.totals)
    # Stored, so that sampling the range bounds of the series order does not rescan the fact.
    forecasts = run.write("work", "forecast", forecast.forecast_demand(sales, config, stored["weekly_sales"], newest))
    plan = planning.plan_inventory(forecasts, config, layers.silver.get("inventory"))
    stored["reorder_risk"] = run.write("gold", "reorder_risk", plan)
    quality.check_orphans(stored["reorder_risk"], stored["weekly_sales"])
    # Files of a stored table are read in any order, so the ordering columns are stored too.
    ranked = run.write(
        "work", "suggestions",
        advice.ranked_suggestions(
            stored["reorder_risk"], stored["store_performance"], stored["promotion_impact"]
        ),
    )
    stored["recommendations"] = advice.in_review_order(ranked)
    run.write("gold", "recommendations", stored["recommendations"])
    totals = marts.run_totals(by_store_day, by_family_day)
    metadata = run.write(
        "gold", "run_metadata",
        report.run_report(
            by_family_day, stored["reorder_risk"], totals, config, layers.selected, layers.warnings
        ),
    )
    for name in GOLD_COLUMNS:
        run.write_csv(name, stored[name].select(*GOLD_COLUMNS[name]), CSV_ORDER[name] if csv == "files" else None)
    result = json.loads(metadata.first()["report_json"])
    files.write_text(run.spark, f"{run.root}/{REPORT_FILE}", json.dumps(result, indent=2))
    return result


def parse_arguments(arguments: list[str] | None = None) -> argparse.Namespace:
    defaults = PlanningConfig()
    parser = argparse.ArgumentParser(description="Build and publish the demand and planning marts")
    parser.add_argument("--source", choices=("auto", "raw", "sample"), default="auto")
    parser.add_argument("--window", type=int, default=defaults.window_days)
    parser.add_argument("--lead-time", type=int, default=defaults.lead_time_days)
    parser.add_argument("--review-days", type=int, default=defaults.review_days)
    parser.add_argument("--z-score", type=float, default=defaults.z_score)
    parser.add_argument("--data-dir", default="data")
    parser.add_argument("--output-dir", default="output")
    parser.add_argument("--csv", choices=("folders", "files"), default="folders", help="one ordered file per mart, or parts")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    args = parse_arguments(arguments)
    config = PlanningConfig(args.window, args.lead_time, args.review_days, args.z_score)
    spark = build_session("shelfcast-batch")
    print(json.dumps(run_job(spark, args.source, args.data_dir, args.output_dir, config, args.csv), indent=2))


if __name__ == "__main__":
    main()
