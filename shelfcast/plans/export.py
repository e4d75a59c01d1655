"""Reporting export: the ten CSV datasets of the published run.

``export_set`` writes a set of its own below the export folder and shows it by a manifest, as runs
are published: readers that ask ``exported`` see one whole set, on any storage. ``export_reporting``
keeps fixed names for readers that know only paths: all ten are written aside first and take their
names at the end, one by one, so a failed export leaves the earlier files.

    exports/CURRENT/<version>           manifest of a set, with the bytes of each dataset
    exports/sets/<set>/<dataset>.csv    the set's datasets
    exports/<dataset>.csv               datasets of fixed names
"""

from __future__ import annotations

import argparse
import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfcast.operators import advice, report
from shelfcast.schemas import CSV_ORDER, GOLD_COLUMNS
from shelfcast.session import build_session
from shelfcast.sources import files
from shelfcast.sources.runs import (
    PublishConflictError, RunFolder, create_manifest, newest_manifest, versions, write_csv, write_csv_file,
)


def _datasets(run: RunFolder) -> dict[str, DataFrame]:
    """The eight marts unchanged, then the KPI overview and the quality summary."""
    tables = {name: run.read("gold", name).select(*columns) for name, columns in GOLD_COLUMNS.items()}
    tables["recommendations"] = advice.in_review_order(run.read("work", "suggestions"))
    metadata = run.read("gold", "run_metadata")
    overview = report.overview_kpis(
        tables["family_performance"], tables["store_performance"], tables["reorder_risk"]
    )
    # Four and seven rows whatever the data size, hence one file each.
    tables["overview_kpis"] = overview.coalesce(1)
    tables["quality_summary"] = report.quality_summary(metadata).coalesce(1)
    return tables


def _write_all(
    spark: SparkSession, tables: dict[str, DataFrame], folder: str, single: bool = False
) -> dict[str, int]:
    """Write the datasets into a new folder; returns their bytes. A failure removes the folder."""
    try:
        for name, df in tables.items():
            if single:
                write_csv_file(df, f"{folder}/{name}.csv", CSV_ORDER.get(name, ()))
            else:
                write_csv(df, f"{folder}/{name}.csv")
        return {name: files.size_in_bytes(spark, f"{folder}/{name}.csv") for name in tables}
    except BaseException:
        files.delete(spark, folder)
        raise


def export_reporting(spark: SparkSession, output_dir: str, export_dir: str, single: bool = False) -> list[str]:
    """Write the ten datasets under fixed names; returns their paths. With ``single`` each is one
    ordered file, else a folder of parts."""
    tables = _datasets(RunFolder.published(spark, output_dir))
    root = export_dir.rstrip("/")
    staged = f"{root}/_staged/{uuid.uuid4().hex}"
    _write_all(spark, tables, staged, single)
    paths = [f"{root}/{name}.csv" for name in tables]
    for name, path in zip(tables, paths):
        files.replace(spark, f"{staged}/{name}.csv", path)
    files.delete(spark, staged)
    return paths


def export_set(spark: SparkSession, output_dir: str, export_dir: str, single: bool = False) -> dict[str, str]:
    """Write the ten datasets as a new set and make all of them current at once; returns their
    paths by name. Of two exports at once the second to finish fails and its set is removed."""
    root = export_dir.rstrip("/")
    version = max(versions(spark, root), default=0) + 1
    run = RunFolder.published(spark, output_dir)
    tables = _datasets(run)
    name = f"{datetime.datetime.now(datetime.timezone.utc):%Y%m%dT%H%M%S}_{uuid.uuid4().hex[:8]}"
    folder = f"{root}/sets/{name}"
    sizes = _write_all(spark, tables, folder, single)
    if not create_manifest(spark, root, version, {"set": name, "run": run.run_id, "datasets": sizes}):
        files.delete(spark, folder)
        raise PublishConflictError(
            f"Export set {name} was not published: version {version} was taken by another export "
            "since it began. Run the export again."
        )
    return exported(spark, root)


def exported(spark: SparkSession, export_dir: str) -> dict[str, str]:
    """Paths of the current set by dataset."""
    root = export_dir.rstrip("/")
    manifest = newest_manifest(spark, root)
    return {name: f"{root}/sets/{manifest['set']}/{name}.csv" for name in manifest["datasets"]}


def prune_sets(spark: SparkSession, export_dir: str, keep: int = 2) -> list[str]:
    """Delete superseded sets but the newest ``keep``; the current one always stays, as do the
    manifests. Call it when no reader of an older set, and no export, is left. Returns the names deleted."""
    root = export_dir.rstrip("/")
    current = newest_manifest(spark, root)["set"]
    names = sorted(files.names(spark, f"{root}/sets"))
    old = [n for n in names[: max(len(names) - keep, 0)] if n != current]
    for name in old:
        files.delete(spark, f"{root}/sets/{name}")
    return old


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Export the published run for reporting")
    parser.add_argument("--output-dir", default="output")
    parser.add_argument("--export-dir", default="exports")
    parser.add_argument("--versioned", action="store_true", help="write a set that becomes current at once")
    parser.add_argument("--single-files", action="store_true", help="one ordered file per dataset")
    args = parser.parse_args(arguments)
    spark = build_session("shelfcast-export")
    if args.versioned:
        paths = export_set(spark, args.output_dir, args.export_dir, args.single_files).values()
    else:
        paths = export_reporting(spark, args.output_dir, args.export_dir, args.single_files)
    for path in paths:
        print(path)


if __name__ == "__main__":
    main()
