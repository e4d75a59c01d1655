"""Run folders: every run writes its layers to a fresh folder and is published by a manifest.

Layout below the output folder::

    CURRENT/<version>            manifest of a published run; the highest whole one counts
    runs/<run>/bronze/<table>    source tables as read, all text
    runs/<run>/silver/<table>    validated, typed tables
    runs/<run>/gold/<table>      marts, plan, recommendations, run metadata
    runs/<run>/work/<table>      day-level sums, forecast and ordered suggestions behind Gold
    runs/<run>/csv/<table>.csv   the published marts as CSV
    runs/<run>/quality_report.json

A manifest is created only if its version is free, which file systems and object stores decide
in one step; nothing is renamed or overwritten. A run takes the version after the one it began
with: of two runs at once the second one to finish fails, and readers see whole runs only.
"""

from __future__ import annotations

import csv
import datetime
import io
import json
import math
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from shelfcast.schemas import GOLD_COLUMNS
from shelfcast.sources import files

VERSIONS = "CURRENT"

# A bucket of the fact should be about one scan split. Spark refuses more buckets than its
# setting spark.sql.sources.bucketing.maxBuckets, which a very large run has to raise.
BUCKET_BYTES = 256 * 1024 * 1024


class PublishConflictError(RuntimeError):
    """Another run was published since this one began."""


def versions(spark: SparkSession, output_dir: str) -> list[int]:
    """Version numbers in ascending order, those of unfinished manifests included."""
    folder = f"{output_dir.rstrip('/')}/{VERSIONS}"
    if not files.exists(spark, folder):
        return []
    return sorted(int(name) for name in files.names(spark, folder) if name.isdigit())


def read_manifest(spark: SparkSession, output_dir: str, version: int) -> dict | None:
    """The manifest of a version; None if its writer has not finished, or never did."""
    text = files.read_text(spark, f"{output_dir.rstrip('/')}/{VERSIONS}/{version:020d}")
    try:
        return json.loads(text)
    except ValueError:
        return None


def newest_manifest(spark: SparkSession, output_dir: str) -> dict:
    """The highest whole manifest of a folder."""
    for version in reversed(versions(spark, output_dir)):
        manifest = read_manifest(spark, output_dir, version)
        if manifest is not None:
            return manifest
    raise FileNotFoundError(f"Missing {output_dir.rstrip('/')}/{VERSIONS}. Run the job first.")


def create_manifest(spark: SparkSession, output_dir: str, version: int, content: Mapping) -> bool:
    """Take a version; False if it is taken."""
    path = f"{output_dir.rstrip('/')}/{VERSIONS}/{version:020d}"
    return files.create_new(spark, path, json.dumps({"version": version, **content}) + "\n")


class RunFolder:
    def __init__(self, spark: SparkSession, output_dir: str, run_id: str):
        self.spark = spark
        self.output_dir = output_dir.rstrip("/")
        self.run_id = run_id
        self.version = max(versions(spark, output_dir), default=0) + 1  # that this run may take
        self.totals: dict[str, dict] = {}  # by table, as gathered while it was written
        self._tables: list[str] = []

    @classmethod
    def create(cls, spark: SparkSession, output_dir: str) -> "RunFolder":
        now = datetime.datetime.now(datetime.timezone.utc)
        return cls(spark, output_dir, f"{now:%Y%m%dT%H%M%S}_{uuid.uuid4().hex[:8]}")

    @classmethod
    def published(cls, spark: SparkSession, output_dir: str) -> "RunFolder":
        return cls(spark, output_dir, newest_manifest(spark, output_dir)["run"])

    @property
    def root(self) -> str:
        return f"{self.output_dir}/runs/{self.run_id}"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        path = self.path(layer, table)
        if not files.exists(self.spark, path):
            raise FileNotFoundError(f"Missing {path}. Run the job first.")
        return self.spark.read.parquet(path)

    def write(
        self, layer: str, table: str, df: DataFrame, partition_by: str | None = None,
        totals: Mapping[str, Column] | None = None,
    ) -> DataFrame:
        """Write a table and return it as read from storage, so later steps start there.

        ``totals`` are aggregates of the written rows, gathered by the tasks that write them and
        kept in ``self.totals``. A task that is run twice counts once.
        """
        path = self.path(layer, table)
        observed = Observation() if totals else None
        rows = df.observe(observed, *[c.alias(n) for n, c in totals.items()]) if totals else df
        writer = rows.write.partitionBy(partition_by) if partition_by else rows.write
        writer.parquet(path)
        if observed:
            self.totals[table] = dict(observed.get)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_bucketed(
        self, layer: str, table: str, df: DataFrame, keys: Sequence[str], order: Sequence[str],
        source_bytes: int,
    ) -> DataFrame:
        """Write a table bucketed by its keys: one shuffle now instead of one per grouping.

        Every later aggregate whose keys include the bucket keys runs without a shuffle
        within this job. The rows of a file are in ``order``; with a date first, a date
        filter skips the row groups and pages outside it.
        """
        parallelism = self.spark.sparkContext.defaultParallelism
        shuffle = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(math.ceil(source_bytes / BUCKET_BYTES), min(parallelism, shuffle))
        name = f"shelfcast_{layer}_{table}_{self.run_id}".lower()
        (
            df.repartition(buckets, *keys)  # same hash as the buckets: one file per bucket
            .write.bucketBy(buckets, *keys)
            .sortBy(*order)
            .option("path", self.path(layer, table))
            .saveAsTable(name)
        )
        self._tables.append(name)
        return self.spark.table(name)

    def write_csv(self, table: str, df: DataFrame, order: Sequence[str] | None = None) -> None:
        """A folder of parts, or with ``order`` (which may be empty) one file in that order."""
        path = f"{self.root}/csv/{table}.csv"
        if order is None:
            write_csv(df, path)
        else:
            write_csv_file(df, path, order)

    def discard(self, layer: str, table: str) -> None:
        """Drop a table of this unpublished run that failed its checks."""
        files.delete(self.spark, self.path(layer, table))

    def publish(self) -> None:
        """Make this run the published one, unless another was published since it began."""
        layers = sorted(files.names(self.spark, self.root)) if files.exists(self.spark, self.root) else []
        if not create_manifest(self.spark, self.output_dir, self.version, {"run": self.run_id, "layers": layers}):
            raise PublishConflictError(
                f"Run {self.run_id} was not published: version {self.version} was taken by another run "
                "since it began. Run the job again."
            )

    def remove(self) -> None:
        """Delete the whole folder of a run that failed."""
        files.delete(self.spark, self.root)

    def close(self) -> None:
        """Forget the session's table names; the files stay."""
        while self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop()}")


def prune_runs(spark: SparkSession, output_dir: str, keep: int = 3) -> list[str]:
    """Delete superseded run folders but the newest ``keep``; the published one always stays, as do
    the manifests. Call it when no reader of an older run is left. Returns the names deleted."""
    current = RunFolder.published(spark, output_dir).run_id
    root = f"{output_dir.rstrip('/')}/runs"
    names = sorted(files.names(spark, root))
    old = [n for n in names[: max(len(names) - keep, 0)] if n != current]
    for name in old:
        files.delete(spark, f"{root}/{name}")
    return old


def register_views(spark: SparkSession, output_dir: str) -> list[str]:
    """Temporary views of the published run, so that plain SQL runs on its marts."""
    run = RunFolder.published(spark, output_dir)
    for name in (*GOLD_COLUMNS, "run_metadata"):
        run.read("gold", name).createOrReplaceTempView(name)
    return [*GOLD_COLUMNS, "run_metadata"]


def plain_number(value: Column) -> Column:
    """A double as decimal text without an exponent, as far as 38 digits reach."""
    text = value.cast("string")
    digits = F.coalesce(text.try_cast("decimal(38,18)").cast("string"), text.try_cast("decimal(38,0)").cast("string"))
    short = F.regexp_replace(F.regexp_replace(digits, r"(\.\d*?)0+$", "$1"), r"\.$", ".0")
    return F.when(text.contains("E"), F.coalesce(short, text)).otherwise(text)


def _csv_texts(df: DataFrame) -> DataFrame:
    """Flags as True and False, numbers without an exponent."""
    texts = {
        name: F.when(F.col(name), F.lit("True")).when(~F.col(name), F.lit("False"))
        if dtype == "boolean" else plain_number(F.col(name))
        for name, dtype in df.dtypes
        if dtype in ("boolean", "double")
    }
    return df.withColumns(texts)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV folder with a header in every part."""
    _csv_texts(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def _header_line(columns: Sequence[str]) -> str:
    line = io.StringIO()
    csv.writer(line, lineterminator="\n").writerow(columns)
    return line.getvalue()


def _part_number(path: str) -> tuple[int, str]:
    name = path.rpartition("/")[2]
    return int(name.split("-")[1]), name


def write_csv_file(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """One CSV file with one header line, its rows in ``order``, or in the DataFrame's own order
    without one. Rows are sorted and written in parts by all tasks; the file system joins the
    parts behind the header. An earlier file or folder of the name stays until the new one is whole."""
    spark = df.sparkSession
    folder, _, name = path.rpartition("/")
    staged = f"{folder}/_parts_{name}_{uuid.uuid4().hex}"
    try:
        # Parts are numbered as the sorted ranges are; an order by texts would not be the columns' order.
        rows = _csv_texts(df.orderBy(*order) if order else df)
        rows.write.option("header", False).option("escape", '"').csv(staged)
        header = f"{staged}/header"
        parts = sorted(files.data_files(spark, staged), key=_part_number)
        files.write_text(spark, header, _header_line(df.columns))
        files.concatenate(spark, [header, *parts])
        files.replace(spark, header, path)
    finally:
        files.delete(spark, staged)
