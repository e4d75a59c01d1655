"""Session helpers: settings the jobs rely on, and the shared checkpoint folder."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.sources import files

# Input bytes that one shuffle partition should stand for; small ones are merged at run time.
SHUFFLE_BYTES = 512 * 1024 * 1024

# Settings of a submitted job where the submitter names none.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str) -> SparkSession:
    """Session for a submitted job; settings given on submit take precedence."""
    given = SparkConf()
    builder = SparkSession.builder.appName(app_name)
    for key, value in DEFAULTS.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def sized_shuffles(spark: SparkSession, source_bytes: int) -> Iterator[None]:
    """Raise the shuffle partition count to suit the input for the time of a job."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    wanted = math.ceil(source_bytes / SHUFFLE_BYTES)
    if wanted <= int(before):
        yield
        return
    spark.conf.set(key, str(wanted))
    try:
        yield
    finally:
        spark.conf.set(key, before)


_REFUSED = "set spark.checkpoint.dir to a folder that all executors share"
_shared: set[tuple[str, str]] = set()  # applications and folders whose trial has passed


def _ensure_shared(spark: SparkSession, folder: str) -> None:
    """Refuse a ``file:`` folder unless all tasks of a trial write reach it and are read back: it
    may be a mount that driver and executors share, or a disk of each machine. Tried once."""
    try:
        key = (spark.sparkContext.applicationId, folder)
        if key in _shared:
            return
        path, n = f"{folder.rstrip('/')}/trial-{uuid.uuid4().hex}", 2 * spark.sparkContext.defaultParallelism
        rows = spark.range(0, n, 1, n)
        rows.write.parquet(path)
        found = spark.read.schema(rows.schema).parquet(path).agg(F.count("id"), F.sum("id")).first()
        files.delete(spark, path)
    except Exception as error:
        raise RuntimeError(_REFUSED) from error
    if tuple(found) != (n, n * (n - 1) // 2):
        raise RuntimeError(_REFUSED)
    _shared.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, or else a folder in the warehouse. A cluster
    needs one that all executors share: a ``file:`` one is tried there, and refused if it is not."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder and (warehouse := spark.conf.get("spark.sql.warehouse.dir", None)):
        folder = f"{warehouse.rstrip('/')}/_checkpoints"
    if not folder:
        raise RuntimeError(_REFUSED)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    folder = sc.getCheckpointDir()  # with the scheme that a bare path stands for
    if folder.startswith("file:") and not sc.master.startswith("local"):
        _ensure_shared(spark, folder)
    return folder


def _table_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables-{spark.sparkContext.applicationId}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows as a table in the shared checkpoint folder and continue from there.

    A plain table rather than ``checkpoint()``: later reads still prune columns, and Spark
    knows the size when it picks a join. Nothing upstream is recomputed if an executor is lost.
    ``drop_tables`` removes what an application has written.
    """
    spark = df.sparkSession
    path = f"{_table_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession) -> str:
    """A folder of its own beside the tables of ``cut_lineage``, removed with them."""
    return f"{_table_folder(spark)}/{uuid.uuid4().hex}"


def drop_tables(spark: SparkSession) -> None:
    """Delete the tables of ``cut_lineage``; call it when no result is read from them any more."""
    files.delete(spark, _table_folder(spark))
