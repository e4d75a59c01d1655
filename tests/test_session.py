"""Written tables and the checkpoint folder."""

import os

import pytest

from shelfcast import session


def test_written_table_keeps_rows_and_schema(spark):
    rows = spark.createDataFrame(
        [(1, "a", 0.1, None), (2, "b", None, True)], "id long, name string, x double, flag boolean")
    stored = session.cut_lineage(rows)
    assert stored.schema == rows.schema
    assert sorted(stored.collect()) == sorted(rows.collect())
    assert "FileScan parquet" in stored._jdf.queryExecution().executedPlan().toString()
    assert session.cut_lineage(rows.limit(0)).count() == 0


class ClusterContext:
    master = "yarn"

    def __init__(self):
        self.checkpoint_dir = None

    def getCheckpointDir(self):
        return self.checkpoint_dir

    def setCheckpointDir(self, path):
        self.checkpoint_dir = path


class ClusterSession:
    def __init__(self, settings):
        self.sparkContext = ClusterContext()
        self.conf = settings


def test_a_cluster_must_name_a_shared_checkpoint_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(ClusterSession({}))
    named = ClusterSession({"spark.checkpoint.dir": "hdfs:///shared"})
    session.ensure_checkpoint_dir(named)
    assert named.sparkContext.checkpoint_dir == "hdfs:///shared"


def test_shuffle_partitions_follow_the_input(spark, monkeypatch):
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 10)
    setting = "spark.sql.shuffle.partitions"
    before = int(spark.conf.get(setting))
    with session.sized_shuffles(spark, 10 * before + 1):
        assert int(spark.conf.get(setting)) == before + 1
    assert int(spark.conf.get(setting)) == before
    with pytest.raises(KeyError), session.sized_shuffles(spark, 10_000):
        raise KeyError
    assert int(spark.conf.get(setting)) == before
    with session.sized_shuffles(spark, 1):
        assert int(spark.conf.get(setting)) == before


def test_a_machine_local_folder_is_refused_on_a_cluster():
    for conf, context in (({"spark.checkpoint.dir": "file:/tmp/x"}, None), ({}, "file:///scratch")):
        cluster = ClusterSession(conf)
        cluster.sparkContext.checkpoint_dir = context
        with pytest.raises(RuntimeError, match="all executors share"):
            session.ensure_checkpoint_dir(cluster)
    shared = ClusterSession({"spark.checkpoint.dir": "hdfs://shared/x"})
    assert session.ensure_checkpoint_dir(shared) == "hdfs://shared/x"


def test_written_tables_can_be_dropped(spark):
    session.cut_lineage(spark.range(3))
    folder = session._table_folder(spark).removeprefix("file:")
    assert os.listdir(folder)
    session.drop_tables(spark)
    assert not os.path.exists(folder)
    assert session.cut_lineage(spark.range(3)).count() == 3


def test_a_shared_file_folder_serves_a_cluster(spark, monkeypatch):
    # Every task reaches this folder, as on a mount that all machines have.
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    assert session.ensure_checkpoint_dir(spark).startswith("file:")
    for _ in range(2):
        assert session.cut_lineage(spark.range(3)).count() == 3


def test_a_cluster_without_a_checkpoint_folder_uses_the_warehouse():
    named = ClusterSession({"spark.sql.warehouse.dir": "hdfs://shared/warehouse"})
    assert session.ensure_checkpoint_dir(named) == "hdfs://shared/warehouse/_checkpoints"


def test_a_folder_that_loses_rows_of_tasks_is_refused(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(session, "_shared", set())
    writer = type(spark.range(1).write)
    whole = writer.parquet

    def some(self, path):
        whole(self._df.where("id > 0").write, path)

    monkeypatch.setattr(writer, "parquet", some)
    with pytest.raises(RuntimeError, match="all executors share"):
        session.ensure_checkpoint_dir(spark)


def test_a_bare_path_that_tasks_cannot_share_is_refused_at_once():
    # Spark makes it a file: path, as it does with the folder named when the session starts.
    class Context(ClusterContext):
        def setCheckpointDir(self, path):
            self.checkpoint_dir = f"file:{path}"

    cluster = ClusterSession({"spark.checkpoint.dir": "/scratch/x"})
    cluster.sparkContext = Context()
    with pytest.raises(RuntimeError, match="all executors share"):
        session.ensure_checkpoint_dir(cluster)
