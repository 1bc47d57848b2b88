"""Sinks and the catalog job."""

from __future__ import annotations

import uuid

import pytest
from tables import rows
from pyspark.sql import functions as F

from waymill import storage
from waymill.plans import profile_and_publish
from waymill.registry import QUERIES
from waymill.sinks import append_if_any, append_parquet, export_csv, overwrite_parquet, publish_table, write_partitions
from waymill.sources import catalog_table, read_state


def files(path):
    return len(list(path.glob("part-*.parquet")))


def test_compact_append_adds_one_file_for_a_small_batch(spark, tmp_path):
    batch = spark.range(0, 1000, 1, 7)
    append_parquet(batch, str(tmp_path / "t"))
    before = files(tmp_path / "t")
    append_parquet(batch, str(tmp_path / "t"), compact=True)
    assert files(tmp_path / "t") == before + 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2000


def test_compact_write_of_a_large_batch_stays_parallel(spark, tmp_path, settings):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="100k", spark__sql__adaptive__coalescePartitions__minPartitionSize="10k")
    overwrite_parquet(spark.range(200_000).withColumn("t", F.sha2(F.col("id").cast("string"), 256)), str(tmp_path / "t"), compact=True)
    assert files(tmp_path / "t") > 4


def test_empty_batch_is_not_written(spark, tmp_path):
    assert not append_if_any(spark.range(0), str(tmp_path / "t"))
    assert read_state(spark, str(tmp_path / "t")) is None
    assert append_if_any(spark.range(3), str(tmp_path / "t"))
    assert not append_if_any(spark.range(0), str(tmp_path / "t"))
    assert read_state(spark, str(tmp_path / "t")).count() == 3


def test_csv_export(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", None, "b"], "x,y"), (2, [None], None)], "id INT, names ARRAY<STRING>, t STRING")
    export_csv(df, str(tmp_path / "csv"), ["names"])
    export_csv(df, str(tmp_path / "csv"), ["names"], mode="append")
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == ["id", "names", "t"]
    assert rows(back, "id", "t") == [("1", "x,y")] * 2 + [("2", None)] * 2
    assert rows(back.filter("id = 1"), "names") == [("a,b",)] * 2


def test_profile_and_publish(spark, tmp_path):
    source, target = (f"t_{uuid.uuid4().hex}" for _ in range(2))
    nation = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    nation.write.option("path", str(tmp_path / "source")).saveAsTable(source)
    try:
        profile = profile_and_publish(spark, source, target, str(tmp_path / "target"))
        assert rows(profile, "column_name", "n_rows", "n_null", "n_distinct") == [
            ("n_name", 25, 0, 25), ("n_nationkey", 25, 0, 25), ("n_regionkey", 25, 0, 5)]
        assert rows(catalog_table(spark, target)) == rows(nation)
        assert list((tmp_path / "target").glob("*.snappy.parquet"))
        profile_and_publish(spark, source, target, str(tmp_path / "target"), mode="append")
        assert catalog_table(spark, target).count() == 50
    finally:
        for name in (source, target):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.mark.parametrize("external", [False, True])
def test_a_failed_replacement_leaves_the_old_table(spark, tmp_path, external):
    name, path = f"t_{uuid.uuid4().hex}", str(tmp_path / "table") if external else None
    try:
        publish_table(spark.range(10), name, path, "overwrite")
        broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
        with pytest.raises(Exception, match="broken"):
            publish_table(broken, name, path, "overwrite")
        assert catalog_table(spark, name).count() == 10
        reader = catalog_table(spark, name)
        publish_table(spark.range(3), name, path, "overwrite")
        # Who has begun to read sees the old rows, who begins now the new ones.
        assert (reader.count(), catalog_table(spark, name).count()) == (10, 3)
        publish_table(spark.range(4), name, path, "append")
        publish_table(catalog_table(spark, name).filter("id > 0"), name, path, "overwrite")
        assert rows(catalog_table(spark, name)) == [(1,), (1,), (2,), (2,), (3,)]
        if external:
            # The table's folder and the one before it; what a failed write has left is gone, too.
            assert len([f for f in tmp_path.iterdir() if f.name.startswith("table")]) == 2
        with pytest.raises(ValueError, match="columns"):
            publish_table(spark.range(3).withColumn("x", F.lit(1)), name, path, "overwrite")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_partitions_get_few_files_and_large_ones_several(spark, tmp_path, settings):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="200k", spark__sql__adaptive__coalescePartitions__minPartitionSize="20k")
    df = spark.range(0, 60_000, 1, 16).select(
        F.when(F.col("id") % 4 > 0, "large").otherwise(F.concat(F.lit("p"), (F.col("id") % 7).cast("string"))).alias("part"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    write_partitions(df, str(tmp_path / "t"), ["part"], "parquet")
    counts = {p.name: len(list(p.glob("part-*.parquet"))) for p in (tmp_path / "t").glob("part=*")}
    # Sixteen tasks would have written sixteen files each way.
    assert counts.pop("part=large") > 4 and max(counts.values()) <= 2
    sizes = [f.stat().st_size for f in (tmp_path / "t").glob("part=large/*.parquet")]
    assert max(sizes) < 2_000_000
    write_partitions(df.filter("part = 'p1'").limit(5), str(tmp_path / "t"), ["part"], "parquet")
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.filter("part = 'p1'").count() == 5 and back.filter("part = 'large'").count() == 45_000


def test_shared_folder(spark, monkeypatch):
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default):
            assert key == "spark.checkpoint.dir"
            return self.value

    class Session:
        def __init__(self, value, master):
            self.conf = Conf(value)
            self.sparkContext = type("Context", (), {"master": master})

    assert storage.shared_root(Session("s3://bucket/work/", "yarn")) == "s3://bucket/work"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_root(Session(None, "yarn"))
    assert storage.shared_root(Session(None, "local[2]")) == storage.shared_root(Session(None, "local[4]"))


def as_cluster(spark, monkeypatch, folder):
    """A session that runs here and is told apart from a cluster's by nothing that the library looks at."""
    get = type(spark.conf).get
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *default: folder if key == "spark.checkpoint.dir" else get(self, key, *default))
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(storage, "_session_folders", {})


@pytest.mark.parametrize("kind", ["none", "path", "checkpoints"])
@pytest.mark.parametrize("name", ["incremental_first_run", "csv_export_roundtrip", "catalog_publish"])
def test_queries_run_on_a_cluster_without_a_folder_set_with_its_scheme(spark, tmp_path, monkeypatch, name, kind):
    as_cluster(spark, monkeypatch, str(tmp_path / "shared") if kind == "path" else None)
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: str(tmp_path / "own") if kind == "checkpoints" else None)
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() in (1000, 1500)
    assert [p.is_dir() for p in tmp_path.glob("*/waymill")] == ([] if kind == "none" else [True])


def test_a_folder_of_each_machine_is_refused(spark, tmp_path, monkeypatch):
    """What tasks write is lost here, as it is for a driver on another machine."""
    as_cluster(spark, monkeypatch, str(tmp_path / "own"))
    write = type(spark.range(1).write).parquet
    monkeypatch.setattr(type(spark.range(1).write), "parquet", lambda self, path: write(self, f"{path}-elsewhere"))
    with pytest.raises(ValueError, match="set spark.checkpoint.dir"):
        storage.new_folder(spark, "x")


def test_the_local_folder_has_its_scheme():
    """Paths without one belong to the default file system, which may be another."""
    assert storage.shared_root(type("Session", (), {"conf": type("Conf", (), {"get": lambda *_: None})(), "sparkContext": type("C", (), {"master": "local"})})).startswith("file:///")


def shuffled(spark):
    """Shuffle files of this machine."""
    kept = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {kept.apply(i).getName() for i in range(kept.length()) if kept.apply(i).getName().startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark, tmp_path, settings):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    dealt, before = spark.range(1000).repartition(4, "id").groupBy("id").count(), shuffled(spark)
    stored = storage.materialize(dealt, str(tmp_path / "t"))
    assert not shuffled(spark) - before and stored.count() == 1000
    assert spark.conf.get(key, None) is None
    # What is stored can be computed again, and a session's own choice holds.
    assert storage.materialize(dealt, str(tmp_path / "again")).count() == 1000
    settings(**{key.replace(".", "__"): "false"})
    storage.materialize(dealt, str(tmp_path / "kept"))
    assert shuffled(spark) - before and spark.conf.get(key) == "false"


def test_passing_folders_go(spark):
    stays = storage.new_folder(spark, "stays")
    with storage.passing_folders(spark):
        passing = storage.materialize(spark.range(3), storage.new_folder(spark, "passing"))
        with storage.passing_folders(spark):
            storage.materialize(passing, inner := storage.new_folder(spark, "inner"))
        assert read_state(spark, inner) is None
        kept = storage.materialize(passing, stays)
    outer = passing.inputFiles()[0].rsplit("/", 1)[0]
    assert read_state(spark, outer) is None and kept.count() == 3
    with pytest.raises(RuntimeError), storage.passing_folders(spark):
        storage.materialize(spark.range(3), broken := storage.new_folder(spark, "broken"))
        raise RuntimeError
    assert read_state(spark, broken) is None
