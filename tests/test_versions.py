"""Versioned tables: whole or not at all, for writers and for readers."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from tallymart.queries import fixture
from tallymart.queries.registry import Tables
from tallymart.session import STEP_SETTINGS, storing_steps
from tallymart.sources import tables, versions
from tallymart.sources.audit import Audit
from tallymart.sources.tables import Layers


def frame(spark, data, schema="id int, y int"):
    return spark.createDataFrame(data, schema)


def failing(spark, after=1000):
    """Rows of which some are written before one raises."""
    return spark.range(0, 4000, 1, 4).select(
        F.when(F.col("id") == 3500, F.raise_error(F.lit("broken row")).cast("int")).otherwise(F.col("id").cast("int")).alias("id"),
        (F.col("id") % 2 + 2018).cast("int").alias("y"),
    )


def test_a_write_that_fails_leaves_the_table(spark, rows, tmp_path):
    root = str(tmp_path / "t")
    versions.write(frame(spark, [(1, 2018), (2, 2019)]), root, partition_by="y")
    for options in ({}, {"only_partitions": True}, {"mode": "append"}):
        with pytest.raises(Exception, match="broken row"):
            versions.write(failing(spark), root, partition_by="y", **options)
        assert rows(versions.read(spark, root)) == [(1, 2018), (2, 2019)]
    assert versions.numbers(spark, root) == [0]


def test_a_reader_keeps_the_version_it_began_with(spark, rows, tmp_path):
    root = str(tmp_path / "t")
    versions.write(frame(spark, [(1, 2018), (2, 2019)]), root, partition_by="y")
    reader = versions.read(spark, root)
    versions.write(frame(spark, [(9, 2018)]), root, partition_by="y", only_partitions=True)
    assert rows(reader) == [(1, 2018), (2, 2019)]
    versions.write(frame(spark, [(7, 2020)]), root, partition_by="y")
    assert rows(reader) == [(1, 2018), (2, 2019)]
    assert rows(versions.read(spark, root)) == [(7, 2020)]
    assert rows(versions.read(spark, root, versions.version(spark, root, 1))) == [(2, 2019), (9, 2018)]


def test_readers_during_writes_see_one_version(spark, tmp_path):
    """Each version's rows all carry its number; no read may mix two."""
    root = str(tmp_path / "t")

    def table(k):
        return spark.range(0, 50, 1, 2).select(F.lit(k).alias("k"), (F.col("id") % 3 + 2018).cast("int").alias("y"))

    versions.write(table(0), root, partition_by="y")
    writer = threading.Thread(target=lambda: [versions.write(table(k), root, partition_by="y") for k in range(1, 6)])
    writer.start()
    seen = []
    while writer.is_alive():
        seen.append([tuple(r) for r in versions.read(spark, root).groupBy("k").count().collect()])
    writer.join()
    seen.append([tuple(r) for r in versions.read(spark, root).groupBy("k").count().collect()])
    assert all(len(s) == 1 and s[0][1] == 50 for s in seen) and seen[-1][0][0] == 5


def test_a_year_replaced_shares_the_other_folders(spark, rows, tmp_path):
    root = str(tmp_path / "t")
    first = versions.write(frame(spark, [(1, 2018), (2, 2019)]), root, partition_by="y")
    second = versions.write(frame(spark, [(3, 2019)]), root, partition_by="y", only_partitions=True)
    assert set(first.folders) & set(second.folders) == {f for f in first.folders if "2018" in f}
    emptied = frame(spark, [])
    versions.write(emptied, root, partition_by="y", only_partitions=True, replaces=[2018, 2025])
    assert rows(versions.read(spark, root)) == [(3, 2019)]
    with pytest.raises(ValueError):
        versions.write(emptied, root, partition_by="y", replaces=[2018])
    with pytest.raises(ValueError, match="partitioned by y"):
        versions.write(emptied, root, mode="append")


def test_append_adds_columns(spark, rows, tmp_path):
    root = str(tmp_path / "t")
    versions.write(frame(spark, [(1, 2018)]), root, partition_by="y")
    versions.write(frame(spark, [(2, "x", 2019)], "id int, z string, y int"), root, mode="append", partition_by="y")
    found = versions.read(spark, root)
    assert found.columns == ["id", "z", "y"] and rows(found) == [(1, None, 2018), (2, "x", 2019)]
    with pytest.raises(ValueError, match="id was int, is string"):
        versions.write(frame(spark, [("a", 2019)], "id string, y int"), root, mode="append", partition_by="y")
    assert versions.read(spark, root, schema=found.select("z").schema).columns == ["z"]


def test_empty_tables(spark, tmp_path):
    for name, key in (("a", None), ("b", "y")):
        root = str(tmp_path / name)
        versions.write(frame(spark, []), root, partition_by=key)
        found = versions.read(spark, root)
        assert found.columns == ["id", "y"] and found.count() == 0
    assert versions.current(spark, str(tmp_path / "none")) is None
    with pytest.raises(FileNotFoundError):
        versions.read(spark, str(tmp_path / "none"))


def test_a_second_writer_gives_up(spark, rows, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    versions.write(frame(spark, [(1, 2018)]), root)
    real, old = versions.current, versions.current(spark, root)
    versions.write(frame(spark, [(2, 2018)]), root)
    monkeypatch.setattr(versions, "current", lambda *_: old)
    with pytest.raises(versions.Conflict):
        versions.write(frame(spark, [(3, 2018)]), root)
    monkeypatch.setattr(versions, "current", real)
    assert rows(versions.read(spark, root)) == [(2, 2018)]
    assert len(versions._all_folders(spark, root)) == 2  # its rows are gone, too


def test_expiry(spark, rows, tmp_path):
    root = str(tmp_path / "t")
    for k in range(4):
        versions.write(frame(spark, [(k, 2018 + k % 2)]), root, partition_by="y", only_partitions=True)
    with pytest.raises(Exception, match="broken row"):
        versions.write(failing(spark), root, partition_by="y", only_partitions=True)
    reader = versions.read(spark, root, versions.version(spark, root, 2))
    assert versions.expire(spark, root, keep=2) == 2
    assert versions.numbers(spark, root) == [2, 3]
    assert rows(reader) == [(1, 2019), (2, 2018)] and rows(versions.read(spark, root)) == [(2, 2018), (3, 2019)]
    assert versions.expire(spark, root, keep=1, abandoned_after=0) == 1
    assert sorted(versions._all_folders(spark, root)) == sorted(versions.current(spark, root).folders)
    assert rows(versions.read(spark, root)) == [(2, 2018), (3, 2019)]
    with pytest.raises(ValueError):
        versions.expire(spark, root, keep=0)


def test_filters_leave_folders_out(spark, plan, tmp_path):
    layers = tables.Layers(spark, str(tmp_path))
    layers.write(frame(spark, [(1, 2018), (2, 2019)]), "gold", "t", partition_by=["y"])
    layers.write(frame(spark, [(3, 2019)]), "gold", "t", partition_by=["y"], mode="append")
    layers.register("pruned")
    for df in (layers.read("gold", "t"), spark.table("pruned_gold.t")):
        chosen = df.filter("y = 2019")
        assert "PartitionFilters: [isnotnull(y" in plan(chosen)
        assert sorted(r.id for r in chosen.collect()) == [2, 3]


def test_a_registered_table_turns_to_new_versions(spark, rows, tmp_path):
    layers, other = tables.Layers(spark, str(tmp_path)), tables.Layers(spark, str(tmp_path))
    for k in range(5):
        layers.write(frame(spark, [(k, 2018)]), "gold", "u")
        layers.register("once") if not k else None
        assert rows(spark.table("once_gold.u")) == [(k, 2018)]
    before = spark.table("once_gold.u")
    other.write(frame(spark, [(7, 2018)], "id int, z int"), "gold", "u")
    assert rows(before) == rows(spark.table("once_gold.u")) == [(4, 2018)]
    assert rows(layers.register("once")) == [("once_gold", "u")]
    assert rows(spark.sql("SELECT id, z FROM once_gold.u")) == [(7, 2018)]
    assert spark.catalog.listTables("once_files")[-1].name == "gold__u__5" and len(spark.catalog.listTables("once_files")) == 2


def test_log_rows_are_written_together_and_merged(spark, tmp_path, monkeypatch):
    layers = tables.Layers(spark, str(tmp_path))
    audit = Audit(layers, "r")
    with pytest.raises(ZeroDivisionError):
        with audit.recording():
            for k in range(5):
                audit.step("s", "gold", f"t{k}", lambda: (1, 1))
            with audit.recording():
                audit.step("s", "gold", "bad", lambda: 1 / 0)
    assert audit.runs().count() == 6 and audit.runs().filter("status = 'ERROR'").count() == 1
    root = layers.path("audit", "pipeline_runs")
    assert len(versions.current(spark, root).folders) == 1
    assert len(versions.read(spark, root).inputFiles()) == 1
    monkeypatch.setattr("tallymart.sources.audit.MERGED_FROM", 2)
    for k in range(3):
        audit.step("s", "gold", f"u{k}", lambda: (1, 1))
    assert len(versions.current(spark, root).folders) <= 2 and audit.runs().count() == 9


def test_stored_files_are_packed_alike(spark, tmp_path):
    df = spark.range(20).withColumn("y", F.lit(1))
    for name, buckets in (("plain", None), ("bucketed", (2, ["id"]))):
        versions.write(df, str(tmp_path / name), partition_by="y", buckets=buckets)
        files = [f.name for f in (tmp_path / name).rglob("*.parquet")]
        assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_what_a_step_shuffled_goes_with_it(spark, tmp_path):
    """Else every step's files stay until the driver collects its garbage."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def left():
        return {n for n in disk.getAllFiles().mkString("\n").splitlines() if "/shuffle_" in n}

    before, key = left(), next(iter(STEP_SETTINGS))
    held = spark.conf.get(key, None)
    with storing_steps(spark):
        assert spark.conf.get(key) == "true"
        versions.write(spark.range(2000).groupBy((F.col("id") % 700).alias("k")).count(), str(tmp_path / "t"))
        for _ in range(50):
            if not left() - before:
                break
            time.sleep(0.2)
        assert not left() - before
    assert spark.conf.get(key, None) == held


def test_loaded_text_goes(spark, tmp_path, monkeypatch):
    orders = [(k, k % 5, "1-URGENT", "O", 1000.5 * k, year) for k, year in enumerate((1995, 1996, 1997, 1997))]
    spark.createDataFrame(
        orders, "o_orderkey long, o_custkey long, o_orderpriority string, o_orderstatus string, o_totalprice double, y int"
    ).withColumn("o_orderdate", F.make_date("y", F.lit(5), F.lit(1))).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(fixture, "scratch_path", lambda spark, label: str(tmp_path / label))
    layers = Layers(spark, str(tmp_path / "lake"))
    fixture.load_survey(Tables(spark, str(tmp_path)), layers, Audit(layers), ["member"])
    assert not (tmp_path / "survey").exists()
    assert layers.read("bronze", "member").count() == 4
