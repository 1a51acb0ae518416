import io
import re
import threading
import zipfile

import pytest
from pyspark.sql import functions as F

from tallymart.operators import quality
from tallymart.operators.joins import upsert
from tallymart.session import scratch_path, shared_folder
from tallymart.sources import delimited, relational, tables, workbook
from tallymart.sources.audit import Audit
from tallymart.sources.delimited import (
    path_exists, raw_module, read_delimited, resolve, union_years,
)
from tallymart.sources.workbook import read_sheet
from tests.workbooks import MAIN, REL, write_workbook


def put(path, text, bom=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode())
    return str(path)


def test_delimited_bom_crlf_short_and_long_rows(spark, rows, tmp_path):
    path = put(tmp_path / "a.csv", "A;Ñ;C\r\n1;ñ;   \r\n2\r\n3;x;y;z\r\n", bom=True)
    df = read_delimited(spark, path)
    assert df.columns == ["A", "Ñ", "C"]
    assert rows(df) == [("1", "ñ", "   "), ("2", None, None), ("3", "x", "y")]


def test_path_exists(spark, tmp_path):
    assert path_exists(spark, put(tmp_path / "a.csv", "A\n1\n"))
    assert path_exists(spark, str(tmp_path / "*.csv"))
    assert not path_exists(spark, str(tmp_path / "b.csv"))
    with pytest.raises(Exception):
        path_exists(spark, "nosuchscheme://x/y")


def test_years_with_other_columns_and_orders(spark, rows, tmp_path):
    put(tmp_path / "2018" / "m2018.csv", "A;B\n1;x\n")
    put(tmp_path / "2019" / "m2019.csv", "B;A;C\ny;2;c\n")
    files = resolve(
        spark, str(tmp_path), {"m": {2018: "m2018.csv", 2019: "m2019.csv", 2020: "m2020.csv"}},
        [2017, 2018, 2019, 2020],
    )
    assert [(f.year, f.present) for f in files] == [(2018, True), (2019, True), (2020, False)]
    merged = union_years([raw_module(spark, f, "r") for f in files if f.present])
    assert rows(merged, "A", "B", "C", "survey_year", "source_file", "origin", "run_id") == [
        ("1", "x", None, 2018, "m2018.csv", "blob_csv", "r"),
        ("2", "y", "c", 2019, "m2019.csv", "blob_csv", "r"),
    ]


def test_workbook_sheets(spark, rows, tmp_path):
    for i in (1, 2):
        write_workbook(tmp_path / f"b{i}.xlsx", {
            "Departamentos": [["Código", None, "Nombre"], [i, None, "Ñandú & co"], [None, "x", None]],
            "Municipios (3)": [["a"], ["b"]],
        })
    df = read_sheet(spark, str(tmp_path / "*.xlsx"), "Departamentos")
    assert df.columns == ["Código", "column_2", "Nombre"]
    assert rows(df) == [
        ("1", None, "Ñandú & co"), ("2", None, "Ñandú & co"), (None, "x", None), (None, "x", None),
    ]
    assert rows(read_sheet(spark, str(tmp_path / "b1.xlsx"), "Municipios (3)")) == [("b",)]
    with pytest.raises(Exception, match="no sheet"):
        read_sheet(spark, str(tmp_path / "b1.xlsx"), "Nope")


def test_connection_values_must_be_set():
    good = relational.Connection("jdbc:x:y", "u", "p", "org.x.Driver")
    assert good.options() == {
        "url": "jdbc:x:y", "user": "u", "password": "p", "driver": "org.x.Driver",
    }
    assert "p'" not in repr(good) and "password" not in repr(good)
    with pytest.raises(ValueError, match="user, password"):
        relational.Connection("jdbc:x:y", "", "Placeholder").options()


class Recorder:
    """Stands in for a reader or writer and notes the calls."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call


def test_jdbc_options_without_a_database():
    reader = Recorder()
    session = type("S", (), {"read": reader})()
    login = relational.Connection("jdbc:x:y", "u", "p")
    split = relational.Split("id", 0, 1000, 16)
    relational.read_table(session, login, "municipios", split)
    assert reader.calls[1][2] == {
        "dbtable": "municipios", "fetchsize": "10000", "url": "jdbc:x:y", "user": "u",
        "password": "p", "partitionColumn": "id", "lowerBound": "0", "upperBound": "1000",
        "numPartitions": "16",
    }
    reader.calls.clear()
    relational.remote_count(session, login, "fac")
    assert reader.calls[1][2]["query"] == "SELECT COUNT(*) AS row_count FROM fac"
    writer = Recorder()
    frame = type("D", (), {"write": writer})()
    relational.write_table(frame, login, "t", writers=4)
    assert writer.calls[1][2]["truncate"] == "true"
    assert writer.calls[1][2]["batchsize"] == "5000"
    assert writer.calls[1][2]["numPartitions"] == "4"
    assert writer.calls[2] == ("mode", ("overwrite",), {})
    writer.calls.clear()
    relational.write_table(frame, login, "t")
    assert writer.calls[1][2]["numPartitions"] == "16"  # never one connection for each partition
    with pytest.raises(ValueError):
        relational.write_table(frame, login, "t", writers=0)


def test_publish_goes_on_after_a_failure(spark):
    seen = []

    def write(df, name):
        if name == "b":
            raise RuntimeError("no room")
        seen.append(name)

    done = relational.publish({"a": spark.range(3), "b": spark.range(1), "c": spark.range(4)}, write)
    assert seen == ["a", "c"]
    assert done.rows == {"a": 3, "c": 4} and done.total == 7
    assert done.errors == {"b": "no room"}


def test_publish_writes_a_few_tables_at_once(spark):
    """Four that wait for each other: one after the other they would never end."""
    meet = threading.Barrier(4, timeout=60)
    logged = []
    done = relational.publish(
        {n: spark.range(2) for n in "abcd"}, lambda df, name: meet.wait(),
        lambda name, rows, started_at, error: logged.append((name, rows, error)), at_once=4,
    )
    assert done.rows == dict.fromkeys("abcd", 2) and not done.errors
    assert sorted(logged) == [(n, 2, None) for n in "abcd"]


def test_partition_reload_is_idempotent(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2018), (2, 2019)], "id int, y int")
    tables.write_parquet(df, path, partition_by=["y"])
    again = spark.createDataFrame([(9, 2019), (8, 2019)], "id int, y int")
    for _ in range(2):
        tables.write_parquet(again, path, partition_by=["y"], only_partitions=True)
    assert rows(tables.read_parquet(spark, path)) == [(1, 2018), (8, 2019), (9, 2019)]


def test_a_named_year_without_rows_is_emptied(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2018), (2, 2019), (3, 2020)], "id int, y int")
    tables.write_parquet(df, path, partition_by=["y"])
    again = spark.createDataFrame([(9, 2019)], "id int, y int")
    tables.write_parquet(again, path, partition_by=["y"], only_partitions=True, replaces=[2018, 2019, 2025])
    assert rows(tables.read_parquet(spark, path)) == [(3, 2020), (9, 2019)]
    with pytest.raises(ValueError):
        tables.write_parquet(again, path, partition_by=["y"], replaces=[2019])


def test_registered_table_shows_the_columns_of_all_years(spark, rows, tmp_path):
    layers = tables.Layers(spark, str(tmp_path))
    early = spark.createDataFrame([(1, 2018)], "a int, y int")
    late = spark.createDataFrame([(2, 3, 2019)], "a int, b int, y int")
    for df in (early, late):
        layers.write(df, "silver", "years", partition_by=["y"], only_partitions=True)
    layers.register("wide")
    assert rows(spark.sql("SELECT a, b, y FROM wide_silver.years")) == [(1, None, 2018), (2, 3, 2019)]


def test_reset_removes_rows_and_entries(spark, rows, tmp_path):
    layers = tables.Layers(spark, str(tmp_path))
    layers.write(spark.range(2), "silver", "u")
    layers.write(spark.range(2), "gold", "v")
    layers.register("gone")
    layers.reset("silver", "gone")
    assert not layers.exists("silver", "u") and layers.exists("gold", "v")
    assert rows(tables.list_tables(spark, "gone")) == [("gone_gold", "v")]


def test_rebalance_cuts_a_large_partition(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        df = spark.range(0, 60_000, 1, 8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
            F.when(F.col("id") % 20 > 0, 2018).otherwise(2019).alias("y"),
        )
        path = str(tmp_path / "t")
        tables.write_parquet(df, path, partition_by=["y"], rebalance=True)
        files = {
            y: len(list((tmp_path / "t" / f"y={y}").glob("*.parquet"))) for y in (2018, 2019)
        }
        assert files[2018] > 3 >= files[2019]
        assert tables.read_parquet(spark, path).count() == 60_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)


def test_layers_and_catalog(spark, rows, tmp_path):
    layers = tables.Layers(spark, str(tmp_path))
    with pytest.raises(ValueError):
        layers.path("platinum", "x")
    assert layers.read_optional("gold", "t") is None
    layers.write(spark.createDataFrame([(1, 2018)], "id int, y int"), "gold", "t", partition_by=["y"])
    layers.write(spark.range(2), "silver", "u")
    listed = layers.register("demo")
    assert rows(listed) == [("demo_gold", "t"), ("demo_silver", "u")]
    assert rows(spark.sql("SELECT * FROM demo_gold.t WHERE y = 2018")) == [(1, 2018)]
    assert [r.namespace for r in tables.list_schemas(spark, "demo_g%").collect()] == ["demo_gold"]
    tables.drop_tables(spark, ["demo_gold.t", "demo_gold.t"])
    assert layers.exists("gold", "t")  # dropping a registered table keeps its files
    tables.create_table(spark, "demo_audit.runs", "id int, at timestamp", str(tmp_path / "r"))
    assert spark.table("demo_audit.runs").count() == 0


def test_run_log_is_a_typed_table_from_the_start(spark, tmp_path):
    audit = Audit(tables.Layers(spark, str(tmp_path)), "r")
    audit.create_tables("logs")
    assert spark.table("logs_audit.pipeline_runs").count() == 0
    assert len(spark.table("logs_audit.pipeline_runs").columns) == 11
    assert len(spark.table("logs_audit.yearly_load_log").columns) == 5
    for rows in (3, 5):
        audit.loaded("member", 2018, rows)
    spark.catalog.refreshTable("logs_audit.yearly_load_log")
    assert spark.table("logs_audit.yearly_load_log").count() == 2
    assert [r.row_count for r in audit.yearly_loads().collect()] == [5]


def test_upsert_through_a_snapshot(spark, rows):
    def frame(data):
        return spark.createDataFrame(data, "k int, v string")

    first = tables.write_snapshot(frame([(1, "a"), (2, "b")]), spark, "snap")
    tables.create_schemas(spark, "snaps")
    spark.sql(f"CREATE TABLE snaps_audit.t USING parquet LOCATION '{first}'")
    merged = upsert(spark.table("snaps_audit.t"), frame([(2, "c"), (3, "d")]), ["k"])
    tables.switch_location(spark, "snaps_audit.t", tables.write_snapshot(merged, spark, "snap"))
    assert rows(spark.table("snaps_audit.t")) == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(spark.read.parquet(first)) == [(1, "a"), (2, "b")]


def test_bucketed_tables_join_without_a_shuffle(spark, plan, tmp_path):
    tables.create_schemas(spark, "bucketed")
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("a", "b"):
            df = spark.range(100).select(
                F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("j"), F.lit(name).alias(name)
            )
            tables.save_table(
                df, f"bucketed_silver.{name}", str(tmp_path / name), bucket_by=(4, ["k", "j"])
            )
        joined = spark.table("bucketed_silver.a").join(spark.table("bucketed_silver.b"), ["k", "j"])
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
        assert joined.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    context = type("C", (), {"master": "spark://host:7077", "applicationId": "a"})()
    session = type("S", (), {"conf": Conf(), "sparkContext": context})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session)


def test_workbooks_go_by_their_own_headers(spark, rows, tmp_path, monkeypatch):
    write_workbook(tmp_path / "a1.xlsx", {"s": [["A", "B"], ["1", "x"], ["2", "y", "wide"]], "other": [["Z"], ["0"]]})
    write_workbook(tmp_path / "a2.xlsx", {"s": [["B", "A"], ["z", "3"], [None, "4"]], "other": [["Z"]]})
    found = workbook.read_sheets(spark, str(tmp_path / "a*.xlsx"), ["s", "other"])
    assert found["s"].columns == ["A", "B", "column_3"]
    assert rows(found["s"]) == [("1", "x", None), ("2", "y", "wide"), ("3", "z", None), ("4", None, None)]
    assert rows(found["other"]) == [("0",)]
    # parsed already: the workbooks are not read again
    for book in tmp_path.glob("a*.xlsx"):
        book.unlink()
    assert found["s"].count() == 4


@pytest.mark.parametrize("header", [["A", "C"], ["A"], ["A", "B", "D"], ["A", "A"]])
def test_a_workbook_with_other_columns_raises(spark, tmp_path, header):
    write_workbook(tmp_path / "a1.xlsx", {"s": [["A", "B"], ["1", "x"]]})
    write_workbook(tmp_path / "a2.xlsx", {"s": [header, ["1", "x"]]})
    with pytest.raises(ValueError, match="a2.xlsx"):
        read_sheet(spark, str(tmp_path / "*.xlsx"), "s")


def test_cells_and_rows_without_places():
    sheet = (
        f'<worksheet xmlns="{MAIN}"><sheetData><row><c t="inlineStr"><is><t>A</t></is></c><c><v>7</v></c></row>'
        '<row><c><v>1</v></c><c r="D2"><v>2</v></c><c><v>3</v></c></row><row r="9"><c><v>4</v></c></row><row/></sheetData></worksheet>'
    )
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as book:
        book.writestr("xl/worksheets/s.xml", sheet)
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets><sheet name="s" r:id="a"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="a" Target="/xl/worksheets/s.xml"/></Relationships>')
    assert list(workbook.Book(content.getvalue()).rows("s")) == [
        (1, ["A", "7"]), (2, ["1", None, None, "2", "3"]), (9, ["4"]), (10, []),
    ]


def test_one_listing_for_any_number_of_years(spark, tmp_path, monkeypatch):
    for year in range(2000, 2040, 2):
        put(tmp_path / str(year) / f"m{year}.csv", "A\n1\n")
        put(tmp_path / str(year) / f"folder{year}.csv" / "part-0.csv", "A\n1\n")
    manifest = {m: {y: f"{m}{y}.csv" for y in range(2000, 2040)} for m in ("m", "folder", "none")}
    monkeypatch.setattr(delimited, "path_exists", None)
    found = resolve(spark, str(tmp_path), manifest, list(range(1990, 2040)))
    assert len(found) == 120 and {(f.module, f.year) for f in found if f.present} == {
        (m, y) for m in ("m", "folder") for y in range(2000, 2040, 2)
    }
    assert not any(f.present for f in resolve(spark, str(tmp_path / "nowhere"), manifest, [2000]))


def test_sketches_settle_what_years_do_not_share(spark):
    apart = spark.range(20_000).select("id", (F.col("id") % 4 + 2018).cast("int").alias("y"))
    shared = spark.range(20_000).select((F.col("id") % 8999).alias("id"), (F.col("id") % 4 + 2018).cast("int").alias("y"))
    twice = apart.unionAll(apart.filter("id < 10"))
    tables_ = {"apart": (apart, "id"), "shared": (shared, "id"), "twice": (twice, "id")}
    sketches = quality.stack([
        quality.key_sketches(df, key, "y").withColumn("table_name", F.lit(n)) for n, (df, key) in tables_.items()
    ])
    found = {r.table_name: r for r in quality.sketched_key_audit(sketches, tables_).collect()}
    assert {n: (r.total, r.distinct_keys, r.status, r.settled_by) for n, r in found.items()} == {
        "apart": (20_000, 20_000, "OK", "sketch"), "shared": (20_000, 8_999, "ALERT", "count"),
        "twice": (20_010, 20_000, "ALERT", "sketch"),
    }


def test_keys_are_counted_before_they_are_sketched(spark, plan):
    rows = [(1, "a"), (1, "a"), (1, None), (2, "b"), (2, "c"), (3, None), (3, None), (None, "a")]
    sketches = quality.key_sketches(spark.createDataFrame(rows, "y int, k string"), "k", "y")
    # beside a count of distinct keys there would be a sketch for each key
    grouped = re.findall(r"keys=\[([^\]]*)\], functions=\[[^\n]*hll_?sketch", plan(sketches), re.IGNORECASE)
    assert grouped and all(re.fullmatch(r"y#\d+", keys) for keys in grouped)
    found = {r.y: (r.total, r.distinct_keys, r.null_keys) for r in sketches.collect()}
    assert found == {1: (3, 1, 1), 2: (2, 2, 0), 3: (2, 0, 2), None: (1, 1, 0)}
    estimates = sketches.select("y", F.hll_sketch_estimate("sketch")).collect()
    assert dict(map(tuple, estimates)) == {1: 1, 2: 2, 3: 0, None: 1}
