import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.operators import project
from tallymart.operators.aggregate import (
    distinct_values, frequency, frequency_profile, top_k, with_growth,
)
from tallymart.operators.dedupe import keep_first, keep_least
from tallymart.operators.project import Field


def test_blank_to_null_keeps_other_text_untouched(spark, rows):
    df = spark.createDataFrame([("   ", "", " a ", 1), (None, "b", "\t", 2)], "a string, b string, c string, n int")
    assert rows(project.blank_to_null(df)) == [(None, "b", "\t", 2), (None, None, " a ", 1)]


def test_conform_types_and_backfills(spark, rows):
    fields = [
        Field("id", "ID", required=True),
        Field("n", "N", "int"),
        Field("w", "W", "number"),
        Field("m", "M", "money"),
        Field("f", "F", "flag"),
        Field("k", "K", "code", {"1": "one"}),
    ]
    df = spark.createDataFrame([("x", " 3 ", "1,5", "1")], "id string, N string, W string, K string")
    out = project.conform(df, fields)
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [
        ("id", "string"), ("n", "int"), ("w", "double"), ("m", "decimal(14,2)"),
        ("f", "boolean"), ("k", "string"),
    ]
    (row,) = rows(out)
    assert row[:3] == ("x", 3, 1.5) and row[4:] == (None, "one") and str(row[3]) == "0.00"


def test_conform_names_what_is_missing(spark):
    df = spark.createDataFrame([("x",)], "other string")
    with pytest.raises(ValueError, match="ID"):
        project.conform(df, [Field("id", "ID", required=True)])


def test_backfill_casts_leniently(spark, rows):
    schema = T.StructType([T.StructField("A", T.IntegerType()), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([("5",), ("x",)], "a string")
    assert rows(project.backfill(df, schema)) == [(5, None), (None, None)]


def test_rename_and_normalize(spark):
    df = spark.createDataFrame([(1, 2)], "A int, b int")
    assert project.rename_present(df, {"a": "x", "c": "y"}).columns == ["x", "b"]
    assert project.normalize_names(df.toDF("Año", "Nº 1")).columns == ["ano", "no_1"]


def test_lineage_takes_the_file_name_from_the_scan(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "t"))
    df = project.with_lineage(spark.read.parquet(str(tmp_path / "t")), "o", 2018, "r")
    (name,) = {r.source_file for r in df.collect()}
    assert name.endswith(".parquet")
    assert df.columns[1:] == list(project.LINEAGE)


def test_keep_first_is_the_minimum_over_a_total_order(spark):
    rng = random.Random(7)
    data = [
        (rng.choice(["a", "b", None]), rng.randint(0, 3), rng.choice([None, 1, 2]), rng.choice("xyz"))
        for _ in range(300)
    ]

    def first(block):
        return min(block, key=lambda r: tuple((v is None, v if v is not None else 0) for v in r[2:]))

    want = {}
    for r in data:
        want.setdefault(r[:2], []).append(r)
    lacking = sorted((r for r in data if r[0] is None), key=repr)
    want = {k: first(v) for k, v in want.items() if k[0] is not None}
    schema = "k string, h int, o int, v string"
    for parts in (1, 7):
        rng.shuffle(data)
        df = spark.createDataFrame(data, schema).repartition(parts)
        found = [tuple(r) for r in keep_first(df, ["k", "h"]).collect()]
        got = {r[:2]: r for r in found if r[0] is not None}
        assert got == want and len(found) == len(want) + len(lacking)
        assert sorted((r for r in found if r[0] is None), key=repr) == lacking


def test_keep_first_limits_before_the_shuffle(spark, plan):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(keep_first(df, ["k"]))
    exchange = text.index("Exchange")
    assert "WindowGroupLimit" in text[:exchange] and "Partial" in text[exchange:]


def test_keep_first_one_hot_key(spark):
    df = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id"
    )
    kept = keep_first(df, ["k"], [F.desc("id")])
    assert kept.count() == 66_667
    assert kept.filter("k = -1").head().id == 99_999



def test_frequency_counts_nulls(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, 1), ("a", 2)], "c string, n int")
    assert rows(frequency(df, "c")) == [("a", 2), (None, 1)]
    assert rows(frequency_profile(df, ["c", "n"])) == [
        ("c", "a", 2), ("c", None, 1), ("n", "1", 2), ("n", "2", 1),
    ]
    assert rows(distinct_values(df, "c")) == [("a",)]


def test_growth_over_the_row_before(spark, rows):
    df = spark.createDataFrame([(2018, 10), (2019, 15), (2021, 0), (2022, 4)], "y int, v int")
    assert rows(with_growth(df, "v", "y", "g"), "y", "g") == [
        (2018, None), (2019, 50.0), (2021, -100.0), (2022, None),
    ]


def test_growth_by_group(spark, rows):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 2, 9)], "k string, y int, v int")
    assert rows(with_growth(df, "v", "y", "g", by=["k"]), "k", "y", "g") == [
        ("a", 1, None), ("a", 2, 100.0), ("b", 2, None),
    ]


def test_top_k_breaks_ties(spark, plan):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 3), ("d", None)], "k string, n int")
    top = top_k(df, 2, "n", ["k"])
    assert [r.k for r in top.collect()] == ["c", "a"]
    assert "TakeOrderedAndProject" in plan(top)


def test_keep_least_is_the_minimum_of_raw_rows(spark, plan):
    rng = random.Random(9)
    data = [
        (rng.choice(["a", "b", None]), rng.randint(0, 3), rng.choice([None, "1", "2"]), rng.choice("xyz"))
        for _ in range(300)
    ]
    groups = {}
    for r in data:
        groups.setdefault(r[:2], []).append(r)
    lacking = sorted((r for r in data if r[0] is None), key=repr)
    least = lambda r: tuple((v is not None, v or "") for v in (r[3], r[2]))
    want = {k: min(v, key=least) for k, v in groups.items() if k[0] is not None}
    schema = "k string, h int, `o.p` string, v string"
    for parts in (1, 7):
        rng.shuffle(data)
        df = spark.createDataFrame(data, schema).repartition(parts)
        found = [tuple(r) for r in keep_least(df, ["k", "h"], ["v"]).collect()]
        assert {r[:2]: r for r in found if r[0] is not None} == want and len(found) == len(want) + len(lacking)
        assert sorted((r for r in found if r[0] is None), key=repr) == lacking
    assert "Window" not in plan(keep_least(df, ["k"]))
    assert keep_least(df.limit(0), ["k"]).count() == 0


def test_keep_least_one_hot_key(spark):
    df = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 3 == 1, F.col("id")).alias("k"), "id"
    )
    kept = keep_least(df, ["k"], ["id"])
    assert kept.count() == 1 + 33_333 + 33_333 and kept.filter("k = -1").head().id == 0
    alike = df.select("k", F.lit("same").alias("v"))
    assert keep_least(alike, ["k"]).filter("k IS NULL").count() == 33_333


def test_columns_without_an_order_are_an_error(spark):
    df = spark.createDataFrame([(1, {"a": 1}, 2)], "k int, m map<string,int>, o int")
    for keep in (keep_first, keep_least):
        with pytest.raises(ValueError, match="without an order.*m"):
            keep(df, ["k"])
    assert keep_first(df, ["k"], ["o"], order_is_total=True).count() == 1
