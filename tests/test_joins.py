import random

import pytest
from pyspark.sql import functions as F

from tallymart.operators import joins
from tallymart.operators.joins import consolidate, frequent_keys, lookup_left, lookup_left_hot, upsert
from tallymart.plans import silver, spec


def skewed(spark, n=3000, seed=3):
    """A third of the rows on one key, a third without a key, a hot unknown key."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        kind = rng.randint(0, 8)
        if kind < 3:
            key = ("hot", 2018)
        elif kind < 5:
            key = (None, 2018)
        elif kind == 5:
            key = ("unknown", 2018)
        else:
            key = (f"k{rng.randint(0, 40)}", rng.choice([2018, 2019]))
        data.append((i, *key))
    lookup = {("hot", 2018): ("north", 1), ("hot", 2019): ("south", None)}
    lookup.update({(f"k{j}", y): (f"r{j % 5}", j if j % 7 else None) for j in range(30) for y in (2018, 2019)})
    frame = spark.createDataFrame(data, "i int, d string, y int")
    table = spark.createDataFrame(
        [(*k, *v) for k, v in lookup.items()], "d string, y int, region string, n int"
    )
    want = [(i, d, y, *lookup.get((d, y), (None, None))) for i, d, y in data]
    want.sort(key=repr)
    return frame, table, want


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_hot_lookup_equals_brute_force(spark, rows, hot):
    frame, table, want = skewed(spark)
    assert rows(lookup_left_hot(frame, table, ["d", "y"], hot_keys=hot)) == want


@pytest.mark.parametrize("buckets", [0, 8])
def test_lookup_equals_brute_force(spark, rows, buckets):
    frame, table, want = skewed(spark)
    assert rows(lookup_left(frame, table, ["d", "y"], buckets)) == want
    renamed = table.withColumnsRenamed({"d": "dd", "y": "yy"})
    assert rows(lookup_left(frame, renamed, {"d": "dd", "y": "yy"}, buckets)) == want


def test_rows_without_key_are_spread(spark, plan):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = spark.range(4000).select("id", F.lit(None).cast("string").alias("k"))
        frame = frame.withColumn("k", F.when(F.col("id") < 4, F.lit("a")).otherwise(F.col("k")))
        table = spark.createDataFrame([("a", 1)], "k string, v int")
        joined = lookup_left(frame, table, ["k"], null_buckets=64)
        assert "SortMergeJoin" in plan(joined)
        assert "_bucket" in plan(joined).split("Exchange hashpartitioning")[1]
        assert joined.count() == 4000 and joined.filter("v = 1").count() == 4
        sizes = (
            joined.filter("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
        )
        assert sum(r["count"] for r in sizes) == 3996
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_skewed_join_is_split_at_run_time(spark, plan):
    keep = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in keep}
    for k, v in keep.items():
        spark.conf.set(k, v)
    try:
        frame = spark.range(0, 200_000, 1, 16).select(
            "id",
            F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id") % 1000).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        table = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        joined = lookup_left(frame, table, ["k"])
        total = joined.agg(F.sum("v"), F.count("*"))
        assert "skew=true" in plan(total, executed=True)
        assert total.head()[1] == 200_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_consolidate_prefers_primary_and_ignores_null_keys(spark, rows):
    primary = spark.createDataFrame([(1, "p"), (None, "p")], "k int, s string")
    secondary = spark.createDataFrame([("s", 1), ("s", 2), ("s", None)], "s string, k int")
    assert rows(consolidate(primary, secondary, "k")) == [(1, "p"), (2, "s"), (None, "p")]


def test_upsert_replaces_and_adds(spark, rows):
    target = spark.createDataFrame([("t", 1, 10), ("t", 2, 20)], "t string, y int, n int")
    source = spark.createDataFrame([("t", 2, 21), ("u", 1, 5)], "t string, y int, n int")
    once = upsert(target, source, ["t", "y"])
    assert rows(once) == [("t", 1, 10), ("t", 2, 21), ("u", 1, 5)]
    assert rows(upsert(once, source, ["t", "y"])) == rows(once)


def test_upsert_with_null_keys_adds_nothing_twice(spark, rows):
    target = spark.createDataFrame([(None, 1, "a"), (2, 1, "b")], "t int, y int, v string")
    source = spark.createDataFrame([(None, 1, "c"), (None, None, "d")], "t int, y int, v string")
    once = upsert(target, source, ["t", "y"])
    assert rows(once) == [(2, 1, "b"), (None, 1, "c"), (None, None, "d")]
    assert rows(upsert(once, source, ["t", "y"])) == rows(once)


def test_frequent_keys_come_from_a_bounded_sketch(spark, plan):
    """Every key of more than one in ``most`` rows, whatever the other keys are."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 10 == 1, F.lit(-2)).when(F.col("id") % 7 > 0, F.col("id")).alias("k"),
        (F.col("id") * 0).alias("z"),
    )
    found = {(r.k, r.z) for r in frequent_keys(df, ["k", "z"], 20).collect()}
    assert {(-1, 0), (-2, 0)} <= found and len(found) <= 20
    text = plan(frequent_keys(df, ["k", "z"], 20))
    assert "keys=[k" not in text and "hashpartitioning" not in text
    for most in (0, 10_001):
        with pytest.raises(ValueError):
            frequent_keys(df, ["k"], most)


def test_hot_lookup_takes_maps_along(spark):
    df = spark.range(300).select(F.lit("a").alias("k"), "id", F.create_map(F.lit("x"), F.col("id")).alias("m"))
    table = spark.createDataFrame([("a", 1)], "k string, v int")
    for by in ((), ("id",)):
        assert lookup_left_hot(df, table, ["k"], 5, 8, by).filter("v = 1 AND m['x'] = id").count() == 300


def test_hot_dwellings_are_counted_without_the_education_records(spark, monkeypatch):
    def empty(columns):
        return spark.range(2).select(*[F.lit(None).cast("int").alias(c) for c in columns])

    counted, keep = [], joins.frequent_keys
    monkeypatch.setattr(joins, "frequent_keys", lambda df, *rest: counted.append(df.columns) or keep(df, *rest))
    tables = empty(spec.MEMBER_COLUMNS), empty(spec.EDUCATION_COLUMNS), empty(spec.DWELLING_COLUMNS)
    assert silver.person(*tables, hot_dwellings=5).columns == spec.PERSON_COLUMNS
    assert counted == [spec.MEMBER_COLUMNS]
