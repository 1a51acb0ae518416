"""Files and stored tables: what is written must be what is read back.

All of these write under the shared folder of the session and return a plain
read of what they wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions import scalar
from tallymart.operators.project import blank_to_null
from tallymart.queries.registry import Tables, query
from tallymart.session import scratch_path
from tallymart.sources import versions
from tallymart.sources.delimited import (
    SurveyFile, listing, manifest_rows, missing_files, raw_module, read_delimited, union_years,
)
from tallymart.sources.tables import delete_folder, read_parquet, write_parquet
from tallymart.streaming.ingest import ingest_new_files


def _orders(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        F.col("o_totalprice").cast("decimal(14,2)").alias("o_totalprice"),
        F.year("o_orderdate").alias("y"),
    )


_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
       CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice,
       CAST(year(o_orderdate) AS INTEGER) AS y
FROM orders
"""


def _write_text(df: DataFrame, path: str) -> None:
    """Survey-style files: ';', a header, blanks of spaces, one folder per year."""
    df.write.partitionBy("y").csv(
        path, sep=";", header=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


@query("""
SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS state,
       CAST(o_totalprice AS DECIMAL(14,2)) AS price
FROM orders
""")
def csv_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders-text")
    price = F.replace(F.col("o_totalprice").cast("string"), F.lit("."), F.lit(","))
    _write_text(
        _orders(t).select(
            F.col("o_orderkey").cast("string").alias("ORDERKEY"),
            F.col("o_custkey").cast("string").alias("CUSTKEY"),
            F.when(F.col("o_orderstatus") == "P", F.lit("   "))
            .otherwise(F.col("o_orderstatus")).alias("STATE"),
            price.alias("PRICE"),
            "y",
        ),
        path,
    )
    raw = blank_to_null(read_delimited(t.spark, path).drop("y"))
    return raw.select(
        F.col("ORDERKEY").try_cast("bigint").alias("o_orderkey"),
        F.col("CUSTKEY").try_cast("bigint").alias("o_custkey"),
        F.col("STATE").alias("state"),
        scalar.comma_money("PRICE").alias("price"),
    )


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS o_orderpriority,
       o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS survey_year,
       'blob_csv' AS origin, 'y=' || CAST(year(o_orderdate) AS VARCHAR) AS source_file
FROM orders
""")
def multi_year_union(t: Tables) -> DataFrame:
    # The early years lack a column and have the others in another order.
    path = scratch_path(t.spark, "years")
    early = _orders(t).filter("y < 1998").select("o_orderstatus", "o_orderkey", "y")
    late = _orders(t).filter("y >= 1998").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", "y"
    )
    _write_text(early, f"{path}/early")
    _write_text(late, f"{path}/late")
    years = [r.y for r in _orders(t).select("y").distinct().orderBy("y").collect()]
    files = [
        SurveyFile("orders", y, f"{path}/{'early' if y < 1998 else 'late'}/y={y}", True)
        for y in years
    ]
    merged = union_years([raw_module(t.spark, f, "run-1") for f in files])
    return merged.select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", "survey_year", "origin", "source_file"
    )


@query("""
SELECT o_orderkey, o_orderstatus,
       CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS o_orderpriority,
       CAST(year(o_orderdate) AS INTEGER) AS y
FROM orders
""")
def append_evolve(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "evolving")
    early = _orders(t).filter("y < 1998").select("o_orderkey", "o_orderstatus", "y")
    late = _orders(t).filter("y >= 1998").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "y"
    )
    write_parquet(early, path, mode="append", partition_by=["y"])
    write_parquet(late, path, mode="append", partition_by=["y"])
    return read_parquet(t.spark, path, merge_schema=True).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "y"
    )


@query(_ORDERS)
def overwrite_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "overwritten")
    write_parquet(_orders(t).select("o_orderkey", "y"), path, partition_by=["y"])
    write_parquet(_orders(t), path, partition_by=["y"], rebalance=True)
    return read_parquet(t.spark, path)


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
       CAST(CAST(o_totalprice AS DECIMAL(14,2))
            + CASE WHEN year(o_orderdate) = 1997 THEN 1 ELSE 0 END AS DECIMAL(14,2))
         AS o_totalprice,
       CAST(year(o_orderdate) AS INTEGER) AS y
FROM orders
""")
def reload_partition(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "reloaded")
    write_parquet(_orders(t), path, partition_by=["y"])
    changed = _orders(t).filter("y = 1997").withColumn(
        "o_totalprice", (F.col("o_totalprice") + 1).cast("decimal(14,2)")
    )
    for _ in range(2):  # loading a year again must not add to it
        write_parquet(changed, path, partition_by=["y"], only_partitions=True)
    return read_parquet(t.spark, path)


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
       CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS y
FROM orders WHERE year(o_orderdate) <> 1997
""")
def reload_emptied_year(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "emptied")
    write_parquet(_orders(t), path, partition_by=["y"])
    emptied = _orders(t).filter("y = 1997 AND o_orderkey IS NULL")
    write_parquet(emptied, path, partition_by=["y"], only_partitions=True, replaces=[1997])
    return read_parquet(t.spark, path)


_STATES = """
WITH o AS (
  SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice,
         CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS o_orderpriority,
         CAST(year(o_orderdate) AS INTEGER) AS y FROM orders)
SELECT 'reader of the first version' AS state, o_orderkey, o_totalprice,
       CAST(NULL AS VARCHAR) AS o_orderpriority, y FROM o WHERE y < 1998
UNION ALL
SELECT 'current version', o_orderkey,
       CAST(o_totalprice + CASE WHEN y = 1997 THEN 1 ELSE 0 END AS DECIMAL(14,2)),
       o_orderpriority, y FROM o WHERE y <> 1996
"""


@query(_STATES)
def versioned_overwrite(t: Tables) -> DataFrame:
    """The table before and after: early years, one reloaded, one emptied, late
    years appended with one column more; a write in between fails midway."""
    root = scratch_path(t.spark, "versioned")
    kept = ["o_orderkey", "o_totalprice", "y"]
    early = _orders(t).filter("y < 1998").select(*kept)
    versions.write(early, root, partition_by="y")
    first = versions.read(t.spark, root)
    broken = F.when(F.col("o_orderkey") > 100, F.raise_error(F.lit("a row that cannot be written")))
    try:
        versions.write(early.withColumn("o_totalprice", F.coalesce(broken.cast("decimal(14,2)"), "o_totalprice")), root, partition_by="y")
    except Exception as error:
        if "cannot be written" not in str(error):
            raise
    changed = early.filter("y = 1997").withColumn(
        "o_totalprice", (F.col("o_totalprice") + 1).cast("decimal(14,2)")
    )
    for _ in range(2):  # loading a year again must not add to it
        versions.write(changed, root, partition_by="y", only_partitions=True, replaces=[1996])
    late = _orders(t).filter("y >= 1998").select(*kept[:-1], "o_orderpriority", "y")
    versions.write(late, root, mode="append", partition_by="y")
    columns = ["o_orderkey", "o_totalprice", "o_orderpriority", "y"]
    before = first.select(F.lit("reader of the first version").alias("state"), *kept[:-1], F.lit(None).cast("string").alias("o_orderpriority"), "y")
    now = versions.read(t.spark, root).select(F.lit("current version").alias("state"), *columns)
    return before.union(now)


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
       CASE WHEN year(o_orderdate) < 1998 THEN 'batch' ELSE 'stream' END AS origin,
       CAST(year(o_orderdate) AS INTEGER) AS survey_year
FROM orders
""")
def stream_replay(t: Tables) -> DataFrame:
    """A table that a batch load begins and streams go on with, one for each
    late year; every stream also loses the note that its batch was done, and
    the batch that it sends again adds nothing."""
    root, text, records = (scratch_path(t.spark, label) for label in ("mixed", "arriving", "records"))
    rows = _orders(t).select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(F.col("o_orderstatus") == "P", F.lit("  ")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), "y",
    )
    early = blank_to_null(rows.filter("y < 1998")).select(
        "o_orderkey", "o_orderstatus", F.lit("batch").alias("origin"), F.col("y").alias("survey_year")
    )
    versions.write(early, root, partition_by="survey_year")
    _write_text(rows.filter("y >= 1998"), text)
    for year in [r.y for r in rows.filter("y >= 1998").select("y").distinct().orderBy("y").collect()]:
        record = f"{records}/{year}"
        for _ in range(2):
            ingest_new_files(t.spark, f"{text}/y={year}", year, root, record, "run-1").awaitTermination()
            delete_folder(t.spark, f"{record}/commits/0")
    origin = F.when(F.col("origin") == "batch", "batch").otherwise("stream").alias("origin")
    return versions.read(t.spark, root).select("o_orderkey", "o_orderstatus", origin, "survey_year")


@query("""
SELECT 'orders' AS module, CAST(y AS INTEGER) AS year, 'orders' || y || '.csv' AS name
FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders) WHERE y % 3 = 0
UNION ALL
SELECT 'orders', 2031, 'orders2031.csv'
""")
def manifest_missing(t: Tables) -> DataFrame:
    """Of the years of the orders and one more, those without a file."""
    root = scratch_path(t.spark, "listed")
    years = [r.y for r in _orders(t).select("y").distinct().collect()]
    for year in years:
        if year % 3:
            rows = _orders(t).filter(F.col("y") == year).select("o_orderkey")
            rows.write.csv(f"{root}/{year}/orders{year}.csv", sep=";", header=True)
    files = {"orders": {year: f"orders{year}.csv" for year in [*years, 2031]}}
    return missing_files(manifest_rows(t.spark, files, [*years, 2031, 2032]), listing(t.spark, root))
