"""Projections, filters and row selection over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.operators import project
from tallymart.operators.aggregate import distinct_values
from tallymart.operators.dedupe import keep_first, keep_least
from tallymart.operators.project import Field
from tallymart.queries.registry import Tables, query


@query("""
SELECT c_custkey, c_name,
       CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN NULL
            ELSE ' ' || c_mktsegment || ' ' END AS segment
FROM customer
""")
def blank_to_null(t: Tables) -> DataFrame:
    segment = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("   "))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit(""))
        .otherwise(F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")))
    )
    padded = t.customer.select("c_custkey", "c_name", segment.alias("segment"))
    return project.blank_to_null(padded)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(CAST(c_acctbal AS DECIMAL(14,2)) AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer
""")
def stringify_all(t: Tables) -> DataFrame:
    exact = t.customer.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(14,2)"))
    return project.stringify(exact)


@query("""
SELECT s_suppkey AS codigo_proveedor, s_name AS nombre_del_proveedor,
       s_nationkey AS pais_id, s_acctbal AS saldo FROM supplier
""")
def normalize_names(t: Tables) -> DataFrame:
    spelled = t.supplier.toDF("Código Proveedor", "Nombre  del-Proveedor", "_País__ID_", "SALDO!")
    return project.normalize_names(spelled)


@query("""
SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey, s_acctbal FROM supplier
""")
def rename_if_present(t: Tables) -> DataFrame:
    return project.rename_present(
        t.supplier,
        {"S_SUPPKEY": "supplier_id", "s_name": "supplier_name", "s_phone": "supplier_phone"},
    )


@query("""
SELECT event_id, user_id, CAST(NULL AS INTEGER) AS score,
       CAST(NULL AS VARCHAR) AS device, CAST(value AS DECIMAL(14,2)) AS value
FROM events
""")
def backfill_missing(t: Tables) -> DataFrame:
    schema = T.StructType([
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("device", T.StringType()),
        T.StructField("value", T.DecimalType(14, 2)),
    ])
    return project.backfill(t.events, schema)


_TYPED = [
    Field("part_id", "P_PARTKEY", "int", required=True),
    Field("part_name", "p_name"),
    Field("size", "size_text", "int"),
    Field("price", "price_text", "number"),
    Field("cost", "price_text", "money"),
    Field("kind", "p_type", "code", {"ECONOMY": "cheap", "STANDARD": "usual"}),
    Field("colour", "p_colour"),
]


@query("""
SELECT CAST(p_partkey AS INTEGER) AS part_id, p_name AS part_name,
       CASE WHEN p_size < 40 THEN CAST(p_size AS INTEGER) END AS size,
       CAST(CAST(p_retailprice AS DECIMAL(14,2)) AS DOUBLE) AS price,
       CAST(p_retailprice AS DECIMAL(14,2)) AS cost,
       CASE p_type WHEN 'ECONOMY' THEN 'cheap' WHEN 'STANDARD' THEN 'usual' END AS kind,
       CAST(NULL AS VARCHAR) AS colour
FROM part
""")
def typed_projection(t: Tables) -> DataFrame:
    size = F.col("p_size").cast("string")
    size_text = (
        F.when(F.col("p_size") < 20, F.concat(F.lit(" "), size, F.lit(" ")))
        .when(F.col("p_size") < 40, F.concat(size, F.lit(".9")))
        .otherwise(F.concat(F.lit("n"), size))
    )
    price_text = F.replace(
        F.col("p_retailprice").cast("decimal(14,2)").cast("string"), F.lit("."), F.lit(",")
    )
    raw = t.part.withColumns({"size_text": size_text, "price_text": price_text})
    return project.conform(raw, _TYPED)


@query("""
SELECT o_orderkey, 'parquet' AS origin, 'orders.parquet' AS source_file,
       CAST(2018 AS INTEGER) AS survey_year, 'run-1' AS run_id, TRUE AS stamped
FROM orders
""")
def lineage_columns(t: Tables) -> DataFrame:
    traced = project.with_lineage(t.orders, "parquet", 2018, "run-1")
    return traced.select(
        "o_orderkey", "origin", "source_file", "survey_year", "run_id",
        F.col("ingested_at").isNotNull().alias("stamped"),
    )


@query("""
SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment
FROM customer WHERE nullif(c_mktsegment, 'BUILDING') IS NOT NULL
""")
def filter_not_null(t: Tables) -> DataFrame:
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return t.customer.select("c_custkey", segment.alias("segment")).filter("segment IS NOT NULL")


@query("""
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END
""")
def filter_flag(t: Tables) -> DataFrame:
    flag = F.when(F.col("l_returnflag") == "R", True).when(F.col("l_returnflag") == "A", False)
    return t.lineitem.filter(flag).select("l_orderkey", "l_linenumber", "l_shipdate")


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%'")
def filter_like(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_name").like("red%")).select("p_partkey", "p_name")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                 l_discount, l_tax, l_returnflag, l_linestatus) AS turn
      FROM lineitem)
WHERE turn = 1
""")
def dedupe_by_key(t: Tables) -> DataFrame:
    return keep_first(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL", name="distinct_values")
def distinct_suppliers(t: Tables) -> DataFrame:
    return distinct_values(t.lineitem, "l_suppkey")


@query("""
WITH o AS (SELECT o_orderkey, nullif(o_custkey, o_custkey % 3 * o_custkey) AS custkey, o_orderpriority FROM orders)
SELECT o_orderkey, custkey FROM o WHERE custkey IS NULL
UNION ALL
SELECT min(o_orderkey), custkey FROM o WHERE custkey IS NOT NULL GROUP BY custkey
""")
def rows_without_key(t: Tables) -> DataFrame:
    key = F.nullif(F.col("o_custkey"), F.col("o_custkey") % 3 * F.col("o_custkey"))
    orders = t.orders.select("o_orderkey", key.alias("custkey"))
    return keep_first(orders, ["custkey"], ["o_orderkey"])


@query("""
WITH raw AS (
  SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_orderkey AS BIGINT) END AS order_id,
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS flag,
         CAST(l_shipdate AS VARCHAR) AS shipped, CAST(l_linenumber AS VARCHAR) AS line FROM lineitem)
SELECT order_id, flag, CAST(shipped AS DATE) AS shipped, CAST(line AS INTEGER) AS line FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY flag NULLS FIRST, shipped, line) AS turn FROM raw)
WHERE turn = 1 OR order_id IS NULL
""")
def dedupe_raw_first(t: Tables) -> DataFrame:
    """One raw row per order, its key read as a number, all else decoded after."""
    number = F.col("l_orderkey").cast("string")
    text = t.lineitem.select(
        F.when(F.col("l_linenumber") == 7, "none").when(F.col("l_linenumber") % 2 == 0, F.concat(number, F.lit(".0")))
        .otherwise(F.concat(F.lit(" "), number)).alias("order_text"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"),
        F.col("l_shipdate").cast("date").cast("string").alias("shipped"), F.col("l_linenumber").cast("string").alias("line"),
    )
    keyed = text.select(F.col("order_text").try_cast("double").cast("bigint").alias("order_id"), "flag", "shipped", "line")
    return keep_least(keyed, ["order_id"]).select(
        "order_id", "flag", F.col("shipped").cast("date").alias("shipped"), F.col("line").cast("int").alias("line")
    )
