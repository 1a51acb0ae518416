"""Joins over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions import scalar
from tallymart.operators.dedupe import keep_first
from tallymart.operators.joins import (
    consolidate, lookup_left, lookup_left_hot, upsert,
)
from tallymart.queries.registry import Tables, query
from tallymart.sources.tables import read_parquet, write_snapshot


@query("""
SELECT c_custkey, c_nationkey, n_name FROM customer
LEFT JOIN nation ON n_nationkey = c_nationkey
""")
def left_join_dim(t: Tables) -> DataFrame:
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return lookup_left(
        t.customer.select("c_custkey", "c_nationkey"), nation, ["c_nationkey"]
    )


@query("""
SELECT doc_id, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
""")
def enrich_lookup(t: Tables) -> DataFrame:
    labels = t.labels.withColumnRenamed("doc_id", "labelled_doc")
    docs = t.documents.select("doc_id", "n_chars")
    return lookup_left(docs, labels, {"doc_id": "labelled_doc"})


_FIRST_LINES = """
first_line AS (
  SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity
  FROM (SELECT *, row_number() OVER (
          PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity) AS turn
        FROM lineitem)
  WHERE turn = 1)
"""


def _first_lines(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"
    )
    return keep_first(lines, ["l_orderkey", "l_linenumber"])


@query("WITH " + _FIRST_LINES + """
SELECT l.l_orderkey, l.l_linenumber, l.l_tax, f.l_shipdate AS first_ship,
       f.l_quantity AS first_quantity
FROM lineitem l LEFT JOIN first_line f
  ON f.l_orderkey = l.l_orderkey AND f.l_linenumber = l.l_linenumber
 AND f.l_partkey = l.l_partkey AND f.l_suppkey = l.l_suppkey AND f.l_shipdate = l.l_shipdate
""")
def composite_key_join(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    first = _first_lines(t)
    joined = lookup_left(
        t.lineitem.select(*keys, "l_tax"),
        first.withColumns({"first_ship": F.col("l_shipdate"), "first_quantity": F.col("l_quantity")})
        .select(*keys, "first_ship", "first_quantity"),
        keys,
    )
    return joined.select("l_orderkey", "l_linenumber", "l_tax", "first_ship", "first_quantity")


_HOUSEHOLDS = """
household AS (
  SELECT o_custkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS household_no,
         CAST(year(o_orderdate) AS INTEGER) AS y, o_orderstatus AS state,
         CAST(o_totalprice AS DECIMAL(14,2)) AS price
  FROM orders),
dwelling AS (
  SELECT o_custkey, y, household_no, state, price
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, y
          ORDER BY household_no, state, price) AS turn FROM household)
  WHERE turn = 1)
"""


def _households(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_custkey",
        scalar.lenient_int(F.left("o_orderpriority", F.lit(1))).alias("household_no"),
        F.year("o_orderdate").alias("y"),
        F.col("o_orderstatus").alias("state"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("price"),
    )


_NO_FANOUT = "WITH " + _HOUSEHOLDS + """
SELECT o_orderkey, o.o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y,
       d.household_no, d.state, d.price
FROM orders o LEFT JOIN dwelling d
  ON d.o_custkey = o.o_custkey AND d.y = year(o_orderdate)
"""


@query(_NO_FANOUT)
def dwelling_join_no_fanout(t: Tables) -> DataFrame:
    dwelling = keep_first(_households(t), ["o_custkey", "y"], ["household_no"])
    persons = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"))
    return lookup_left(persons, dwelling, ["o_custkey", "y"])


@query(_NO_FANOUT)
def dwelling_join_hot_keys(t: Tables) -> DataFrame:
    dwelling = keep_first(_households(t), ["o_custkey", "y"], ["household_no"])
    persons = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"))
    return lookup_left_hot(persons, dwelling, ["o_custkey", "y"], hot_keys=100)


@query("WITH " + _FIRST_LINES + """
SELECT o_orderkey,
       CASE WHEN f.l_orderkey IS NOT NULL THEN
         CAST('0x' || substr(sha256(CAST(f.l_orderkey AS VARCHAR) || '||'
              || CAST(f.l_linenumber AS VARCHAR)), 1, 15) AS BIGINT) END AS line_sk
FROM orders LEFT JOIN first_line f ON f.l_orderkey = o_orderkey AND f.l_linenumber = 1
""")
def fk_lookup_left(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    dim = _first_lines(t).select(*keys, scalar.surrogate_key(keys).alias("line_sk"))
    fact = t.orders.select("o_orderkey", F.lit(1).alias("line"))
    return lookup_left(fact, dim, {"o_orderkey": "l_orderkey", "line": "l_linenumber"}).drop("line")


@query("""
SELECT o_orderkey, nullif(r_name, 'ASIA') AS region,
       CASE WHEN r_name NOT IN ('ASIA', 'EUROPE') THEN
         CAST('0x' || substr(sha256(r_name), 1, 15) AS BIGINT) END AS region_sk
FROM orders
JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey
""")
def fk_by_name(t: Tables) -> DataFrame:
    region = F.nullif(F.col("r_name"), F.lit("ASIA")).alias("region")
    fact = (
        t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
        .select("o_orderkey", region)
    )
    known = t.region.filter("r_name <> 'EUROPE'").select(
        "r_name", scalar.surrogate_key(["r_name"]).alias("region_sk")
    )
    return lookup_left(fact, known, {"region": "r_name"}, null_buckets=16)


@query("""
WITH ordering AS (
  SELECT o_custkey AS custkey, CAST(max(o_orderdate) AS TIMESTAMP) AS seen,
         'orders' AS source FROM orders GROUP BY o_custkey)
SELECT custkey, seen, source FROM ordering
UNION ALL
SELECT c_custkey, CAST(NULL AS TIMESTAMP), 'customer' FROM customer
WHERE NOT EXISTS (SELECT 1 FROM ordering WHERE custkey = c_custkey)
""")
def consolidate_sources(t: Tables) -> DataFrame:
    primary = t.orders.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.max("o_orderdate").alias("seen")
    ).withColumn("source", F.lit("orders"))
    secondary = t.customer.select(
        F.col("c_custkey").alias("custkey"),
        scalar.null_of("timestamp_ntz").alias("seen"),
        F.lit("customer").alias("source"),
    )
    return consolidate(primary, secondary, "custkey")


def _yearly(t: Tables, condition: str) -> DataFrame:
    return t.orders.filter(condition).groupBy(
        "o_custkey", F.year("o_orderdate").alias("y")
    ).agg(
        F.count("*").alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(14,2)")).cast("decimal(24,2)").alias("price"),
    )


@query("""
WITH yearly AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, o_orderstatus = 'F' AS closed,
         count(*) AS n,
         CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(24,2)) AS price
  FROM orders GROUP BY 1, 2, 3)
SELECT o_custkey, y, n, price FROM yearly WHERE closed
UNION ALL
SELECT o_custkey, y, sum(n)::BIGINT, sum(price)::DECIMAL(24,2) FROM yearly a
WHERE NOT closed AND NOT EXISTS (
  SELECT 1 FROM yearly b WHERE b.closed AND b.o_custkey = a.o_custkey AND b.y = a.y)
GROUP BY 1, 2
""")
def upsert_keyed(t: Tables) -> DataFrame:
    keys = ["o_custkey", "y"]
    stored = read_parquet(
        t.spark, write_snapshot(_yearly(t, "o_orderstatus <> 'F'"), t.spark, "yearly")
    )
    merged = upsert(stored, _yearly(t, "o_orderstatus = 'F'"), keys)
    return read_parquet(t.spark, write_snapshot(merged, t.spark, "yearly"))
