"""Groupings, shares, growth and top-k over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.operators.aggregate import (
    count_true, frequency, frequency_profile, sums_by, top_k, with_growth, with_shares,
)
from tallymart.queries.registry import Tables, query


@query("""
SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS n
FROM orders GROUP BY o_orderstatus
UNION ALL
SELECT 'o_orderpriority', nullif(o_orderpriority, '5-LOW'), count(*)
FROM orders GROUP BY 2
""")
def frequency_table(t: Tables) -> DataFrame:
    coded = t.orders.withColumn(
        "o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    )
    return frequency_profile(coded, ["o_orderstatus", "o_orderpriority"])


@query("""
SELECT event_type, dayofmonth(ts)::INTEGER AS day, count(*) AS n FROM events GROUP BY 1, 2
""")
def frequency_of_pairs(t: Tables) -> DataFrame:
    return frequency(t.events.select("event_type", F.day("ts").alias("day")), "event_type", "day")


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n FROM orders GROUP BY 1
""")
def rows_per_year(t: Tables) -> DataFrame:
    return frequency(t.orders.select(F.year("o_orderdate").alias("y")), "y").orderBy("y")


@query("""
SELECT CAST(year(l_shipdate) AS INTEGER) AS y, count(*) AS total,
       CAST(sum(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END) AS BIGINT) AS returned,
       round(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) * 100.0 / count(*), 2)
         AS returned_pct
FROM lineitem GROUP BY 1
""")
def share_by_year(t: Tables) -> DataFrame:
    flag = F.when(F.col("l_returnflag") == "R", True).when(F.col("l_returnflag") == "A", False)
    counts = t.lineitem.groupBy(F.year("l_shipdate").alias("y")).agg(
        F.count("*").alias("total"), count_true(flag).alias("returned")
    )
    return with_shares(counts, {"returned_pct": ("returned", "total")})


@query("""
SELECT r_name, count(*) AS total,
       CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS closed,
       round(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) * 100.0 / count(*), 2)
         AS closed_pct,
       CAST(NULL AS DOUBLE) AS no_base_pct
FROM orders
JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey
GROUP BY r_name
""")
def share_by_group(t: Tables) -> DataFrame:
    counts = (
        t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .groupBy("c_nationkey")
        .agg(F.count("*").alias("total"), count_true(F.col("o_orderstatus") == "F").alias("closed"))
        .join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    )
    sums = sums_by(counts, ["r_name"], {"total": "total", "closed": "closed"})
    shares = with_shares(
        sums.withColumn("zero", F.lit(0)),
        {"closed_pct": ("closed", "total"), "no_base_pct": ("closed", "zero")},
    )
    return shares.drop("zero").orderBy(F.desc("closed_pct"), "r_name")


_YEARLY = """
yearly AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS lines,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DECIMAL(24,2)) AS price
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1)
"""


def _yearly(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.year("o_orderdate").alias("y"),
        F.lit(1).alias("one"),
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("price"),
    )
    return sums_by(lines, ["y"], {"lines": "one", "returned": "returned", "price": "price"})


@query("WITH " + _YEARLY + """
SELECT y, lines, returned, price, round(returned * 100.0 / lines, 2) AS returned_pct FROM yearly
""")
def sums_by_year(t: Tables) -> DataFrame:
    return with_shares(_yearly(t), {"returned_pct": ("returned", "lines")}).orderBy("y")


@query("WITH " + _YEARLY + """
SELECT y, returned,
       round((returned - lag(returned) OVER (ORDER BY y)) * 100.0
             / nullif(lag(returned) OVER (ORDER BY y), 0), 2) AS growth_pct
FROM yearly
""")
def yoy_growth(t: Tables) -> DataFrame:
    return with_growth(_yearly(t), "returned", "y", "growth_pct").select(
        "y", "returned", "growth_pct"
    )


@query("""
SELECT c_mktsegment, c_nationkey, count(*) AS n FROM orders
JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'F'
GROUP BY 1, 2 ORDER BY n DESC, c_mktsegment, c_nationkey LIMIT 10
""")
def topk_groups(t: Tables) -> DataFrame:
    closed = t.orders.filter("o_orderstatus = 'F'").join(
        t.customer, F.col("c_custkey") == F.col("o_custkey")
    )
    return top_k(
        frequency(closed, "c_mktsegment", "c_nationkey"), 10, "n", ["c_mktsegment", "c_nationkey"]
    )
