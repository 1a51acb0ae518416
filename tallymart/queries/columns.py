"""Column builders over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions import scalar
from tallymart.queries.registry import Tables, query

PRIORITY = {"1": "urgent", "2": "high", "3": "medium", "4": "unspecified"}
NUMBERED_REGION = {"1": "AFRICA", "2": "AMERICA", "3": "ASIA", "4": "EUROPE"}


def comma(amount: str):
    """A given amount the way survey files write it: '2072,53'."""
    return F.replace(
        F.col(amount).cast("decimal(14,2)").cast("string"), F.lit("."), F.lit(",")
    )


@query("""
SELECT o_orderkey,
       CASE substr(o_orderpriority, 1, 1)
            WHEN '1' THEN 'urgent' WHEN '2' THEN 'high'
            WHEN '3' THEN 'medium' WHEN '4' THEN 'unspecified' END AS priority
FROM orders
""")
def decode_codes(t: Tables) -> DataFrame:
    code = F.left("o_orderpriority", F.lit(1))
    return t.orders.select("o_orderkey", scalar.decode(code, PRIORITY).alias("priority"))


@query("""
SELECT s_suppkey, CAST(CASE r_name WHEN 'AFRICA' THEN 1 WHEN 'AMERICA' THEN 2
       WHEN 'ASIA' THEN 3 WHEN 'EUROPE' THEN 4 END AS INTEGER) AS region_id
FROM supplier
JOIN nation ON n_nationkey = s_nationkey
JOIN region ON r_regionkey = n_regionkey
""")
def label_to_id(t: Tables) -> DataFrame:
    placed = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")).join(
        t.region, F.col("r_regionkey") == F.col("n_regionkey")
    )
    return placed.select(
        "s_suppkey", scalar.label_to_id("r_name", NUMBERED_REGION).alias("region_id")
    )


@query("""
SELECT l_orderkey, l_linenumber,
       CASE l_linestatus WHEN 'F' THEN TRUE WHEN 'N' THEN FALSE END AS finished,
       CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS returned
FROM lineitem
""")
def yes_no_flag(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        scalar.yes_no("l_linestatus", "F", "N").alias("finished"),
        scalar.yes_no("l_returnflag", "R", "A").alias("returned"),
    )


@query("""
SELECT l_orderkey, l_linenumber,
       CASE WHEN nullif(l_returnflag, 'N') IS NULL THEN NULL
            ELSE l_returnflag = 'R' END AS returned
FROM lineitem
""")
def tri_state_flag(t: Tables) -> DataFrame:
    code = F.nullif(F.col("l_returnflag"), F.lit("N"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", scalar.is_code(code, "R").alias("returned")
    )


@query("""
SELECT l_orderkey, l_linenumber,
       CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS DOUBLE) AS price,
       CAST(l_extendedprice AS DECIMAL(14,2)) AS money,
       TRY_CAST(CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR) || '.'
                || CAST(l_linenumber AS VARCHAR) AS DOUBLE) AS two_commas
FROM lineitem
""")
def decimal_comma(t: Tables) -> DataFrame:
    text = comma("l_extendedprice")
    broken = F.concat(text, F.lit(","), F.col("l_linenumber").cast("string"))
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        scalar.comma_double(text).alias("price"),
        scalar.comma_money(text).alias("money"),
        scalar.comma_double(broken).alias("two_commas"),
    )


@query("""
SELECT l_orderkey, l_linenumber,
       coalesce(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(14,2)) END,
                CAST(0 AS DECIMAL(14,2))) AS refunded
FROM lineitem
""")
def money_default(t: Tables) -> DataFrame:
    text = F.when(F.col("l_returnflag") == "R", comma("l_extendedprice"))
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        scalar.money_or_zero(scalar.comma_money(text)).alias("refunded"),
    )


def _three_flags(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        scalar.yes_no("l_returnflag", "R", "A").alias("a"),
        scalar.yes_no("l_linestatus", "F", "O").alias("b"),
        F.when(F.col("l_linenumber") > 2, F.col("l_quantity") > 25).alias("c"),
    )


_THREE_FLAGS = """
WITH flags AS (
  SELECT l_orderkey, l_linenumber,
         CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS a,
         CASE l_linestatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS b,
         CASE WHEN l_linenumber > 2 THEN l_quantity > 25 END AS c
  FROM lineitem)
"""


@query(_THREE_FLAGS + """
SELECT l_orderkey, l_linenumber,
       coalesce(a, FALSE) OR coalesce(b, FALSE) OR coalesce(c, FALSE) AS any_set
FROM flags
""")
def any_flag(t: Tables) -> DataFrame:
    return _three_flags(t).select(
        "l_orderkey", "l_linenumber", scalar.any_true(["a", "b", "c"]).alias("any_set")
    )


@query(_THREE_FLAGS + """
SELECT l_orderkey, l_linenumber,
       NOT coalesce(a, TRUE) OR NOT coalesce(b, TRUE) OR NOT coalesce(c, TRUE) AS any_unset
FROM flags
""")
def any_missing_flag(t: Tables) -> DataFrame:
    return _three_flags(t).select(
        "l_orderkey", "l_linenumber", scalar.any_false(["a", "b", "c"]).alias("any_unset")
    )


@query(_THREE_FLAGS + """
SELECT l_orderkey, l_linenumber, coalesce(CAST(a AS INTEGER), 0) AS a_count,
       coalesce(CAST(c AS INTEGER), 0) AS c_count
FROM flags
""")
def flag_to_measure(t: Tables) -> DataFrame:
    return _three_flags(t).select(
        "l_orderkey",
        "l_linenumber",
        scalar.flag_measure("a").alias("a_count"),
        scalar.flag_measure("c").alias("c_count"),
    )


@query("""
SELECT p_partkey,
       CASE WHEN nullif(p_size, 50) IS NULL THEN NULL WHEN p_size < 10 THEN 'small'
            WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_band,
       CASE WHEN nullif(p_size, 50) IS NULL THEN 'large' WHEN p_size < 10 THEN 'small'
            WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_band_labelled
FROM part
""")
def band_numeric(t: Tables) -> DataFrame:
    size = F.nullif(F.col("p_size"), F.lit(50))
    edges = [(10, "small"), (30, "medium")]
    return t.part.select(
        "p_partkey",
        scalar.band(size, edges, "large").alias("size_band"),
        scalar.band(size, edges, "large", null_label="large").alias("size_band_labelled"),
    )


@query("""
SELECT l_orderkey, l_linenumber,
       CAST('0x' || substr(sha256(CAST(l_orderkey AS VARCHAR) || '||'
            || CAST(l_linenumber AS VARCHAR) || '||'
            || coalesce(nullif(l_returnflag, 'N'), 'NULL')), 1, 15) AS BIGINT) AS line_sk,
       sha256(length(CAST(l_orderkey AS VARCHAR)) || ':' || CAST(l_orderkey AS VARCHAR) || '|'
            || coalesce(length(nullif(l_returnflag, 'N')) || ':' || nullif(l_returnflag, 'N'), '-')) AS wide_sk
FROM lineitem
""")
def surrogate_key(t: Tables) -> DataFrame:
    flag = F.nullif(F.col("l_returnflag"), F.lit("N"))
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        scalar.surrogate_key(["l_orderkey", "l_linenumber", flag]).alias("line_sk"),
        scalar.surrogate_key(["l_orderkey", flag], wide=True).alias("wide_sk"),
    )


@query("""
SELECT CAST(year(l_shipdate) AS INTEGER) AS y,
       CAST(round(CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) / 1000000, 2)
            AS DECIMAL(25,2)) AS price_millions
FROM lineitem GROUP BY 1
""")
def amount_millions(t: Tables) -> DataFrame:
    return (
        t.lineitem.groupBy(F.year("l_shipdate").alias("y"))
        .agg(F.sum(F.col("l_extendedprice").cast("decimal(14,2)")).alias("price"))
        .select("y", scalar.millions("price").alias("price_millions"))
    )
