"""Counts, sums, shares, growth and top-k.

Every grouping combines inside the task before it shuffles, so a value that
holds a third of all rows still arrives as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions import scalar


def frequency(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value (or combination of values), as ``n``."""
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def frequency_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Frequency tables of several columns in one scan: column, value, n."""
    return (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "column", "value")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column, NULL left out."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


def sums_by(df: DataFrame, by: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """``sum(measure)`` per group; ``measures`` maps result names to columns."""
    return df.groupBy(*by).agg(*[F.sum(c).alias(name) for name, c in measures.items()])


def count_true(flag: str | Column) -> Column:
    """How many rows have the flag set; NULL when no row has a value."""
    return F.sum((F.col(flag) if isinstance(flag, str) else flag).cast("int"))


def with_shares(df: DataFrame, shares: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add percentages; ``shares`` maps a name to (part, whole)."""
    return df.withColumns({
        name: scalar.share_pct(part, whole) for name, (part, whole) in shares.items()
    })


def with_growth(
    df: DataFrame,
    value: str,
    order: str,
    name: str,
    by: Sequence[str] = (),
) -> DataFrame:
    """Add the growth in percent over the row before, in ``order``.

    For aggregated frames: without ``by`` all rows meet in one task, which is
    right for one row per year and for nothing larger.
    """
    window = Window.partitionBy(*by).orderBy(order)
    before = F.lag(value).over(window)
    return df.withColumn(name, scalar.share_pct(F.col(value) - before, before))


def top_k(df: DataFrame, k: int, by: str, tie: Sequence[str]) -> DataFrame:
    """The k rows with the largest ``by``; ``tie`` settles equal ones.

    Each task keeps its own k rows, so only k per task are merged.
    """
    return df.orderBy(F.desc_nulls_last(by), *[F.asc_nulls_last(t) for t in tie]).limit(k)
