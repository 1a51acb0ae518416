"""One row per key, the same row in every run.

Rows that lack a part of the key are not known to be equal to any other: all
of them stay.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NO_ORDER = (T.MapType, T.VariantType)


def _split(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a full key, and the others."""
    lacking = reduce(or_, [F.col(f"`{k}`").isNull() for k in keys])
    return df.filter(~lacking), df.filter(lacking)


def _ordered(df: DataFrame, named: set[str]) -> list[str]:
    """The other columns, all of which have an order."""
    rest = [f for f in df.schema.fields if f.name not in named]
    without = [f.name for f in rest if isinstance(f.dataType, _NO_ORDER)]
    if without:
        raise ValueError(f"columns without an order cannot break ties: {', '.join(without)}")
    return [f.name for f in rest]


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column] = (),
    order_is_total: bool = False,
    keep_lacking: bool = True,
) -> DataFrame:
    """Keep the first row of every key.

    Rows are ordered by ``order`` and then by all other columns, NULLs last,
    so ties are exact copies and the choice does not depend on how the data
    was split. Spark turns ``row_number() = 1`` into a per-task limit ahead of
    the shuffle: each task sends at most one row per key, however many copies
    one key has.

    ``order_is_total`` promises that no two rows of a key are equal in
    ``order``. Other columns are then left out of the order, and those that no
    later step uses are not even read. Otherwise a column that has no order,
    such as a map, is an error.
    """
    named = {c for c in order if isinstance(c, str)} | set(keys)
    first = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    rest = [] if order_is_total else [F.col(f"`{c}`").asc_nulls_last() for c in _ordered(df, named)]
    full, lacking = _split(df, keys)
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(*first, *rest))
    first_rows = full.withColumn("_turn", turn).filter("_turn = 1").drop("_turn")
    return first_rows.unionByName(lacking) if keep_lacking else first_rows


def keep_least(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Keep the least row of every key, by an aggregate instead of a sort of rows.

    Rows are compared by ``order`` and then by all other columns, in their
    order, NULLs first; only rows of one key are ever compared. Each task
    sends one row per key. Meant for raw rows that are decoded afterwards: a
    row that does not stay is then never decoded, and keys are worked out once.

    Rows without a full key are grouped by 128 bits of hashes of the whole row
    and by the task that reads them, counted, and given back as often: so they
    spread evenly, however many are alike, and a task that runs again sends
    them where it did before, in whatever order it reads.
    """
    rest = _ordered(df, {*keys, *order})
    lacking = reduce(or_, [F.col(f"`{k}`").isNull() for k in keys])
    whole = [F.col(f"`{c}`") for c in df.columns]
    parts = [F.xxhash64(*whole), F.xxhash64(F.lit(1), *whole), F.spark_partition_id()]
    own = F.when(lacking, F.concat_ws(" ", *[x.cast("string") for x in parts]))
    least = F.min(F.struct(*[F.col(f"`{c}`") for c in [*order, *rest]])).alias("_row")
    kept = df.withColumn("_own", own).groupBy(*[F.col(f"`{k}`") for k in keys], "_own").agg(least, F.count("*").alias("_n"))
    times = F.when(F.col("_own").isNull(), F.lit(1)).otherwise(F.col("_n").cast("int"))
    copies = kept.select("*", F.explode(F.array_repeat(F.lit(True), times)).alias("_copy"))
    named = {c: F.col(f"`{c}`") for c in keys} | {c: F.col("_row").getField(c) for c in [*order, *rest]}
    return copies.select(*[named[c].alias(c) for c in df.columns])
