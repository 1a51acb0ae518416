"""Joins of a large frame with lookups and dimensions.

No size hints, but for a few frequent keys: Spark broadcasts a side once it knows that it is small, from
file sizes or from a finished shuffle, and otherwise joins by key and splits
oversized partitions at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _pairs(on: Mapping[str, str] | Sequence[str]) -> dict[str, str]:
    return dict(on) if isinstance(on, Mapping) else {c: c for c in on}


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__and__, conditions)


def lookup_left(
    df: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    null_buckets: int = 0,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """All rows of ``df`` with the other columns of ``lookup``, NULL if absent.

    ``on`` lists shared key names or maps left names to right names; only the
    left spelling stays. ``lookup`` must hold one row per key, otherwise rows
    multiply. Rows with a NULL key match nothing, yet a shuffle would send all
    of them to one task: ``null_buckets`` spreads them over that many, by a
    hash of ``spread_by``, such as the row's own key, or else of all columns.
    """
    pairs = _pairs(on)
    right_keys = {r: f"_key{i}" for i, r in enumerate(pairs.values())}
    right = lookup.withColumnsRenamed(right_keys)
    left = df
    match = [df[l] == right[right_keys[r]] for l, r in pairs.items()]
    if null_buckets:
        no_key = reduce(Column.__or__, [F.col(l).isNull() for l in pairs])
        spread = F.pmod(F.xxhash64(*(spread_by or df.columns)), F.lit(null_buckets))
        left = df.withColumn("_bucket", F.when(no_key, spread).otherwise(F.lit(0)))
        # always 0, but not a literal, which would drop out of the shuffle key
        right = right.withColumn(
            "_home", F.pmod(F.xxhash64(*right_keys.values()), F.lit(1))
        )
        match = [left[l] == right[right_keys[r]] for l, r in pairs.items()]
        match.append(left["_bucket"] == right["_home"])
    joined = left.join(right, _all(match), "left")
    return joined.drop(*right_keys.values(), "_bucket", "_home")


#: frequent keys are counted with at least this support, in so many counters
LEAST_SUPPORT = 1e-4


def frequent_keys(df: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """At most ``most`` keys, among them every key of more than one in ``most`` rows.

    Counted by the algorithm of Misra and Gries in ``most`` counters for each
    task, however many keys there are; the counters are what is merged. Some
    keys may come along that are less frequent.
    """
    if not 1 <= most <= 1 / LEAST_SUPPORT:
        raise ValueError(f"the number of frequent keys lies between 1 and {1 / LEAST_SUPPORT:.0f}")
    known = df.dropna(subset=list(keys)).select(F.struct(*[F.col(f"`{k}`") for k in keys]).alias("_key"))
    return known.freqItems(["_key"], 1 / most).select(F.explode("_key_freqItems").alias("_key")).select("_key.*")


def lookup_left_hot(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    hot_keys: int = 1000,
    buckets: int = 64,
    spread_by: Sequence[str] = (),
    counted: DataFrame | None = None,
) -> DataFrame:
    """``lookup_left`` for frames in which a few keys hold most of the rows.

    The ``frequent_keys``, at most ``hot_keys`` and never more than 10,000, are
    broadcast. Their rows are spread over ``buckets`` tasks by a hash of
    ``spread_by``, such as the row's own key, or else of all columns that can
    be hashed, and their lookup rows are copied once per bucket; rows without a
    key are spread too. Which keys count as hot changes the work, never the
    result. The key columns of ``df`` are read once more than by ``lookup_left``;
    ``counted`` is a frame with the same keys that costs less to read, such as
    the table that ``df`` is a join of.
    """
    keys = list(on)
    hot = F.broadcast(frequent_keys(df if counted is None else counted, keys, hot_keys).withColumn("_hot", F.lit(True)))
    hashed = list(spread_by) or [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashed]), F.lit(buckets)).cast("int")
    no_key = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    left = df.join(hot, keys, "left").select(
        *df.columns,
        F.when(F.col("_hot") | no_key, spread).otherwise(F.lit(0)).alias("_bucket"),
    )
    homes = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(buckets - 1)))
    right = lookup.join(hot, keys, "left").select(
        *lookup.columns,
        F.explode(F.coalesce(homes, F.array(F.lit(0)))).alias("_bucket"),
    )
    return lookup_left(left, right, [*keys, "_bucket"])


def consolidate(primary: DataFrame, secondary: DataFrame, key: str) -> DataFrame:
    """All rows of ``primary`` and those of ``secondary`` whose key it lacks.

    Secondary rows without a key are left out; a NULL key in ``primary`` has
    no effect.
    """
    missing = secondary.filter(F.col(key).isNotNull()).join(
        primary.select(key), key, "left_anti"
    )
    return primary.unionByName(missing)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``source`` in place of, or beside, its own.

    ``source`` must hold one row per key; a NULL part of a key equals NULL, so
    the same rows can be put in again. The result has to go to a new path: the
    target is still being read while it is written.
    """
    new = source.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    return target.join(new, same, "left_anti").unionByName(source)
