"""Reports on keys, references, row counts and runs. Each is a frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions import scalar


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """The rows of all frames, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)


def _verdict(ok, good: str = "OK", bad: str = "ALERT"):
    return F.when(ok, good).otherwise(bad)


def key_audit(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per table: rows, distinct keys, NULL keys, and whether the key is one."""
    reports = [
        df.select(F.col(key).alias("key")).agg(
            F.count("*").alias("total"),
            F.count_distinct("key").alias("distinct_keys"),
            F.count_if(F.col("key").isNull()).alias("null_keys"),
        ).select(F.lit(name).alias("table_name"), "total", "distinct_keys", "null_keys")
        for name, (df, key) in tables.items()
    ]
    sound = (F.col("total") == F.col("distinct_keys")) & (F.col("null_keys") == 0)
    return stack(reports).withColumn("status", _verdict(sound))


#: 2^14 registers of a sketch, 16 KB; a relative error of 0.8 %, taken threefold
SKETCH_BITS = 14
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def key_sketches(df: DataFrame, key: str, by: str) -> DataFrame:
    """Per part of a table (``by``, a year): total, distinct_keys, null_keys,
    exactly, and a mergeable sketch of its keys. Stored by part, a part that is
    loaded again replaces its own row, and only its rows are read.

    Uses of a key are counted first and only keys are sketched. Beside a count
    of distinct keys Spark would make a sketch for each key and merge them all.
    """
    uses = df.select(F.col(by), F.col(key).alias("key")).groupBy(by, "key").agg(F.count("*").alias("uses"))
    no_key = F.when(F.col("key").isNull(), F.col("uses"))
    return uses.groupBy(by).agg(
        F.sum("uses").alias("total"), F.count("key").alias("distinct_keys"),
        F.coalesce(F.sum(no_key), F.lit(0)).alias("null_keys"),
        F.hll_sketch_agg("key", F.lit(SKETCH_BITS)).alias("sketch"),
    )


def sketched_key_audit(sketches: DataFrame, exact: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``key_audit`` from stored ``key_sketches`` (with ``table_name``).

    Keys of one part are counted exactly. Whether parts share keys the merged
    sketch tells: its estimate is off by more than ``SKETCH_ERROR`` once in some
    400 times. If it falls short of the sum by more than that, the table in
    ``exact`` is counted whole.
    What stays unseen are keys that parts share by less than that error.
    ``settled_by`` names the way.
    """
    merged = sketches.groupBy("table_name").agg(
        F.sum("total").alias("total"), F.sum("distinct_keys").alias("distinct_keys"), F.sum("null_keys").alias("null_keys"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"),
    ).withColumn("doubtful", F.col("estimate") < F.col("distinct_keys") * (1 - SKETCH_ERROR))
    doubtful = {r.table_name for r in merged.filter("doubtful").select("table_name").collect()}
    columns = ["table_name", "total", "distinct_keys", "null_keys", "settled_by"]
    settled = merged.filter(~F.col("doubtful")).withColumn("settled_by", F.lit("sketch")).select(*columns)
    counted = [
        key_audit({name: exact[name]}).withColumn("settled_by", F.lit("count")).select(*columns) for name in sorted(doubtful)
    ]
    sound = (F.col("total") == F.col("distinct_keys")) & (F.col("null_keys") == 0)
    return stack([settled, *counted]).withColumn("status", _verdict(sound))


def without_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that lack a part of their key: no join will ever match them."""
    return df.filter(reduce(Column.__or__, [F.col(k).isNull() for k in keys]))


@dataclass(frozen=True)
class Reference:
    """A foreign key of the fact, the dimension it points to, and its rule."""

    fk: str
    dim: DataFrame
    key: str
    nullable: bool


def referential_audit(fact: DataFrame, references: Sequence[Reference]) -> DataFrame:
    """Per foreign key: rows without a match, NULL rows and their share.

    One pass over the fact counts the uses of every value of every key; only
    those counts meet the dimensions, so a key that half of the fact shares
    costs one row per task.
    """
    keys = [r.fk for r in references]
    whole = all(
        isinstance(df.schema[c].dataType, T.IntegralType)
        for r in references for df, c in ((fact, r.fk), (r.dim, r.key))
    )
    kind = "bigint" if whole else "string"
    uses = (
        fact.select(*[F.col(k).cast(kind).alias(k) for k in keys])
        .unpivot([], keys, "fk", "key")
        .groupBy("fk", "key").agg(F.count("*").alias("uses"))
    )
    known = stack([
        r.dim.select(F.lit(r.fk).alias("fk"), F.col(r.key).cast(kind).alias("key"))
        for r in references
    ]).distinct().withColumn("known", F.lit(True))
    found = uses.join(known, ["fk", "key"], "left")
    no_key = F.col("key").isNull()
    sums = found.groupBy("fk").agg(
        F.sum("uses").alias("total"),
        F.sum(F.when(~no_key & F.col("known").isNull(), F.col("uses"))).alias("orphans"),
        F.sum(F.when(no_key, F.col("uses"))).alias("null_rows"),
    )
    rules = fact.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(r.fk).alias("fk"), F.lit(r.nullable).alias("nullable")) for r in references
    ])))
    return rules.join(sums, "fk", "left").na.fill(0, ["total", "orphans", "null_rows"]).select(
        "fk",
        "total",
        "orphans",
        "null_rows",
        scalar.share_pct("null_rows", "total").alias("null_pct"),
        _verdict(F.col("orphans") == 0).alias("match_status"),
        _verdict(F.col("nullable") | (F.col("null_rows") == 0)).alias("null_status"),
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, row_count. Parquet answers from its footers."""
    return stack([
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ])


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Two ``row_counts`` side by side; a table missing on one side is an alert."""
    left = source.withColumnRenamed("row_count", "source_rows")
    right = target.withColumnRenamed("row_count", "target_rows")
    same = F.col("source_rows").eqNullSafe(F.col("target_rows"))
    return left.join(right, "table_name", "full").withColumn("status", _verdict(same))


def run_summary(runs: DataFrame, run_id: str | None = None) -> DataFrame:
    """Per run: how many table loads there were and how they ended."""
    chosen = runs.filter(F.col("run_id") == run_id) if run_id is not None else runs
    return chosen.groupBy("run_id").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "OK").alias("ok"),
        F.count_if(F.col("status") == "ERROR").alias("errors"),
        F.count_if(F.col("status") == "SKIPPED").alias("skipped"),
    )


def run_details(runs: DataFrame, run_id: str) -> DataFrame:
    """The loads of one run in the order they started."""
    return (
        runs.filter(F.col("run_id") == run_id)
        .orderBy("started_at", "table_name")
        .select("table_name", "status", "rows_in", "rows_out", "seconds", "message")
    )
