"""Shards of near equal bytes, tokens and rows, by vector bin packing.

Groups of equal texts are the things to place. A task sums them up first; then
groups that hold more than a small share of anything are units of their own and
all others share a fixed number of cells by hash, so the driver places a
bounded number of units, whatever the table holds. Units go to the shard where
the dot product of their vector with the residual capacity is highest, the
largest first. A group larger than half a shard is split by its rows, which are
numbered when they are stored.

Defined results: NULL text has no bytes, no tokens and counts as one group;
NULL or repeated ids are rows like others; a text may be of any length; an empty
table has an empty result. Other columns are passed on in ``row``, under any
names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.store import stored

SUMS = ("size", "tokens", "n")


def attributes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")
    return docs.select(
        rest, F.col(id_col).cast("long").alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.size(F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("grp"), F.lit(1).cast("long").alias("n"),
    )


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unit; columns are bytes, tokens and rows.

    Then units move from the fullest to the emptiest shard in bytes while that
    brings the two closer.
    """
    totals = np.maximum(vectors.sum(axis=0), 1)
    parts = vectors / totals * shards  # of one shard's capacity
    residual = np.ones((shards, vectors.shape[1]))
    chosen = np.zeros(len(vectors), np.int64)
    for unit in np.argsort(-parts.max(axis=1), kind="stable"):
        fits = residual[:, 0] >= parts[unit, 0]
        score = residual @ parts[unit]
        score[~fits] = residual[~fits, 0] - 10 * shards  # no room: the emptiest
        chosen[unit] = shard = int(score.argmax())
        residual[shard] -= parts[unit]
    load = np.bincount(chosen, vectors[:, 0], shards)
    for _ in range(50 * shards):
        high, low = int(load.argmax()), int(load.argmin())
        gap = load[high] - load[low]
        own = np.flatnonzero((chosen == high) & (vectors[:, 0] < gap))
        if not len(own):
            break
        unit = own[np.abs(vectors[own, 0] - gap / 2).argmin()]
        chosen[unit] = low
        load[high] -= vectors[unit, 0]
        load[low] += vectors[unit, 0]
    return chosen


def sharded(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", cells: int = 4096
) -> DataFrame:
    """(row, size, text_crc32, shard, slot): slots count from 0 in each shard.

    The driver sees at most 3 x ``cells`` groups, 5 x ``cells`` x shards units.
    """
    spark = docs.sparkSession
    # a stored number tells rows apart, whatever their ids are
    numbered = attributes(docs, id_col, text_col).withColumn("place", F.monotonically_increasing_id())
    rows = stored(numbered, "shard-rows")
    groups = stored(rows.groupBy("grp").agg(*[F.sum(c).alias(c) for c in SUMS]), "shard-groups")
    totals = groups.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS]).first()
    heavy = F.greatest(*[F.col(c) / F.lit(max(totals[c], 1)) for c in SUMS])
    # at most ``cells`` groups for each of three sums can exceed 1 / cells
    large = groups.select("grp", heavy.alias("share")).where(F.col("share") > 1.0 / cells)
    pieces = F.when(F.col("share") * shards * 2 > 1, F.ceil(F.col("share") * shards * 2)).otherwise(1)
    large = large.select("grp", pieces.cast("long").alias("pieces"))
    cell = F.pmod("grp", F.lit(cells))
    piece = F.pmod(F.xxhash64("place", F.lit(7)), F.col("pieces"))
    units = rows.join(F.broadcast(large), "grp", "left").withColumns({
        "unit": F.when(F.col("pieces").isNull(), cell).otherwise(F.col("grp")),
        "piece": F.when(F.col("pieces").isNull(), F.lit(-1).cast("long")).otherwise(piece),
    })
    sums = units.groupBy("unit", "piece").agg(*[F.sum(c).alias(c) for c in SUMS]).orderBy("unit", "piece").collect()
    chosen = place(np.array([[r[c] for c in SUMS] for r in sums], float).reshape(-1, 3), shards)
    # ranks are counted within parts of units, so that no task sorts a shard
    step = max(1, -(-totals["n"] // cells))
    plan = spark.createDataFrame(
        [(r.unit, r.piece, int(s), -(-r.n // step)) for r, s in zip(sums, chosen)],
        "unit long, piece long, shard int, parts long",
    )
    placed = units.join(F.broadcast(plan), ["unit", "piece"]).withColumn("part", F.pmod(F.xxhash64("place", F.lit(8)), "parts"))
    begins, filled = [], [0] * shards
    counts = placed.groupBy("unit", "piece", "part", "shard").agg(F.count("*").alias("n"))
    for r in counts.orderBy("unit", "piece", "part").collect():
        begins.append((r.unit, r.piece, r.part, filled[r.shard]))
        filled[r.shard] += r.n
    begins = spark.createDataFrame(begins, "unit long, piece long, part long, begin long")
    rank = F.row_number().over(Window.partitionBy("unit", "piece", "part").orderBy("grp", "id", "text_crc32", "place"))
    return placed.join(F.broadcast(begins), ["unit", "piece", "part"]).select(
        "row", "size", "text_crc32", "shard", (F.col("begin") + rank - 1).cast("long").alias("slot")
    )

