"""Texts whose sets of word shingles are alike: SimHash links, exact Jaccard.

A text is the set of its shingles, equal sets are one node. Nodes whose
fingerprints over pairs of words are linked by the grid of
``tallymart.llm.simhash`` (five bits at most) are candidates. Similar sets can
differ in more bits than a grid can carry, so MinHash adds candidates: of 80
minima of hashed shingles four each are a cell; two sets with a Jaccard
similarity of 0.8 have none of the 20 cells in common once in 38,000 pairs.
What meets either way is compared by its whole sets, so each link is exact.
Cells with the same members are compared once, and a crowded cell is cut into
blocks of which each two are compared, so a task holds two blocks at most.

Defined results: NULL text has no words; texts without words are one group; one
of fewer words than a shingle is a single shingle. A row without an id joins the
group of its text; a group of such rows alone has no id. Texts may be of any
length; repeated rows and ids are one group; an empty table stays empty; other
columns are passed on, under any names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm import components, simhash, textcore
from tallymart.llm.repeats import TEXT
from tallymart.llm.store import stored

#: words of a fingerprint's shingle, and bits in which linked fingerprints may differ
FP_SHINGLE, FP_BITS = 2, 5
BANDS, ROWS = 20, 4
#: nodes of a cell that are compared with each other, or with as many others, in one go
BLOCK_NODES = 1024

_random = np.random.default_rng(80)
_XOR, _TIMES = (_random.integers(0, 2**64 - 1, BANDS * ROWS, dtype=np.uint64) for _ in range(2))
_TIMES |= np.uint64(1)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row in order, and the row bounds."""
    data = textcore.lowered(data)
    units = textcore.words(data, bounds)
    counts = units.counts
    sizes = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    tops = np.cumsum(sizes)
    at = np.arange(tops[-1] if len(tops) else 0) + np.repeat(units.bounds[:-1] - (tops - sizes), sizes)
    ends = np.minimum(at + shingle, np.repeat(units.bounds[1:], sizes))
    keys = textcore.Prefixes(textcore.unit_hashes(data, units)).between(at, ends)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    return keys[new], np.searchsorted(rows[new], np.arange(len(sizes) + 1))


def signed(keys: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A node for each set, and its cells."""
    full = np.flatnonzero(np.diff(bounds))
    nodes = np.zeros(len(bounds) - 1, np.uint64)
    cells = np.zeros((len(full), BANDS), np.uint64)
    if len(full):
        starts = bounds[full]
        nodes[full] = np.add.reduceat(textcore.mixed(keys ^ np.uint64(0x5851F42D4C957F2D)), starts)
        for at in range(BANDS * ROWS):
            band = at // ROWS
            least = np.minimum.reduceat((keys ^ _XOR[at]) * _TIMES[at], starts)
            cells[:, band] = textcore.mixed(cells[:, band] + least + np.uint64(band + 1))
    limits = np.concatenate([[0], np.cumsum(np.diff(bounds) > 0)]) * BANDS
    return nodes.view(np.int64), pa.ListArray.from_arrays(
        pa.array(limits, pa.int32()), pa.array(cells.ravel().view(np.int64), pa.int64())
    )


def _marked(shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textcore.slices(batch, TEXT):
                data, bounds = textcore.column_bytes(part.column(TEXT))
                nodes, cells = signed(*shingle_sets(data, bounds, shingle))
                found = simhash.fingerprints_of(data, bounds, FP_SHINGLE).view(np.int64)
                yield pa.RecordBatch.from_pydict(
                    {n: part.column(n) for n in part.schema.names}
                    | {"__node": pa.array(nodes), "__cells": cells, "__fp": pa.array(found)}
                )

    return run


def _sets(shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textcore.slices(batch, TEXT):
                keys, bounds = shingle_sets(*textcore.column_bytes(part.column(TEXT)), shingle)
                found = textcore.from_bounds(keys.tobytes(), bounds * 8, pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("node"), found], ["node", "keys"])

    return run


def tree(keys: np.ndarray, bounds: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of sets that are alike: enough pairs to join all that are.

    Sets already joined to the one at hand are not compared again.
    """
    sizes = np.diff(bounds)
    values, places = np.unique(keys, return_inverse=True)
    held = np.zeros(len(values), bool)
    label = np.arange(len(sizes))
    left, right = [], []
    for a in range(len(sizes) - 1):
        if (label[a + 1:] == label[a]).all():
            continue
        begin = bounds[a + 1]
        own = places[bounds[a]:begin]
        held[own] = True
        both = np.add.reduceat(held[places[begin:]].astype(np.int64), bounds[a + 1:-1] - begin)
        held[own] = False
        near = a + 1 + np.flatnonzero(both >= least * (sizes[a] + sizes[a + 1:] - both))
        for b in near.tolist():
            if label[b] != label[a]:
                left.append(a)
                right.append(b)
                label[label == label[b]] = label[a]
    return np.array(left, np.int64), np.array(right, np.int64)


def _links(least: float):
    """Rows of a partition, sorted by group, to links of alike sets."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, nodes, sets = None, [], []
        for batch in batches:
            groups = zip(*(batch.column(c).to_pylist() for c in ("cell", "low", "high")))
            for group, node, keys in zip(groups, batch.column("node").to_pylist(), batch.column("keys").to_pylist()):
                if group != head:
                    yield from found(nodes, sets)
                    head, nodes, sets = group, [], []
                nodes.append(node)
                sets.append(keys)
        yield from found(nodes, sets)

    def found(nodes: list[int], sets: list[bytes]) -> Iterator[pa.RecordBatch]:
        if len(nodes) > 1:
            bounds = np.concatenate([[0], np.cumsum([len(s) // 8 for s in sets])])
            a, b = tree(np.frombuffer(b"".join(sets), np.uint64), bounds, least)
            if len(a):
                own = np.array(nodes, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(own[a]), pa.array(own[b])], ["a", "b"])

    return run


def meetings(nodes: DataFrame) -> DataFrame:
    """(cell, low, high, node): who is compared with whom, from (node, cells)."""
    spread = nodes.select("node", F.explode("cells").alias("cell"))
    members = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.min("node").alias("a"), F.max("node").alias("b")]
    crowds = spread.groupBy("cell").agg(*members).where("n > 1")
    once = crowds.groupBy("n", "x", "a", "b").agg(F.min("cell").alias("cell"))
    blocks = F.ceil(F.col("n") / BLOCK_NODES).cast("int")
    placed = spread.join(once.select("cell", blocks.alias("blocks")), "cell").withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return placed.select("cell", "node", "own", other).select(
        "cell", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node"
    )


def linked_pairs(nodes: DataFrame) -> DataFrame:
    """(cell, low, high, node), two rows for each pair that fingerprints link,
    from (node, fp). Nodes of one fingerprint are linked to the least of them."""
    least = stored(nodes.groupBy("fp").agg(F.min("node").alias("node")), "fingerprints")
    equal = nodes.join(least.withColumnRenamed("node", "a"), "fp").where("node <> a").select("a", F.col("node").alias("b"))
    pairs = simhash.links(least, FP_BITS).unionByName(equal)
    once = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    ends = once.select(F.xxhash64("a", "b").alias("cell"), F.explode(F.array("a", "b")).alias("node"))
    return ends.select("cell", F.lit(-1).alias("low"), F.lit(-1).alias("high"), "node")


def first_of_groups(docs: DataFrame, shingle: int = 5, least: float = 0.8) -> DataFrame:
    """Of each group of alike texts the row with the smallest ``doc_id``.

    Of several rows with that id, and of a group without ids, one; which one
    depends on the rows alone.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("__row")
    source = docs.select(rest, F.col("text").cast("string").alias(TEXT))
    kinds = f"__row {source.schema['__row'].dataType.simpleString()}, {TEXT} string, __node long, __cells array<long>, __fp long"
    marked = stored(source.mapInArrow(_marked(shingle), kinds).select(
        F.col("__row").alias("row"), F.col(TEXT), F.col("__node").alias("node"), F.col("__cells").alias("cells"),
        F.col("__fp").alias("fp"), F.monotonically_increasing_id().alias("place"),
    ), "marked")
    nodes = marked.groupBy("node").agg(F.min("place").alias("place"), F.first("cells").alias("cells"), F.min("fp").alias("fp"))
    nodes = stored(nodes, "nodes")
    meet = stored(meetings(nodes).unionByName(linked_pairs(nodes.select("node", "fp"))), "meetings")
    asked = meet.select("node").distinct().join(nodes.select("node", "place"), "node")
    sets = marked.select("place", TEXT).join(asked, "place").mapInArrow(_sets(shingle), "node long, keys binary")
    group = ("cell", "low", "high")
    links = (
        meet.join(sets, "node").select(*group, "node", "keys").repartition(*group).sortWithinPartitions(*group)
        .mapInArrow(_links(least), "a long, b long")
    )
    roots = components.roots(stored(links, "links")).withColumnRenamed("root", "group")
    order = F.struct(
        F.col("row.doc_id").isNull(), F.col("row.doc_id"), F.xxhash64(TEXT), F.xxhash64("row", TEXT), F.col("place")
    )
    firsts = (
        marked.select("node", "place", order.alias("order")).groupBy("node").agg(F.min("order").alias("order"))
        .join(roots, "node", "left").groupBy(F.coalesce("group", "node").alias("group")).agg(F.min("order").alias("order"))
    )
    kept = marked.select("row", TEXT, "place").join(firsts.select(F.col("order.place").alias("place")), "place")
    return kept.select(*[F.col(TEXT if c == "text" else f"row.`{c}`").alias(c) for c in docs.columns])
