"""Near-duplicates by SimHash: fingerprints, links within a few bits, groups.

Links come from a lower bound. Two bits are a segment; a fingerprint is mapped
to the number of ones in each of its 32 segments. The Manhattan distance of two
such vectors is never more than the number of differing bits. The vector is cut
into parts, of which one differs by at most 1 if the fingerprints differ by no
more than allowed, so a range join of width 1 over a grid of part vectors finds
every link: a fingerprint goes to its own cell of each part and to the cells
one step up. What meets in a cell is then compared bit by bit. A crowded cell
is first parted: of four shares of the bits one is alike in linked
fingerprints, so its rows go to four smaller cells by their shares, again and
again, until a cell is a few thousand rows; no cell is ever held whole.

Defined results: a text without words has fingerprint zero and is linked like
any other, NULL text has no words. A row without an id joins the group of its
fingerprint; a group of such rows alone has no id. Texts may be of any length;
repeated rows share their fingerprint; an empty table has an empty result. Other
columns are passed on in ``row``, under any names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm import components, textcore
from tallymart.llm.repeats import TEXT
from tallymart.llm.store import stored

SEED = 42
#: fixed values: the low bit of each two-bit segment
LOW_BITS = 0x5555555555555555
#: rows of a grid cell that are compared in one go; more are taken in blocks
BLOCK_ROWS = 1024
#: rows of a cell above which it is parted by further bits, while more bits are
#: open than give that many rows
CELL_ROWS, OPEN_BITS = 4096, 12


def fingerprints_of(data: np.ndarray, bounds: np.ndarray, shingle: int) -> np.ndarray:
    """One fingerprint for each row of a batch."""
    data = textcore.lowered(data)
    units = textcore.words(data, bounds)
    # words of a row with one blank between them, so that a shingle is a slice
    everything = np.ones(len(units), bool)
    clean, limits = textcore.column_bytes(textcore.joined(data, bounds, units, everything, b" "))
    units = textcore.words(clean, limits)
    counts = units.counts
    sizes = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    tops = np.cumsum(sizes)
    at = np.arange(tops[-1] if len(tops) else 0) + np.repeat(units.bounds[:-1] - (tops - sizes), sizes)
    starts = units.starts[at]
    ends = units.ends[np.minimum(at + shingle - 1, np.repeat(units.bounds[1:] - 1, sizes))]
    view, digest = clean.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(view[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts)
    )
    found = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begins = (tops - sizes)[full]
        ones = np.zeros((len(full), 64), np.int64)
        for i, (a, n) in enumerate(zip(begins.tolist(), sizes[full].tolist())):
            # sums of a small type are fast; 255 rows fit into a byte
            part = bits[a:a + n]
            whole = n - n % 255
            if whole:
                ones[i] = part[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
            ones[i] += part[whole:].sum(axis=0, dtype=np.int64) if n % 255 else 0
        set_bits = (2 * ones > sizes[full, None]).astype(np.uint8)
        found[full] = np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return found


def _fingerprints(shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textcore.slices(batch, TEXT):
                found = fingerprints_of(*textcore.column_bytes(part.column(TEXT)), shingle)
                yield pa.RecordBatch.from_pydict(
                    {n: part.column(n) for n in part.schema.names if n != TEXT} | {"__fp": pa.array(found.view(np.int64))}
                )

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(row, fingerprint): all columns but the text, and 64 bits as a long.

    A bit is one if it is one in more than half of the XXH64 hashes (seed 42)
    of the word shingles, repeats included.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("__row")
    source = docs.select(rest, F.col(text_col).cast("string").alias(TEXT))
    kinds = f"__row {source.schema['__row'].dataType.simpleString()}, __fp long"
    found = source.mapInArrow(_fingerprints(shingle), kinds)
    return found.select(F.col("__row").alias("row"), F.col("__fp").alias("fingerprint"))


def _signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def grid(fingerprints: DataFrame, max_bits: int) -> DataFrame:
    """(cell, home, fp, node): the cells of each fingerprint; home or one step up.

    The cell is the number of the part above the counts of its segments, two
    bits each: one bit of the segment alone gives 01, both give 10.
    """
    parts = (max_bits + 2) // 2  # one part differs by 1 at most
    even = F.col("fp").bitwiseAND(F.lit(LOW_BITS))
    odd = F.shiftrightunsigned("fp", 1).bitwiseAND(F.lit(LOW_BITS))
    counts = even.bitwiseXOR(odd).bitwiseOR(F.shiftleft(even.bitwiseAND(odd), 1))
    edges = [64 * p // parts // 2 * 2 for p in range(parts)] + [64]
    cells = []
    for part, (low, high) in enumerate(zip(edges[:-1], edges[1:])):
        mask = _signed(((1 << (high - low)) - 1) << low)
        own = F.col("counts").bitwiseAND(F.lit(mask))
        cells.append(F.struct(F.lit(part).alias("part"), own.alias("cell"), F.lit(True).alias("home")))
        for bit in range(low, high, 2):
            two = F.shiftrightunsigned("counts", bit + 1).bitwiseAND(F.lit(1)) == 1
            up = own.bitwiseXOR(_step(bit))
            cells.append(F.when(~two, F.struct(F.lit(part).alias("part"), up.alias("cell"), F.lit(False).alias("home"))))
    spread = fingerprints.select("fp", "node", counts.alias("counts"))
    return spread.select("fp", "node", F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())).alias("c")).select(
        "c.part", "c.cell", "c.home", "fp", "node"
    )


def _step(bit: int):
    """Takes the count at this place one up: 00 to 01, 01 to 10."""
    low = F.shiftrightunsigned("counts", bit).bitwiseAND(F.lit(1)) == 1
    return F.when(low, F.lit(_signed(3 << bit))).otherwise(F.lit(_signed(1 << bit)))


def _links(max_bits: int):
    """Sorted grid rows of a partition to links: a spanning tree for each cell."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            now = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            last = np.flatnonzero(_new_cells(now)[1:])
            if not len(last):
                rest = now
                continue
            cut = int(last[-1]) + 1
            yield from found(now.slice(0, cut))
            rest = now.slice(cut).combine_chunks()
        if rest is not None and rest.num_rows:
            yield from found(rest)

    def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
        home, node = table.column("home").to_numpy(), table.column("node").to_numpy()
        fp = table.column("fp").to_numpy().view(np.uint64)
        first = np.flatnonzero(_new_cells(table))
        sizes = np.diff(np.append(first, table.num_rows))
        left, right = [], []
        for low in sorted({s for s in sizes.tolist() if 1 < s <= 16}):
            begin = first[sizes == low][:, None]
            a, b = np.triu_indices(low, 1)
            left.append((begin + a).ravel())
            right.append((begin + b).ravel())
        if left:
            a, b = np.concatenate(left), np.concatenate(right)
            close = (home[a] | home[b]) & (np.bitwise_count(fp[a] ^ fp[b]) <= max_bits) & (node[a] != node[b])
            yield _pairs(node[a[close]], node[b[close]])
        for begin, size in zip(first[sizes > 16].tolist(), sizes[sizes > 16].tolist()):
            own = slice(begin, begin + size)
            yield _pairs(*tree(fp[own], home[own], node[own], max_bits))

    return run


def _new_cells(table: pa.Table) -> np.ndarray:
    """Rows at which another cell begins."""
    new = np.ones(table.num_rows, bool)
    new[1:] = False
    for name in ("part", "cell", "held", "value"):
        column = table.column(name).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return new


def tree(fp: np.ndarray, home: np.ndarray, node: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what a cell's links join, fewer than rows; in blocks.

    Rows already joined to the one at hand are not compared again.
    """
    label = np.arange(len(fp))
    left, right = [], []
    homes = np.flatnonzero(home)
    for begin in range(0, len(homes), BLOCK_ROWS):
        block = homes[begin:begin + BLOCK_ROWS]
        for other in range(0, len(fp), BLOCK_ROWS):
            span = np.arange(other, min(other + BLOCK_ROWS, len(fp)))
            close = np.bitwise_count(fp[block, None] ^ fp[None, span]) <= max_bits
            for i in np.flatnonzero(close.any(axis=1)).tolist():
                a = block[i]
                near = span[close[i]]
                apart = near[label[near] != label[a]]
                while len(apart):
                    b = apart[0]
                    if node[a] != node[b]:
                        left.append(node[a])
                        right.append(node[b])
                    label[label == label[b]] = label[a]
                    apart = apart[label[apart] != label[a]]
    return np.array(left, np.int64), np.array(right, np.int64)


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _further(held: int, parts: int) -> list[int]:
    """Masks that each hold one more of ``parts`` shares of the bits not yet held."""
    free = [b for b in range(64) if not held >> b & 1]
    edges = [len(free) * p // parts for p in range(parts + 1)]
    return [held | sum(1 << b for b in free[a:z]) for a, z in zip(edges[:-1], edges[1:])]


def _parted(crowded: DataFrame, max_bits: int) -> DataFrame:
    """Rows of crowded cells in smaller ones: of one share more than bits may
    differ, two linked fingerprints have one share of the open bits alike."""
    masks = [r.held for r in crowded.select("held").distinct().collect()]  # a few for each round
    further = F.create_map(*[
        x for m in masks for x in (F.lit(m), F.array(*[F.lit(_signed(h)) for h in _further(m % 2**64, max_bits + 1)]))
    ])
    again = crowded.select("part", "cell", "home", "fp", "node", F.explode(F.element_at(further, F.col("held"))).alias("held"))
    return again.withColumn("value", F.col("fp").bitwiseAND(F.col("held")))


def bounded_cells(cells: DataFrame, max_bits: int) -> DataFrame:
    """Grid rows in cells of at most ``CELL_ROWS`` rows, in which every link
    has at least one. ``held`` and ``value``: further bits that a cell shares."""
    keys = ["part", "cell", "held", "value"]
    open_rows = stored(cells.withColumns({"held": F.lit(0).cast("long"), "value": F.lit(0).cast("long")}), "grid")
    ready = None
    while True:
        sizes = open_rows.groupBy(*keys).agg(F.count("*").alias("size"))
        many = (F.col("size") > CELL_ROWS) & (F.bit_count("held") < 64 - OPEN_BITS)
        crowded = stored(sizes.where(many).drop("size"), "crowded")
        some = not crowded.isEmpty()
        small = open_rows.join(crowded, keys, "left_anti") if some else open_rows
        ready = small if ready is None else ready.unionByName(small)
        if not some:
            return ready
        open_rows = stored(_parted(open_rows.join(crowded, keys, "left_semi"), max_bits), "grid").select(*open_rows.columns)


def links(distinct: DataFrame, max_bits: int = 3) -> DataFrame:
    """(a, b): nodes whose fingerprints are linked, enough of them to join all
    that are. ``distinct``: (fp, node), one row for each fingerprint."""
    keys = ["part", "cell", "held", "value"]
    cells = bounded_cells(grid(distinct, max_bits), max_bits)
    return (
        cells.repartition(*keys).sortWithinPartitions(*keys)
        .mapInArrow(_links(max_bits), "a long, b long")
    )


def near_duplicates(marked: DataFrame, max_bits: int = 3) -> DataFrame:
    """(row, fingerprint, group, component_id) from the rows of ``fingerprints``.

    ``row`` must hold ``doc_id``. The component is the smallest id reachable.
    Equal fingerprints are one node, so copies make no links. ``group`` tells
    groups apart also where no row has an id.
    """
    marked = stored(marked, "fingerprints")
    least = F.min("row.doc_id").cast("long").alias("least")
    distinct = stored(marked.groupBy(F.col("fingerprint").alias("fp")).agg(least), "nodes")
    nodes = distinct.select("fp", F.col("fp").alias("node"))
    roots = components.roots(stored(links(nodes, max_bits), "links"))
    member = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("fingerprint"), F.coalesce("root", "fp").alias("group"), "least"
    )
    names = member.groupBy("group").agg(F.min("least").alias("component_id"))
    named = member.drop("least").join(names, "group")
    return marked.join(named, "fingerprint").select("row", "fingerprint", "group", "component_id")
