"""Vectors as short codes: each part by the index of its codebook's nearest entry.

Codebooks come from rounds of assigning parts to entries and averaging, sped up
by metric trees. A task cuts its vectors into chunks and builds one tree for
each part of a chunk, by the anchors hierarchy: a chunk's points are gathered
around anchors, each new anchor being the point farthest from the widest one's
centre and taking over what lies closer to it; the anchors are merged pairwise
into a tree above them, and split the same way below them. Every ball keeps the
sum and the number of its points. A round walks each tree with a list of
candidate entries. A ball inherits its parent's list and strikes entries that
another one beats everywhere in the ball; once a single entry is left it takes
the ball's sum and number without looking at a point. Points are compared only
in leaves, in whole numbers, so results do not depend on chunks.

Trees are built once and stored; a round reads them and sends back sums, a few
numbers for each entry and component.

Defined results: vectors that are NULL or hold a NULL or a component that is not
finite are dropped. Rows whose vector has another length than that of the first
row (by id) stay without a code. Components are whole numbers after scaling,
held within bounds that keep every error in 64 bits. Rows that repeat count
each; equal ids start in the order of their vectors, rows without an id come
last. With fewer rows than entries the codebooks are smaller. A length that the
number of parts does not divide is an error. Other columns are passed on in
``row``, under any names. An empty table has an empty result.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.store import stored

#: vectors that share a tree, and points that a leaf may hold
CHUNK_ROWS, LEAF_ROWS = 2048, 48
#: relative slack of comparisons in floating point: a candidate is struck only beyond it
SLACK = 1e-9
VECTOR = "__vector"


def whole_numbers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), within the bounds that keep squared errors in 64 bits."""
    most = math.isqrt(2**62 // max(1, vectors.shape[1])) // 2
    return np.floor(np.clip(vectors.astype(np.float64) * scale, -most, most)).astype(np.int64)


# -- trees ---------------------------------------------------------------------


def _anchored(points: np.ndarray) -> list[np.ndarray]:
    """Groups of points around about the square root of their number of anchors."""
    count = len(points)
    first = int(np.argmax(((points - points.mean(axis=0)) ** 2).sum(axis=1)))
    owner = np.zeros(count, np.int64)
    gap = np.sqrt(((points - points[first]) ** 2).sum(axis=1))
    anchors, radii = [first], [float(gap.max())]
    while len(anchors) < math.isqrt(count):
        widest = int(np.argmax(radii))
        if not radii[widest]:
            break
        own = np.flatnonzero(owner == widest)
        new = int(own[np.argmax(gap[own])])
        between = np.sqrt(((points[anchors] - points[new]) ** 2).sum(axis=1))
        # a point nearer to its anchor than half the way to the new one stays
        asked = np.flatnonzero(gap > between[owner] / 2)
        far = np.sqrt(((points[asked] - points[new]) ** 2).sum(axis=1))
        taken = far < gap[asked]
        lost = np.unique(owner[asked[taken]])
        owner[asked[taken]], gap[asked[taken]] = len(anchors), far[taken]
        anchors.append(new)
        radii.append(0.0)
        for a in [*lost.tolist(), len(anchors) - 1]:
            radii[a] = float(gap[owner == a].max(initial=0.0))
    order = np.argsort(owner, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(owner[order])) + 1)


class _Growing:
    """Balls while a tree is built: centre, radius and number; children or points."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        self.counts: list[int] = []
        self.below: list[tuple[int, int] | np.ndarray] = []

    def _add(self, centre: np.ndarray, radius: float, count: int, below) -> int:
        self.centres.append(centre)
        self.radii.append(radius)
        self.counts.append(count)
        self.below.append(below)
        return len(self.radii) - 1

    def ball(self, members: np.ndarray) -> int:
        points = self.points[members]
        if len(members) > LEAF_ROWS:
            groups = _anchored(points)
            if len(groups) > 1:
                return self._merged([self.ball(members[g]) for g in groups])
        centre = points.mean(axis=0)
        return self._add(centre, float(np.sqrt(((points - centre) ** 2).sum(axis=1).max())), len(members), members)

    def _merged(self, balls: list[int]) -> int:
        """Joins the two balls with the smallest common ball until one is left."""
        centres = np.array([self.centres[b] for b in balls])
        radii, counts = np.array([self.radii[b] for b in balls]), np.array([float(self.counts[b]) for b in balls])
        names = list(balls)

        def common(i: int) -> np.ndarray:
            apart = np.sqrt(((centres - centres[i]) ** 2).sum(axis=1))
            share = counts / (counts + counts[i])  # how far the centre moves from i
            return np.maximum(share * apart + radii[i], (1 - share) * apart + radii)

        cost = np.array([common(i) for i in range(len(balls))])
        np.fill_diagonal(cost, np.inf)
        for _ in range(len(balls) - 1):
            i, j = divmod(int(np.argmin(cost)), len(balls))
            total = counts[i] + counts[j]
            radius = float(cost[i, j])
            centre = (centres[i] * counts[i] + centres[j] * counts[j]) / total
            names[i] = self._add(centre, radius, int(total), (names[i], names[j]))
            centres[i], radii[i], counts[i] = centre, radius, total
            cost[j, :] = cost[:, j] = np.inf
            gone = np.isinf(cost[i]) & (np.arange(len(balls)) != i)
            fresh = common(i)
            fresh[gone] = np.inf
            fresh[i] = np.inf
            cost[i, :] = cost[:, i] = fresh
        return names[i] if len(balls) > 1 else names[0]


@dataclass
class Tree:
    """Balls of one part of a chunk. ``points`` lie in the order of the leaves;
    ball k holds points ``starts[k]`` to ``ends[k]``; leaves have no children."""

    points: np.ndarray
    order: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    left: np.ndarray
    right: np.ndarray
    radii: np.ndarray
    sums: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray) -> Tree:
        growing = _Growing(points.astype(np.float64))
        root = growing.ball(np.arange(len(points)))
        order, starts, ends, left, right, radii = [], [], [], [], [], []
        waiting = [(root, -1, False)]
        filled = 0
        while waiting:
            ball, parent, is_right = waiting.pop()
            own = len(starts)
            if parent >= 0:
                (right if is_right else left)[parent] = own
            starts.append(filled)
            ends.append(filled + growing.counts[ball])
            left.append(-1)
            right.append(-1)
            radii.append(growing.radii[ball])
            below = growing.below[ball]
            if isinstance(below, tuple):  # the left child is laid out first
                waiting += [(below[1], own, True), (below[0], own, False)]
            else:
                order.append(below)
                filled += len(below)
        order = np.concatenate(order)
        laid = points[order].astype(np.int32)
        tops = np.zeros((len(laid) + 1, laid.shape[1]), np.int64)
        np.cumsum(laid, axis=0, out=tops[1:])
        begin, end = np.array(starts), np.array(ends)
        return cls(laid, order, begin, end, np.array(left), np.array(right), np.array(radii), tops[end] - tops[begin])

    def packed(self) -> bytes:
        file = io.BytesIO()
        np.savez(file, **self.__dict__)
        return file.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as arrays:
            return cls(**{n: arrays[n] for n in arrays.files})

    def owners(self, entries: np.ndarray, sums: np.ndarray, counts: np.ndarray, codes: np.ndarray | None) -> None:
        """Adds the points of each entry to ``sums`` and ``counts``, and writes
        the entries of points, in the order of the input, to ``codes``."""
        real = entries.astype(np.float64)
        norms = (real * real).sum(axis=1)
        # an entry equal to an earlier one loses every tie
        repeated = np.array([any((entries[j] == entries[k]).all() for j in range(k)) for k in range(len(entries))])
        balls, listed = np.zeros(1, np.int64), ~repeated[None, :]
        while len(balls):
            sizes = self.ends[balls] - self.starts[balls]
            centres = self.sums[balls] / sizes[:, None]
            far = norms - 2 * centres @ real.T  # squared distance but for a term that all share
            best = np.argmin(np.where(listed, far, np.inf), axis=1)
            ways = real[None, :, :] - real[best][:, None, :]
            along = 2 * (ways * centres[:, None, :]).sum(axis=2)
            reach = 2 * self.radii[balls][:, None] * np.sqrt((ways * ways).sum(axis=2))
            ahead = norms[None, :] - norms[best][:, None]
            slack = SLACK * (np.abs(along) + reach + norms[None, :] + norms[best][:, None] + 1)
            listed = listed & ~(along + reach + slack < ahead)
            whole = listed.sum(axis=1) == 1
            np.add.at(sums, best[whole], self.sums[balls[whole]])
            np.add.at(counts, best[whole], sizes[whole])
            if codes is not None:
                codes[self.order[_spans(self.starts[balls[whole]], sizes[whole])]] = np.repeat(best[whole], sizes[whole])
            leaf = ~whole & (self.left[balls] < 0)
            if leaf.any():
                self._compared(balls[leaf], listed[leaf], entries, sums, counts, codes)
            inner = ~whole & ~leaf
            listed = np.repeat(listed[inner], 2, axis=0)
            balls = np.stack([self.left[balls[inner]], self.right[balls[inner]]], axis=1).ravel()

    def _compared(self, balls, listed, entries, sums, counts, codes) -> None:
        sizes = self.ends[balls] - self.starts[balls]
        at = _spans(self.starts[balls], sizes)
        points, listed = self.points[at], np.repeat(listed, sizes, axis=0)
        far = np.full(listed.shape, np.iinfo(np.int64).max)
        for k in np.flatnonzero(listed.any(axis=0)).tolist():
            rows = listed[:, k]
            far[rows, k] = ((points[rows] - entries[k]) ** 2).sum(axis=1)
        nearest = np.argmin(far, axis=1)  # the lowest index among equals
        np.add.at(sums, nearest, points)
        counts += np.bincount(nearest, minlength=len(entries))
        if codes is not None:
            codes[self.order[at]] = nearest


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of the spans, one span after the other."""
    tops = np.cumsum(sizes)
    return np.repeat(starts - (tops - sizes), sizes) + np.arange(tops[-1] if len(tops) else 0)


# -- Spark ---------------------------------------------------------------------


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _chunks(width: int, parts: int, scale: int):
    """For ``mapInArrow``: rows to chunks of rows with a tree for each part."""

    def chunk(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        numbers = whole_numbers(_matrix(table.column(VECTOR).combine_chunks(), width), scale)
        rows = table.column("__row").combine_chunks()
        trees = [Tree.of(p).packed() for p in np.split(numbers, parts, axis=1)]
        listed = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
        return pa.RecordBatch.from_arrays([listed, pa.array([trees], pa.list_(pa.binary()))], ["__rows", "__trees"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, CHUNK_ROWS - size)
                held.append(part)
                size += part.num_rows
                batch = batch.slice(part.num_rows)
                if size == CHUNK_ROWS:
                    yield chunk(held)
                    held, size = [], 0
        if size:
            yield chunk(held)

    return run


def _sums(books: list[np.ndarray]):
    """For ``mapInArrow``: stored trees to sums, one set of rows for each task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros_like(b) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for trees in batch.column("__trees"):
                for part, tree in enumerate(trees):
                    Tree.unpacked(tree.as_py()).owners(books[part], sums[part], counts[part], None)
        for part, (total, count) in enumerate(zip(sums, counts)):
            values = np.column_stack([count, total])
            entry, place = np.indices(values.shape)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(np.full(values.size, part), pa.int32()), "entry": pa.array(entry.ravel(), pa.int32()),
                "place": pa.array(place.ravel() - 1, pa.int32()), "total": pa.array(values.ravel(), pa.int64()),
            })

    return run


def _codes(books: list[np.ndarray]):
    """For ``mapInArrow``: stored trees to the rows with their codes and errors."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, trees in enumerate(batch.column("__trees")):
                rows = batch.column("__rows").slice(k, 1).flatten()
                codes = np.zeros((len(rows), len(books)), np.int64)
                error = np.zeros(len(rows), np.int64)
                for part, data in enumerate(trees):
                    tree, book = Tree.unpacked(data.as_py()), books[part]
                    tree.owners(book, np.zeros_like(book), np.zeros(len(book), np.int64), codes[:, part])
                    error[tree.order] += ((tree.points - book[codes[tree.order, part]]) ** 2).sum(axis=1)
                bounds = pa.array(np.arange(len(rows) + 1) * len(books), pa.int32())
                listed = pa.ListArray.from_arrays(bounds, pa.array(codes.ravel(), pa.int32()))
                yield pa.RecordBatch.from_arrays([rows, listed, pa.array(error)], ["__row", "__code", "__error"])

    return run


def _usable(vector: str) -> Column:
    """Not NULL, no NULL inside, every component finite."""
    numbers = F.col(vector)
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return numbers.isNotNull() & finite


@dataclass
class Codes:
    """``found``: (row, code array<int>, error long); ``books``: for each part
    the final entries, whole numbers, one row for each entry."""

    found: DataFrame
    books: list[np.ndarray]

    def listing(self) -> str:
        """All components by part, entry and position, joined by commas."""
        return ",".join(str(x) for book in self.books for x in book.ravel().tolist())


def vector_codes(
    vectors: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id",
    parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
) -> Codes:
    """Trains codebooks on all vectors and codes all of them.

    What reaches the driver is the first ``entries`` vectors and, in each
    round, ``entries`` sums of each component.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in vectors.columns if c != vector_col]).alias("__row")
    source = vectors.select(
        rest, F.col(f"`{vector_col}`").cast("array<double>").alias(VECTOR), F.col(f"`{id_col}`").alias("__id")
    ).where(_usable(VECTOR))
    first = source.orderBy(F.col("__id").asc_nulls_last(), VECTOR).select(VECTOR).limit(entries).collect()
    width = len(first[0][0]) if first else 0
    if width % parts:
        raise ValueError(f"{parts} parts do not divide vectors of {width} components")
    kind = source.schema["__row"].dataType.simpleString()
    fits = F.size(VECTOR) == width
    chunks = stored(
        source.where(fits).select("__row", VECTOR)
        .mapInArrow(_chunks(width, parts, scale), f"__rows array<{kind}>, __trees array<binary>"), "trees",
    )
    start = [r[0] for r in first if len(r[0]) == width]
    books = np.split(whole_numbers(np.array(start).reshape(len(start), width), scale), parts, axis=1) if first else []
    for _ in range(rounds if width else 0):
        gathered = chunks.mapInArrow(_sums(books), "part int, entry int, place int, total long")
        totals = {
            (r.part, r.entry, r.place): r.total
            for r in gathered.groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect()
        }
        books = [
            np.array([
                [totals[p, k, i] // totals[p, k, -1] for i in range(book.shape[1])] if totals[p, k, -1] else old
                for k, old in enumerate(book)
            ], np.int64)
            for p, book in enumerate(books)
        ]
    coded = chunks.mapInArrow(_codes(books), f"__row {kind}, __code array<int>, __error long")
    odd = source.where(~fits).select("__row", F.lit(None).cast("array<int>"), F.lit(None).cast("long"))
    found = coded.union(odd).toDF("row", "code", "error")
    return Codes(found, books)
