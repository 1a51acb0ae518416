"""Removal of repeated runs of units (words, lines), by anchors and extension.

Two runs of ``size`` equal units share an anchor, whatever stands around them;
how anchors are chosen is the caller's. First the anchors that several
documents hold are found. Only around those, up to ``size - 1`` units to both
sides, are the windows of ``size`` units compared between documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm import repeats, textcore
from tallymart.llm.repeats import ID, TEXT
from tallymart.llm.textcore import Prefixes, Units


@dataclass(frozen=True)
class Runs:
    """``units``: bytes and row bounds to units. ``anchors``: unit hashes and
    units to (unit positions, hashes); an anchor at unit p speaks for the
    windows that start from p - ``reach`` to p. ``render``: bytes, bounds,
    units and the mask of removed units to the column of remaining text."""

    size: int
    reach: int
    units: Callable[[np.ndarray, np.ndarray], Units]
    anchors: Callable[[np.ndarray, Units], tuple[np.ndarray, np.ndarray]]
    render: Callable[[np.ndarray, np.ndarray, Units, np.ndarray], tuple[np.ndarray, pa.Array]]

    def read(self, batch: pa.RecordBatch):
        data, bounds = textcore.column_bytes(batch.column(TEXT))
        units = self.units(data, bounds)
        return data, bounds, units, textcore.unit_hashes(data, units)

    def windows(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return Prefixes(hashes).between(starts, starts + self.size)

    def near(self, units: Units, positions: np.ndarray) -> np.ndarray:
        """Starts of the windows that the anchors at these units speak for."""
        if not len(positions):
            return positions
        steps = np.zeros(len(units) + 1, np.int32)
        np.add.at(steps, np.maximum(positions - self.reach, 0), 1)
        np.add.at(steps, positions + 1, -1)
        marked = np.cumsum(steps[:-1]) > 0
        starts = textcore.window_starts(units, self.size)
        return starts[marked[starts]]

    def alone(self, data: np.ndarray, bounds: np.ndarray, units: Units, hashes: np.ndarray):
        """(starts, sizes, keys) of shorter windows that count as well, each its own anchor."""
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)

    def anchor_keys(self, batch: pa.RecordBatch):
        for part in textcore.slices(batch, TEXT):
            data, bounds, units, hashes = self.read(part)
            positions, keys = self.anchors(hashes, units)
            starts, _, own = self.alone(data, bounds, units, hashes)
            places = np.concatenate([positions, starts])
            yield textcore.ids_of(part.column(ID))[units.rows[places]], np.concatenate([keys, own])

    def window_keys(self, batch: pa.RecordBatch):
        for part in textcore.slices(batch, TEXT):
            data, bounds, units, hashes = self.read(part)
            positions, keys = self.anchors(hashes, units)
            known = repeats.listed(part.column("__keys"))
            shared = repeats.held_by_row(units.rows[positions], keys, *known)
            starts = self.near(units, positions[shared])
            single, _, own = self.alone(data, bounds, units, hashes)
            again = repeats.held_by_row(units.rows[single], own, *known)
            places = np.concatenate([starts, single[again]])
            yield textcore.ids_of(part.column(ID))[units.rows[places]], np.concatenate([self.windows(hashes, starts), own[again]])

    def removed(
        self, part: pa.RecordBatch, data: np.ndarray, bounds: np.ndarray, units: Units, hashes: np.ndarray
    ) -> np.ndarray:
        """Units in windows that an earlier document, or an earlier place of the same one, holds too."""
        rows = units.rows
        known = repeats.listed(part.column("__keys"))
        starts = textcore.window_starts(units, self.size)
        starts = starts[np.isin(rows[starts], known[0])]
        starts = starts[repeats.held_by_row(rows[starts], self.windows(hashes, starts), *known)]

        positions, keys = self.anchors(hashes, units)
        twice = repeats.paired(rows[positions], keys)
        _, where, counts = np.unique(twice, return_inverse=True, return_counts=True)
        inner = self.near(units, positions[counts[where] > 1])
        again = repeats.paired(rows[inner], self.windows(hashes, inner))
        first = np.zeros(len(inner), bool)
        first[np.unique(again, return_index=True)[1]] = True
        gone = textcore.covered(np.concatenate([starts, inner[~first]]), self.size, len(units))

        starts, sizes, own = self.alone(data, bounds, units, hashes)
        later = np.ones(len(starts), bool)
        later[np.unique(repeats.paired(rows[starts], own), return_index=True)[1]] = False
        later |= repeats.held_by_row(rows[starts], own, *known)
        for size in np.unique(sizes[later]).tolist():
            gone |= textcore.covered(starts[later & (sizes == size)], size, len(units))
        return gone

    def clean(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textcore.slices(batch, TEXT):
                data, bounds, units, hashes = self.read(part)
                removed = self.removed(part, data, bounds, units, hashes)
                gone, kept = self.render(data, bounds, units, removed)
                columns = {n: part.column(n) for n in part.schema.names if n not in (TEXT, "__keys")}
                columns |= {
                    "__units": pa.array(units.counts, pa.int64()),
                    "__removed": pa.array(gone, pa.int64()),
                    "__kept": kept,
                }
                yield pa.RecordBatch.from_pydict(columns)


def sums_by_row(flags: np.ndarray, units: Units) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[units.bounds])


def without_repeats(docs: DataFrame, runs: Runs, id_col: str, text_col: str) -> DataFrame:
    """(row, n_units, n_removed, kept_text); row holds all columns but the text.

    The texts are shuffled once, by id: both joins read the same exchange.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("__row")
    source = repeats.texts(docs, id_col, text_col, rest)
    buckets = repeats.reducers(source)
    anchors = repeats.shared_keys(source, runs.anchor_keys, False, buckets)
    near = repeats.with_keys(source, anchors, "inner")
    windows = repeats.shared_keys(near, runs.window_keys, True, buckets)
    kinds = f"{ID} long, __row {rest_type(source)}, __units long, __removed long, __kept string"
    return (
        repeats.with_keys(source, windows, "left")
        .mapInArrow(runs.clean, kinds)
        .select(
            F.col("__row").alias("row"), F.col("__units").alias("n_units"),
            F.col("__removed").alias("n_removed"), F.col("__kept").alias("kept_text"),
        )
    )


def rest_type(source: DataFrame) -> str:
    return source.schema["__row"].dataType.simpleString()
