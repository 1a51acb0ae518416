"""Repeated runs of words, found by difference-cover anchors.

Positions whose remainder modulo the period lies in a difference cover are
anchor positions: for any two positions some shift below the period takes both
to anchor positions. So two equal windows, wherever they start, hold the same
short anchor at the same place, if the window is longer than the period. Only
anchors are hashed and shuffled; windows around shared ones are then compared.

Defined results: NULL text has no words, a NULL id comes last, rows that share
an id never count against each other (each row is compared with itself and with
smaller ids), other columns are passed on in ``row`` under their own names.
Texts may be of any length; an empty table has an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallymart.llm import textcore
from tallymart.llm.runs import Runs, sums_by_row, without_repeats
from tallymart.llm.textcore import Units


def difference_cover(period: int) -> tuple[int, ...]:
    """A small set of remainders that has every difference modulo the period.

    Taken greedily: always the remainder that adds most new differences, the
    smallest one among equals.
    """
    chosen: list[int] = [0]
    missing = set(range(1, period))

    def added(c: int) -> set[int]:
        return {d for x in chosen for d in ((c - x) % period, (x - c) % period)} & missing

    while missing:
        best = max((c for c in range(period) if c not in chosen), key=lambda c: (len(added(c)), -c))
        missing -= added(best)
        chosen.append(best)
    return tuple(sorted(chosen))


def cover_anchors(period: int, length: int):
    """Hashes of ``length`` units at the cover positions of each row."""
    at = np.zeros(period, bool)
    at[list(difference_cover(period))] = True

    def anchors(hashes: np.ndarray, units: Units) -> tuple[np.ndarray, np.ndarray]:
        starts = textcore.window_starts(units, length)
        offsets = starts - units.bounds[:-1][units.rows[starts]]
        starts = starts[at[offsets % period]]
        return starts, textcore.Prefixes(hashes).between(starts, starts + length)

    return anchors


def render(data: np.ndarray, bounds: np.ndarray, units: Units, removed: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    return sums_by_row(removed, units), textcore.joined(data, bounds, units, ~removed, b" ")


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, period: int = 13
) -> DataFrame:
    """(row, n_units, n_removed, kept_text): words, those removed, the rest with single blanks."""
    if not 1 <= period <= window:
        raise ValueError("the period must lie between 1 and the window")
    anchors = cover_anchors(period, window - period + 1)
    return without_repeats(docs, Runs(window, period - 1, textcore.words, anchors, render), id_col, text_col)
