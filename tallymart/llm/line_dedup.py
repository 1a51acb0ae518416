"""Runs of lines that occurred earlier, found by winnowing.

Of each ``min_lines`` consecutive lines the one with the smallest hash is a
fingerprint, so two equal runs of that length choose the same one. Fingerprints
that several documents hold are joined, the match is extended from there to
both sides, and the later run goes. Runs of fewer lines that together have
``min_words`` words count too; these are compared as they are.

Defined results: lines without a word take no part in runs; such a line goes if
the line with words before it goes. A run is later if it starts in a document
with a larger id or further on in the same document. NULL text is empty, a NULL
id comes last, rows that share an id never count against each other, other
columns are passed on in ``row`` under their own names. Texts may be of any
length; an empty table has an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallymart.llm import textcore
from tallymart.llm.runs import Runs, sums_by_row, without_repeats
from tallymart.llm.textcore import Prefixes, Units


def content_lines(data: np.ndarray, bounds: np.ndarray) -> tuple[Units, np.ndarray]:
    """All lines, and which of them hold a word."""
    every = textcore.lines(data, bounds)
    sums = np.concatenate([[0], np.cumsum(textcore.WORD_BYTES[data])])
    return every, sums[every.ends] > sums[every.starts]


def lines_with_words(data: np.ndarray, bounds: np.ndarray) -> Units:
    every, full = content_lines(data, bounds)
    counts = np.concatenate([[0], np.cumsum(full)])
    return Units(every.starts[full], every.ends[full], counts[every.bounds])


def winnow(size: int):
    """Unit hashes to the minima of all windows, the last one among equals."""

    def anchors(hashes: np.ndarray, units: Units) -> tuple[np.ndarray, np.ndarray]:
        starts = textcore.window_starts(units, size)
        if not len(starts):
            return starts, hashes[:0]
        seen = np.lib.stride_tricks.sliding_window_view(hashes, size)[starts][:, ::-1]
        chosen = np.unique(starts + size - 1 - seen.argmin(axis=1))
        return chosen, textcore.mixed(hashes[chosen])  # minima crowd at the low end

    return anchors


@dataclass(frozen=True)
class LineRuns(Runs):
    words: int

    def alone(self, data: np.ndarray, bounds: np.ndarray, units: Units, hashes: np.ndarray):
        """Runs of fewer lines, long enough by their words."""
        begins = textcore.words(data, bounds).starts
        sums = np.concatenate([[0], np.cumsum(np.searchsorted(begins, units.ends) - np.searchsorted(begins, units.starts))])
        prefixes = Prefixes(hashes)
        found = [super().alone(data, bounds, units, hashes)]
        for size in range(1, self.size):
            starts = textcore.window_starts(units, size)
            starts = starts[sums[starts + size] - sums[starts] >= self.words]
            keys = textcore.mixed(prefixes.between(starts, starts + size) + np.uint64(size))
            found.append((starts, np.full(len(starts), size), keys))
        return tuple(map(np.concatenate, zip(*found)))


def render(data: np.ndarray, bounds: np.ndarray, units: Units, removed: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    every, full = content_lines(data, bounds)
    last = np.cumsum(full) - 1  # the line with words at or before each line
    same_row = (last >= 0) & (last >= units.bounds[every.rows])
    gone = np.zeros(len(every), bool)
    gone[same_row] = removed[last[same_row]]
    return sums_by_row(removed, units), textcore.joined(data, bounds, every, ~gone, b"\n")


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 3, min_words: int = 50
) -> DataFrame:
    """(row, n_units, n_removed, kept_text): lines with words, those removed, the rest.

    A run counts from ``min_lines`` lines or ``min_words`` words.
    """
    runs = LineRuns(min_lines, min_lines - 1, lines_with_words, winnow(min_lines), render, min_words)
    return without_repeats(docs, runs, id_col, text_col)
