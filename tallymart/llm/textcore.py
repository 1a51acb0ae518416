"""Whole Arrow columns of text as arrays: words, lines and their hashes.

A column is one run of bytes with a start for each row, so words, lines and
windows of all its rows come from a few array operations instead of a loop.
Everything here works on the rows of one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# separators of words: the blank and the five control characters 09 to 0D
BLANKS = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
#: stands for a NULL id: behind all others
LAST_ID = 2**63 - 1

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_BYTE_VALUES = np.random.default_rng(20).integers(1, 2**64 - 1, 256, dtype=np.uint64) | np.uint64(1)
#: longer spans are hashed one by one
LONG_SPAN = 64
_LANES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_powers = {True: np.ones(1, np.uint64), False: np.ones(1, np.uint64)}


def members(chars: bytes, inverted: bool = False) -> np.ndarray:
    """A table of 256 truth values: which bytes belong."""
    table = np.zeros(256, bool)
    table[np.frombuffer(chars, np.uint8)] = True
    return ~table if inverted else table


WORD_BYTES = members(BLANKS, inverted=True)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, every other byte as it is."""
    return _LOWER[data]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and the n + 1 row starts; NULL is an empty row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_binary(column.type)):
        column = column.cast(pa.binary() if "binary" in str(column.type) else pa.string())
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) else b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, starts, data = column.buffers()
    bounds = np.frombuffer(starts, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), bounds
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def ids_of(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), LAST_ID).to_numpy(zero_copy_only=False)


def slices(batch: pa.RecordBatch, text: str, size: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of text; one row at least."""
    _, bounds = column_bytes(batch.column(text))
    row = 0
    while row < batch.num_rows:
        end = int(np.searchsorted(bounds, bounds[row] + size, "right")) - 1
        end = min(max(end, row + 1), batch.num_rows)
        yield batch.slice(row, end - row)
        row = end


class Units:
    """Pieces of rows (words or lines): byte starts and ends, and row bounds."""

    def __init__(self, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray):
        self.starts, self.ends, self.bounds = starts, ends, bounds

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def words(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray = WORD_BYTES) -> Units:
    """Longest runs of member bytes; a run ends with its row."""
    return stretches(inside[data], bounds)


def stretches(held: np.ndarray, bounds: np.ndarray) -> Units:
    """Longest runs of held bytes; a run ends with its row."""
    first, last = held.copy(), held.copy()
    first[1:] &= ~held[:-1]
    last[:-1] &= ~held[1:]
    edges = bounds[(bounds > 0) & (bounds < len(held))]
    first[edges] = held[edges]
    last[edges - 1] = held[edges - 1]
    starts = np.flatnonzero(first)
    return Units(starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds))


def lines(data: np.ndarray, bounds: np.ndarray) -> Units:
    """What line feeds part; a row without any is one line, also an empty row."""
    feeds = np.flatnonzero(data == 0x0A)
    before = np.searchsorted(feeds, bounds)
    rows = len(bounds) - 1
    row = np.repeat(np.arange(rows), np.diff(before))
    starts = np.empty(len(feeds) + rows, np.int64)
    ends = np.empty(len(feeds) + rows, np.int64)
    at = before + np.arange(rows + 1)
    starts[at[:-1]] = bounds[:-1]
    starts[np.arange(len(feeds)) + row + 1] = feeds + 1
    ends[at[1:] - 1] = bounds[1:]
    ends[np.arange(len(feeds)) + row] = feeds
    return Units(starts, ends, at)


def mixed(values: np.ndarray) -> np.ndarray:
    """The values with their bits spread (finishing steps of splitmix64)."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def _power_table(size: int, inverse: bool) -> np.ndarray:
    if len(_powers[inverse]) < size:
        table = np.full(size + size // 4, _INVERSE if inverse else _BASE, np.uint64)
        table[0] = 1
        _powers[inverse] = np.multiply.accumulate(table)
    return _powers[inverse][:size]


class Prefixes:
    """Hash of any stretch of a sequence of 64-bit values in constant time.

    For stretches of up to some hundred values, such as windows: of longer ones
    some orders of two values cancel each other, see ``span_hashes``.
    """

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _power_table(len(values), False), out=self.sums[1:])

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        found = self.sums[ends] - self.sums[starts]
        found *= _power_table(len(self.sums), True)[starts]
        return mixed(found)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span, whatever its length.

    Eight bytes at a time are mixed in, so there is no sum that an order of
    letters could cancel; a long span takes its XXH64.
    """
    sizes = ends - starts
    found = mixed(sizes.astype(np.uint64) + np.uint64(_BASE))
    lanes = np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    some = np.flatnonzero(sizes <= LONG_SPAN)
    for at in range(0, LONG_SPAN, 8):
        some = some[sizes[some] > at]
        lane = lanes[starts[some] + at] & _LANES[np.minimum(sizes[some] - at, 8)]
        found[some] = mixed(found[some] ^ lane)
    view = memoryview(np.ascontiguousarray(data))
    for k in np.flatnonzero(sizes > LONG_SPAN).tolist():
        found[k] = xxhash.xxh64_intdigest(view[starts[k]:ends[k]])
    return found


def unit_hashes(data: np.ndarray, units: Units) -> np.ndarray:
    """64-bit hash of the bytes of each word or line."""
    return span_hashes(data, units.starts, units.ends)


def window_starts(units: Units, size: int) -> np.ndarray:
    """Units at which ``size`` units of the same row start."""
    room = np.repeat(units.bounds[1:], units.counts) - np.arange(len(units))
    return np.flatnonzero(room >= size)


def covered(starts: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which of ``total`` positions lie in a window from one of the starts."""
    steps = np.zeros(total + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + size, total), -1)
    return np.cumsum(steps[:-1]) > 0


def joined(data: np.ndarray, bounds: np.ndarray, units: Units, kept: np.ndarray, between: bytes) -> pa.Array:
    """Per row the kept units with one byte between them.

    The byte behind a unit takes the separator, so every unit that another
    one of its row follows must have such a byte: words and lines do.
    """
    data = data.copy()
    steps = np.zeros(len(data) + 1, np.int8)
    np.add.at(steps, units.starts[kept], 1)
    np.subtract.at(steps, units.ends[kept], 1)
    mask = np.cumsum(steps[:-1], dtype=np.int8) > 0
    chosen = np.flatnonzero(kept)
    row = units.rows[chosen]
    followed = chosen[:-1][row[:-1] == row[1:]]
    mask[units.ends[followed]] = True
    data[units.ends[followed]] = between[0]
    return rows_of(data, mask, bounds)


def rows_of(data: np.ndarray, mask: np.ndarray, bounds: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """The masked bytes, in the rows they came from."""
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return from_bounds(data[mask].tobytes(), sums[bounds], kind or pa.string())


def from_bounds(data: bytes, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A string or binary column from its bytes and row bounds."""
    return pa.Array.from_buffers(
        kind, len(bounds) - 1,
        [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(data)],
    )
