"""Byte strings that an earlier document holds too, by merged shard transforms.

Every window of ``size`` bytes belongs to the smallest hash of its ``anchor``
byte strings, its anchor. Consecutive windows with the same one form a piece.
First only hashes travel: equal pieces of a batch once, for the smallest id.
A piece that a smaller id holds as it is goes whole. Windows can still be shared
by different pieces with one anchor, so the first holders of such pieces are
asked for their bytes. The pieces of one reducer are cut into shards, each shard
gets its Burrows-Wheeler transform, and the transforms are merged by refining
their interleave until it is right for ``size`` bytes. The blocks that are left
are the shared windows. Where too many pieces have one anchor, hashes of their
windows are sent instead, each to its own reducer. Around an anchor with more
pieces than a reducer takes, their hashes too are parted, each by itself.

Defined results: NULL text is empty, a NULL id comes last, rows that share an
id never count against each other, other columns are passed on in ``row``,
under any names. Texts may be of any length; an empty table has an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm import bwt, repeats, runs, textcore
from tallymart.llm.repeats import ID, TEXT

SPANS = np.dtype([("key", "u8"), ("start", "u4"), ("count", "u4")])
#: in a span's count: all windows of the piece
WHOLE = 2**32 - 1
#: bytes of pieces that are merged at once; equal anchors stay together
MERGE_BYTES = 1 << 20
#: bytes of candidate pieces that a task sends as one batch
BATCH_BYTES = 4 << 20

#: distinct pieces around one anchor beyond which their windows are compared one by one
HOT_PIECES = 4096
#: distinct pieces around one anchor beyond which no reducer takes all their hashes
PARTED_PIECES = 1 << 19
#: one of so many texts is looked at to find such anchors
LOOKED_AT = 64

PIECES = "bucket int, settled boolean, ids binary, places binary, keys binary, anchors binary, sizes binary, pieces binary"
_SCHEMA = pa.schema([
    ("bucket", pa.int32()), ("settled", pa.bool_()), ("ids", pa.binary()), ("places", pa.binary()), ("keys", pa.binary()),
    ("anchors", pa.binary()), ("sizes", pa.binary()), ("pieces", pa.binary()),
])


def _minima(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[:len(values) - (width - done)], values[width - done:]) if done < width else values


@dataclass
class Pieces:
    """Of the rows of a batch: first windows, windows, anchors, hashes, rows."""

    starts: np.ndarray
    counts: np.ndarray
    anchors: np.ndarray
    keys: np.ndarray
    rows: np.ndarray


@dataclass(frozen=True)
class ByteRuns:
    size: int
    anchor: int
    hot: int = HOT_PIECES
    #: lower halves of the anchors whose piece hashes go to reducers by themselves
    parted: tuple[int, ...] = ()

    def is_parted(self, anchors: np.ndarray) -> np.ndarray:
        return np.isin(anchors.astype(np.uint32), np.array(self.parted, np.uint32))

    def piece_names(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts to (anchor, key) of each distinct piece of a slice."""
        for batch in batches:
            for part in textcore.slices(batch, TEXT):
                found = self.pieces(*textcore.column_bytes(part.column(TEXT)))
                _, first = np.unique(found.keys, return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.anchors[first].astype(np.uint32).astype(np.int64)), pa.array(found.keys[first].view(np.int64))],
                    ["anchor", "key"],
                )

    def pieces(self, data: np.ndarray, bounds: np.ndarray) -> Pieces:
        none = np.zeros(0, np.int64)
        if len(data) < self.size:
            return Pieces(none, none, none.astype(np.uint64), none.astype(np.uint64), none)
        prefixes = textcore.Prefixes(textcore._BYTE_VALUES[data])
        at = np.arange(len(data) - self.anchor + 1)
        minima = _minima(prefixes.between(at, at + self.anchor), self.size - self.anchor + 1)
        room = np.repeat(bounds[1:], np.diff(bounds))[:len(minima)] - np.arange(len(minima))
        whole = room >= self.size
        new = whole.copy()
        new[1:] &= (minima[1:] != minima[:-1]) | ~whole[:-1]
        firsts = bounds[:-1][np.diff(bounds) >= self.size]
        new[firsts] = True
        last = whole.copy()
        last[:-1] &= new[1:] | ~whole[1:]
        starts, ends = np.flatnonzero(new), np.flatnonzero(last) + 1
        rows = np.searchsorted(bounds, starts, "right") - 1
        keys = textcore.span_hashes(data, starts, ends + self.size - 1)
        # smallest hashes crowd at the low end; mixed again they part evenly
        return Pieces(starts, ends - starts, textcore.mixed(minima[starts]), keys, rows)

    def hashes(self, buckets: int):
        """Texts to bundles of piece hashes and anchors."""

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            waiting, size = [], 0
            for batch in batches:
                for part in textcore.slices(batch, TEXT):
                    found = self.pieces(*textcore.column_bytes(part.column(TEXT)))
                    ids = textcore.ids_of(part.column(ID))[found.rows]
                    waiting.append((ids, found.keys, found.anchors, found.counts + self.size - 1))
                    size += len(ids)
                    if size >= repeats.GROUP_KEYS:
                        yield from self._send(*map(np.concatenate, zip(*waiting)), None, buckets)
                        waiting, size = [], 0
            if size:
                yield from self._send(*map(np.concatenate, zip(*waiting)), None, buckets)

        return run

    def compare(self, buckets: int):
        """Bundles of hashes to whole pieces that go, and to requests, which
        are spans without windows, on their way to their documents.

        Anchors come without their upper half; what that joins by chance is
        compared in vain."""

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            waiting = []
            for batch in batches:
                for row in batch.to_pylist():
                    ids, keys = repeats.unbundled(row, SPANS if row["settled"] else np.uint64)
                    if row["settled"]:
                        yield from repeats.back(ids, keys, buckets)
                    else:
                        anchors = np.frombuffer(row["anchors"], np.uint32)
                        waiting.append((ids, keys, anchors))
            if not waiting:
                return
            ids, keys, anchors = map(np.concatenate, zip(*waiting))
            waiting.clear()
            chosen, settled = self.distinct(ids, keys)
            yield from repeats.back(*settled, buckets)
            parted = self.is_parted(anchors[chosen])
            chosen = np.concatenate([with_partner(chosen[~parted], anchors), chosen[parted]])
            spans = np.zeros(len(chosen), SPANS)
            spans["key"] = keys[chosen]
            _, anchor, counts = np.unique(anchors[chosen], return_inverse=True, return_counts=True)
            spans["start"] = (counts[anchor] > self.hot) | self.is_parted(anchors[chosen])
            yield from repeats.back(ids[chosen], spans, buckets)

        return run

    def spread(self, buckets: int):
        """Texts with their requests to bundles of the pieces asked for; of
        pieces around a hot anchor, which ``start`` of a request tells, of
        their windows' hashes."""

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            waiting, size, hot, hot_size = [], 0, [], 0
            for batch in batches:
                for part in textcore.slices(batch, TEXT):
                    data, bounds = textcore.column_bytes(part.column(TEXT))
                    found = self.pieces(data, bounds)
                    rows, spans = repeats.listed(part.column("__keys"), SPANS)
                    asked = (spans["count"] == 0) & (spans["start"] == 1)
                    if asked.any():
                        crowded = repeats.held_by_row(found.rows, found.keys, rows[asked], spans["key"][asked])
                        counts = found.counts[crowded]
                        at = stretches(found.starts[crowded], counts)
                        hot.append((
                            np.repeat(textcore.ids_of(part.column(ID))[found.rows[crowded]], counts),
                            np.repeat(found.keys[crowded], counts), stretches(np.zeros_like(counts), counts),
                            textcore.Prefixes(textcore._BYTE_VALUES[data]).between(at, at + self.size),
                        ))
                        hot_size += len(at)
                        if hot_size >= repeats.GROUP_KEYS:
                            yield from self._send_windows(*map(np.concatenate, zip(*hot)), buckets)
                            hot, hot_size = [], 0
                    asked = (spans["count"] == 0) & (spans["start"] == 0)
                    shared = repeats.held_by_row(found.rows, found.keys, rows[asked], spans["key"][asked])
                    ids = textcore.ids_of(part.column(ID))[found.rows[shared]]
                    sizes = found.counts[shared] + self.size - 1
                    at = stretches(found.starts[shared], sizes)
                    waiting.append((ids, found.keys[shared], found.anchors[shared], sizes, data[at]))
                    size += len(at)
                    if size >= BATCH_BYTES:
                        yield from self._send(*map(np.concatenate, zip(*waiting)), buckets)
                        waiting, size = [], 0
            if size:
                yield from self._send(*map(np.concatenate, zip(*waiting)), buckets)
            if hot_size:
                yield from self._send_windows(*map(np.concatenate, zip(*hot)), buckets)

        return run

    def _send_windows(self, ids, keys, starts, windows, buckets) -> Iterator[pa.RecordBatch]:
        """Windows of pieces by their own hashes; those that a smaller id of
        the batch holds are settled."""
        later = later_windows(ids, windows)
        rows = []
        if later.any():
            rows.append(self._bundle(int(windows[0] % np.uint64(buckets)), True, *single(ids, keys, starts, later)))
        shares = (windows >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        left = np.flatnonzero(~later)
        left = left[np.argsort(shares[left], kind="stable")]
        cuts = np.flatnonzero(np.concatenate([[True], shares[left][1:] != shares[left][:-1], [True]]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = left[a:b]
            rows.append(self._bundle(int(shares[own[0]]), False, ids[own], keys[own]) | {
                "anchors": windows[own].tobytes(), "sizes": starts[own].astype(np.uint32).tobytes(),
            })
        yield from repeats.in_batches(rows, _SCHEMA)

    def _send(self, ids, keys, anchors, sizes, data, buckets) -> Iterator[pa.RecordBatch]:
        chosen, settled = self.distinct(ids, keys)
        rows = [self._bundle(0, True, *settled)] if len(settled[0]) else []
        if rows:
            rows[0]["bucket"] = int(keys[0] % np.uint64(buckets))
        begins = np.cumsum(sizes) - sizes
        routes = anchors[chosen]
        if data is None:
            routes = np.where(self.is_parted(routes), keys[chosen], routes)
        shares = (routes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        order = np.argsort(shares, kind="stable")
        chosen, shares = chosen[order], shares[order]
        cuts = np.flatnonzero(np.concatenate([[True], shares[1:] != shares[:-1], [True]])) if len(chosen) else []
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = chosen[a:b]
            sent = self._bundle(int(shares[a]), False, ids[own], keys[own])
            if data is None:
                sent |= {"anchors": anchors[own].astype(np.uint32).tobytes()}
            else:
                sent |= {
                    "anchors": anchors[own].tobytes(), "sizes": sizes[own].astype(np.uint32).tobytes(),
                    "pieces": data[stretches(begins[own], sizes[own])].tobytes(),
                }
            rows.append(sent)
        yield from repeats.in_batches(rows, _SCHEMA)

    @staticmethod
    def _bundle(bucket: int, settled: bool, ids: np.ndarray, keys: np.ndarray) -> dict:
        empty = {"anchors": b"", "sizes": b"", "pieces": b""}
        return repeats._bundle(bucket, settled, ids, keys) | empty

    def distinct(self, ids, keys):
        """Places of the piece with the smallest id for each hash; (ids, spans) of the later ones."""
        order = np.lexsort((ids, keys))
        first = np.concatenate([[True], keys[order][1:] != keys[order][:-1]]) if len(order) else np.zeros(0, bool)
        chosen = order[first]
        smallest = ids[chosen][np.cumsum(first) - 1]
        later = order[ids[order] > smallest]
        spans = np.zeros(len(later), SPANS)
        spans["key"], spans["count"] = keys[later], WHOLE
        return chosen, (ids[later], spans)

    def gather(self, buckets: int):
        """Bundles of pieces to spans on their way back to their documents."""

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, spans in self.merged(batches):
                yield from repeats.back(ids, spans, buckets)

        return run

    def merged(self, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        waiting, hot = [], []
        for batch in batches:
            for row in batch.to_pylist():
                ids, keys = repeats.unbundled(row, SPANS if row["settled"] else np.uint64)
                if row["settled"]:
                    yield ids, keys
                elif not row["pieces"]:
                    hot.append((ids, keys, np.frombuffer(row["sizes"], np.uint32), np.frombuffer(row["anchors"], np.uint64)))
                else:
                    waiting.append((
                        ids, keys, np.frombuffer(row["anchors"], np.uint64),
                        np.frombuffer(row["sizes"], np.uint32).astype(np.int64), np.frombuffer(row["pieces"], np.uint8),
                    ))
        if hot:
            ids, keys, starts, windows = map(np.concatenate, zip(*hot))
            hot.clear()
            later = later_windows(ids, windows)
            if later.any():
                yield single(ids, keys, starts, later)
        if not waiting:
            return
        ids, keys, anchors, sizes, data = map(np.concatenate, zip(*waiting))
        waiting.clear()
        chosen, settled = self.distinct(ids, keys)
        if len(settled[0]):
            yield settled
        begins = np.cumsum(sizes) - sizes
        chosen = with_partner(chosen, anchors)
        if not len(chosen):
            return
        group = np.concatenate([[True], anchors[chosen][1:] != anchors[chosen][:-1]])
        sums = np.cumsum(sizes[chosen])
        cuts, reached = [0], 0
        heads = np.append(np.flatnonzero(group), len(chosen))
        for head in heads[1:]:
            if sums[head - 1] - reached >= MERGE_BYTES or head == len(chosen):
                cuts.append(head)
                reached = sums[head - 1]
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = chosen[a:b]
            bounds = np.concatenate([[0], np.cumsum(sizes[own])])
            found = bwt.shared_windows(data[stretches(begins[own], sizes[own])], bounds, ids[own], self.size)
            starts = np.flatnonzero(found & ~np.concatenate([[False], found[:-1]]))
            ends = np.flatnonzero(found & ~np.concatenate([found[1:], [False]])) + 1
            if len(starts):
                piece = np.searchsorted(bounds, starts, "right") - 1
                spans = np.zeros(len(starts), SPANS)
                spans["key"], spans["start"], spans["count"] = keys[own][piece], starts - bounds[piece], ends - starts
                yield ids[own][piece], spans

    def removed(self, part: pa.RecordBatch, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        both = [repeats.listed(part.column(c), SPANS) for c in ("__keys", "__more")]
        rows, spans = map(np.concatenate, zip(*both))
        rows, spans = rows[spans["count"] > 0], spans[spans["count"] > 0]
        steps = np.zeros(len(data) + 1, np.int32)
        if len(spans):
            found = self.pieces(data, bounds)
            here = repeats.paired(found.rows, found.keys)
            order = np.argsort(here)
            wanted = repeats.paired(rows, spans["key"])
            low, high = np.searchsorted(here[order], wanted, "left"), np.searchsorted(here[order], wanted, "right")
            span = np.repeat(np.arange(len(spans)), high - low)
            piece = order[stretches(low, high - low)]
            count = np.where(spans["count"][span] == WHOLE, found.counts[piece], spans["count"][span].astype(np.int64))
            begin = found.starts[piece] + spans["start"][span]
            np.add.at(steps, begin, 1)
            np.add.at(steps, begin + count + (self.size - 1), -1)
        return np.cumsum(steps[:-1]) > 0

    def clean(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textcore.slices(batch, TEXT):
                data, bounds = textcore.column_bytes(part.column(TEXT))
                removed = self.removed(part, data, bounds)
                head = removed.copy()
                head[1:] &= ~removed[:-1]
                inner = bounds[bounds < len(data)]
                head[inner] = removed[inner]

                def sums(flags: np.ndarray) -> pa.Array:
                    return pa.array(np.diff(np.concatenate([[0], np.cumsum(flags)])[bounds]), pa.int64())

                yield pa.RecordBatch.from_pydict({
                    ID: part.column(ID), "__row": part.column("__row"),
                    "__bytes": pa.array(np.diff(bounds), pa.int64()), "__removed": sums(removed), "__spans": sums(head),
                    "__kept": textcore.rows_of(data, ~removed, bounds, pa.binary()),
                })


def later_windows(ids: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Which windows a smaller id holds too."""
    order = np.lexsort((ids, windows))
    _, first, window = np.unique(windows[order], return_index=True, return_inverse=True)
    later = np.zeros(len(ids), bool)
    later[order] = ids[order] > ids[order][first][window]
    return later


def single(ids: np.ndarray, keys: np.ndarray, starts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of one window each."""
    spans = np.zeros(int(chosen.sum()), SPANS)
    spans["key"], spans["start"], spans["count"] = keys[chosen], starts[chosen], 1
    return ids[chosen], spans


def with_partner(chosen: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Distinct pieces by anchor, without those alone with theirs."""
    chosen = chosen[np.argsort(anchors[chosen], kind="stable")]
    same = anchors[chosen][1:] == anchors[chosen][:-1]
    if not len(chosen):
        return chosen
    return chosen[np.concatenate([same, [False]]) | np.concatenate([[False], same])]


def stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of all stretches, one stretch after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def crowded_anchors(source: DataFrame, method: ByteRuns, parted: int, looked_at: int) -> tuple[int, ...]:
    """Lower halves of the anchors with more than ``parted`` distinct pieces, by
    one of ``looked_at`` texts.

    This says only where hashes meet; all are compared, whatever is found. As a
    piece takes some 16 bytes of text, there is at most one such anchor for each
    ``16 * parted`` bytes.
    """
    some = source.select(TEXT).where(F.pmod(F.xxhash64(ID, TEXT), F.lit(looked_at)) == 0)
    pieces = some.mapInArrow(method.piece_names, "anchor long, key long").distinct()
    found = pieces.groupBy("anchor").count().where(F.col("count") > parted // looked_at).collect()
    return tuple(sorted(r.anchor for r in found))


def byte_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 50, anchor: int = 20,
    hot: int = HOT_PIECES, parted: int = PARTED_PIECES, looked_at: int = LOOKED_AT,
) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept): ``kept`` are the remaining bytes.

    ``size`` is even; ``anchor`` is shorter. A longer anchor is rarer by chance
    and gives more pieces. More than ``hot`` pieces around one anchor are compared
    by the hashes of their windows; beyond ``parted``, an estimate from one of
    ``looked_at`` texts, their own hashes are spread as well.
    """
    if size % 2 or not 8 <= anchor <= size - 1:
        raise ValueError("size must be even, the anchor from 8 bytes to less than the size")
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("__row")
    source = repeats.texts(docs, id_col, text_col, rest)
    buckets = repeats.reducers(source)
    method = ByteRuns(size, anchor, hot)
    method = replace(method, parted=crowded_anchors(source, method, parted, looked_at))
    whole = (
        source.mapInArrow(method.hashes(buckets), PIECES)
        .repartitionById(buckets, "bucket")
        .mapInArrow(method.compare(buckets), repeats.BUNDLE)
    )
    whole = repeats.delivered(whole, buckets, SPANS)
    spans = (
        repeats.with_keys(source, whole, "inner")
        .mapInArrow(method.spread(buckets), PIECES)
        .repartitionById(buckets, "bucket")
        .mapInArrow(method.gather(buckets), repeats.BUNDLE)
    )
    spans = repeats.delivered(spans, buckets, SPANS)
    kinds = f"{ID} long, __row {runs.rest_type(source)}, __bytes long, __removed long, __spans long, __kept binary"
    return (
        source.join(whole, ID, "left").join(spans.withColumnRenamed("__keys", "__more"), ID, "left")
        .mapInArrow(method.clean, kinds)
        .select(
            F.col("__row").alias("row"), F.col("__bytes").alias("n_bytes"), F.col("__removed").alias("n_removed"),
            F.col("__spans").alias("n_spans"), F.col("__kept").alias("kept"),
        )
    )
