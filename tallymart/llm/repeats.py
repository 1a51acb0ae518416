"""Which keys of a document other documents hold too: exact, one shuffle.

A key is a 64-bit hash of something in a text, such as a run of words. Rows of
keys never leave a task one by one. A task judges the keys of its own batch
first and sends each distinct key once, for the smallest document of the batch
that holds it; the documents behind it are settled there. So a key that a third
of all documents hold reaches its reducer once per batch, and what comes back
for a document goes by its id. Keys travel in bundles, one binary column for
all keys that a batch sends to one reducer.

What comes back is bundled too, by the id's own bucket, so that each document
gets one row, however many reducers there are.

Ids are integers below 2^62. A row without an id gets one from a hash of its
text, behind all others. Rows that share an id never count as copies of each
other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.textcore import LAST_ID, column_bytes, mixed

#: the texts of a frame while operators of this package work on it
ID, TEXT = "__id", "__text"
#: keys that a task judges at once: about 50 MB with what sorting needs
GROUP_KEYS = 500_000
#: bytes of text for each reducer of keys
REDUCER_BYTES = 32 << 20

BUNDLE = "bucket int, settled boolean, ids binary, places binary, keys binary"
FOUND = f"{ID} long, __keys binary"

Extract = Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]]


def texts(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """Id and text under names that no other column has."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), behind(text_col)).alias(ID),
        F.col(text_col).cast("string").alias(TEXT),
        *more,
    )


def behind(text_col: str) -> Column:
    """An id behind all given ones, the same for equal texts."""
    return F.lit(LAST_ID) - F.xxhash64(F.col(text_col).cast("string")).bitwiseAND(F.lit(2**60 - 1))


def reducers(docs: DataFrame) -> int:
    """Partitions for the keys of these texts: in proportion to their bytes."""
    size = docs.agg(F.sum(F.octet_length(TEXT))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-size // REDUCER_BYTES))


def judged(ids: np.ndarray, keys: np.ndarray, later: bool):
    """(order, group starts, smallest ids, which entries others hold too).

    ``later``: held by a document with a smaller id; else by any other one.
    """
    order = np.argsort(keys)
    sorted_keys, sorted_ids = keys[order], ids[order]
    first = np.ones(len(keys), bool)
    first[1:] = sorted_keys[1:] != sorted_keys[:-1]
    starts = np.flatnonzero(first)
    smallest = np.minimum.reduceat(sorted_ids, starts)
    group = np.cumsum(first) - 1
    if later:
        held = sorted_ids > smallest[group]
    else:
        held = (smallest != np.maximum.reduceat(sorted_ids, starts))[group]
    return sorted_keys, sorted_ids, starts, smallest, held


def _bundle(bucket: int, settled: bool, ids: np.ndarray, keys: np.ndarray) -> dict:
    known, places = np.unique(ids, return_inverse=True)
    kind = np.uint16 if len(known) <= 65536 else np.uint32
    return {
        "bucket": bucket, "settled": settled, "ids": known.tobytes(),
        "places": places.astype(kind).tobytes(), "keys": keys.tobytes(),
    }


def unbundled(row: dict, kind: type = np.uint64) -> tuple[np.ndarray, np.ndarray]:
    known, values = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["keys"], kind)
    return known[np.frombuffer(row["places"], np.uint16 if len(known) <= 65536 else np.uint32)], values


def in_batches(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for begin in range(0, len(rows), 200):
        yield pa.RecordBatch.from_pylist(rows[begin:begin + 200], schema)


BUNDLE_SCHEMA = pa.schema([
    ("bucket", pa.int32()), ("settled", pa.bool_()), ("ids", pa.binary()), ("places", pa.binary()), ("keys", pa.binary()),
])


def by_bucket(shares: np.ndarray, values: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> list[dict]:
    """Bundles of (id, key), one for each bucket; ``shares``: where values part."""
    order = np.argsort(values, kind="stable")
    edges = np.concatenate([[0], np.searchsorted(values[order], shares), [len(order)]])
    rows = []
    for bucket in np.flatnonzero(np.diff(edges)):
        part = order[edges[bucket]:edges[bucket + 1]]
        rows.append(_bundle(int(bucket), False, ids[part], keys[part]))
    return rows


def shares_of(buckets: int) -> np.ndarray:
    """Where the range of 64-bit hashes parts into equal buckets."""
    return (np.arange(1, buckets, dtype=object) * 2**64 // buckets).astype(np.uint64)


def _send(ids: np.ndarray, keys: np.ndarray, later: bool, buckets: int) -> Iterator[pa.RecordBatch]:
    sorted_keys, sorted_ids, starts, smallest, held = judged(ids, keys, later)
    unique = sorted_keys[starts]
    rows = by_bucket(shares_of(buckets), unique, smallest, unique)
    if held.any():
        rows.append(_bundle(int(sorted_keys[0] % np.uint64(buckets)), True, sorted_ids[held], sorted_keys[held]))
    yield from in_batches(rows, BUNDLE_SCHEMA)


def spread(extract: Extract, later: bool, buckets: int):
    """For ``mapInArrow``: texts to bundles of keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            for ids, keys in extract(batch):
                if len(keys):
                    waiting.append((ids, keys))
                    size += len(keys)
                if size >= GROUP_KEYS:
                    yield from _send(*map(np.concatenate, zip(*waiting)), later, buckets)
                    waiting, size = [], 0
        if size:
            yield from _send(*map(np.concatenate, zip(*waiting)), later, buckets)

    return run


def by_id(ids: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    """One row for each id, with its keys as one binary value."""
    order = np.argsort(ids, kind="stable")
    ids, keys = ids[order], keys[order]
    starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, int)
    bounds = np.append(starts, len(ids)) * keys.itemsize
    values = pa.Array.from_buffers(
        pa.binary(), len(starts),
        [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(keys.tobytes())],
    )
    return pa.RecordBatch.from_arrays([pa.array(ids[starts]), values], [ID, "__keys"])


def back(ids: np.ndarray, keys: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Keys on their way to their documents: bundles by a hash of the id."""
    values = mixed(ids.astype(np.uint64))
    yield from in_batches(by_bucket(shares_of(buckets), values, ids, keys), BUNDLE_SCHEMA)


def gather(later: bool, buckets: int):
    """For ``mapInArrow``: judges the bundles of a partition, sends keys back."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = []
        for batch in batches:
            for row in batch.to_pylist():
                ids, keys = unbundled(row)
                if row["settled"]:
                    yield from back(ids, keys, buckets)
                else:
                    waiting.append((ids, keys))
        if waiting:
            ids, keys = map(np.concatenate, zip(*waiting))
            sorted_keys, sorted_ids, _, _, held = judged(ids, keys, later)
            yield from back(sorted_ids[held], sorted_keys[held], buckets)

    return run


def sorted_by_id(kind: type = np.uint64):
    """For ``mapInArrow``: the bundles of a partition to one row for each id."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = [unbundled(row, kind) for batch in batches for row in batch.to_pylist()]
        if waiting:
            yield by_id(*map(np.concatenate, zip(*waiting)))

    return run


def delivered(bundles: DataFrame, buckets: int, kind: type = np.uint64) -> DataFrame:
    return bundles.repartitionById(buckets, "bucket").mapInArrow(sorted_by_id(kind), FOUND)


def shared_keys(docs: DataFrame, extract: Extract, later: bool, buckets: int) -> DataFrame:
    """(id, __keys binary): the keys of a document that others hold too."""
    judged_keys = (
        docs.mapInArrow(spread(extract, later, buckets), BUNDLE)
        .repartitionById(buckets, "bucket")
        .mapInArrow(gather(later, buckets), BUNDLE)
    )
    return delivered(judged_keys, buckets)


def with_keys(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Texts beside the keys found for them."""
    return docs.join(found, ID, how)


def listed(column: pa.Array, kind: type = np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every key in a column of binary values that hold keys."""
    data, bounds = column_bytes(column)
    keys = np.frombuffer(data.tobytes(), kind)
    return np.repeat(np.arange(len(column)), np.diff(bounds) // np.dtype(kind).itemsize), keys


def held_by_row(rows: np.ndarray, keys: np.ndarray, known_rows: np.ndarray, known_keys: np.ndarray) -> np.ndarray:
    """Which (row, key) pairs are among the known pairs."""
    if not len(known_keys):
        return np.zeros(len(keys), bool)
    return np.isin(paired(rows, keys), paired(known_rows, known_keys), kind="sort")


def paired(rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """One hash for a row of the batch and a key."""
    return mixed(keys ^ mixed((rows + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
