"""Occurrences of benchmark passages in documents, by Wu-Manber search.

The benchmark's windows of words are the test strings, all of one length per
search. A table over hashed blocks of two words tells how far the window may
move on: most blocks occur in no test string and skip almost its whole length.
Where the shift is zero, the bucket of the block, which ends the window, names
the test strings to look at, and these are compared word for word. Stretches of
many documents are searched in step, one array operation for a step of all.

Defined results: NULL text has no words, so no hits; benchmark rows without an
id or without words are left out; repeated benchmark rows count once, a
repeated document each time; texts may be of any length; an empty benchmark hits
nothing, an empty table has an empty result. Other columns are passed on in
``row``, under any names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm import textcore
from tallymart.llm.repeats import TEXT
from tallymart.llm.store import stored
from tallymart.llm.textcore import Units, members

# words: digits, letters a-z after lowering, and everything beyond ASCII
WORD_BYTES = members(bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100)))
#: bytes of benchmark text that tasks hold at once; more is searched in rounds
BLOCK_BYTES = 4 << 20
TABLE_BITS = 20
STRETCH = 256

FOUND = "array<struct<`start`:int,`end`:int>>"


def read(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, Units, np.ndarray]:
    data = textcore.lowered(data)
    units = textcore.words(data, bounds, WORD_BYTES)
    return data, units, textcore.unit_hashes(data, units)


def block_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return textcore.mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)


class Search:
    """Test strings of one length in words."""

    def __init__(self, size: int):
        self.size = size
        self.block = min(2, size)
        self.items: dict[tuple[bytes, ...], set[str]] = defaultdict(set)

    def add(self, pattern: tuple[bytes, ...], item: str) -> None:
        self.items[pattern].add(item)

    def prepare(self) -> None:
        patterns = list(self.items)
        flat = [w for p in patterns for w in p]
        data = np.frombuffer(b"".join(flat), np.uint8)
        ends = np.cumsum([len(w) for w in flat])
        units = Units(np.concatenate([[0], ends[:-1]]), ends, np.array([0, len(flat)]))
        hashes = textcore.unit_hashes(data, units).reshape(-1, self.size)
        self.shift = np.full(1 << TABLE_BITS, min(self.size - self.block + 1, 255), np.uint8)
        for last in range(self.block - 1, self.size):
            slots = self.slots(hashes[:, last - 1], hashes[:, last])
            np.minimum.at(self.shift, slots, np.uint8(min(self.size - 1 - last, 255)))
        suffix = self.suffix(hashes[:, self.size - 2], hashes[:, self.size - 1])
        order = np.argsort(suffix)
        self.suffixes, self.order = suffix[order], order
        self.patterns = [tuple(p) for p in patterns]

    def suffix(self, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        return block_hash(before, at) if self.block == 2 else textcore.mixed(at)

    def slots(self, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (self.suffix(before, at) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def candidates(self, hashes: np.ndarray, units: Units) -> np.ndarray:
        """Last words of the windows whose shift is zero."""
        begin = units.bounds[:-1] + self.size - 1
        sizes = np.maximum(units.bounds[1:] - begin, 0)
        pieces = -(-sizes // STRETCH)
        number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = np.repeat(begin, pieces) + number * STRETCH
        limit = np.minimum(at + STRETCH, np.repeat(units.bounds[1:], pieces))
        found = []
        while len(at):
            steps = self.shift[self.slots(hashes[at - 1], hashes[at])]
            found.append(at[steps == 0])
            at = at + np.maximum(steps, 1)
            on = at < limit
            at, limit = at[on], limit[on]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def hits(self, data: np.ndarray, units: Units, hashes: np.ndarray) -> tuple[list[int], list[set[str]]]:
        """First words of the occurrences, and the items that hold them."""
        last = self.candidates(hashes, units)
        key = self.suffix(hashes[last - 1], hashes[last])
        low, high = np.searchsorted(self.suffixes, key, "left"), np.searchsorted(self.suffixes, key, "right")
        starts, items = [], []
        text = data.tobytes()
        for end, a, b in zip(last[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist()):
            first = end - self.size + 1
            window = tuple(text[x:y] for x, y in zip(units.starts[first:end + 1].tolist(), units.ends[first:end + 1].tolist()))
            for place in range(a, b):
                if self.patterns[self.order[place]] == window:
                    starts.append(first)
                    items.append(self.items[window])
                    break  # test strings are distinct
        return starts, items


def searches(rows: Iterable[tuple[str, str]], window: int) -> list[Search]:
    """(item, text) rows to one search per length of test string."""
    by_size: dict[int, Search] = {}
    for item, text in rows:
        data, units, _ = read(*textcore.column_bytes(pa.array([text], pa.string())))
        raw = data.tobytes()
        words = [raw[a:b] for a, b in zip(units.starts.tolist(), units.ends.tolist())]
        size = min(window, len(words))
        if size:
            search = by_size.setdefault(size, Search(size))
            for i in range(len(words) - size + 1):
                search.add(tuple(words[i:i + size]), item)
    for search in by_size.values():
        search.prepare()
    return [by_size[size] for size in sorted(by_size)]


def scan(found: list[Search]):
    """For ``mapInArrow``: adds the hits of these searches to earlier ones."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textcore.slices(batch, TEXT):
                yield from one(part)

    def one(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, bounds = textcore.column_bytes(part.column(TEXT))
        data, units, hashes = read(data, bounds)
        spans = part.column("__spans").to_pylist()
        names = [set(x) for x in part.column("__items").to_pylist()]
        steps = np.zeros(len(units) + 1, np.int32)
        for row, known in enumerate(spans):
            for span in known:
                steps[units.bounds[row] + span["start"]] += 1
                steps[units.bounds[row] + span["end"]] -= 1
        rows = units.rows
        for search in found:
            starts, items = search.hits(data, units, hashes)
            starts = np.array(starts, np.int64)
            np.add.at(steps, starts, 1)
            np.add.at(steps, starts + search.size, -1)
            for row, item in zip(rows[starts].tolist(), items):
                names[row] |= item
        hit = np.cumsum(steps[:-1]) > 0
        edge = np.zeros(len(hit), bool)
        edge[units.bounds[:-1][units.counts > 0]] = True
        first = np.flatnonzero(hit & (edge | ~np.concatenate([[False], hit[:-1]])))
        last = np.flatnonzero(hit & np.concatenate([edge[1:] | ~hit[1:], [True]])[:len(hit)]) + 1
        spans = [[] for _ in range(part.num_rows)]
        for row, a, b in zip(rows[first].tolist(), first.tolist(), last.tolist()):
            spans[row].append({"start": a - int(units.bounds[row]), "end": b - int(units.bounds[row])})
        columns = {n: part.column(n) for n in part.schema.names}
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        columns["__words"] = pa.array(units.counts, pa.int64())
        columns["__spans"] = pa.array(spans, kind)
        columns["__items"] = pa.array([sorted(x) for x in names], pa.list_(pa.string()))
        yield pa.RecordBatch.from_pydict(columns)

    return run


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
    doc_text: str = "text", window: int = 13, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(row, text, n_words, spans, items): word spans [start, end) that hold
    test strings, and the ids of the items these come from, as sorted strings.

    The benchmark is the query set: tasks hold ``block_bytes`` of its text at
    a time, and a larger one takes several rounds over the documents.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != doc_text]).alias("__row")
    source = docs.select(
        rest, F.col(doc_text).cast("string").alias(TEXT), F.lit(0).cast("long").alias("__words"),
        F.lit(None).cast(FOUND).alias("__spans"), F.lit(None).cast("array<string>").alias("__items"),
    ).select("__row", TEXT, "__words", F.coalesce("__spans", F.array().cast(FOUND)).alias("__spans"),
             F.coalesce("__items", F.array().cast("array<string>")).alias("__items"))
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    items = items.where("item is not null and text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = max(1, -(-size // block_bytes))
    for number in range(rounds):
        block = items.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == number).collect()
        source = source.mapInArrow(scan(searches(block, window)), source.schema)
        if number < rounds - 1:
            source = stored(source, "hits")
    return source.select(
        F.col("__row").alias("row"), F.col(TEXT).alias("text"), F.col("__words").alias("n_words"),
        F.col("__spans").alias("spans"), F.col("__items").alias("items"),
    )


def contamination(found: DataFrame) -> DataFrame:
    """Adds n_hit, and contaminated: a twentieth of the words or more are hit."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.withColumn("n_hit", hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )
