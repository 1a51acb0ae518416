"""Spelling variants: words one edit apart, grouped under their frequent forms.

Two words one edit apart, the shorter of m letters, share their first m // 2
letters or their last m - m // 2, whichever half the edit is not in. So a word
goes to a block for its own length and one for the length below, each by its
first and by its last letters, and all pairs meet in a block of words that
agree at one end and differ in length by one at most. Blocks too large for a
task are cut the same way again, by half of what the words do not yet share,
until what is left is a letter or two; each pair meets in one block only.

Within a block the sorted list of what is not shared is scanned for all its
words at once. A word's edit matrix needs three cells in each row, as a path
further off the diagonal is beyond one edit. Neighbours in the sorted list
reuse the rows up to their longest common prefix: the rows of a range of words
that begin alike are computed once, and a range in whose row no cell is one or
less is skipped whole.

Defined results: NULL text has no words. Repeated rows count each. A word
without near words has no form and is its own root. Ties go to the smallest
word in code-point order. Words may be of any length. Empty tables give empty
results. Columns other than id and text are not read, so their names never
clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm import textcore
from tallymart.llm.repeats import TEXT
from tallymart.llm.store import stored

#: words and cells of a block that is not cut further; blocks with at most one
#: letter left that is not shared cannot grow beyond some 8,000 words
BLOCK_WORDS, BLOCK_CELLS = 4096, 1 << 20
#: cells and rows that are scanned in one go, and open ranges held at once
BATCH_CELLS, BATCH_WORDS, OPEN_RANGES = 1 << 20, 1 << 15, 1 << 21
#: distinct words that a task holds before it sends their counts on
HELD_WORDS = 300_000
#: longer words are hashed one by one
LONG_WORD = 48

_LETTERS = textcore.members(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
# In UTF-8 the letters from U+00C0 to U+00FF are the byte C3 and one more byte.
_LEAD = 0xC3


def _crc_table() -> np.ndarray:
    """Steps of CRC-32 for each byte, from its reversed polynomial."""
    values = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        values = np.where(values & 1, (values >> 1) ^ np.uint32(0xEDB88320), values >> 1)
    return values


_CRC = _crc_table()


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each stretch, carried on from the checksum of what comes before it."""
    state = ~before.astype(np.uint32)
    sizes = ends - starts
    long = np.flatnonzero(sizes > LONG_WORD)
    order = np.argsort(sizes)
    order = order[: len(order) - len(long)]
    begin = np.searchsorted(sizes[order], np.arange(LONG_WORD + 1), "right")
    for place in range(int(sizes[order[-1]]) if len(order) else 0):
        rows = order[begin[place]:]
        state[rows] = _CRC[(state[rows] ^ data[starts[rows] + place]) & np.uint32(255)] ^ (state[rows] >> np.uint32(8))
    found = ~state
    for row in long.tolist():
        found[row] = zlib.crc32(data[starts[row]:ends[row]].tobytes(), int(before[row]))
    return found


def altered_words(data: np.ndarray, bounds: np.ndarray, ids: list[bytes], one_in: int, least: int) -> pa.Array:
    """The words of a batch of texts that have ``least`` letters, lower-cased,
    one letter less where the checksum of id and word says so."""
    data = textcore.lowered(data)
    held = _LETTERS[data] | (data == _LEAD)
    held[1:] |= data[:-1] == _LEAD
    units = textcore.stretches(held, bounds)
    tops = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=tops[1:])
    sizes = tops[units.ends] - tops[units.starts]
    chosen = sizes >= least
    starts, ends, sizes, rows = units.starts[chosen], units.ends[chosen], sizes[chosen], units.rows[chosen]
    kept = np.ones(len(starts), bool)
    gone = np.zeros(len(data), bool)
    if one_in:
        before = np.array([zlib.crc32(i + b":") for i in ids], np.uint32)
        sums = checksums(data, starts, ends, before[rows])
        for k in np.flatnonzero(sums % np.uint32(one_in) == 0).tolist():
            if sizes[k] == least:
                kept[k] = False
                continue
            letters = starts[k] + np.flatnonzero((data[starts[k]:ends[k]] & 0xC0) != 0x80)
            place = int(sums[k]) % int(sizes[k])
            gone[letters[place]:letters[place + 1] if place + 1 < len(letters) else ends[k]] = True
    starts, ends = starts[kept], ends[kept]
    mask = np.zeros(len(data) + 1, np.int8)
    mask[starts] += 1
    np.subtract.at(mask, ends, 1)
    mask = (np.cumsum(mask[:-1], dtype=np.int8) > 0) & ~gone
    tops[1:] = np.cumsum(mask)
    return textcore.from_bounds(data[mask].tobytes(), np.append(tops[starts], tops[-1]), pa.string())


def _counted(one_in: int, least: int):
    """For ``mapInArrow``: texts to words with their numbers in the task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in textcore.slices(batch, TEXT):
                ids = [b"" if i is None else i.encode() for i in part.column("__id").to_pylist()]
                found = altered_words(*textcore.column_bytes(part.column(TEXT)), ids, one_in, least).value_counts()
                held.append(pa.table({"word": found.field("values"), "n": found.field("counts")}))
                size += len(found)
                if size > HELD_WORDS:
                    held, size = [_summed(held)], 0
                    if held[0].num_rows > HELD_WORDS // 2:
                        yield from held.pop().to_batches(max_chunksize=10_000)
        if held:
            yield from _summed(held).to_batches(max_chunksize=10_000)

    def _summed(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

    return run


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_length: int = 6, min_count: int = 5, alter_one_in: int = 0,
) -> DataFrame:
    """(word, n): lower-cased runs of letters (A to Z, U+00C0 to U+00FF) of at
    least ``min_length`` letters that occur ``min_count`` times or more.

    ``alter_one_in`` misspells on purpose: where it divides the CRC-32 of
    "id:word", the letter at the checksum modulo the length is left out.
    A row without an id counts as one with an empty id.
    """
    source = docs.select(F.col(id_col).cast("string").alias("__id"), F.col(text_col).cast("string").alias(TEXT))
    counted = source.mapInArrow(_counted(alter_one_in, min_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# -- blocks --------------------------------------------------------------------

_KEY = ("m", "front", "back", "head", "tail")


def _block(front: Column, back: Column, apart: Column) -> Column:
    """The block of words that share ``front`` first and ``back`` last letters.
    A pair with ``apart`` or more common first letters is left to another block,
    unless that is below zero."""
    return F.struct(
        front.alias("front"), back.alias("back"), F.substring("word", F.lit(1), front).alias("head"),
        F.substring("word", F.char_length("word") - back + 1, back).alias("tail"), apart.alias("apart"),
    )


def _cut(words: DataFrame) -> DataFrame:
    """Each row in the two blocks that share half more of what is left."""
    left = F.col("m") - F.col("front") - F.col("back")
    half = F.floor(left / 2).cast("int")
    by_head = _block(F.col("front") + half, F.col("back"), F.col("apart"))
    by_tail = _block(F.col("front"), F.col("back") + left - half, F.col("front") + half)
    cut = words.select("word", "n", "m", F.explode(F.array(by_head, by_tail)).alias("b"))
    return cut.select("word", "n", "m", "b.*")


def _sized(blocks: DataFrame) -> DataFrame:
    """Rows of blocks in which a pair can meet, with the number of words."""
    short = F.count_if(F.char_length("word") == F.col("m"))
    sizes = blocks.groupBy(*_KEY).agg(F.count("*").alias("size"), short.alias("short"))
    return blocks.join(sizes.where("size > 1 and short > 0").drop("short"), list(_KEY))


def _blocks(words: DataFrame) -> list[DataFrame]:
    """The words in blocks that a task can hold, as stored frames."""
    length = F.char_length("word")
    start = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("m"))
    zero = F.lit(0)
    open_rows = start.select("word", "n", "m", zero.alias("front"), zero.alias("back"), F.lit(-1).alias("apart"))
    left = F.col("m") - F.col("front") - F.col("back")
    fits = (F.col("size") <= BLOCK_WORDS) & (F.col("size") * (left + 1) <= BLOCK_CELLS) | (left <= 1)
    ready = []
    while True:
        sized = stored(_sized(_cut(open_rows)), "blocks")
        ready.append(sized.where(fits).drop("size"))
        open_rows = sized.where(~fits).drop("size", "head", "tail")
        if open_rows.isEmpty():
            return ready


# -- scan ----------------------------------------------------------------------


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all rows, and the row bounds."""
    sizes = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(column.to_pylist()).encode("utf-32-le"), np.uint32)
    return points, np.concatenate([[0], np.cumsum(sizes)])


def near_pairs(rests: pa.Array, blocks: np.ndarray, left: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows (of ``left`` letters, of ``left`` or one more) one edit
    apart, and the number of their common first letters.

    Rows are sorted by block, then by ``rests``, what their words do not share;
    ``blocks`` numbers the block of each row.
    """
    count, width = len(rests), left + 1
    points, bounds = _letters(rests)
    sizes = np.diff(bounds)
    letters = np.zeros((count, width + 1), np.uint32)
    letters[np.repeat(np.arange(count), sizes), np.arange(len(points)) - np.repeat(bounds[:-1], sizes)] = points
    same = np.zeros((count, width), bool)
    same[1:] = letters[1:, :width] == letters[:-1, :width]
    same[1:] &= (blocks[1:] == blocks[:-1])[:, None]
    common = np.where(same.all(axis=1), width, np.argmin(same, axis=1))
    new = np.ones(count, bool)
    new[1:] = blocks[1:] != blocks[:-1]
    heads = [np.flatnonzero(new | (common < depth)) for depth in range(width + 1)]
    edges = np.append(heads[0], count)
    first = edges[np.searchsorted(heads[0], np.arange(count), "right") - 1]
    last = edges[np.searchsorted(heads[0], np.arange(count), "right")]
    asked = np.flatnonzero(sizes == left)
    cells = np.stack([np.full(len(asked), 2), np.zeros(len(asked)), np.ones(len(asked))]).astype(np.int8)
    found = []
    waiting = [(0, asked, first[asked], last[asked], cells)]
    while waiting:
        depth, query, begin, end, cells = waiting.pop()
        if depth > left:
            done = (sizes[begin] == depth) & (cells[0] == 1)
            found.append((query[done], begin[done]))
            continue
        low = np.searchsorted(heads[depth + 1], begin)
        parts = np.searchsorted(heads[depth + 1], end) - low
        total = int(parts.sum())
        if total > OPEN_RANGES and len(query) > 1:
            half = len(query) // 2
            for cut in (slice(half), slice(half, None)):
                waiting.append((depth, query[cut], begin[cut], end[cut], cells[:, cut]))
            continue
        if depth == left:  # a row that ends here comes first in its range
            done = (sizes[begin] == depth) & (cells[1] == 1)
            found.append((query[done], begin[done]))
        own = np.repeat(np.arange(len(query)), parts)
        at = np.repeat(low - (np.cumsum(parts) - parts), parts) + np.arange(total)
        begin, stop = heads[depth + 1][at], np.append(heads[depth + 1], count)[at + 1]
        end, query, cells = np.minimum(stop, end[own]), query[own], cells[:, own]
        letter = letters[begin, depth]
        near = np.full((3, total), 2, np.int8)
        for k in range(3):  # the cell for depth + k letters of the query
            place = depth + k
            if place > left:
                continue
            best = cells[k + 1] + 1 if k < 2 else np.full(total, 2, np.int8)
            if place:
                best = np.minimum(best, cells[k] + (letters[query, place - 1] != letter))
            if k:
                best = np.minimum(best, near[k - 1] + 1)
            near[k] = np.minimum(best, 2)
        # words that end before this letter are done; ranges beyond one edit are skipped
        going = (near.min(axis=0) <= 1) & (sizes[begin] > depth)
        waiting.append((depth + 1, query[going], begin[going], end[going], near[:, going]))
    a, b = [np.concatenate(side) for side in zip(*found)]
    alike = np.column_stack([letters[a] == letters[b], np.zeros(len(a), bool)])
    return a, b, np.argmin(alike, axis=1)


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: rows sorted by block to pairs, both ways round."""

    def scanned(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for batch in table.combine_chunks().to_batches():
            # blocks with as much left are scanned together
            left = pc.subtract(pc.subtract(batch.column("m"), batch.column("front")), batch.column("back")).to_numpy()
            cuts = np.flatnonzero(np.diff(left)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(left)]):
                yield from found(batch.slice(a, b - a), int(left[a]))

    def found(rows: pa.RecordBatch, left: int) -> Iterator[pa.RecordBatch]:
        word, n = rows.column("word"), rows.column("n")
        a, b, alike = near_pairs(rows.column("rest"), rows.column("block").to_numpy(), left)
        apart, front = rows.column("apart").to_numpy()[a], rows.column("front").to_numpy()[a]
        keep = (apart < 0) | (front + alike < apart)
        a, b = a[keep], b[keep]
        longer = pc.utf8_length(rows.column("rest")).to_numpy()[b] > left
        # a longer word is not asked itself, so its pairs are turned here
        ask, near = np.concatenate([a, b[longer]]), np.concatenate([b, a[longer]])
        for begin in range(0, len(ask), 50_000):
            cut = slice(begin, begin + 50_000)
            yield pa.RecordBatch.from_arrays(
                [word.take(pa.array(ask[cut])), word.take(pa.array(near[cut])), n.take(pa.array(near[cut]))], ["word", "near", "near_n"])

    held: list[pa.RecordBatch] = []
    rows = cells = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        cells += pc.sum(pc.add(batch.column("m"), 1)).as_py() or 0
        if rows < BATCH_WORDS and cells < BATCH_CELLS:
            continue
        table = pa.Table.from_batches(held)
        block = table.column("block").to_numpy()
        edges = np.flatnonzero(np.diff(block))
        if len(edges):
            cut = int(edges[-1]) + 1
            yield from scanned(table.slice(0, cut))
            table = table.slice(cut).combine_chunks()
            held, rows = table.to_batches(), table.num_rows
            cells = pc.sum(pc.add(table.column("m"), 1)).as_py()
    if rows:
        yield from scanned(pa.Table.from_batches(held))


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): all words one insertion, deletion or replacement
    of a letter apart, each pair both ways round, once. ``words``: (word, n)."""
    rest = F.substring("word", F.col("front") + 1, F.char_length("word") - F.col("front") - F.col("back"))
    kind = "word string, near string, near_n long"
    found = None
    for blocks in _blocks(words):
        # numbers within a task: a new one where the sorted key changes
        dealt = blocks.select(*_KEY, "word", "n", "apart", rest.alias("rest")).repartition(*_KEY)
        ordered = dealt.sortWithinPartitions("m", "front", "back", "head", "tail", "rest")
        pairs = ordered.mapInArrow(_numbered, kind)
        found = pairs if found is None else found.union(pairs)
    return found


def _numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the blocks of a task, then scans them."""

    def run() -> Iterator[pa.RecordBatch]:
        last, number = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            for name in _KEY:
                column = batch.column(name)
                new[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
            first = [batch.column(k)[0].as_py() for k in _KEY]
            new[0] = first != last
            last = [batch.column(k)[batch.num_rows - 1].as_py() for k in _KEY]
            numbers = number + np.cumsum(new)
            number = int(numbers[-1])
            kept = ["word", "n", "m", "front", "back", "apart", "rest"]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in kept], pa.array(numbers)], [*kept, "block"])

    return _scan(run())


# -- forms ---------------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of forms. Every form is more frequent
    than its word, so there are no rings; a round halves the way that is left."""
    step = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = step.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        ahead = step.join(on, "root", "left")
        step = stored(ahead.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        step = step.drop("moved")


def variants(words: DataFrame, factor: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of ``words`` (word, n).

    A word's form is the most frequent word near it, if that is ``factor``
    times as frequent or more; its root is the last of the chain of forms.
    """
    words = stored(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    often = -F.col("best.less") >= factor * F.col("n")
    judged = stored(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(often, F.col("best.near")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n"),
        ), "forms",
    )
    roots = _roots(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
