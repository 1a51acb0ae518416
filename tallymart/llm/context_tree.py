"""Scores of texts by context-tree weighting over bytes, beside a word baseline.

A byte is eight binary decisions, each below those made before. For every
decision and every context, the bytes before, from none to DEPTH of them, the
texts to learn from give the number of zeros and ones, and by these the
probability of the whole sequence under the estimate of Krichevsky and
Trofimov. A context's weighted probability is half that, and half the product
of its longer contexts' weighted ones, bottom up; so all depths are mixed, each
by how well it foretold the texts learned from. Top down the same weights give
the probability of the next bit. A context that was never seen foretells
nothing: its bits count a half.

Counts and probabilities are tables, one row for each context and decision that
occurs, and grow with the texts. A chunk of texts asks for each five-byte
string and each word in it once; the answers meet its texts again by the chunk.

A text is its UTF-8 bytes, A to Z lower-cased, and an end, the byte FF, which no
text holds; ends are also what stands before its first byte. The probabilities
of all texts therefore add up to one.

Defined results: NULL text is empty and has its end alone. Rows that repeat are
learned from and scored each. A text may be of any length; it is scored in
blocks. Without texts to learn from, every bit counts a half and every word one
in one. Columns are passed on in ``row``, under any names. An empty table has
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm import textcore
from tallymart.llm.repeats import TEXT
from tallymart.llm.store import stored

#: bytes of the longest context; with the byte itself a key fits 64 bits
DEPTH = 4
END = 0xFF
#: text that asks together, text that is taken at once, and bytes of a block
CHUNK_BYTES, SLICE_BYTES, BLOCK = 64 << 20, 2 << 20, 1 << 20

ASKED = "chunk long, gram long, word string, n long"


def _chunked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: numbers the chunks of a task."""
    number, size = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        for part in textcore.slices(batch, TEXT, SLICE_BYTES):
            _, bounds = textcore.column_bytes(part.column(TEXT))
            if size and size + bounds[-1] > CHUNK_BYTES:
                number, size = number + 1, 0
            size += int(bounds[-1]) + part.num_rows
            column = pa.array(np.full(part.num_rows, number), pa.int64())
            yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, "__chunk"])


def strings(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(strings, rows): for each byte of each row, and for its end, the number
    of the bytes before it and itself, in blocks."""
    rows = len(bounds) - 1
    starts = bounds[:-1] + np.arange(rows) * (DEPTH + 1)
    long = np.full(len(data) + rows * (DEPTH + 1), END, np.uint8)
    long[np.arange(len(data)) + np.repeat(np.arange(rows) * (DEPTH + 1) + DEPTH, np.diff(bounds))] = data
    for begin in range(0, len(long) - DEPTH, BLOCK):
        block = long[begin:begin + BLOCK + DEPTH].astype(np.uint64)
        count = len(block) - DEPTH
        found = np.zeros(count, np.uint64)
        for place in range(DEPTH + 1):
            found = (found << np.uint64(8)) | block[place:place + count]
        row = np.searchsorted(starts, np.arange(begin, begin + count), "right") - 1
        inside = np.arange(begin, begin + count) - starts[row] <= bounds[row + 1] - bounds[row]
        yield found[inside].astype(np.int64), row[inside]


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(words, rows) of a batch of lower-cased texts, without their ends."""
    units = textcore.words(data, bounds)
    held = textcore.WORD_BYTES[data]
    tops = np.zeros(len(data) + 1, np.int64)
    np.cumsum(held, out=tops[1:])
    return textcore.from_bounds(data[held].tobytes(), np.append(tops[units.starts], tops[-1]), pa.string()), units.rows


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    known, at = np.unique(np.concatenate(keys), return_inverse=True)
    return known, np.bincount(at, np.concatenate(counts), len(known)).astype(np.int64)


class _Asking:
    """What the texts of a chunk ask for: their strings and words, with the
    numbers of those that are learned."""

    def __init__(self, chunk: int):
        self.chunk = chunk
        self.grams: tuple[list, list] = ([], [])
        self.words: list[pa.Table] = []
        self.ends = 0

    def add(self, data: np.ndarray, bounds: np.ndarray, learn: bool) -> None:
        for found, _ in strings(data, bounds):
            known, counts = np.unique(found, return_counts=True)
            self.grams[0].append(known)
            self.grams[1].append(counts if learn else np.zeros(len(known), np.int64))
        if len(self.grams[0]) >= 32:
            known, counts = _merged(*self.grams)
            self.grams = ([known], [counts])
        found = tokens(data, bounds)[0].value_counts()
        counts = found.field("counts") if learn else pa.array(np.zeros(len(found), np.int64))
        self.words.append(pa.table({"word": found.field("values"), "n": counts}))
        if len(self.words) >= 32:
            self.words = [self._words()]
        self.ends += (len(bounds) - 1) if learn else 0

    def _words(self) -> pa.Table:
        return pa.concat_tables(self.words).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

    def rows(self) -> Iterator[pa.RecordBatch]:
        grams, counts = _merged(*self.grams)
        words = self._words()
        chunk, empty = pa.scalar(self.chunk, pa.int64()), pa.scalar("", pa.string())
        tables = [
            pa.table([pa.repeat(chunk, len(grams)), pa.array(grams), pa.nulls(len(grams), pa.string()), pa.array(counts)], _NAMES),
            pa.table([pa.repeat(chunk, len(words)), pa.nulls(len(words), pa.int64()), words.column("word"), words.column("n")], _NAMES),
            # the empty word stands for the end
            pa.table([pa.repeat(chunk, 1), pa.nulls(1, pa.int64()), pa.repeat(empty, 1), pa.array([self.ends], pa.int64())], _NAMES),
        ]
        for table in tables:
            yield from table.to_batches(max_chunksize=50_000)


_NAMES = ["chunk", "gram", "word", "n"]


def _asked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: what each chunk, or the part of it in a task, asks for."""
    asking = None
    for batch in batches:
        chunks = batch.column("__chunk").to_numpy()
        cuts = np.flatnonzero(np.diff(chunks)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(chunks)]):
            if a == b:
                continue
            if asking is not None and asking.chunk != chunks[a]:
                yield from asking.rows()
                asking = None
            asking = asking or _Asking(int(chunks[a]))
            own = batch.slice(a, b - a)
            for learn in (True, False):
                some = own.filter(pc.equal(own.column("__learn"), learn))
                for part in textcore.slices(some, TEXT, SLICE_BYTES):
                    data, bounds = textcore.column_bytes(part.column(TEXT))
                    asking.add(textcore.lowered(data), bounds, learn)
    if asking is not None:
        yield from asking.rows()


# -- the tree --------------------------------------------------------------------


def _log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function from a half on: the series of Stirling, eight steps up."""
    z = x + 8
    below = x
    for step in range(1, 8):
        below = below * (x + step)
    inverse = 1 / (z * z)
    series = (1 / 12 - inverse * (1 / 360 - inverse * (1 / 1260 - inverse / 1680))) / z
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(below)


def _steps(byte: Column) -> Column:
    """(node, bit): the eight decisions of a byte. A node is a one and the bits before."""
    return F.array(*[
        F.struct(
            F.shiftright(byte, 8 - k).bitwiseOR(F.lit(1 << k)).alias("node"),
            F.shiftright(byte, 7 - k).bitwiseAND(F.lit(1)).alias("bit"),
        ) for k in range(8)
    ])


def _decided(grams: DataFrame) -> DataFrame:
    """One row for each decision of each string; ``context``: its first bytes."""
    byte, context = F.col("gram").bitwiseAND(F.lit(255)), F.shiftright("gram", 8)
    return grams.select("*", context.alias("context"), F.explode(_steps(byte)).alias("s")).select(
        *grams.columns, "context", "s.node", "s.bit"
    )


def _shorter(depth: int) -> Column:
    """The context of this many bytes, the last ones."""
    return F.col("context").bitwiseAND(F.lit((1 << 8 * depth) - 1))


def _meeting(level: DataFrame, depth: int) -> DataFrame:
    """``level`` as the side of a join. Its files are far smaller than its rows, as
    most contexts have the same few counts, so Spark would take millions of rows
    for a table to broadcast. Of contexts of a byte there are 65,280 rows at most."""
    return level if depth < 2 else level.hint("merge")


def probabilities(counts: DataFrame) -> list[DataFrame]:
    """For each depth (context, node, one): how likely a one is after that
    context, if longer ones were never seen. ``counts``: (gram, n)."""
    zeros, ones = F.sum(F.col("n") * (1 - F.col("bit"))), F.sum(F.col("n") * F.col("bit"))
    below = _decided(counts).groupBy("context", "node").agg(
        zeros.alias("zeros"), ones.alias("ones"), F.lit(None).cast("double").alias("longer")
    )
    a, b = F.col("zeros").cast("double"), F.col("ones").cast("double")
    estimate = _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1) - math.log(math.pi)
    high = F.greatest("estimate", "longer")
    either = high + F.log(F.exp(F.col("estimate") - high) + F.exp(F.col("longer") - high)) - math.log(2)
    levels = []
    for depth in range(DEPTH, -1, -1):
        own = below.withColumn("estimate", estimate)
        weighted = F.when(F.col("longer").isNull(), F.col("estimate")).otherwise(either)
        levels.append(stored(own.withColumn("weighted", weighted), "contexts"))
        if depth:
            below = levels[-1].groupBy(_shorter(depth - 1).alias("context"), "node").agg(
                F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("longer")
            )
    # the share of this depth's own estimate; exp is held within its range
    apart = F.least(F.lit(700.0), F.greatest(F.lit(-700.0), F.col("longer") - F.col("estimate")))
    share = F.when(F.col("longer").isNull(), F.lit(1.0)).otherwise(1 / (1 + F.exp(apart)))
    ahead = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0)
    mixed: list[DataFrame] = []
    for depth, level in enumerate(reversed(levels)):
        own = level.select("context", "node", share.alias("share"), ahead.alias("ahead"))
        if depth:
            upper = mixed[-1].select(F.col("context").alias("__short"), F.col("node").alias("__node"), "sum", "rest")
            match = (_shorter(depth - 1) == F.col("__short")) & (F.col("node") == F.col("__node"))
            own = own.join(_meeting(upper, depth - 1), match)
        else:
            own = own.withColumns({"sum": F.lit(0.0), "rest": F.lit(1.0)})
        mixed.append(stored(own.select(
            "context", "node", (F.col("sum") + F.col("rest") * F.col("share") * F.col("ahead")).alias("sum"),
            (F.col("rest") * (1 - F.col("share"))).alias("rest"),
        ), "mixed"))
    return [m.select("context", "node", (F.col("sum") + 0.5 * F.col("rest")).alias("one")) for m in mixed]


def string_scores(grams: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(gram, lp): log10 of the probability of each string's last byte after
    the others. ``grams``: (gram, n); those with n > 0 were learned."""
    lp = F.log10(F.when(F.col("bit") == 1, F.col("one")).otherwise(1 - F.col("one")))
    bits = _decided(grams.where("n > 0").select("gram")).join(_meeting(levels[DEPTH], DEPTH), ["context", "node"]).select("gram", lp.alias("lp"))
    # strings not learned: each decision at the deepest context that knows it
    left = _decided(grams.where("n = 0").select("gram"))
    for depth in range(DEPTH, -1, -1):
        level = levels[depth].select(F.col("context").alias("__short"), F.col("node").alias("__node"), "one")
        match = (_shorter(depth) == F.col("__short")) & (F.col("node") == F.col("__node"))
        asked = stored(left.join(_meeting(level, depth), match, "left").select(*left.columns, "one"), "decisions")
        bits = bits.union(asked.where("one is not null").select("gram", lp.alias("lp")))
        left = asked.where("one is null").drop("one")
    bits = bits.union(left.select("gram", F.lit(math.log10(0.5)).alias("lp")))
    return bits.groupBy("gram").agg(F.sum("lp").alias("lp"))


# -- scores ----------------------------------------------------------------------


def _scored(train_tokens: int, train_words: int):
    """For ``applyInArrow`` on the texts of a chunk and its answers."""
    offset = math.log10(train_tokens + train_words + 1)

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        grams = answers.filter(pc.is_valid(answers.column("gram")))
        order = np.argsort(grams.column("gram").to_numpy())
        known, lps = grams.column("gram").to_numpy()[order], grams.column("lp").to_numpy()[order]
        words = answers.filter(pc.is_valid(answers.column("word")))
        listed, seen = words.column("word").combine_chunks(), words.column("n").to_numpy()
        end = int(seen[pc.index(listed, "").as_py()])
        parts = []
        for batch in texts.combine_chunks().to_batches():
            for part in textcore.slices(batch, TEXT, SLICE_BYTES):
                data, bounds = textcore.column_bytes(part.column(TEXT))
                data, rows = textcore.lowered(data), part.num_rows
                score = np.zeros(rows)
                for found, row in strings(data, bounds):
                    score += np.bincount(row, lps[np.searchsorted(known, found)], rows)
                token, row = tokens(data, bounds)
                coded = token.dictionary_encode()
                place = pc.fill_null(pc.index_in(coded.dictionary, listed), len(seen)).to_numpy()
                count = np.append(seen, 0)[place][coded.indices.to_numpy()]  # words never learned get no answer
                n_tokens = np.bincount(row, minlength=rows) + 1
                n_known = np.bincount(row, count > 0, rows).astype(np.int64) + (end > 0)
                base = np.bincount(row, np.log10(count + 1), rows) + math.log10(end + 1) - n_tokens * offset
                parts.append(pa.table(
                    [part.column("__row"), pa.array(np.diff(bounds)), pa.array(n_tokens.astype(np.int64)), pa.array(n_known),
                     pa.array(base), pa.array(score)], OUT))
        return pa.concat_tables(parts)

    return run


OUT = ["__row", "__n_bytes", "__n_tokens", "__n_known", "__base_score", "__score"]


def scored(docs: DataFrame, learn: Column, text_col: str = "text") -> DataFrame:
    """(row, n_bytes, n_tokens, n_known, train_tokens, base_score, score).

    The model learns from rows for which ``learn`` holds, and scores all.
    ``score``: log10 of the probability of the text and its end; divided by
    ``n_bytes`` + 1 it is the negative code length per byte. ``base_score``: the same
    by the frequencies of words, one added to each; the end is a token.
    What reaches the driver is the number of tokens and of words.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("__row")
    source = docs.select(
        rest, F.col(f"`{text_col}`").cast("string").alias(TEXT), F.coalesce(learn, F.lit(False)).alias("__learn")
    )
    kind = source.schema["__row"].dataType.simpleString()
    chunked = source.mapInArrow(_chunked, f"__row {kind}, {TEXT} string, __learn boolean, __chunk long")
    chunks = stored(chunked, "chunks", compression="zstd")
    asked = stored(chunks.select(TEXT, "__learn", "__chunk").mapInArrow(_asked, ASKED), "asked")
    grams, words = asked.where("gram is not null"), asked.where("word is not null")
    counts = stored(grams.groupBy("gram").agg(F.sum("n").alias("n")), "counts")
    scores = string_scores(counts, probabilities(counts.where("n > 0")))
    # each chunk asks for a word once, so the sums meet the chunks in one shuffle
    same = Window.partitionBy("word")
    first = F.row_number().over(same.orderBy("chunk")) == 1
    counted = words.select("chunk", "word", F.sum("n").over(same).alias("n"), first.alias("first"))
    words = stored(counted.where("n > 0 or word = ''"), "words", compression="zstd")
    seen = words.where("first and n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"))
    total, different = seen.first()
    nothing = F.lit(None)
    answers = grams.select("chunk", "gram").join(scores.hint("merge"), "gram").select(
        "chunk", "gram", "lp", nothing.cast("string").alias("word"), nothing.cast("long").alias("n")
    ).unionByName(words.select(
        "chunk", nothing.cast("long").alias("gram"), nothing.cast("double").alias("lp"), "word", "n"
    ))
    out = f"__row {kind}, __n_bytes long, __n_tokens long, __n_known long, __base_score double, __score double"
    texts = chunks.select(F.col("__chunk").alias("chunk"), "__row", TEXT)
    found = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_scored(total, different), out)
    return found.select(
        F.col("__row").alias("row"), F.col("__n_bytes").alias("n_bytes"), F.col("__n_tokens").alias("n_tokens"),
        F.col("__n_known").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        F.col("__base_score").alias("base_score"), F.col("__score").alias("score"),
    )
