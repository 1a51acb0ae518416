"""Secrets in texts: three fixed patterns, and strings that look random.

Two character Markov models, one of random strings and one of ordinary words
and identifiers, give each long run of token characters the logarithm of their
likelihood ratio. Both are counted on what the fixed patterns label, over all
documents: values that they find (and seeded random strings, so that every
character occurs) are random, all other runs are ordinary.

Defined results: NULL text is empty. Spans are code points, end exclusive. A
run that overlaps a fixed pattern's span adds nothing. Documents that repeat
are counted and scanned each; a text of any length is scanned in time in
proportion to it; an empty table has an empty result, and its models know the
random strings alone. Other columns are passed on in ``row``, under any names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm import textcore
from tallymart.llm.repeats import TEXT

# fixed patterns and lengths of the three base kinds
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

KINDS = ("assign", "access", "hex", "markov")
ALPHABET = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
TOKEN_BYTES = textcore.members(ALPHABET)
_CODE = np.zeros(256, np.int64)
_CODE[np.frombuffer(ALPHABET, np.uint8)] = np.arange(len(ALPHABET))
HEX_BYTES = textcore.members(b"0123456789abcdef")
SPANS = "array<struct<kind:string,`start`:int,`end`:int>>"


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), leftmost and non-overlapping for each kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if len(m[0]) >= MIN_HEX]
    return found


def rows_with_base(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows in which one of the base patterns can match at all."""
    found = np.zeros(len(bounds), np.int64)
    raw, low = data.tobytes(), textcore.lowered(data).tobytes()
    for text, needles in ((raw, (b"AKIA",)), (low, KEYWORDS)):
        for needle in needles:
            at = text.find(needle)
            while at >= 0:
                row = int(np.searchsorted(bounds, at, "right")) - 1
                found[row] = 1
                at = text.find(needle, int(bounds[row + 1]))  # one is enough
    runs = textcore.words(data, bounds, HEX_BYTES)
    found[runs.rows[runs.ends - runs.starts >= MIN_HEX]] = 1
    return np.flatnonzero(found)


def transitions(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of neighbouring characters in each run, and the runs they are of."""
    sizes = np.maximum(ends - starts - 1, 0)
    tops = np.cumsum(sizes)
    at = np.repeat(starts - (tops - sizes), sizes) + np.arange(tops[-1] if len(tops) else 0)
    return _CODE[data[at]] * len(ALPHABET) + _CODE[data[at + 1]], np.repeat(np.arange(len(starts)), sizes)


def spans_in(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, dict[int, list]]:
    """Bytes that base spans cover, and the spans of rows with any."""
    covered = np.zeros(len(data), bool)
    found = {}
    raw = data.tobytes()
    for row in rows_with_base(data, bounds).tolist():
        text = raw[bounds[row]:bounds[row + 1]].decode("utf-8", "replace")
        spans = base_spans(text)
        if spans:
            found[row] = spans
            own = data[bounds[row]:bounds[row + 1]]
            places = np.append(np.flatnonzero((own & 0xC0) != 0x80), len(own)) + bounds[row]  # of code points
            for start, end, _ in spans:
                covered[places[start]:places[end]] = True
    return covered, found


class Model:
    """Log-likelihood ratio of every pair of neighbouring characters."""

    def __init__(self, counts: dict[tuple[bool, int], int], smoothing: float = 0.5):
        width = len(ALPHABET)
        logs = []
        for label in (True, False):
            table = np.full(width * width, smoothing)
            for (own, pair), n in counts.items():
                if own == label:
                    table[pair] += n
            table = table.reshape(width, width)
            logs.append(np.log(table / table.sum(axis=1, keepdims=True)))
        self.ratio = (logs[0] - logs[1]).ravel()

    def scores(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        pairs, run = transitions(data, starts, ends)
        return np.bincount(run, self.ratio[pairs], len(starts))


def random_strings(count: int = 2000, size: int = 32, seed: int = 9) -> np.ndarray:
    """Labelled random strings over the letters and digits, and over hex."""
    rng = np.random.default_rng(seed)
    letters = np.frombuffer(ALPHABET, np.uint8)
    half = count // 2
    return np.concatenate([
        rng.choice(letters, (half, size)), rng.choice(np.frombuffer(b"0123456789abcdef", np.uint8), (half, size)),
    ])


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    width = len(ALPHABET) ** 2
    totals = np.zeros((2, width), np.int64)
    for batch in batches:
        for part in textcore.slices(batch, TEXT):
            data, bounds = textcore.column_bytes(part.column(TEXT))
            covered, _ = spans_in(data, bounds)
            runs = textcore.words(data, bounds, TOKEN_BYTES)
            label = covered[runs.starts].astype(np.int64)
            pairs, run = transitions(data, runs.starts, runs.ends)
            totals += np.bincount(label[run] * width + pairs, minlength=2 * width).reshape(2, width)
    label, pair = np.nonzero(totals)
    yield pa.RecordBatch.from_pydict({
        "random": pa.array(label == 1), "pair": pa.array(pair, pa.int32()), "n": pa.array(totals[label, pair], pa.int64()),
    })


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Counts pairs of characters over all documents.

    What reaches the driver is one count for each label and pair of characters.
    """
    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias(TEXT)).where(F.col(TEXT).isNotNull())
    rows = texts.mapInArrow(_counts, "random boolean, pair int, n long").groupBy("random", "pair").agg(F.sum("n").alias("n"))
    counts = {(r.random, r.pair): r.n for r in rows.collect()}
    strings = random_strings()
    begins = np.arange(len(strings)) * strings.shape[1]
    pairs, _ = transitions(strings.ravel(), begins, begins + strings.shape[1])
    for pair, n in zip(*np.unique(pairs, return_counts=True)):
        counts[(True, int(pair))] = counts.get((True, int(pair)), 0) + int(n)
    return Model(counts)


def scan(model: Model, min_length: int, threshold: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textcore.slices(batch, TEXT):
                data, bounds = textcore.column_bytes(part.column(TEXT))
                columns = {n: part.column(n) for n in part.schema.names if n != TEXT}
                columns["__spans"] = pa.array(spans(data, bounds), pa.list_(pa.struct(
                    [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))
                yield pa.RecordBatch.from_pydict(columns)

    def spans(data: np.ndarray, bounds: np.ndarray) -> list[list[dict]]:
        covered, found = spans_in(data, bounds)
        runs = textcore.words(data, bounds, TOKEN_BYTES)
        long = runs.ends - runs.starts >= min_length
        starts, ends, rows = runs.starts[long], runs.ends[long], runs.rows[long]
        odd = model.scores(data, starts, ends) > threshold
        sums = np.concatenate([[0], np.cumsum(covered)])
        odd &= sums[ends] == sums[starts]
        out: list[list[tuple]] = [[] for _ in range(len(bounds) - 1)]
        for row, base in found.items():
            out[row] += base
        tops = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
        begins = tops[starts[odd]] - tops[bounds[rows[odd]]]
        for begin, size, row in zip(begins.tolist(), (ends - starts)[odd].tolist(), rows[odd].tolist()):
            out[row].append((begin, begin + size, "markov"))
        return [
            [{"kind": k, "start": a, "end": b} for a, b, k in sorted(x, key=lambda s: (s[0], KINDS.index(s[2])))] for x in out
        ]

    return run


def secret_spans(
    docs: DataFrame, model: Model, text_col: str = "text", min_length: int = 16, threshold: float = 12.0
) -> DataFrame:
    """(row, spans): kind, start and end of what looks secret, by start.

    ``threshold`` is the log-likelihood ratio above which a run of at least
    ``min_length`` token characters counts as random.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("__row")
    source = docs.select(rest, F.col(text_col).cast("string").alias(TEXT))
    kinds = f"__row {source.schema['__row'].dataType.simpleString()}, __spans {SPANS}"
    found = source.mapInArrow(scan(model, min_length, threshold), kinds)
    return found.select(F.col("__row").alias("row"), F.col("__spans").alias("spans"))
