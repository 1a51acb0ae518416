"""Toxicity by a classifier chain over labelled categories.

Categories are predicted one after the other by linear models. A later model
also gets the earlier categories' probabilities. In training these come from
models that have not seen the document (out of fold), so the later model meets
them as it will on new documents.

Features are which of a few hundred words and word beginnings a text holds,
selected on the labelled sample, and five figures of the whole text. Words are
digits, letters and all characters beyond ASCII, A-Z in lower case.

Defined results: NULL text has no words. Labelled rows without an id or with a
NULL label are left out, repeated labels count by their largest value. Without
labels of both kinds a category's probability is its share. Texts may be
of any length; empty tables give an empty result, and probabilities of a half
for texts scored by a model without labels. Other columns are passed on in
``row``, under any names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm import textcore
from tallymart.llm.decontaminate import WORD_BYTES
from tallymart.llm.repeats import TEXT
from tallymart.llm.store import stored

SLOT_BITS = 22
#: bytes of word beginnings that are features beside whole words
PREFIXES = (4, 5, 6)
FIGURES = 5
_SYMBOLS = textcore.members(b"#*$%&|<>!")
_UPPER = textcore.members(bytes(range(ord("A"), ord("Z") + 1)))


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, slots) of all features, with repeats, and figures of each row."""
    low = textcore.lowered(data)
    units = textcore.words(low, bounds, WORD_BYTES)
    prefixes = textcore.Prefixes(textcore._BYTE_VALUES[low])
    rows = units.rows
    slots, owners = [_slot(prefixes.between(units.starts, units.ends), 0)], [rows]
    for length in PREFIXES:
        longer = units.ends - units.starts > length
        starts = units.starts[longer]
        slots.append(_slot(prefixes.between(starts, starts + length), length))
        owners.append(rows[longer])
    size = np.maximum(np.diff(bounds), 1)
    count = np.maximum(units.counts, 1)

    def total(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[bounds])

    if len(units):
        keys = np.unique((rows.astype(np.uint64) << np.uint64(SLOT_BITS)) | slots[0].astype(np.uint64))
        distinct = np.bincount((keys >> np.uint64(SLOT_BITS)).astype(np.int64), minlength=len(bounds) - 1)
    else:
        distinct = np.zeros(len(bounds) - 1)
    figures = np.stack([
        np.log1p(units.counts), distinct / count, total(_UPPER[data]) / size, total(_SYMBOLS[data]) / count,
        np.minimum(size / count, 50) / 10,
    ], axis=1)
    return np.concatenate(owners), np.concatenate(slots), figures


def _slot(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (textcore.mixed(hashes + np.uint64(kind)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def held(rows: np.ndarray, slots: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, slot) pairs."""
    keys = np.unique(rows * (1 << SLOT_BITS) + slots)
    return keys >> SLOT_BITS, keys & ((1 << SLOT_BITS) - 1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, rounds: int = 300) -> np.ndarray:
    """Weights of a logistic model, the last one its constant; accelerated
    gradient steps on the mean loss, with a small quadratic penalty."""
    weights = np.zeros(x.shape[1] + 1)
    share = (y.sum() + 0.5) / (len(y) + 1)
    weights[-1] = np.log(share / (1 - share))
    if not len(y) or y.min() == y.max():
        return weights
    norm = np.sqrt((x * x).sum(axis=1)).max() ** 2 + 1
    step = 4.0 / min(norm, 60.0)
    ahead, last = weights.copy(), weights.copy()
    for number in range(rounds):
        off = sigmoid(x @ ahead[:-1] + ahead[-1]) - y
        slope = np.append(x.T @ off / len(y) + penalty * ahead[:-1], off.mean())
        weights = ahead - step * slope
        ahead = weights + number / (number + 3) * (weights - last)
        last = weights
    return last


def predict(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return sigmoid(x @ weights[:-1] + weights[-1])


def threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from which precision and recall are best together (F1)."""
    if not len(y) or y.min() == y.max():
        return 0.5
    order = np.argsort(-p)
    right = np.cumsum(y[order])
    score = 2 * right / (np.arange(1, len(y) + 1) + y.sum())
    best = int(score.argmax())
    below = p[order[best + 1]] if best + 1 < len(y) else 0.0
    return float((p[order[best]] + below) / 2)


def chain(x: np.ndarray, labels: np.ndarray, fold: np.ndarray, folds: int) -> tuple[list[np.ndarray], list[float]]:
    """Weights of each category's model and the threshold that suits its
    out-of-fold probabilities; labels are columns in chain order."""
    models, thresholds = [], []
    for category in range(labels.shape[1]):
        y = labels[:, category]
        models.append(fit(x, y))
        out = np.zeros(len(y))
        for k in range(folds):
            own = fold == k
            if own.any():
                out[own] = predict(x[own], fit(x[~own], y[~own]))
        thresholds.append(threshold(out, y))
        x = np.column_stack([x, out])
    return models, thresholds


@dataclass
class Chain:
    categories: tuple[str, ...]
    slots: np.ndarray  # selected features, ascending
    center: np.ndarray
    scale: np.ndarray
    models: list[np.ndarray]
    thresholds: list[float]

    def inputs(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        rows, slots, figures = features(data, bounds)
        return self.dense(rows, slots, figures)

    def dense(self, rows: np.ndarray, slots: np.ndarray, figures: np.ndarray) -> np.ndarray:
        place = np.full(1 << SLOT_BITS, -1, np.int32)
        place[self.slots] = np.arange(len(self.slots))
        column = place[slots]
        x = np.zeros((len(figures), len(self.slots) + FIGURES), np.float32)
        x[rows[column >= 0], column[column >= 0]] = 1
        x[:, len(self.slots):] = (figures - self.center) / self.scale
        return x

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        found = np.zeros((len(x), 0))
        for weights in self.models:
            found = np.column_stack([found, predict(np.column_stack([x, found]), weights)])
        return found


def _sample_features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in textcore.slices(batch, TEXT):
            data, bounds = textcore.column_bytes(part.column(TEXT))
            rows, slots, figures = features(data, bounds)
            rows, slots = held(rows, slots, part.num_rows)
            counts = np.bincount(rows, minlength=part.num_rows)
            limits = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_pydict({
                "id": part.column("id"), "labels": part.column("labels"),
                "slots": pa.ListArray.from_arrays(pa.array(limits), pa.array(slots.astype(np.int32))),
                "figures": pa.array(figures.tolist(), pa.list_(pa.float64())),
            })


def train(
    docs: DataFrame, labels: DataFrame, categories: tuple[str, ...], id_col: str = "doc_id", text_col: str = "text",
    sample_rows: int = 12_000, selected: int = 200, folds: int = 3,
) -> Chain:
    """A chain over 0/1 label columns, in that order, from a bounded sample.

    At most about ``sample_rows`` labelled documents, by a hash of the id, and
    ``selected`` features for each category, by how far the two classes part.
    """
    known = labels.groupBy(F.col(id_col).cast("long").alias("id")).agg(*[F.max(F.col(c)).alias(c) for c in categories])
    known = known.where(" and ".join(f"`{c}` is not null" for c in ("id", *categories)))
    share = max(1, -(-known.count() // sample_rows))
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(share)) == 0)
    chosen = chosen.select("id", F.array(*[F.col(c).cast("int") for c in categories]).alias("labels"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias(TEXT))
    sample = texts.join(F.broadcast(chosen), "id").select("id", "labels", TEXT)
    sample = stored(sample.mapInArrow(_sample_features, "id long, labels array<int>, slots array<int>, figures array<double>"), "toxicity-sample")

    total = sample.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(F.col("labels")[i]), F.lit(0)).alias(f"p{i}") for i in range(len(categories))]).first()
    held_by = sample.select(F.explode("slots").alias("slot"), "labels").groupBy("slot").agg(
        F.count("*").alias("n"), *[F.sum(F.col("labels")[i]).alias(f"p{i}") for i in range(len(categories))]
    ).where("n >= 4")
    slots: set[int] = set()
    for i in range(len(categories)):
        # how far the positives' share exceeds the negatives', in standard deviations
        positive = F.col(f"p{i}") / F.lit(max(total[f"p{i}"], 1))
        negative = (F.col("n") - F.col(f"p{i}")) / F.lit(max(total["n"] - total[f"p{i}"], 1))
        spread = F.sqrt(F.col("n") / F.lit(max(total["n"], 1) * max(total[f"p{i}"], 1)))
        best = held_by.orderBy(F.desc((positive - negative) / spread), "slot").limit(selected)
        slots |= {r.slot for r in best.select("slot").collect()}
    wanted = np.array(sorted(slots), np.int64)
    wanted_column = F.array(*[F.lit(int(s)) for s in wanted]) if len(wanted) else F.array().cast("array<int>")
    rows = sample.select("id", "labels", F.array_intersect("slots", wanted_column).alias("slots"), "figures").orderBy("id").collect()
    figures = np.array([r.figures for r in rows]).reshape(-1, FIGURES)
    found = Chain(categories, wanted, np.zeros(FIGURES), np.ones(FIGURES), [], [])
    if len(rows):
        found.center, found.scale = figures.mean(axis=0), figures.std(axis=0) + 1e-6
    owners = np.repeat(np.arange(len(rows)), [len(r.slots) for r in rows]).astype(np.int64)
    x = found.dense(owners, np.array([s for r in rows for s in r.slots], np.int64), figures)
    y = np.array([r.labels for r in rows], np.float64).reshape(-1, len(categories))
    fold = np.array([r.id % folds for r in rows], np.int64)
    found.models, found.thresholds = chain(x.astype(np.float64), y, fold, folds)
    return found


def _score(model: Chain):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textcore.slices(batch, TEXT):
                found = model.probabilities(model.inputs(*textcore.column_bytes(part.column(TEXT))))
                columns = {n: part.column(n) for n in part.schema.names if n != TEXT}
                columns["__p"] = pa.array(found.tolist(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_pydict(columns)

    return run


def scored(docs: DataFrame, model: Chain, text_col: str = "text") -> DataFrame:
    """(row, probabilities): one for each category, in chain order."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("__row")
    source = docs.select(rest, F.col(text_col).cast("string").alias(TEXT))
    kinds = f"__row {source.schema['__row'].dataType.simpleString()}, __p array<double>"
    found = source.mapInArrow(_score(model), kinds)
    return found.select(F.col("__row").alias("row"), F.col("__p").alias("probabilities"))
