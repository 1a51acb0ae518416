"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a condition under which a document goes. What a rule costs and how
much it rejects is measured on a sample; rules then run in the order of
rejection per cost, and a document that one rule rejects is not shown to the
next. The order decides the time taken, never the verdict.

Defined results: NULL text has no words; a rule whose condition is NULL does
not reject; other columns are passed on; repeated rows are judged each; a text
of any length is judged whole; an empty table stays empty.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.store import stored

# separators of words, and characters that count as symbols
BLANKS = "[\\x20\\x09-\\x0D]+"
NOT_BLANK = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"

@dataclass(frozen=True)
class Rule:
    """``rejects``: text and array of words to a condition, true where it goes."""

    name: str
    rejects: Callable[[Column, Column], Column]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, and only if it is needed."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def word_chars(words: Column) -> Column:
    """Code points in words."""
    return F.char_length(F.array_join(words, "")).cast("long")


def n_words(words: Column) -> Column:
    return F.size(words).cast("long")


def count_matches(text: Column, pattern: str) -> Column:
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("long")


def full_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_BLANK))


def dup_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def repeat_words(words: Column, width: int = 5) -> Column:
    """Words in windows of ``width`` words that the text holds twice or more.

    Windows are hashed. Only a text with equal hashes sorts them with their
    places; the places of equal neighbours, in order, then give the words.
    """
    hashed = F.transform(
        F.sequence(F.lit(0), F.size(words) - width),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]),
    )
    windows = F.when(F.size(words) >= width, hashed).otherwise(F.array().cast("array<bigint>"))

    def covered(starts: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-width).alias("last"))
        return F.aggregate(
            starts, start,
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(width), i - acc["last"])).alias("n"), i.alias("last")),
            lambda acc: acc["n"],
        )

    def in_places(places: Column) -> Column:
        repeated = F.filter(
            places, lambda x, k: (F.get(places, k - 1)["h"] == x["h"]) | (F.get(places, k + 1)["h"] == x["h"])
        )
        return covered(F.sort_array(F.transform(repeated, lambda x: x["i"])))

    def count(grams: Column) -> Column:
        placed = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")).otherwise(let(placed, in_places))

    return let(windows, count)


def _shouts(text: Column, words: Column) -> Column:
    return F.regexp_count(text, F.lit("\\p{Lu}")) > F.regexp_count(text, F.lit("\\p{Ll}"))


BASE = (
    Rule("few_words", lambda text, words: n_words(words) < 10),
    Rule("repeated_words", lambda text, words: 100 * repeat_words(words) > 20 * n_words(words)),
)
#: beyond the base: symbols, shouting, exclamation marks, odd word lengths, repeated lines
MORE = (
    Rule("symbols", lambda text, words: 10 * count_matches(text, SYMBOLS) > n_words(words)),
    Rule("upper_case", _shouts),
    Rule("exclamations", lambda text, words: 2 * count_matches(text, "!") > n_words(words)),
    Rule("word_length", lambda text, words: let(
        word_chars(words), lambda n: (n < 2 * n_words(words)) | (n > 15 * n_words(words)))),
    Rule("repeated_lines", lambda text, words: let(
        full_lines(text), lambda lines: 2 * dup_lines(lines) > F.size(lines))),
)


def text_of(text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def sampled(texts: DataFrame, share: float) -> DataFrame:
    return texts.sample(fraction=share, seed=4)


def estimates(docs: DataFrame, rules: tuple[Rule, ...], text_col: str = "text", sample_rows: int = 1000) -> list[Estimate]:
    """Cost and rejection of each rule on a sample of about ``sample_rows``
    documents, drawn row by row, so that copies of a text count like others;
    the best worth first.

    The cost is the time beyond what reading the sample and its words takes.
    The table is sampled where it lies; only the sample goes to one file.
    """
    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    share = min(1.0, sample_rows / max(1, texts.count()))
    sample = stored(sampled(texts, share).repartition(1), "rule-sample")
    text = text_of("text")

    def timed(condition: Callable[[Column, Column], Column]) -> tuple[float, float]:
        began = time.perf_counter()
        met = let(words(text), lambda w: condition(text, w))
        rows, gone = sample.agg(F.count("*"), F.count_if(met)).first()
        return time.perf_counter() - began, gone / max(rows, 1)

    def nothing(text: Column, words: Column) -> Column:
        return F.size(words) < 0

    timed(nothing)
    floor = timed(nothing)[0]
    found = []
    for rule in rules:
        seconds, rejected = timed(rule.rejects)
        found.append(Estimate(rule, max(seconds - floor, 0.0), rejected))
    return sorted(found, key=lambda e: -e.worth)


def kept(rules: list[Rule], text_col: str = "text") -> Column:
    """No rule rejects. A rule runs only where those before it do not reject."""
    text = text_of(text_col)

    def verdict(words: Column) -> Column:
        rest = F.lit(True)
        for rule in reversed(rules):
            rest = F.when(rule.rejects(text, words), F.lit(False)).otherwise(rest)
        return rest

    return let(words(text), verdict)


def quality_filter(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """The documents that all rules keep, with their columns."""
    order = [e.rule for e in estimates(docs, rules, text_col)]
    return docs.where(kept(order, text_col))


def measures(text_col: str = "text") -> Column:
    """A struct of the counts that the base rules are made of."""
    text = text_of(text_col)
    return let(words(text), lambda w: F.struct(
        n_words(w).alias("n_words"), word_chars(w).alias("word_chars"),
        count_matches(text, SYMBOLS).alias("n_symbols"),
        let(full_lines(text), dup_lines).alias("n_dup_lines"), repeat_words(w).alias("n_repeat_words"),
    ))
