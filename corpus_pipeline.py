"""From raw documents to packed sequences; every stage is one operator.

Each stage takes all that the one before kept and returns the columns of
``documents``; the last returns pieces of sequences.

- quality: documents that a rule rejects go.
- lines: lines of later repeated runs go, ``n_chars`` is counted anew. A
  document of which every line with a word was removed goes with them.
- near_duplicates: texts that share eight tenths of their five-word shingles are
  linked. Of each group the document with the smallest id stays; of several rows
  with that id, and of a group without ids, one.
- decontamination: documents whose words are benchmark passages to a twentieth
  or more go.
- packing: token pieces, see ``tallymart.llm.packing``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import quality as rules
from tallymart.llm.decontaminate import benchmark_hits, contamination
from tallymart.llm.line_dedup import line_dedup
from tallymart.llm.near_copies import first_of_groups
from tallymart.llm.packing import packed
from tallymart.llm.store import small_batches, stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.quality_filter(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = line_dedup(docs)
    left = found.where("n_units = 0 or n_removed < n_units")
    text = F.col("kept_text")
    columns = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return left.select(*[columns.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return first_of_groups(docs, shingle=5, least=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = contamination(benchmark_hits(docs, table(spark, sf_dir, "benchmark")))
    clean = found.where("not contaminated")
    return clean.select(*[(F.col("text") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates),
    ("decontamination", decontamination), ("packing", packing),
]
#: fingerprints and token ids are beyond SQL; tests compare with plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
