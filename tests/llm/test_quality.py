"""Counts and verdicts of quality rules against plain Python."""

import re
from collections import Counter

from pyspark.sql import functions as F

from tallymart.llm import quality
from tests.llm.cases import edge_texts, frame, words_of

MORE = [
    (1000, "BE!! IS!! A!! ANNTANAT!! REESLY!! TO!! OR!! NTHE!! A!! ONLY!! EA!! ER!!"),
    (1001, "one | two | three | four | five | six | seven | eight | nine | ten | eleven"),
    (1002, "same same same same same same same same same same same same"),
    (1003, "\n".join(["a line of text that comes again and again and again"] * 6)),
    (1004, "a b c d e f g h i j k"), (1005, "x" * 400 + " y" * 10),
    (1006, "Plain words of an ordinary sentence that nobody would want to lose, in two lines.\nThe second one differs."),
]


def counts(text):
    text = text or ""
    w = words_of(text)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    again = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if words_of(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)


def test_measures(spark):
    texts = edge_texts(5) + MORE
    got = frame(spark, texts).select("doc_id", quality.measures().alias("m")).select("doc_id", "m.*")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((i, *counts(t)) for i, t in texts), key=repr)


def test_order_never_changes_the_verdict(spark):
    df = frame(spark, edge_texts(5) + MORE)
    rules = list(quality.BASE + quality.MORE)
    verdicts = [sorted(map(tuple, df.select("doc_id", "n_chars", quality.kept(order).alias("kept")).collect()), key=repr)
                for order in (rules, rules[::-1])]
    assert verdicts[0] == verdicts[1]
    kept = {r[0] for r in verdicts[0] if r[2]}
    assert 1006 in kept and not kept & {1000, 1001, 1002, 1003, 1004, 1005, 5, 7, 9}


def test_filter_keeps_columns(spark):
    df = frame(spark, edge_texts(5) + MORE)
    kept = quality.quality_filter(df)
    assert kept.columns == df.columns and 0 < kept.count() < df.count()
    assert quality.quality_filter(frame(spark, [])).count() == 0


def test_no_python_in_the_plan(spark, plan):
    df = frame(spark, MORE).select(quality.measures(), quality.kept(list(quality.BASE + quality.MORE)))
    assert not re.search("Python|Pandas|Arrow", plan(df))


def test_the_sample_is_bounded_and_taken_in_parallel(spark, plan):
    """A text on a third of all rows is sampled like the rest; no task reads the whole table."""
    texts = spark.range(30_000).repartition(7).select(
        F.when(F.col("id") % 3 == 0, F.lit("the same text")).otherwise(F.col("id").cast("string")).alias("text"))
    drawn = quality.sampled(texts, 1000 / 30_000)
    same, rows = drawn.agg(F.count_if(F.col("text") == "the same text"), F.count("*")).first()
    assert 800 < rows < 1200 and 0.25 < same / rows < 0.42
    assert drawn.rdd.getNumPartitions() > 1 and "Coalesce" not in plan(drawn.repartition(1))


def test_long_and_empty_texts(spark):
    long = "many words in one line " * 100_000
    df = frame(spark, [(1, long), (2, ""), (3, None), (3, None)])
    got = {r.doc_id: r.m for r in df.select("doc_id", quality.measures().alias("m")).collect()}
    assert got[1].n_words == 500_000 == got[1].n_repeat_words and got[2].n_words == got[3].n_words == 0


def test_labelled_junk_goes_and_good_text_stays(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(labels, "doc_id")
    verdict = quality.kept(list(quality.BASE + quality.MORE)).alias("kept")
    beyond = quality.kept(list(quality.MORE)).alias("beyond")  # the base rules are given
    rows = docs.select("quality", verdict, beyond, F.size(F.split("text", " ")).alias("n")).collect()
    junk = [r for r in rows if r.quality == 0]
    good = [r for r in rows if r.quality == 1 and r.n >= 12]
    assert sum(r.kept for r in junk) <= 0.02 * len(junk)
    assert sum(r.beyond for r in good) >= 0.995 * len(good)
