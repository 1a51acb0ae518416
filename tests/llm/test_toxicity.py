"""The chain on held-out labels, and its handling of awkward rows."""

import numpy as np
from pyspark.sql import functions as F

from tallymart.llm import toxicity
from tests.llm.cases import edge_texts, frame


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").withColumn("low_quality", 1 - F.col("quality"))
    held_out = labels.where("doc_id % 3 = 0")
    model = toxicity.train(docs, labels.where("doc_id % 3 <> 0"), ("low_quality", "toxic"))
    found = toxicity.scored(docs.join(held_out, "doc_id"), model)
    rows = found.select("row.toxic", "row.low_quality", "probabilities").collect()
    toxic, p = np.array([r.toxic for r in rows]), np.array([r.probabilities[1] for r in rows]) >= model.thresholds[1]
    # a few hundred toxic samples leave some rare words of four languages unseen
    assert len(rows) > 1000 and (p[toxic == 1]).mean() > 0.85 and (p[toxic == 0]).mean() < 0.01
    low, q = np.array([r.low_quality for r in rows]), np.array([r.probabilities[0] for r in rows]) >= model.thresholds[0]
    assert (low == q).mean() > 0.97


def test_later_models_use_earlier_out_of_fold_probabilities():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (600, 4)).astype(np.float32)
    first = x[:, 0]
    second = 1 - first
    models, _ = toxicity.chain(x, np.column_stack([first, second]), np.arange(600) % 3, 3)
    assert [len(m) for m in models] == [5, 6] and models[1][4] < -0.5


def test_awkward_rows(spark):
    texts = edge_texts(9)
    labels = spark.createDataFrame(
        [(0, 1, 0), (0, 0, 0), (2, 0, 1), (4, None, 1), (None, 1, 1), (9999, 1, 1), (6, 1, 1)], "doc_id long, a int, b int"
    )
    df = frame(spark, texts)
    found = toxicity.scored(df, toxicity.train(df, labels, ("a", "b"))).collect()
    assert len(found) == len(texts) and all(len(r.probabilities) == 2 and 0 <= min(r.probabilities) <= max(r.probabilities) <= 1 for r in found)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, a int")
    model = toxicity.train(frame(spark, []), none, ("a",))
    assert toxicity.scored(frame(spark, []), model).count() == 0
    assert toxicity.scored(frame(spark, [(1, "x")]), model).first().probabilities == [0.5]


def test_long_and_repeated_texts(spark):
    texts = [(i, "good words here" if i % 2 else "bad words here") for i in range(40)] + [(100, "bad " * 300_000), (100, "bad " * 300_000)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, a int")
    found = toxicity.scored(frame(spark, texts), toxicity.train(frame(spark, texts), labels, ("a",))).collect()
    p = {r.row.doc_id: r.probabilities[0] for r in found}
    assert len(found) == 42 and p[100] > p[1] and p[0] > 0.5 > p[1]
