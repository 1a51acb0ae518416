"""Benchmark hits against brute force."""

import random
import re

import pytest

from tallymart.llm.decontaminate import benchmark_hits, contamination
from tests.llm.cases import edge_texts, frame


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def expected(texts, items, window):
    patterns = []
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        if item is not None and size:
            patterns += [(tuple(w[i:i + size]), str(item)) for i in range(len(w) - size + 1)]
    out = []
    for i, text in texts:
        w = words(text)
        hit, names = [False] * len(w), set()
        for p, item in patterns:
            for a in range(len(w) - len(p) + 1):
                if tuple(w[a:a + len(p)]) == p:
                    hit[a:a + len(p)] = [True] * len(p)
                    names.add(item)
        out.append((i, len(w), sum(hit), sorted(names), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return sorted(out, key=repr)


def case(seed):
    rng = random.Random(seed)
    texts = edge_texts(seed)
    items = [(None, "no id here at all")]
    for n in range(25):
        w = words(rng.choice([t for _, t in texts if t]))
        a = rng.randint(0, max(0, len(w) - 5))
        items.append((n, " ".join(w[a:a + rng.randint(1, 40)]).upper()))
    items += [(30, None), (31, ""), (32, "  .,; "), (33, items[3][1]), items[4], (34, "nothing of this occurs anywhere in those texts or so I hope now"), (35, "é語")]
    return texts, items


@pytest.mark.parametrize("seed, window, block", [(1, 13, 4 << 20), (2, 5, 300), (3, 1, 4 << 20)])
def test_hits(spark, seed, window, block):
    texts, items = case(seed)
    items_df = spark.createDataFrame(items, "item_id long, text string")
    found = contamination(benchmark_hits(frame(spark, texts), items_df, window=window, block_bytes=block))
    got = sorted(((r.row.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in found.collect()), key=repr)
    assert got == expected(texts, items, window)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert benchmark_hits(frame(spark, []), none).count() == 0
    found = contamination(benchmark_hits(frame(spark, edge_texts()), none))
    assert found.where("n_hit > 0 or contaminated").count() == 0


def test_long_texts(spark):
    """A passage beyond the slice in which a task takes texts, and one across its end."""
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(30)]
    noise = [f"n{rng.randint(0, 999)}" for _ in range(200_000)]
    long = " ".join([*noise[:150_000], *passage[:20], *noise[150_000:]])
    texts = [(1, long), (2, "x" * ((1 << 19) - 40) + " " + " ".join(passage)), (3, None), (3, "x")]
    items = [(7, " ".join(passage)), (8, "never " * 20)]
    found = contamination(benchmark_hits(frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")))
    got = sorted(((r.row.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in found.collect()), key=repr)
    assert got == expected(texts, items, 13)
