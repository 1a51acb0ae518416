"""Scores against a context tree that is walked recursively, in plain Python."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallymart.llm import context_tree
from tests.llm.cases import edge_texts, frame, words_of

DEPTH = context_tree.DEPTH


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sequence(text):
    return [255] * DEPTH + list(low(text).encode()) + [255]


def decisions(byte):
    return [((1 << k) | byte >> (8 - k), byte >> (7 - k) & 1) for k in range(8)]


class PlainTree:
    """Counts and weighted probabilities by recursion over longer contexts."""

    def __init__(self, texts):
        self.counts = defaultdict(lambda: [0, 0])
        self.longer = defaultdict(set)
        self.weights = {}
        for text in texts:
            seq = sequence(text)
            for i in range(DEPTH, len(seq)):
                for node, bit in decisions(seq[i]):
                    for d in range(DEPTH + 1):
                        context = tuple(seq[i - d:i])
                        self.counts[context, node][bit] += 1
                        if d:
                            self.longer[context[1:], node].add(context)

    def estimate(self, context, node):
        zeros, ones = self.counts[context, node]
        return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)

    def weighted(self, context, node):
        if (context, node) not in self.weights:
            own = self.estimate(context, node)
            if len(context) < DEPTH:
                below = sum(self.weighted(c, node) for c in self.longer[context, node])
                top = max(own, below)
                own = top + math.log(0.5 * math.exp(own - top) + 0.5 * math.exp(below - top))
            self.weights[context, node] = own
        return self.weights[context, node]

    def one(self, before, node, depth=0):
        context = tuple(before[len(before) - depth:])
        if (context, node) not in self.counts:
            return 0.5
        zeros, ones = self.counts[context, node]
        own = (ones + 0.5) / (zeros + ones + 1)
        if depth == DEPTH:
            return own
        # the estimate's share of the weighted probability
        share = math.exp(self.estimate(context, node) - math.log(2) - self.weighted(context, node))
        return share * own + (1 - share) * self.one(before, node, depth + 1)

    def score(self, text):
        seq, total = sequence(text), 0.0
        for i in range(DEPTH, len(seq)):
            for node, bit in decisions(seq[i]):
                one = self.one(seq[i - DEPTH:i], node)
                total += math.log10(one if bit else 1 - one)
        return total


def plain(texts, learn):
    tree = PlainTree([t for (i, t), own in zip(texts, learn) if own])
    words = Counter()
    for (_, t), own in zip(texts, learn):
        if own:
            words.update([*words_of(low(t)), ""])
    total, out = sum(words.values()), []
    for i, t in texts:
        tokens = [*words_of(low(t)), ""]
        base = sum(math.log10((words[w] + 1) / (total + len(words) + 1)) for w in tokens)
        out.append((i, len((t or "").encode()), len(tokens), sum(words[w] > 0 for w in tokens), total, base, tree.score(t)))
    return sorted(out, key=repr)


def same(got, expected):
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9) and a[6] == pytest.approx(b[6], rel=1e-7, abs=1e-7)


def scores(spark, texts, learn):
    df = frame(spark, texts)
    found = context_tree.scored(df, learn).collect()
    return sorted(((r.row.doc_id, *r[1:]) for r in found), key=repr)


def cases():
    rng = random.Random(5)
    texts = [(i, t[:400] if t else t) for i, t in edge_texts(2)]
    texts += [(400 + i, "ABC abc Étude\n" * rng.randint(0, 9) + "zq" * i) for i in range(9)]
    return texts + [(500 + i, "always the same text") for i in range(len(texts) // 2)]


@pytest.mark.parametrize("block,slice_bytes,chunk", [(1 << 20, 2 << 20, 64 << 20), (7, 50, 300)])
def test_scores(spark, monkeypatch, block, slice_bytes, chunk):
    monkeypatch.setattr(context_tree, "BLOCK", block)
    monkeypatch.setattr(context_tree, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(context_tree, "CHUNK_BYTES", chunk)
    texts = cases()
    learn = [i is not None and i % 7 != 2 for i, _ in texts]
    same(scores(spark, texts, F.col("doc_id") % 7 != 2), plain(texts, learn))


def test_nothing_learned(spark):
    texts = [(1, "ab"), (2, None), (2, "ab")]
    same(scores(spark, texts, F.lit(False)), plain(texts, [False] * 3))
    assert scores(spark, texts, F.lit(None).cast("boolean"))[0][6] == pytest.approx(-8 * 3 * math.log10(2))


def test_probabilities_of_a_byte_add_up(spark):
    texts = [(1, "banana bandana"), (2, "a")]
    every = [(10 + b, "ban" + chr(b)) for b in range(128) if not chr(b).isupper()]
    found = {r[0]: r[6] for r in scores(spark, texts + every, F.col("doc_id") < 10)}
    tree = PlainTree(["banana bandana", "a"])
    assert all(found[i] == pytest.approx(tree.score(t)) for i, t in every)
    before = [255, *b"ban"]
    total = sum(math.prod(p if bit else 1 - p for p, bit in ((tree.one(before, n), x) for n, x in decisions(b))) for b in range(256))
    assert total == pytest.approx(1)


def test_long_text_is_scored_in_blocks(spark):
    text = "the end of the line " * 60_000
    texts = [(1, text), (2, "the end of the line ")]
    found = scores(spark, texts, F.col("doc_id") == 2)
    assert found[0][1] == len(text) and found[0][2] == 300_001
    short = PlainTree([texts[1][1]])
    twice, thrice = short.score(texts[1][1] * 2), short.score(texts[1][1] * 3)
    assert found[0][6] == pytest.approx(twice + (thrice - twice) * 59_998, rel=1e-9)


def test_learned_texts_foretell_others_of_their_kind(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    found = context_tree.scored(docs, F.col("doc_id") % 7 != 2).where("row.doc_id % 7 = 2")
    model, size = found.agg(F.sum("score"), F.sum("n_bytes")).first()
    data = b"".join(low(r.text).encode() for r in docs.where("doc_id % 7 = 2").collect())
    alone = -sum(n * math.log2(n / len(data)) for n in Counter(data).values()) / len(data)
    assert -model / math.log10(2) / size < 0.75 * alone


def test_query_holds_out_by_checksum(spark):
    from tallymart.llm.queries import op12_lm_scoring

    rows = op12_lm_scoring(spark, "/root/testdata/sf0.001").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in rows) and len(rows) == 200


def test_empty_table(spark):
    assert context_tree.scored(frame(spark, []), F.lit(True)).count() == 0


def test_levels_of_longer_contexts_are_not_broadcast(spark, monkeypatch):
    """Their files are small, their rows many: as a broadcast they fill the driver."""
    plans, keep = {"mixed": [], "decisions": []}, context_tree.stored

    def spied(df, label, **options):
        plans.setdefault(label, []).append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, label, **options)

    monkeypatch.setattr(context_tree, "stored", spied)
    found = context_tree.scored(frame(spark, [(1, "banana bandana"), (2, "a band"), (3, "zebra")]), F.col("doc_id") < 3)
    plans["answers"] = [found._jdf.queryExecution().executedPlan().toString()]
    assert [len(plans[k]) for k in ("mixed", "decisions")] == [DEPTH + 1, DEPTH + 1]
    for plan in [*plans["mixed"][3:], *plans["decisions"][:DEPTH - 1], *plans["answers"]]:
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
