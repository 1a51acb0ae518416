"""Groups of alike texts against brute force over their shingle sets."""

import random

import pytest

import corpus_pipeline
from tallymart.llm import near_copies
from tests.llm.cases import edge_texts, frame, words_of
from tests.llm.test_simhash import groups, plain_fingerprint


def shingles(text):
    words = [w.lower() if w.isascii() else w for w in words_of(text)]
    return frozenset(tuple(words[i:i + 5]) for i in range(max(len(words) - 4, min(1, len(words)))))


def near_texts(seed):
    """Copies with none to ten of 200 words changed, at or below and above 0.8."""
    rng = random.Random(seed)
    texts = edge_texts(seed)
    for i in range(12):
        base = [f"v{rng.randint(0, 10**6)}" for _ in range(200)]
        for j in range(6):
            other = list(base)
            for at in rng.sample(range(200), rng.randint(0, 10)):
                other[at] = f"u{rng.randint(0, 10**6)}"
            texts.append((1000 + 10 * i + j, " ".join(other)))
    return texts


@pytest.mark.parametrize("seed, block", [(1, 1024), (2, 1024), (3, 3)])
def test_stage(spark, monkeypatch, seed, block):
    monkeypatch.setattr(near_copies, "BLOCK_NODES", block)
    texts = near_texts(seed)
    sets = [shingles(t) for _, t in texts]
    names = {s: n for n, s in enumerate(dict.fromkeys(sets))}
    own = list(names)
    root = groups(range(len(own)), lambda a, b: len(own[a] & own[b]) >= 0.8 * len(own[a] | own[b]))
    wanted = {}
    for (i, _), s in zip(texts, sets):
        if i is not None:
            wanted[root[names[s]]] = min(wanted.get(root[names[s]], i), i)
        else:
            wanted.setdefault(root[names[s]], 10**9)
    got = corpus_pipeline.near_duplicates(spark, frame(spark, texts), "").collect()
    assert sorted(10**9 if r.doc_id is None else r.doc_id for r in got) == sorted(wanted.values())
    assert {(r.doc_id, r.text) for r in got} <= set(texts)
    assert len(set(root.values())) < len(root)


def test_links_of_fingerprints(spark, monkeypatch):
    """What fingerprints link is found without any MinHash cell, and is verified."""
    every = near_copies.meetings
    monkeypatch.setattr(near_copies, "meetings", lambda nodes: every(nodes).limit(0))
    texts = [(i, t) for i, t in near_texts(5) if i is not None and t]
    # the same words in another order have few or no shingles in common
    swapped = "one two " * 40
    texts += [(3000, swapped + "a b c d e"), (3001, "two one " * 3 + swapped + "f g h i j")]
    sets, fps = [shingles(t) for _, t in texts], [plain_fingerprint(t, 2) for _, t in texts]
    least = {s: min(i for (i, _), o in zip(texts, sets) if o == s) for s in set(sets)}
    fp = {s: {f for f, o in zip(fps, sets) if o == s} for s in least}
    own = [s for s in least if len(fp[s]) == 1]
    alike = [
        (a, b) for a in own for b in own if a is not b
        and (next(iter(fp[a])) ^ next(iter(fp[b]))).bit_count() <= 5 and len(a & b) >= 0.8 * len(a | b)
    ]
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, frame(spark, texts), "").collect()}
    assert len(alike) > 20
    assert not [1 for a, b in alike if least[a] in got and least[b] in got]


def test_long_repeated_and_no_texts(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(110_000)]
    other = list(words)
    for at in rng.sample(range(len(words)), 1500):
        other[at] = "changed"
    texts = [(5, " ".join(words)), (6, " ".join(other)), (7, "alone in this"), (7, "alone in this"), (None, None), (8, None)]
    got = corpus_pipeline.near_duplicates(spark, frame(spark, texts), "").collect()
    assert sorted((r.doc_id for r in got), key=repr) == [5, 7, 8]
    assert corpus_pipeline.near_duplicates(spark, frame(spark, []), "").count() == 0
