"""Words and their forms against plain Python over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallymart.llm import spelling
from tallymart.llm.spelling import altered_words, near_words, variants, vocabulary
from tests.llm.cases import frame

LETTERS = "abcdefghijklmnopqrstuvwxyzàéÿ÷ÀÉ"


def near(a, b):
    """One letter inserted, deleted or replaced."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def plain_words(texts, one_in, least):
    words = Counter()
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            words[run] += len(run) >= least
    return words


def plain_variants(words, factor=5):
    form = {}
    out = {}
    for w, n in words.items():
        others = sorted((-words[x], x) for x in words if near(w, x))
        if others and -others[0][0] >= factor * n:
            form[w] = others[0][1]
        out[w] = (form.get(w), n, len(others), words.get(form.get(w)))
    for w in out:
        root = w
        while root in form:
            root = form[root]
        out[w] = (out[w][0], root, *out[w][1:])
    return {(w, *r) for w, r in out.items()}


def spelled(seed, count=300):
    """Words with misspelt copies, of few letters so that many are near."""
    rng = random.Random(seed)
    words = Counter()
    for _ in range(count):
        base = "".join(rng.choice(LETTERS[:rng.choice([2, 5, 30])]) for _ in range(rng.randint(5, 14)))
        n = rng.choice([5, 30, 200])
        words[base] += n
        for _ in range(rng.randint(0, 6)):
            k = rng.randrange(len(base) + 1)
            bad = base[:k] + rng.choice(["", rng.choice(LETTERS)]) + base[k + rng.randint(0, 1):]
            words[bad] += rng.choice([1, 5, 6, n])
    return {w: n for w, n in words.items() if w}


def words_frame(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)


@pytest.mark.parametrize("seed,block,batch,ranges", [(1, 4096, 1 << 15, 1 << 21), (2, 8, 50, 40), (3, 3, 7, 1)])
def test_variants(spark, monkeypatch, seed, block, batch, ranges):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    monkeypatch.setattr(spelling, "BATCH_WORDS", batch)
    monkeypatch.setattr(spelling, "OPEN_RANGES", ranges)
    words = spelled(seed)
    got = [tuple(r) for r in variants(words_frame(spark, words)).collect()]
    assert len(got) == len(words) and set(got) == plain_variants(words)


def test_short_words_and_dense_blocks(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", 4)
    words = {a: 5 for a in "abcdé"} | {a + b: 7 for a in "abc" for b in "abé"} | {"aab": 100, "x" * 3000: 5, "x" * 3001: 50}
    words |= {"common" + a + b + c: 6 for a in "abcdef" for b in "abcdef" for c in "abcdef"}
    pairs = [(r.word, r.near) for r in near_words(words_frame(spark, words)).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(a, b) for a in words for b in words if near(a, b)}
    assert {tuple(r) for r in variants(words_frame(spark, words)).collect()} == plain_variants(words)


def test_chains_of_forms(spark):
    words = {"a" * 6 + "b" * k: 5 ** (6 - k) * 5 for k in range(7)}
    found = {r.word: r for r in variants(words_frame(spark, words)).collect()}
    assert {r.root for r in found.values()} == {"a" * 6} and found["aaaaaab"].form == "aaaaaa" and found["aaaaaa"].form is None
    tie = {"aaaaax": 100, "aaaaay": 100, "aaaaa": 5}
    assert {r.word: r.form for r in variants(words_frame(spark, tie)).collect()}["aaaaa"] == "aaaaax"


def odd_texts(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice(LETTERS + "XYZ") for _ in range(rng.randint(3, 9))) for _ in range(60)]
    texts = [(i, "".join(rng.choice(words) + rng.choice([" ", "-", "語", "\n", "ā", "1"]) for _ in range(rng.randint(0, 200)))) for i in range(80)]
    texts += [(None, texts[3][1]), (None, None), (90, None), (91, ""), texts[5], texts[5], (7, texts[9][1]), (92, "é" * 70 + " " + "Q" * 50)]
    return texts + [(93, "ZZZZZZZ " * 100_000)]


@pytest.mark.parametrize("one_in,held", [(0, 300_000), (3, 20), (199, 1000)])
def test_vocabulary(spark, monkeypatch, one_in, held):
    monkeypatch.setattr(spelling, "HELD_WORDS", held)
    texts = odd_texts(one_in)
    expected = {(w, n) for w, n in plain_words(texts, one_in, 6).items() if n >= 5}
    got = {tuple(r) for r in vocabulary(frame(spark, texts), alter_one_in=one_in).collect()}
    assert got == expected and len(got) > 20


def test_checksums():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = np.sort(rng.integers(0, 4000, 200))
    ends = starts + rng.integers(0, 100, 200)
    before = rng.integers(0, 2**32, 200).astype(np.uint32)
    expected = [zlib.crc32(data[a:b].tobytes(), int(c)) for a, b, c in zip(starts, ends, before)]
    assert spelling.checksums(data, starts, ends, before).tolist() == expected


def test_words_of_rows_that_touch():
    data = np.frombuffer("abcdefghijkl".encode(), np.uint8)
    assert altered_words(data, np.array([0, 6, 12]), [b"1", b"2"], 0, 6) == pa.array(["abcdef", "ghijkl"])


def test_empty_table(spark):
    assert variants(vocabulary(frame(spark, []), alter_one_in=199)).count() == 0
