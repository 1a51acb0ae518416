"""Repeated runs of words and lines against brute force."""

import random

import pytest

from tallymart.llm import repeats
from tallymart.llm.line_dedup import line_dedup
from tallymart.llm.substring_dedup import difference_cover, substring_dedup
from tests.llm.cases import edge_texts, frame, repeated, words_of


def expected_words(texts, size):
    return sorted(
        ((i, len(seq), sum(gone), " ".join(w for w, g in zip(seq, gone) if not g))
         for (i, _), (seq, gone) in zip(texts, repeated(texts, words_of, size))), key=repr)


def collected(df):
    return sorted(((r.row.doc_id, r.n_units, r.n_removed, r.kept_text) for r in df.collect()), key=repr)


@pytest.mark.parametrize("period", [2, 7, 13, 21, 31, 40])
def test_cover_has_every_difference(period):
    cover = difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("seed, window, period", [(1, 20, 13), (2, 20, 7), (3, 5, 3)])
def test_substring_dedup(spark, seed, window, period):
    texts = edge_texts(seed)
    got = substring_dedup(frame(spark, texts), window=window, period=period)
    assert collected(got) == expected_words(texts, window)


def test_small_groups_give_the_same(spark, monkeypatch):
    """Keys judged in many small groups, as over many tasks."""
    monkeypatch.setattr(repeats, "GROUP_KEYS", 50)
    texts = edge_texts(4)
    assert collected(substring_dedup(frame(spark, texts))) == expected_words(texts, 20)


def test_other_columns_are_kept(spark):
    got = substring_dedup(frame(spark, edge_texts())).select("row.*")
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "keys", "row", "__row"]


def test_texts_are_shuffled_once(spark):
    df = substring_dedup(frame(spark, edge_texts()))
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_window_must_hold_the_period(spark):
    with pytest.raises(ValueError):
        substring_dedup(frame(spark, []), window=5, period=9)


def line_texts(seed):
    rng = random.Random(seed)
    pool = [f"line {i} é" for i in range(30)]
    texts = []
    for i in range(80):
        lines = [rng.choice(["", "  ", *pool[:12]]) if rng.random() < 0.2 else f"own {rng.random()}" for _ in range(rng.randint(0, 9))]
        if rng.random() < 0.5:
            at = rng.randint(0, 20)
            lines += pool[at:at + rng.randint(2, 9)]
        if rng.random() < 0.2:
            lines += lines
        texts.append((i, "\n".join(lines)))
    return texts + [(None, texts[5][1]), (200, None), (201, ""), (202, "\n\n"), (203, texts[7][1]), texts[9], texts[9]]


def expected_lines(texts, size):
    def full(text):
        return [x for x in (text or "").split("\n") if words_of(x)]

    out = []
    for (i, text), (seq, gone) in zip(texts, repeated(texts, full, size)):
        kept, at, last = [], 0, False
        for x in (text or "").split("\n"):
            if words_of(x):
                last = gone[at]
                at += 1
            if not last:
                kept.append(x)
        out.append((i, len(seq), sum(gone), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed, size", [(1, 3), (2, 2), (3, 5), (4, 1)])
def test_line_dedup(spark, seed, size):
    texts = line_texts(seed)
    assert collected(line_dedup(frame(spark, texts), min_lines=size)) == expected_lines(texts, size)


def test_runs_of_many_words(spark):
    """One line, or two lines together, of at least ``min_words`` words."""
    long = " ".join(f"w{i}" for i in range(50))
    half, other = " ".join(f"h{i}" for i in range(20)), " ".join(f"o{i}" for i in range(30))
    texts = [
        (1, f"a\n{long}\nb"), (2, f"c\n\n{long}\nd"), (3, long), (4, f"x\n{half}\n{other}\ny"), (5, f"{half}\n\n{other}"),
        (6, f"{half}\nz\n{other}"), (7, f"e\n{long} more\nf\n{long} more"), (8, long.replace("w49", "")), (None, long),
    ]
    gone = {1: 0, 2: 1, 3: 1, 4: 0, 5: 2, 6: 0, 7: 1, 8: 0, None: 1}
    kept = dict(texts) | {2: "c\n\nd", 3: "", 5: "", 7: f"e\n{long} more\nf", None: ""}
    got = collected(line_dedup(frame(spark, texts)))
    assert {(i, n, t) for i, _, n, t in got} == {(i, gone[i], kept[i]) for i in kept}
    assert all(n == 0 for _, _, n, _ in collected(line_dedup(frame(spark, texts), min_words=10_000)))


def thue_morse(size, one, other):
    return [one if bin(i).count("1") % 2 else other for i in range(size)]


@pytest.mark.parametrize("size", [512, 1024, 4096])
def test_lines_and_words_of_two_letters_in_turn_are_told_apart(spark, size):
    """Sequences whose sums modulo powers of two agree, whatever the base."""
    lines = [" ".join(thue_morse(size, *pair)) for pair in ("ab", "ba")]
    kept = {i: t for i, _, _, t in collected(line_dedup(frame(spark, list(enumerate(lines)))))}
    assert kept == dict(enumerate(lines))
    words = ["".join(thue_morse(size, *pair)) for pair in ("ab", "ba")]
    texts = [(i, " ".join([w] * 3 + [f"w{k}" for k in range(30)])) for i, w in enumerate(words)]
    assert collected(substring_dedup(frame(spark, texts))) == expected_words(texts, 20)


def test_long_texts(spark):
    """Beyond the slice in which a task takes texts."""
    rng = random.Random(8)
    words = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(120_000)]
    long = " ".join(words)
    texts = [(1, long), (2, " ".join(words[500:90_000] + ["end"])), (3, " ".join(words[:30]) + " " + long[::-1])]
    assert collected(substring_dedup(frame(spark, texts))) == expected_words(texts, 20)
    lines = [(i, t.replace(" ", "\n")) for i, t in texts]
    assert collected(line_dedup(frame(spark, lines))) == expected_lines(lines, 3)


def test_empty_tables(spark):
    assert line_dedup(frame(spark, [])).count() == 0
    assert substring_dedup(frame(spark, [])).count() == 0

