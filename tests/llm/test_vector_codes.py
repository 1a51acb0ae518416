"""Codes against plain k-means over lists of whole numbers."""

import math
import random

import numpy as np
import pytest

from tallymart.llm import vector_codes as module
from tallymart.llm.vector_codes import Tree, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, row int, `__row` string, code string"


def sample(seed, count=700, width=8):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(5)]
    rows = []
    for i in range(count):
        centre = rng.choice(centres)
        rows.append((i * 3 + 2, [float(np.float32(c + rng.gauss(0, 0.1))) for c in centre], rng.choice([1, 2, None])))
    same = rows[7][1]
    rows += [(5000 + i, same, 9) for i in range(350)]  # a third of all rows
    rows += [(1, None, 1), (4, [0.5] * (width - 1) + [None], 1), (7, [math.nan] + [0.0] * (width - 1), 2)]
    rows += [(10, [math.inf] + [0.0] * (width - 1), 2), (13, [-math.inf] * width, 2)]
    rows += [rows[3], rows[3], (rows[4][0], rows[5][1], 2), (None, rows[6][1], None), (None, [1e30] * width, 1)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "r", "c") for i, v, label in rows], SCHEMA).repartition(4)


def plain(rows, parts, entries, rounds, scale=4096):
    """{(id, label, vector): (code, error)} and the codebooks."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return [], []
    width = len(kept[0][1])
    most = math.isqrt(2**62 // width) // 2
    numbers = [[math.floor(min(max(x * scale, -most), most)) for x in v] for _, v, _ in kept]
    size = width // parts
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[numbers[k][p * size:(p + 1) * size] for k in first] for p in range(parts)]

    def nearest(p, v):
        own = v[p * size:(p + 1) * size]
        far = [sum((a - b) ** 2 for a, b in zip(own, e)) for e in books[p]]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in numbers:
                groups.setdefault(nearest(p, v)[0], []).append(v[p * size:(p + 1) * size])
            books[p] = [
                [sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])
            ]
    out = []
    for (i, _, label), v in zip(kept, numbers):
        found = [nearest(p, v) for p in range(parts)]
        out.append((i, label, [k for k, _ in found], sum(e for _, e in found)))
    return out, books


@pytest.mark.parametrize("parts,chunk,leaf", [(4, 2048, 48), (2, 64, 4), (8, 100, 1)])
def test_codes(spark, monkeypatch, parts, chunk, leaf):
    monkeypatch.setattr(module, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(module, "LEAF_ROWS", leaf)
    rows = sample(parts)
    expected, books = plain(rows, parts, 16, 6)
    result = vector_codes(frame(spark, rows), parts=parts)
    got = [(r.row.vec_id, r.row.label, list(r.code), r.error) for r in result.found.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert [b.tolist() for b in result.books] == books
    assert result.found.select("row.*").columns == ["vec_id", "label", "row", "__row", "code"]


def test_balls_hold_their_points():
    points = np.random.default_rng(3).integers(-5000, 5000, (900, 4))
    points[100:400] = points[5]
    tree = Tree.unpacked(Tree.of(points).packed())
    assert sorted(tree.order.tolist()) == list(range(900)) and (tree.points == points[tree.order]).all()
    for a, b, left, right, radius, total in zip(tree.starts, tree.ends, tree.left, tree.right, tree.radii, tree.sums):
        own = tree.points[a:b]
        assert (own.sum(axis=0) == total).all()
        assert np.sqrt(((own - total / (b - a)) ** 2).sum(axis=1)).max() <= radius * (1 + 1e-9) + 1e-9
        if left >= 0:
            assert tree.starts[left] == a and tree.ends[left] == tree.starts[right] and tree.ends[right] == b
    assert (tree.left >= 0).sum() > 10


def test_most_balls_are_taken_whole():
    rng = np.random.default_rng(4)
    centres = rng.integers(-50_000, 50_000, (16, 8))
    points = (centres[rng.integers(0, 16, 2000)] + rng.integers(-300, 300, (2000, 8))).astype(np.int64)
    tree, seen = Tree.of(points), []
    compared = tree._compared
    tree._compared = lambda balls, *rest: (seen.append((tree.ends[balls] - tree.starts[balls]).sum()), compared(balls, *rest))
    counts = np.zeros(16, np.int64)
    tree.owners(centres, np.zeros_like(centres), counts, None)
    assert counts.sum() == 2000 and sum(seen) < 200


def test_few_rows_equal_entries_and_ties(spark):
    rows = [(3, [0.0, 1.0], 1), (1, [0.0, 1.0], 1), (2, [2.0, 1.0], None), (None, [1.0, 1.0], 3)]
    expected, books = plain(rows, 2, 16, 6)
    result = vector_codes(frame(spark, rows), parts=2)
    assert [b.tolist() for b in result.books] == books
    got = [(r.row.vec_id, r.row.label, list(r.code), r.error) for r in result.found.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_other_lengths_and_errors(spark):
    rows = [(1, [0.0, 1.0], 1), (2, [2.0, 1.0, 3.0], None), (3, [], 1), (4, [1.0, 1.0], 1)]
    found = {r.row.vec_id: r.code for r in vector_codes(frame(spark, rows), parts=2).found.collect()}
    assert found[2] is None and found[3] is None and found[1] is not None and found[4] is not None
    with pytest.raises(ValueError, match="do not divide"):
        vector_codes(frame(spark, rows[:1]), parts=3)


def test_empty_and_unusable_tables(spark):
    for rows in ([], [(1, None, 1)]):
        result = vector_codes(frame(spark, rows))
        assert result.books == [] and result.found.count() == 0 and result.listing() == ""
