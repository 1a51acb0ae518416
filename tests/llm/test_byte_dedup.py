"""Shared byte strings against brute force; merged transforms against sorting."""

from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest

from tallymart.llm import bwt, repeats
from tallymart.llm.byte_dedup import SPANS, ByteRuns, byte_dedup, crowded_anchors
from tallymart.llm.repeats import ID, TEXT
from tests.llm.cases import edge_texts, frame, place


def expected(texts, size):
    smallest: dict = {}
    for i, t in texts:
        b = (t or "").encode()
        for p in range(len(b) - size + 1):
            smallest[b[p:p + size]] = min(smallest.get(b[p:p + size], place(i, t)), place(i, t))
    out = []
    for i, t in texts:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - size + 1):
            if smallest[b[p:p + size]] < place(i, t):
                gone[p:p + size] = b"\1" * size
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed, size, anchor", [(1, 50, 20), (2, 20, 8), (3, 50, 24)])
def test_byte_dedup(spark, seed, size, anchor):
    texts = edge_texts(seed) + [(400, "ab" * 90), (401, "ba" * 70), (402, "x" * 200), (403, "x" * 120), (404, "\0" * 60), (405, "\0" * 60)]
    got = sorted(((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in byte_dedup(frame(spark, texts), size=size, anchor=anchor).collect()), key=repr)
    assert got == expected(texts, size)


@pytest.mark.parametrize("seed", [1, 2])
def test_every_anchor_hot(spark, seed):
    texts = edge_texts(seed) + [(400, "ab" * 90), (401, "ba" * 70), (402, "x" * 200), (403, "x" * 120)]
    got = sorted(((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in byte_dedup(frame(spark, texts), hot=1).collect()), key=repr)
    assert got == expected(texts, 50)


def test_hot_anchor(spark):
    """A phrase in a third of the documents between other neighbours: no piece
    of it is gathered whole, and what is shared around it still goes."""
    rng = np.random.default_rng(3)

    def noise(n):
        return bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()

    phrase, ends = "in witness whereof the parties", [noise(25) for _ in range(6)]
    texts = [(i, noise(60) + (rng.choice(ends) + phrase + rng.choice(ends) if i % 3 == 0 else "") + noise(60)) for i in range(300)]
    size, anchor = 50, 20

    def gathered(hot):
        method = ByteRuns(size, anchor, hot)
        source = pa.RecordBatch.from_pydict({ID: [i for i, _ in texts], TEXT: [t for _, t in texts]})
        whole = list(method.compare(1)(method.hashes(1)([source])))
        found = [repeats.unbundled(row, SPANS) for b in whole for row in b.to_pylist()]
        keys = {i: b"" for i, _ in texts}
        for ids, spans in found:
            for i, span in zip(ids.tolist(), spans):
                keys[i] += span.tobytes()
        asked = source.append_column("__keys", pa.array([keys[i] for i, _ in texts], pa.binary()))
        sent = list(method.spread(1)([asked]))
        return max((len(row["pieces"]) for b in sent for row in b.to_pylist()), default=0)

    before, after = gathered(10**6), gathered(4)
    got = sorted(((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in byte_dedup(frame(spark, texts), hot=4).collect()), key=repr)
    assert after < before / 2
    assert got == expected(texts, size) and any(r[2] for r in got)


@pytest.mark.parametrize("seed, looked_at", [(1, 1), (2, 2)])
def test_parted_anchors(spark, seed, looked_at):
    """Hashes around crowded anchors by themselves, around all of them or some."""
    texts = edge_texts(seed) + [(400, "ab" * 90), (401, "ba" * 70), (402, "x" * 200), (403, "x" * 120)]
    found = byte_dedup(frame(spark, texts), parted=looked_at, looked_at=looked_at)
    got = sorted(((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found.collect()), key=repr)
    assert got == expected(texts, 50)


def test_hashes_around_a_crowded_anchor_are_spread(spark):
    """One phrase in all documents: without parting one reducer gets its pieces."""
    rng = np.random.default_rng(4)

    def noise(n):
        return bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()

    texts = [(i, noise(6) + "in witness whereof the parties have signed it" + noise(6)) for i in range(400)]
    source = repeats.texts(frame(spark, texts), "doc_id", "text")
    method, buckets = ByteRuns(50, 20), 16
    crowded = crowded_anchors(source, method, 100, 1)

    def largest(parted):
        sent = replace(method, parted=parted).hashes(buckets)([
            pa.RecordBatch.from_pydict({ID: [i for i, _ in texts], TEXT: [t for _, t in texts]})
        ])
        pieces = np.zeros(buckets, int)
        for batch in sent:
            for row in batch.to_pylist():
                pieces[row["bucket"]] += len(repeats.unbundled(row)[1])
        return pieces.max() / pieces.sum()

    assert 0 < len(crowded) < 10
    assert largest(()) > 0.3 and largest(crowded) < 0.12


def test_empty_table(spark):
    assert byte_dedup(frame(spark, [])).count() == 0


@pytest.mark.parametrize("depth", [8, 10, 24])
def test_merge_equals_sorting(depth):
    rng = np.random.default_rng(depth)
    strings = [bytes(rng.choice([97, 98], rng.integers(30, 60)).astype(np.uint8)) for _ in range(40)]
    groups = [strings[:10], strings[10:13], strings[13:]]
    shards, rotations = [], []
    for group in groups:
        text = np.frombuffer(b"".join(group), np.uint8)
        closed, bounds = bwt.closed(text, np.concatenate([[0], np.cumsum([len(s) for s in group])]))
        shards.append(bwt.shard(closed, bounds))
        turned = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            s = closed[a:b].tobytes()
            turned += [s[i:] + s[:i] for i in range(len(s))]
        rotations.append([turned[i] for i in shards[-1].order])
    which, place, blocks = bwt.merge(shards, depth)
    heads = [rotations[w][p][:depth] for w, p in zip(which, place)]
    assert heads == sorted(heads)
    assert [a == b for a, b in zip(heads, heads[1:])] == list(blocks[1:] == blocks[:-1])


def test_shared_windows_over_many_shards(monkeypatch):
    monkeypatch.setattr(bwt, "SHARD_BYTES", 300)
    rng = np.random.default_rng(5)
    strings = [bytes(rng.choice([97, 98, 99], rng.integers(12, 90)).astype(np.uint8)) for _ in range(60)]
    strings += [strings[3][5:] + b"zz", strings[7] + strings[8]]
    ids = rng.integers(0, 40, len(strings))
    size, smallest = 12, {}
    for i, s in zip(ids, strings):
        for p in range(len(s) - size + 1):
            smallest[s[p:p + size]] = min(smallest.get(s[p:p + size], 99), i)
    wanted = [smallest.get(s[p:p + size], i) < i for i, s in zip(ids, strings) for p in range(len(s))]
    data = np.frombuffer(b"".join(strings), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
    assert bwt.shared_windows(data, bounds, ids, size).tolist() == wanted
    assert bwt.shared_windows(data[:0], bounds[:1], ids[:0], size).tolist() == []


def test_shared_windows_above_64_bytes(monkeypatch):
    monkeypatch.setattr(bwt, "SHARD_BYTES", 2000)
    rng = np.random.default_rng(6)
    base = b"a" * 90
    strings = [base + bytes(rng.choice([97, 98], 60).astype(np.uint8)) for _ in range(60)]
    ids = rng.integers(0, 40, len(strings))
    size, smallest = 100, {}
    for i, s in zip(ids, strings):
        for p in range(len(s) - size + 1):
            smallest[s[p:p + size]] = min(smallest.get(s[p:p + size], 99), i)
    wanted = [smallest.get(s[p:p + size], i) < i for i, s in zip(ids, strings) for p in range(len(s))]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
    assert bwt.shared_windows(np.frombuffer(b"".join(strings), np.uint8), bounds, ids, size).tolist() == wanted


def test_long_texts(spark):
    """Beyond the slice in which a task takes texts, with two letters in an order
    whose sums cancel."""
    rng = np.random.default_rng(8)
    long = bytes(rng.integers(97, 123, 700_000).astype(np.uint8)).decode()
    turns = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    texts = [(1, long), (2, long[300:600_000] + "!" + long[500_000:]), (3, turns), (4, turns.translate({97: "b", 98: "a"})), (5, None), (5, long[:60])]
    got = sorted(((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in byte_dedup(frame(spark, texts)).collect()), key=repr)
    assert got == expected(texts, 50)


@pytest.mark.parametrize("depth", [8, 12, 50])
def test_merge_of_repeated_rotations_leaves_out_those_alone(depth):
    rng = np.random.default_rng(depth)
    strings = [bytes(rng.choice([97, 98], rng.integers(60, 90)).astype(np.uint8)) for _ in range(30)]
    strings += [s[:58] + b"c" for s in strings[:9]]
    shards = []
    for group in (strings[:20], strings[20:21], strings[21:]):
        text = np.frombuffer(b"".join(group), np.uint8)
        shards.append(bwt.shard(*bwt.closed(text, np.concatenate([[0], np.cumsum([len(s) for s in group])]))))
    which, place, blocks = bwt.merge(shards, depth)
    sizes = np.bincount(blocks)[blocks]
    assert 0 < (sizes == 1).sum() < len(sizes)
    found = bwt.merge(shards, depth, repeated=True)

    def groups(which, place, blocks):
        return [sorted(zip(which[blocks == b].tolist(), place[blocks == b].tolist())) for b in dict.fromkeys(blocks.tolist())]

    several = sizes > 1
    assert groups(*found) == groups(which[several], place[several], blocks[several])
    lone = bwt.shard(*bwt.closed(np.frombuffer(b"abcdefghijklmnop", np.uint8), np.array([0, 16])))
    assert [len(x) for x in bwt.merge([lone], depth, repeated=True)] == [0, 0, 0]
