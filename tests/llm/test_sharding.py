"""Shards: balance, whole groups, gapless slots, large groups split."""

import re
import zlib
from collections import Counter, defaultdict

import pytest

from tallymart.llm.sharding import sharded
from tests.llm.cases import edge_texts, frame


def collected(df):
    return [(r.row.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in df.collect()]


def check(texts, rows, shards):
    sizes = lambda t: len((t or "").encode())
    wanted = sorted(((i, sizes(t) + 1, zlib.crc32((t or "").encode())) for i, t in texts), key=repr)
    assert sorted((r[:3] for r in rows), key=repr) == wanted
    slots = defaultdict(list)
    for r in rows:
        slots[r[3]].append(r[4])
    for shard, found in slots.items():
        assert 0 <= shard < shards and sorted(found) == list(range(len(found)))
    load = Counter()
    for r in rows:
        load[r[3]] += r[1]
    return [load[s] for s in range(shards)]


def test_edge_texts(spark):
    texts = edge_texts(6)
    for cells in (4096, 16):
        rows = collected(sharded(frame(spark, texts), 3, cells=cells))
        check(texts, rows, 3)


def test_balance_and_groups(spark):
    texts = [(i, "word " * (i % 50 + 1)) for i in range(3000)]
    texts = [(i, f"{i // 3} {t}") for i, t in texts]
    rows = collected(sharded(frame(spark, texts), 8))
    load = check(texts, rows, 8)
    assert max(load) - min(load) <= 0.01 * max(load)
    counts = Counter(r[3] for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 0.05 * len(rows) / 8
    texts = [(i, f"{i % 500} " + "w " * (i % 7)) for i in range(3500)]
    rows = collected(sharded(frame(spark, texts), 4))
    by_text = defaultdict(set)
    for r in rows:
        by_text[texts[r[0]][1]].add(r[3])
    assert all(len(s) == 1 for s in by_text.values())


def test_a_third_of_all_rows_in_one_group(spark):
    texts = [(i, "the same text in very many rows" if i % 3 == 0 else f"text number {i} of its own kind") for i in range(6000)]
    rows = collected(sharded(frame(spark, texts), 8, cells=1024))
    load = check(texts, rows, 8)
    assert max(load) - min(load) <= 0.05 * max(load)


@pytest.mark.parametrize("own_id", [None, 7])
def test_a_third_of_all_rows_without_ids_of_their_own(spark, own_id):
    texts = [(own_id if i % 3 == 0 else i, "the same text in very many rows" if i % 3 == 0 else f"text number {i} of its own") for i in range(6000)]
    load = check(texts, collected(sharded(frame(spark, texts), 8)), 8)
    assert max(load) - min(load) <= 0.01 * max(load)


def test_rows_of_a_hot_group_are_ranked_in_parts(spark):
    """No task ranks more than a small share of a group, also without ids."""
    texts = [(None, "the same text")] * 4000
    ranked = sharded(frame(spark, texts), 8, cells=64)
    keys = re.findall(r"windowspecdefinition\(unit#\d+L, piece#\d+L, part#\d+L,", ranked._jdf.queryExecution().toString())
    assert keys
    load = check(texts, collected(ranked), 8)
    assert max(load) - min(load) <= 0.05 * max(load)


def test_a_very_long_text(spark):
    texts = [(1, "long " * 300_000), (2, "short"), (3, None)]
    rows = collected(sharded(frame(spark, texts), 2))
    assert len({r[3] for r in rows if r[0] != 1} - {r[3] for r in rows if r[0] == 1}) == 1
    check(texts, rows, 2)


def test_empty_table(spark):
    assert sharded(frame(spark, [])).count() == 0
