"""Fingerprints, links and groups against brute force."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tallymart.llm import components, simhash
from tests.llm.cases import edge_texts, frame


def plain_fingerprint(text, shingle=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    parts = [" ".join(words[i:i + shingle]) for i in range(max(len(words) - shingle + 1, min(1, len(words))))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def near_texts(seed):
    rng = random.Random(seed)
    texts = edge_texts(seed)
    for i in range(12):
        base = [f"v{rng.randint(0, 10**6)}" for _ in range(150)]
        for j in range(5):
            other = list(base)
            for _ in range(rng.randint(0, 3)):
                other[rng.randrange(len(other))] = f"u{rng.randint(0, 99)}"
            texts.append((1000 + 10 * i + j, " ".join(other)))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates(spark, seed):
    texts = near_texts(seed)
    wanted = [plain_fingerprint(t) for _, t in texts]
    distinct = sorted(set(wanted))
    root = groups(distinct, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for (i, _), f in zip(texts, wanted):
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    expected = sorted(((i, f, least.get(root[f])) for (i, _), f in zip(texts, wanted)), key=repr)
    got = simhash.near_duplicates(simhash.fingerprints(frame(spark, texts))).collect()
    assert sorted(((r.row.doc_id, r.fingerprint % 2**64, r.component_id) for r in got), key=repr) == expected
    assert len(set(root.values())) < len(distinct)


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3, 4])
def test_links_find_every_pair(spark, max_bits):
    rng = random.Random(max_bits)
    values = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        values.add(base)
        for _ in range(6):
            values.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))))
    values = sorted(values)
    rows = [(v - 2**64 if v >= 2**63 else v, i) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "fp long, node long").repartition(4)
    pairs = {(r.a, r.b) for r in simhash.links(df, max_bits).collect()}
    root = groups(range(len(values)), lambda a, b: (values[a] ^ values[b]).bit_count() <= max_bits)
    joined = groups(range(len(values)), lambda a, b: (a, b) in pairs or (b, a) in pairs)
    assert joined == root


def test_one_crowded_cell(spark, monkeypatch):
    """Thousands of near copies send fewer links than there are rows."""
    rng = random.Random(7)
    base = rng.getrandbits(63)
    values = sorted({base ^ sum(1 << b for b in rng.sample(range(40), 3)) for _ in range(1500)})
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "fp long, node long")
    found = simhash.links(df, 3)
    cells = simhash.grid(df, 3).count()
    assert found.count() < cells
    root = groups(range(len(values)), lambda a, b: (values[a] ^ values[b]).bit_count() <= 3)
    got = {r.node: r.root for r in components.roots(found).collect()}
    assert {n: got.get(n, n) for n in root} == root


def test_long_chain(spark):
    chain = spark.range(400).select(((F.col("id") * 7919) % 401).alias("a"), (((F.col("id") + 1) * 7919) % 401).alias("b"))
    got = components.roots(chain)
    assert got.count() == 400 and got.agg(F.max("root")).first()[0] == 0


def test_empty_table(spark):
    assert simhash.near_duplicates(simhash.fingerprints(frame(spark, []))).count() == 0


@pytest.mark.parametrize("rows", [10, 60])
def test_crowded_cells_are_parted(spark, monkeypatch, rows):
    """Groups as brute force finds them, when every cell of a few rows counts as crowded."""
    monkeypatch.setattr(simhash, "CELL_ROWS", rows)
    rng = random.Random(rows)
    low = [rng.getrandbits(10) for _ in range(150)]  # all in one cell of one part
    values = sorted({0xABCDEF0000000000 | v << 3 for v in low} | {rng.getrandbits(64) for _ in range(20)})
    signed = [(v - 2**64 if v >= 2**63 else v,) * 2 for v in values]
    found = simhash.links(spark.createDataFrame(signed, "fp long, node long").repartition(3)).collect()
    pairs = {tuple(sorted((r.a % 2**64, r.b % 2**64))) for r in found}
    linked = lambda a, b: (a ^ b).bit_count() <= 3
    assert all(linked(a, b) for a, b in pairs)
    assert groups(values, lambda a, b: (a, b) in pairs) == groups(values, linked)


def test_a_large_cell_takes_no_square_of_time(spark):
    """Forty thousand fingerprints that share one part meet in small cells."""
    fps = spark.range(40_000).select((F.xxhash64("id").bitwiseAND(F.lit(0xFFFFFFFF)) + F.lit(0x5A5A5A5A << 32)).alias("fp")).distinct()
    cells = simhash.bounded_cells(simhash.grid(fps.select("fp", F.col("fp").alias("node")), 3), 3)
    assert cells.groupBy("part", "cell", "held", "value").count().agg(F.max("count")).first()[0] <= simhash.CELL_ROWS


def test_fingerprint_of_a_long_text(spark):
    rng = random.Random(5)
    long = " ".join(f"w{rng.randint(0, 500)}" for _ in range(130_000))
    texts = [(1, long), (2, long + " end"), (3, None), (3, "one")]
    got = {(r.row.doc_id, r.fingerprint % 2**64) for r in simhash.fingerprints(frame(spark, texts)).collect()}
    assert got == {(i, plain_fingerprint(t)) for i, t in texts}
