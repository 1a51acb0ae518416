"""Pieces: exact ids, full windows, every token once."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from tallymart.llm.packing import Encoder, pack, packed, steps
from tests.llm.cases import edge_texts, frame

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "It's we're I'll THEY'D 'tis '' s", "œuvre “quoted” naïve ǅ İstanbul ΑΣ Σ ﬁ", "a b c\x85d", "<|endoftext|> in <|start", "x²½ 3¾ µ ª º",
    "日本語 のテキスト", "é combining ́ x", "tab\tnew\nline\x00zero", "1234 5,6.7!", "", " ", "🎉 party 🎉🎉", "don’t", "ẞ STRASSE ß",
]


def test_ids_equal_the_tokenizer():
    encode = Encoder(PATH, 2)
    rng = random.Random(3)
    texts = ODD + [t for _, t in edge_texts() if t]
    texts += ["".join(rng.choice("aé ß'sœ.12\n日Z² ́") for _ in range(60)) for _ in range(300)]
    for text in texts:
        ids = encode.tokenizer.encode(text, add_special_tokens=False).ids + [2]
        assert np.frombuffer(encode(text), "<u4").tolist() == ids, text


def test_control_characters_are_no_blanks():
    encode = Encoder(PATH, 2)
    blanks = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (chr(c).isspace() or c < 0x21 or 0x2000 <= c < 0x2070)]
    texts = ["日本\x1cab", "日本 \x1f 語", "\x1d日本 x\x1e"] + [f"日本{c}ab {c} 語{c}" for c in blanks]
    for text in texts:
        ids = encode.tokenizer.encode(text, add_special_tokens=False).ids + [2]
        assert np.frombuffer(encode(text), "<u4").tolist() == ids, text


@pytest.mark.parametrize("seed", range(6))
def test_pack(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 5, 60, 64, 65, rng.randint(1, 300)]) for _ in range(rng.randint(0, 60))]
    windows, rest = pack(sizes, (64, 32, 16, 8))
    seen = defaultdict(list)
    for tier, pieces in windows:
        assert sum(p[2] for p in pieces) == tier
    for pieces in [p for _, p in windows] + [rest]:
        for doc, start, length in pieces:
            seen[doc].append((start, length))
    assert sum(p[2] for p in rest) < 8
    for doc, size in enumerate(sizes):
        at = 0
        for start, length in sorted(seen[doc]):
            assert start == at and length > 0
            at += length
        assert at == size


def test_steps_are_balanced():
    windows = [4096] * 40 + [2048] * 21 + [512] * 33
    found = steps(windows, 16384)
    load = defaultdict(int)
    for w, s in zip(windows, found):
        load[s] += w
    assert max(load.values()) - min(load.values()) <= 512


@pytest.mark.parametrize("group_tokens", [1 << 20, 3000])
def test_packed(spark, group_tokens):
    texts = edge_texts(8) + [(5000 + i, t) for i, t in enumerate(ODD)]
    rows = packed(frame(spark, texts), PATH, group_tokens=group_tokens).collect()
    encode = Encoder(PATH, 2)
    wanted = defaultdict(list)
    for i, t in texts:
        wanted[i].append(encode(t))
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id].append(r)
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    padding = sum(4096 - n for n in (sum(r.length for r in s) for s in sequences.values()) if n & (n - 1))
    assert padding < 4096
    for doc, own in pieces.items():
        assert sum(r.length for r in own) == sum(len(t) // 4 for t in wanted[doc])
        for r in own:
            cut = [t[4 * r.start:4 * (r.start + r.length)] for t in wanted[doc] if len(t) // 4 == r.doc_tokens]
            assert r.ids_crc32 in [zlib.crc32(c) for c in cut]
    assert set(pieces) == set(wanted)


def test_rests_are_dealt_to_steps(spark):
    texts = [(i, "word " * 300) for i in range(200)]
    rows = packed(frame(spark, texts), PATH, group_tokens=1, step_tokens=8192).collect()
    load = defaultdict(int)
    for r in rows:
        load[r.step_id] += r.length
    assert sum(load.values()) == 200 * 301 and len(load) == 7
    assert max(load.values()) - min(load.values()) <= 4096


def test_empty_table(spark):
    assert packed(frame(spark, []), PATH).count() == 0
