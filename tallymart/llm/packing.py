"""Documents packed into sequences of several lengths, tier by tier.

A task tokenizes its documents and packs a bounded group of them at a time.
What is left of a document after its full windows goes to the tier of the
smallest window that holds it. Tiers are packed from the longest: a window's
gap takes pieces of shorter tiers, the last one cut to fit, or of its own tier
when there are no others. The windows of a group are dealt to steps of nearly
equal tokens. What fills no window of the shortest tier is packed once more,
with the like of other groups.

Defined results: NULL text is empty and has the end token alone; NULL or
repeated ids are documents like others; a text of any length is cut into pieces;
an empty table has no sequences; the pieces of a document carry its id and no
other column.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.store import stored

TIERS = (4096, 2048, 1024, 512)
GROUP_TOKENS = 1 << 20
STEP_TOKENS = 16 * 4096
#: tokens of words that a worker remembers
CACHE_WORDS = 500_000
#: groups whose rests are packed together
RESTS_TOGETHER = 1000

PIECES = (
    "doc_id long, `start` long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long, "
    "tier int, step_id long, rest long"
)

# fixed values: the vocabulary's pattern of parts, for texts of Latin-1 characters
_LETTER, _NUMBER, _BLANK = "a-zA-ZªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", "\\t-\\r \\x85\\xa0"
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_BLANK}{_LETTER}{_NUMBER}]+")
_OTHER = re.compile("[^\\x00-\\xff]")
# blanks beyond Latin-1 as well; not \x1c to \x1f, which str.split() parts at
_BLANKS = re.compile(f"[{_BLANK}\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
_SPECIAL = re.compile(r"<\|")


class Encoder:
    """Token ids of whole texts as little-endian bytes, equal to the tokenizer's.

    Texts of Latin-1 characters are parted as the vocabulary parts them, and
    each distinct part is encoded once. Others are parted at blanks, which no
    token spans; what might hold a special token goes to the tokenizer whole.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = np.array([end_id], "<u4").tobytes()
        self.known: dict[str, bytes] = {}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}

    def part(self, part: str) -> bytes:
        found = self.known.get(part)
        if found is None:
            spelled = part.encode().decode("latin-1").translate(self.letters)
            found = np.array([t.id for t in self.tokenizer.model.tokenize(spelled)], "<u4").tobytes()
            self._remember(part, found)
        return found

    def chunk(self, chunk: str) -> bytes:
        found = self.known.get("\n" + chunk)
        if found is None:
            found = self.whole(chunk)
            self._remember("\n" + chunk, found)
        return found

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _remember(self, key: str, value: bytes) -> None:
        if len(self.known) < CACHE_WORDS:
            self.known[key] = value

    def __call__(self, text: str | None) -> bytes:
        text = text or ""
        if _SPECIAL.search(text):
            return self.whole(text) + self.end
        if not _OTHER.search(text):
            return b"".join(map(self.part, _PARTS.findall(text.lower()))) + self.end
        out = []
        for chunk in _BLANKS.split(text):
            if _OTHER.search(chunk):
                out.append(self.chunk(chunk))
            else:
                out += map(self.part, _PARTS.findall(chunk.lower()))
        return b"".join(out) + self.end


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    """One for each Python worker."""
    if (path, end_id) not in _encoders:
        _encoders[(path, end_id)] = Encoder(path, end_id)
    return _encoders[(path, end_id)]


Piece = tuple[int, int, int]  # document, start, length


def pack(sizes: list[int], tiers: tuple[int, ...] = TIERS) -> tuple[list[tuple[int, list[Piece]]], list[Piece]]:
    """([(window, pieces)], rest): all windows are full, the rest is shorter
    than the shortest window."""
    top = tiers[0]
    windows: list[tuple[int, list[Piece]]] = []
    pools: dict[int, list[Piece]] = {tier: [] for tier in tiers}
    for doc, size in enumerate(sizes):
        full = size // top
        windows += [(top, [(doc, n * top, top)]) for n in range(full)]
        if size % top:
            fitting = min(tier for tier in tiers if tier >= size % top)
            pools[fitting].append((doc, full * top, size % top))
    for pool in pools.values():
        pool.sort(key=lambda p: (p[2], p[0]))

    rest: list[Piece] = []
    for at, tier in enumerate(tiers):
        shorter = tiers[at + 1:][::-1]
        while pools[tier]:
            pieces, gap = [], tier
            while gap:
                source = tier if not pieces else next((t for t in (*shorter, tier) if pools[t]), None)
                if source is None:
                    break
                doc, start, length = pools[source].pop()
                taken = min(length, gap)
                pieces.append((doc, start, taken))
                gap -= taken
                if taken < length:
                    left = (doc, start + taken, length - taken)
                    pools[min(t for t in tiers if t >= length - taken)].append(left)
            if gap:
                rest = pieces  # nothing is left anywhere
            else:
                windows.append((tier, pieces))
    # the last, unfinished window as full windows of shorter tiers
    for tier in tiers[1:]:
        while sum(p[2] for p in rest) >= tier:
            pieces, gap = [], tier
            while gap:
                doc, start, length = rest.pop(0)
                taken = min(length, gap)
                pieces.append((doc, start, taken))
                gap -= taken
                if taken < length:
                    rest.insert(0, (doc, start + taken, length - taken))
            windows.append((tier, pieces))
    return windows, rest


def steps(windows: list[int], step_tokens: int) -> list[int]:
    """A step for each window: the longest first, to the step with fewest tokens."""
    count = max(1, round(sum(windows) / step_tokens))
    heap = [(0, step) for step in range(count)]
    found = [0] * len(windows)
    for at in sorted(range(len(windows)), key=lambda i: -windows[i]):
        load, step = heapq.heappop(heap)
        found[at] = step
        heapq.heappush(heap, (load + windows[at], step))
    return found


def _packed(path: str, end_id: int, tiers: tuple[int, ...], group_tokens: int, step_tokens: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, end_id)
        group = TaskContext.get().partitionId() << 34
        ids, tokens, size = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids.append(doc)
                tokens.append(encode(text))
                size += len(tokens[-1]) // 4
                if size >= group_tokens:
                    yield packed(ids, tokens, group)
                    ids, tokens, size, group = [], [], 0, group + (1 << 18)
        if ids:
            yield packed(ids, tokens, group)

    def packed(ids: list, tokens: list[bytes], group: int) -> pa.RecordBatch:
        windows, rest = pack([len(t) // 4 for t in tokens], tiers)
        dealt = steps([w for w, _ in windows], step_tokens)
        rows = []

        def add(pieces: list[Piece], sequence: int | None, tier: int, step: int | None) -> None:
            offset = 0
            for doc, start, length in pieces:
                crc = zlib.crc32(tokens[doc][4 * start:4 * (start + length)])
                rows.append((ids[doc], start, length, crc, len(tokens[doc]) // 4, sequence, offset, tier, step,
                             None if sequence is not None else group))
                offset += length

        for number, ((tier, pieces), step) in enumerate(zip(windows, dealt)):
            add(pieces, group + number, tier, group + step)
        add(rest, None, tiers[0], None)
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64(), pa.int64()]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_id", "rest"]
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def _rests(window: int, step_tokens: int):
    """Whole rests of groups into full-size windows, the largest first, and
    these to steps like all others."""

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        sums = pdf.groupby("rest", sort=True)["length"].sum().sort_values(ascending=False, kind="stable")
        room: list[int] = []
        begin, place = {}, {}
        for rest, size in sums.items():
            at = next((i for i, r in enumerate(room) if r >= size), len(room))
            if at == len(room):
                room.append(window)
            begin[rest], place[rest] = window - room[at], at
            room[at] -= size
        base = (1 << 62) | (int(key[0]) << 18)
        pdf["offset"] += pdf["rest"].map(begin)
        dealt = steps([int(window - r) for r in room], step_tokens)
        windows = pdf["rest"].map(place)
        pdf["sequence_id"] = base + windows
        pdf["step_id"] = base + windows.map(dict(enumerate(dealt)))
        return pdf

    return run


def packed(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
    tiers: tuple[int, ...] = TIERS, group_tokens: int = GROUP_TOKENS, step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """One row for each piece; ``tier`` is the window's length, ``step_id`` its step.

    ``tokenizer`` is the path of a vocabulary file on every executor. All
    windows are full but those that hold the rests of groups.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = stored(source.mapInArrow(_packed(tokenizer, end_id, tiers, group_tokens, step_tokens), PIECES), "pieces")
    rests = pieces.where("rest is not null")
    together = max(1, -(-rests.select("rest").distinct().count() // RESTS_TOGETHER))
    again = rests.groupBy(F.pmod(F.xxhash64("rest"), F.lit(together)).alias("set")).applyInPandas(_rests(tiers[0], step_tokens), PIECES)
    return pieces.where("rest is null").unionByName(again).drop("rest")
