"""Burrows-Wheeler transforms of shards of strings, merged by interleaving.

A shard is a set of strings, each closed by a byte that no text has. Its
transform lists, for all rotations in sorted order, the two bytes in front and
the place of the rotation that begins with them. Merging looks at transforms
only: an interleave that is right for the first h bytes of all rotations,
partitioned stably by the bytes in front, is right for h + 2 bytes of the
rotations that begin there. Rotations that an interleave cannot part share that
prefix, so the blocks that remain are the repeated intervals. One that stands
alone stays alone with more bytes in front. No suffix is compared again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

END = 0xFF  # in no UTF-8 text
FIRST = 8  # bytes by which the first interleave is right
SHARD_BYTES = 128 << 10


@dataclass
class Shard:
    order: np.ndarray  # rotations, sorted by as many bytes as merging goes to, at least
    front: np.ndarray  # the two bytes in front of each, in that order
    before: np.ndarray  # places in that order of the rotations that begin with those
    heads: np.ndarray  # their first 8 bytes as numbers, in that order


def closed(pieces: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The strings with their closing bytes, and the new bounds."""
    count = len(bounds) - 1
    out = np.full(len(pieces) + count, END, np.uint8)
    new = bounds + np.arange(count + 1)
    mask = np.ones(len(out), bool)
    mask[new[1:] - 1] = False
    out[mask] = pieces
    return out, new


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    in_order = keys[order]
    ranks = np.empty(len(keys), np.uint64)
    steps = np.zeros(len(keys), np.uint64)
    steps[1:] = in_order[1:] != in_order[:-1]
    ranks[order] = np.cumsum(steps)
    return order, ranks


def shard(text: np.ndarray, bounds: np.ndarray, depth: int = 64) -> Shard:
    """The transform of closed strings, sorted by ``depth`` bytes at least;
    ``bounds`` are theirs in ``text``."""
    size = len(text)
    sizes = np.diff(bounds)
    begin, length = np.repeat(bounds[:-1], sizes), np.repeat(sizes, sizes)
    offset = np.arange(size) - begin

    def shifted(k: int) -> np.ndarray:
        return begin + (offset + k) % length

    one = shifted(1)
    heads = text.astype(np.uint64)
    step, width = one, 1
    while width < FIRST:  # twice as many bytes each time
        heads = (heads << np.uint64(8 * width)) | heads[step]
        step, width = step[step], 2 * width
    order, ranks = _ranks(heads)
    while width < depth and ranks[order[-1]] < size - 1:
        order, ranks = _ranks((ranks << np.uint64(32)) | ranks[step])
        step, width = step[step], 2 * width
    back = shifted(-1)
    two = back[back]
    front = (text[two].astype(np.uint16) << np.uint16(8)) | text[back]
    place = np.empty(size, np.int32)
    place[order] = np.arange(size, dtype=np.int32)
    return Shard(order, front[order], place[two[order]], heads[order])


def merge(shards: list[Shard], depth: int, repeated: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, place in the shard's order, block) of all rotations in merged
    order, or of those that are ``repeated``: not alone in their block.

    Rotations of one block have their first ``depth`` bytes in common.
    ``depth`` is even and 8 at least.
    """
    sizes = [len(s.order) for s in shards]
    bases = np.cumsum(sizes) - sizes
    heads, fronts = np.concatenate([s.heads for s in shards]), np.concatenate([s.front for s in shards])
    before = np.concatenate([s.before + np.int32(base) for s, base in zip(shards, bases)])
    at = np.argsort(heads, kind="stable").astype(np.int32)
    heads = heads[at]
    parted = heads[1:] != heads[:-1]
    blocks = _numbers(parted)
    for _ in range((depth - FIRST) // 2):
        if repeated:
            at, blocks = _together(at, blocks, parted, 8)
        if not len(blocks) or blocks[-1] == len(blocks) - 1:
            break  # every rotation stands alone
        symbols = fronts[at]
        moved = np.argsort(symbols, kind="stable")
        at, blocks, symbols = before[at[moved]], blocks[moved], symbols[moved]
        parted = (blocks[1:] != blocks[:-1]) | (symbols[1:] != symbols[:-1])
        blocks = _numbers(parted)
    if repeated:
        at, blocks = _together(at, blocks, blocks[1:] != blocks[:-1])
    own = np.repeat(np.arange(len(shards)), sizes)[at]
    return own, at - bases[own], blocks


def _numbers(parted: np.ndarray) -> np.ndarray:
    """Blocks by number, of rotations that are parted from the one before or not."""
    blocks = np.zeros(len(parted) + 1, np.int32)
    np.cumsum(parted, out=blocks[1:])
    return blocks


def _together(at: np.ndarray, blocks: np.ndarray, parted: np.ndarray, share: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Rotations and blocks without those alone in theirs, if these are more
    than one in ``share``."""
    if not len(at):
        return at, blocks
    held = np.zeros(len(at), bool)
    held[1:] = ~parted
    held[:-1] |= ~parted
    if share and (len(at) - np.count_nonzero(held)) * share <= len(at):
        return at, blocks
    at, blocks = at[held], blocks[held]
    return at, _numbers(blocks[1:] != blocks[:-1]) if len(at) else blocks


def shared_windows(pieces: np.ndarray, bounds: np.ndarray, ids: np.ndarray, size: int) -> np.ndarray:
    """For each byte of the strings: does the window from there also start in a
    string with a smaller id? Strings are cut into shards and merged. ``size``
    is even and 8 at least."""
    text, closed_bounds = closed(pieces, bounds)
    cuts = np.unique(np.searchsorted(closed_bounds, np.append(np.arange(0, len(text), SHARD_BYTES), len(text))))
    shards, bases = [], []
    for a, b in zip(cuts[:-1], cuts[1:]):
        base = closed_bounds[a]
        shards.append(shard(text[base:closed_bounds[b]], closed_bounds[a:b + 1] - base, max(64, size)))
        bases.append(base)
    if not shards:
        return np.zeros(0, bool)
    which, place, blocks = merge(shards, size, repeated=True)
    starts = np.concatenate([[0], np.cumsum([len(s.order) for s in shards])])
    rotation = np.concatenate([s.order + base for s, base in zip(shards, bases)])[starts[which] + place]
    sizes = np.diff(closed_bounds)
    room = np.repeat(closed_bounds[1:] - 1, sizes) - np.arange(len(text))
    owner = np.repeat(ids, sizes)
    found = np.zeros(len(text), bool)
    full = room[rotation] >= size
    rotation, blocks = rotation[full], blocks[full]
    if len(rotation):
        first = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]]))
        smallest = np.minimum.reduceat(owner[rotation], first)
        number = np.zeros(len(blocks), np.int64)
        number[first[1:]] = 1
        found[rotation] = owner[rotation] > smallest[np.cumsum(number)]
    return found[text != END]
