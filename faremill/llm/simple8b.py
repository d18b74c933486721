"""Simple-8b: a 64-bit word holds a selector and as many ids as fit at one width.

The four top bits name how many ids the word holds and how wide they are. Blocks of a fixed
number of ids start on a word of their own, so that blocks are packed and read side by side.
An id wider than 60 bits is an escape: its word holds its place in a list of whole values.
"""

from __future__ import annotations

import numpy as np

BLOCK_IDS = 1024
# Ids per word and bits per id, by selector. Selector 0 is the escape.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
_MOST = 60
_AT_ONCE = 512
_SHIFT = np.uint64(60)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits of each value (uint8)."""
    width = np.zeros(values.shape, np.uint8)
    rest = values.copy()
    for step in (32, 16, 8, 4, 2, 1):
        high = rest >> np.uint64(step)
        more = high > 0
        width += more.astype(np.uint8) * np.uint8(step)
        rest = np.where(more, high, rest)
    return width + (rest > 0)


def _selectors(width: np.ndarray) -> np.ndarray:
    """At every position of every block, the selector that packs most from there."""
    blocks, room = width.shape
    best = np.zeros((blocks, room), np.uint8)
    reach = {1: width}
    size = 1
    while size < _MOST:  # the widest id of the next `size` ones, by doubling
        grown = reach[size].copy()
        grown[:, :room - size] = np.maximum(reach[size][:, :room - size], reach[size][:, size:])
        size *= 2
        reach[size] = grown
    for selector in range(len(COUNTS) - 1, 0, -1):  # rising counts: the last that fits packs most
        count = int(COUNTS[selector])
        power = 1 << (count.bit_length() - 1)
        widest = reach[power]
        if count > power:
            widest = widest.copy()
            shift = count - power
            widest[:, :room - shift] = np.maximum(widest[:, :room - shift], reach[power][:, shift:])
        best[widest <= WIDTHS[selector]] = selector
    return best


def pack(ids: np.ndarray, block_ids: int = BLOCK_IDS):
    """(words, offsets, escapes): the words of all blocks, where each block starts, whole values.

    The blocks are packed `_AT_ONCE` at a time, which bounds the room it takes.
    """
    parts = [_pack(ids[at:at + _AT_ONCE * block_ids], block_ids) for at in range(0, max(len(ids), 1), _AT_ONCE * block_ids)]
    offsets, escaped = [np.zeros(1, np.int64)], 0
    for words, starts, escapes in parts:
        offsets.append(starts[1:] + offsets[-1][-1])
        words[words >> _SHIFT == 0] += np.uint64(escaped)
        escaped += len(escapes)
    return np.concatenate([p[0] for p in parts]), np.concatenate(offsets), np.concatenate([p[2] for p in parts])


def _pack(ids: np.ndarray, block_ids: int):
    total = len(ids)
    blocks = -(-total // block_ids)
    if not blocks:
        return np.empty(0, np.uint64), np.zeros(1, np.int64), np.empty(0, np.uint64)
    room = block_ids + _MOST
    values = np.zeros((blocks, room), np.uint64)
    flat = np.zeros(blocks * block_ids, np.uint64)
    flat[:total] = ids
    values[:, :block_ids] = flat.reshape(blocks, block_ids)
    selector = _selectors(_widths(values))
    at, row = np.zeros(blocks, np.int64), np.arange(blocks)
    end = np.full(blocks, block_ids)
    end[-1] = total - (blocks - 1) * block_ids
    steps = []
    while True:  # one word of every block at a time
        live = at < end
        if not live.any():
            break
        steps.append(np.where(live, at, -1))
        at += np.where(live, COUNTS[selector[row, np.minimum(at, room - 1)]], 0)
    place = np.stack(steps, axis=1)
    used = place >= 0
    per_block = used.sum(axis=1)
    block_of = np.repeat(row, per_block)
    start = place[used]
    chosen = selector[block_of, start].astype(np.int64)
    first = block_of * room + start
    source = values.ravel()
    words = chosen.astype(np.uint64) << _SHIFT
    for s in range(1, len(COUNTS)):
        mine = np.flatnonzero(chosen == s)
        if len(mine):
            word = words[mine]
            for i in range(int(COUNTS[s])):
                word |= source[first[mine] + i] << np.uint64(WIDTHS[s] * i)
            words[mine] = word
    escaped = np.flatnonzero(chosen == 0)
    escapes = source[first[escaped]]
    words[escaped] = np.arange(len(escaped), dtype=np.uint64)
    return words, np.concatenate([[0], np.cumsum(per_block)]), escapes


def unpack(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, total: int, block_ids: int = BLOCK_IDS) -> np.ndarray:
    """The ids (uint64) of all blocks."""
    blocks = len(offsets) - 1
    if not blocks:
        return np.empty(0, np.uint64)
    room = block_ids + _MOST
    selector = (words >> _SHIFT).astype(np.int64)
    counts = COUNTS[selector]
    before = np.concatenate([[0], np.cumsum(counts)])
    block_of = np.repeat(np.arange(blocks), np.diff(offsets))
    first = before[:-1] - before[offsets[:-1]][block_of] + block_of * room
    out = np.zeros(blocks * room, np.uint64)
    for s in range(1, len(COUNTS)):
        mine = np.flatnonzero(selector == s)
        if len(mine):
            word, mask = words[mine], np.uint64((1 << int(WIDTHS[s])) - 1)
            for i in range(int(COUNTS[s])):
                out[first[mine] + i] = word >> np.uint64(WIDTHS[s] * i) & mask
    mine = np.flatnonzero(selector == 0)
    if len(mine):
        out[first[mine]] = escapes[words[mine].astype(np.int64)]
    return out.reshape(blocks, room)[:, :block_ids].ravel()[:total]
