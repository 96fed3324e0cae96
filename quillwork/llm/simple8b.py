"""Simple-8b coding of unsigned integers into 64-bit words, block by block, with NumPy.

A word's high 4 bits are its selector, the other 60 hold COUNT[selector] values of BITS[selector] bits, lowest first.
Selector 0 is the escape: the value stands alone in the next word, all 64 bits of it. Values are coded in blocks of
BLOCK; a block's last word may hold zeros beyond its count. Offsets of the blocks' first words let blocks be decoded
apart. All blocks of a call are coded in step, so that the greedy choice of selectors is one array operation per word.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
#: The counts of Simple-8b's selectors for 60 bits.
COUNT = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, *(60 // COUNT[1:])])
ESCAPE = 0


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values: uint64. Gives the words and, per block, the offset of its first word."""
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    blocks, pad = -(-n // BLOCK), int(COUNT.max())
    v = np.zeros((blocks, BLOCK + pad), np.uint64)
    full = np.zeros(blocks * BLOCK, np.uint64)
    full[:n] = values
    v[:, :BLOCK] = full.reshape(blocks, BLOCK)
    sel = np.full(v.shape, ESCAPE, np.int8)
    width = np.frexp(v.astype(float))[1].astype(np.uint8)  # bits; one too many at most, for values above 2^53
    # most[k]: the widest of k values from each place on, from two overlapping or adjoining shorter runs
    most = {1: width}
    for s in range(len(COUNT) - 1, 0, -1):  # from one value a word to sixty: the last that fits wins
        k = int(COUNT[s])
        if k not in most:
            j = max(x for x in most if x < k)
            while 2 * j < k:
                most[2 * j] = np.maximum(most[j][:, :-j], most[j][:, j:])
                j *= 2
            wide = most[j].shape[1] - (k - j)
            most[k] = np.maximum(most[j][:, :wide], most[j][:, k - j : k - j + wide])
        np.copyto(sel[:, : most[k].shape[1]], s, where=most[k] <= BITS[s])
    lane, at, ends = np.arange(blocks), np.zeros(blocks, np.int64), np.minimum(BLOCK, n - np.arange(blocks) * BLOCK)
    lanes, starts = [], []
    while len(lane):
        lanes.append(lane)
        starts.append(at)
        at = at + COUNT[sel[lane, at]]
        more = at < ends[lane]
        lane, at = lane[more], at[more]
    lanes, starts = np.concatenate(lanes), np.concatenate(starts)
    order = np.lexsort((starts, lanes))
    lanes, starts = lanes[order], starts[order]
    chosen = sel[lanes, starts]
    width = 1 + (chosen == ESCAPE)
    place = np.cumsum(width) - width
    words = np.zeros(int(width.sum()), np.uint64)
    for s in np.unique(chosen):
        m = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            words[place[m] + 1] = v[lanes[m], starts[m]]
            continue
        k, b = int(COUNT[s]), int(BITS[s])
        out = np.full(len(m), int(s) << 60, np.uint64)
        for j in range(k):
            out |= v[lanes[m], starts[m] + j] << np.uint64(j * b)
        words[place[m]] = out
    return words, place[np.searchsorted(lanes, np.arange(blocks))]


def decode(words: np.ndarray, n: int, offsets: np.ndarray) -> np.ndarray:
    """The n values that encode() got. To decode some blocks alone, pass their words and offsets from the first of them."""
    if not n:
        return np.zeros(0, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    # a raw word follows its escape; escapes come one after another only as (escape, raw) pairs
    raw = np.zeros(len(words), bool)
    esc = np.flatnonzero(sel == ESCAPE)
    last = -2
    for i in esc.tolist():
        if last != i - 1 or not raw[i]:
            if i + 1 < len(words) and not raw[i]:
                raw[i + 1] = True
        last = i
    heads = np.flatnonzero(~raw)
    hs = sel[heads]
    counts = COUNT[hs]
    block = np.searchsorted(offsets, heads, side="right") - 1
    before = np.cumsum(counts) - counts
    first = before[np.searchsorted(heads, offsets)]
    place = before - first[block] + block * BLOCK
    out = np.zeros(len(offsets) * BLOCK + int(COUNT.max()), np.uint64)
    for s in np.unique(hs):
        m = np.flatnonzero(hs == s)
        if s == ESCAPE:
            out[place[m]] = words[heads[m] + 1]
            continue
        k, b = int(COUNT[s]), int(BITS[s])
        w, mask, end = words[heads[m]], np.uint64((1 << b) - 1), (block[m] + 1) * BLOCK
        for j in range(k):
            ok = place[m] + j < end
            out[place[m][ok] + j] = ((w >> np.uint64(j * b)) & mask)[ok]
    return out[:n]
