"""Words of texts by bytes: a lookup table over the concatenated UTF-8 of a portion finds the bounds, xxHash64 of all
slices is computed lane by lane, and slices with equal hashes are compared byte by byte.

All bytes from 0x80 on belong to words, so a word never cuts a character. Only A-Z is lower-cased."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

LETTERS = np.zeros(256, bool)
LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True
LETTERS_DIGITS = LETTERS.copy()
LETTERS_DIGITS[0x30:0x3A] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

#: xxHash64's published primes.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
#: LOW[n] keeps the first n bytes of a little-endian lane.
LOW = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


class Slices(NamedTuple):
    """data: bytes, lower-cased, with 8 more at the end; where each slice starts, its size, and the row it is in."""

    data: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    rows: np.ndarray

    def lane(self, k: int, at: np.ndarray) -> np.ndarray:
        """Bytes 8k to 8k + 7 of the slices numbered at, zeros after their ends."""
        every = np.ndarray(len(self.data) - 7, "<u8", self.data, strides=(1,))
        return every[self.starts[at] + 8 * k] & LOW[np.clip(self.sizes[at] - 8 * k, 0, 8)]

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i] + self.sizes[i]].tobytes()

    def strings(self, at: np.ndarray) -> pa.Array:
        """The slices numbered at, as an Arrow array."""
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        data = self.data[np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


#: Bytes of text that are cut into words at once; cutting and grouping take about 25 times as much memory.
MOST = 2_000_000


def portions(column: pa.Array, most: int = MOST) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` bytes; a longer text is a portion by itself."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield at, to
        at = to


def pieces(column: pa.Array, member: np.ndarray, most: int = MOST) -> Iterator[pa.Array]:
    """A portion as it is, or one text of more than `most` bytes in pieces of about that size, cut before a byte that is in
    no word. A longer run of member bytes stays whole."""
    if len(column) != 1 or (pc.binary_length(column)[0].as_py() or 0) <= most:
        yield column
        return
    text = column[0].as_buffer()
    raw = np.frombuffer(text, np.uint8)
    at = 0
    while at < len(raw):
        to = at + most
        while to < len(raw):
            ends = np.flatnonzero(~member[raw[max(at + 1, to - most) : to]])
            if len(ends):
                to = max(at + 1, to - most) + int(ends[-1])
                break
            to += most
        to = min(to, len(raw))
        yield pa.Array.from_buffers(pa.large_string(), 1, [None, pa.py_buffer(np.array([0, to - at])), text.slice(at, to - at)])
        at = to


def cut(column: pa.Array, member: np.ndarray) -> Slices:
    """The maximal runs of member bytes in each text; null has none."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return Slices(np.zeros(8, np.uint8), *(np.zeros(0, np.int64) for _ in range(3)))
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    data = np.concatenate([LOWER[raw], np.zeros(8, np.uint8)])
    inside = member[raw]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[ends[:-1][ends[:-1] < len(raw)]] = False
    after[ends[1:][ends[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    sizes = np.flatnonzero(inside & ~after) + 1 - starts
    return Slices(data, starts, sizes, np.searchsorted(ends, starts, side="right") - 1)


def _rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def hashes(s: Slices, seed: int = 0) -> np.ndarray:
    """xxHash64 of each slice; slices of one size are hashed together, those of 32 bytes and more by the library."""
    out = np.empty(len(s.starts), np.uint64)
    order = np.argsort(np.minimum(s.sizes, 32).astype(np.uint8), kind="stable")
    bounds = np.searchsorted(np.minimum(s.sizes, 32)[order], np.arange(34))
    for size in range(1, 32):
        at = order[bounds[size] : bounds[size + 1]]
        if not len(at):
            continue
        h = np.full(len(at), (seed + int(P5) + size) % (1 << 64), np.uint64)
        for k in range(size // 8):
            h = _rotl(h ^ (_rotl(s.lane(k, at) * P2, 31) * P1), 27) * P1 + P4
        rest, left = s.lane(size // 8, at), size % 8
        if left >= 4:
            h = _rotl(h ^ ((rest & LOW[4]) * P1), 23) * P2 + P3
            rest, left = rest >> np.uint64(32), left - 4
        for _ in range(left):
            h = _rotl(h ^ ((rest & LOW[1]) * P5), 11) * P1
            rest = rest >> np.uint64(8)
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        out[at] = h ^ (h >> np.uint64(32))
    for i in order[bounds[32] :].tolist():
        out[i] = xxhash.xxh64_intdigest(s.text(i), seed)
    return out


def same_bytes(a: Slices, at: np.ndarray, b: Slices, bt: np.ndarray) -> np.ndarray:
    """Whether slices at of a equal slices bt of b, one by one."""
    equal = a.sizes[at] == b.sizes[bt]
    k, todo = 0, np.flatnonzero(equal)
    while len(todo):
        equal[todo] = a.lane(k, at[todo]) == b.lane(k, bt[todo])
        k += 1
        todo = todo[equal[todo] & (a.sizes[at[todo]] > 8 * k)]
    return equal


def grouped(s: Slices, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number per slice, equal for equal bytes only, and one slice of each number. keys: the hashes; slices whose bytes
    differ from those of their hash's first slice get numbers of their own."""
    _, first, number = np.unique(keys, return_index=True, return_inverse=True)
    odd = np.flatnonzero(~same_bytes(s, np.arange(len(keys)), s, first[number]))
    if len(odd):
        own: dict[bytes, int] = {}
        extra = []
        for i in odd.tolist():
            word = s.text(i)
            if word not in own:
                own[word] = len(first) + len(extra)
                extra.append(i)
            number[i] = own[word]
        first = np.concatenate([first, np.array(extra, first.dtype)])
    return number, first
