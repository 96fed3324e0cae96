"""Encoding of texts with a public tokenizer file, by way of their distinct pre-tokens.

A byte-level BPE first splits a text into pre-tokens, and no pre-token reaches over a single space or line feed between
other characters: a space begins the next one, a line feed is one by itself. So a text's ids are the joined ids of its
pre-tokens. Texts are coded in portions: Arrow marks the pre-tokens, splits at the marks and numbers the distinct ones;
the library's model codes each that was not met before. Ids are kept in flat arrays, from which a portion's ids are
gathered at once. Texts with runs of white space or white space of other kinds go to the library whole, and so do texts
that hold an added token's string (the library gives it that token's id) and parts at spaces with characters outside SAFE.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import keep_only, kept

#: Where white space is more than single spaces and line feeds between other characters, and the mark used below.
BLANKS = r"  |\n\n|\n | \n|^ | $|[\x01\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
#: Characters of whose class (letter, digit, other) there is no doubt.
SAFE = "!-~À-ÖØ-öø-ɏ"
IS_SAFE = re.compile(f" ?[{SAFE}]+|\n")
LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
#: The published pattern of byte-level BPE pre-tokens, for SAFE characters after one space at most, but for letters:
#: what stands between two marks, and begins with the space before it, is a run of letters.
PIECE = rf"'(?:[stmd]|re|ve|ll)| ?(?:[0-9]+|[^\s{LETTER}0-9]+)|\n"
#: Parts at spaces with other characters; they come before PIECE.
UNSAFE = rf"[^ {SAFE}\n]"
UNSAFE_PART = rf" ?[^ \n]*{UNSAFE}[^ \n]*"
MARK = "\x01"
#: The published rule that gives each byte a printable character.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: chr(b) for b in _PLAIN} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}
#: Appended to each document: id 0.
END = (0).to_bytes(4, "little")


def read_model(path: str) -> str:
    """The tokenizer file's JSON text; the driver reads it and tasks get it as a value, for no executor need hold the file."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Store:
    """Id sequences in one flat array, each known by its number."""

    def __init__(self):
        self.flat, self.start, self.size = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.n = self.used = 0

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        """Appends sequences, which get the next numbers."""
        n, m = len(sizes), len(flat)
        self.flat, self.start, self.size = self._room(self.flat, self.used + m), self._room(self.start, self.n + n), self._room(self.size, self.n + n)
        self.flat[self.used : self.used + m] = flat
        self.size[self.n : self.n + n] = sizes
        self.start[self.n : self.n + n] = self.used + np.cumsum(sizes) - sizes
        self.n, self.used = self.n + n, self.used + m

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbered sequences, joined, and their sizes."""
        sizes = self.size[numbers]
        shift = self.start[numbers] - (np.cumsum(sizes) - sizes)
        return self.flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))], sizes


#: Numbers of a store's first two sequences: the end id, and none for the empty string.
STOP, NOTHING = 0, 1


class Encoder:
    def __init__(self, model: str, most: int = 600_000):
        """most: pre-tokens kept."""
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(model)
        kind = json.loads(model)
        added = [t["content"] for t in kind.get("added_tokens") or ()]
        #: Where a text goes to the library whole: odd white space, and the strings of added tokens, which are ids of their own.
        self.odd = "|".join([BLANKS, *("".join(f"\\x{{{ord(c):x}}}" for c in t) for t in added)])
        pre = kind.get("pre_tokenizer") or {}
        self.by_piece = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and kind.get("normalizer") is None
        self.most = most
        self.model = self.library.model
        self.model._resize_cache(0)
        self.clear()

    def clear(self) -> None:
        self.known, self.ids = {"": NOTHING}, Store()
        self.ids.add(np.frombuffer(END, "<u4"), np.array([1, 0]))

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def _learn(self, new: list[str]) -> None:
        space, flat, ends, tokenize = BYTE_CHARS[32], [], [0], self.model.tokenize
        for p in new:
            if p.isascii() and p != "\n":  # one character changes, a space at its start
                flat += [t.id for t in tokenize(space + p[1:] if p[0] == " " else p)]
            elif IS_SAFE.fullmatch(p):
                flat += [t.id for t in tokenize("".join(map(BYTE_CHARS.__getitem__, p.encode())))]
            else:
                flat += np.frombuffer(self.whole(p), "<u4").tolist()
            ends.append(len(flat))
        self.known.update(zip(new, range(len(self.known) + 1, len(self.known) + 1 + len(new)), strict=True))
        self.ids.add(np.array(flat, np.uint32), np.diff(ends))

    def encode_simple(self, column: pa.Array) -> list[memoryview]:
        """Ids with the end id of each text; no text is null, has BLANKS or an added token."""
        if len(self.known) > self.most:
            self.clear()
        odd = pc.any(pc.match_substring_regex(column, UNSAFE)).as_py()
        marked = pc.replace_substring_regex(column, f"{UNSAFE_PART}|{PIECE}" if odd else PIECE, f"{MARK}\\0{MARK}")
        pieces = pc.split_pattern(pc.replace_substring(marked, " ", f"{MARK} "), MARK)
        coded = pieces.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [w for w in words if w not in self.known]
        if new:
            self._learn(new)
        numbers = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))[coded.indices.to_numpy()]
        ends = np.cumsum(np.diff(pieces.offsets.to_numpy()))
        flat, sizes = self.ids.take(np.insert(numbers, ends, STOP))
        cuts = np.concatenate([[0], np.cumsum(sizes)[ends + np.arange(len(ends))]]) * 4
        raw = memoryview(flat.astype("<u4").tobytes())
        return [raw[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def encode_all(self, column: pa.Array) -> list[bytes | memoryview]:
        """Ids with the end id of each text; null is empty."""
        column = pc.fill_null(column.cast(pa.large_string()), "")
        plain = pc.invert(pc.match_substring_regex(column, self.odd)) if self.by_piece else pa.array([False] * len(column))
        found = iter(self.encode_simple(column.filter(plain)) if pc.any(plain).as_py() else ())
        rest = iter(column.filter(pc.invert(plain)).to_pylist())
        return [next(found) if p else self.whole(next(rest)) + END for p in plain.to_pylist()]

    def encode(self, text: str | None) -> bytes:
        """Ids of text, without the end id."""
        return bytes(self.encode_all(pa.array([text], pa.large_string()))[0])[:-4]


def encoded(batch: pa.RecordBatch, enc: Encoder, most: int = 4_000_000) -> Iterator[tuple[int | None, bytes | memoryview]]:
    """doc_id and ids with the end id for each row of a batch (doc_id, text), in portions of about `most` bytes; a
    longer text is a portion by itself."""
    keep_only("tokens")
    ids, column = batch.column(0).to_pylist(), batch.column(1)
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = int(sizes[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + most, side="right")))
        yield from zip(ids[at:to], enc.encode_all(column.slice(at, to - at)), strict=True)
        at = to


@functools.lru_cache(maxsize=2)
def encoder(model: str) -> Encoder:
    """One per Python worker, kept between tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(model)


kept("tokens", encoder)
