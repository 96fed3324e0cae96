"""Packing token sequences by vector bin packing with the dot-product heuristic.

An item asks for (tokens, segments, loss-bearing tokens); a sequence offers `limits` of each. While a sequence is open
it takes, of the items that fit, the one whose demand has the largest weighted dot product with what the sequence has
left. Where items may be cut and none fits, one is cut to what is left, if that is at least `min_cut` tokens.

Each task packs its own rows as they stream by, so nothing is shuffled: pieces of a full sequence leave at once, the
rest waits in a buffer of bounded size, and sequence ids are the task's number and a counter. A task ends with one
sequence that is not full, or few if other limits than tokens bind. It is cut at powers of two, which need no padding.

Defined cases: null text is empty: the end id alone. Rows that share a doc_id are packed apart, as two documents; a null
doc_id stays null in its pieces. A very long text is coded as one portion and cut like any other; an item that waits
holds its own ids alone. Other columns, whatever their names, are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import default_path, encoded, encoder, read_model


@dataclass
class Item:
    tokens: int
    loss: int
    data: Any = None
    start: int = 0  # of data's tokens, those before this item
    segments: int = 1


class Packer:
    """add() and finish() give closed sequences, each a list of items."""

    def __init__(self, limits: tuple[int, int, int], may_cut: bool = True, min_cut: int = 8, buffer: int = 512):
        self.limits, self.may_cut, self.min_cut, self.buffer = np.array(limits, float), may_cut, min_cut, buffer
        self.items: list[Item] = []

    def add(self, item: Item) -> Iterator[list[Item]]:
        top, most = int(self.limits[0]), int(self.limits[2])
        if self.may_cut:
            while item.tokens > top or item.loss > most:
                head, item = self.cut(item, min(top, item.tokens, most))
                if head.tokens == top:
                    yield [head]
                else:
                    self.items.append(head)
        elif item.tokens > top or item.loss > most or item.segments > self.limits[1]:
            raise ValueError("an item exceeds a sequence's limits")
        if item.tokens == top:
            yield [item]
        elif item.tokens:
            self.items.append(item)
        if len(self.items) >= self.buffer:
            yield from self.pack(False)

    def finish(self) -> Iterator[list[Item]]:
        yield from self.pack(True)

    @staticmethod
    def cut(item: Item, n: int) -> tuple[Item, Item]:
        """The first n tokens and the rest. Loss-bearing tokens are dealt as evenly as the tokens; all-loss items stay so."""
        loss = item.loss * n // item.tokens
        return Item(n, loss, item.data, item.start, item.segments), Item(item.tokens - n, item.loss - loss, item.data, item.start + n, item.segments)

    def pack(self, last: bool) -> Iterator[list[Item]]:
        items, self.items = self.items, []
        need = np.array([(x.tokens, x.segments, x.loss) for x in items], float).reshape(-1, 3)
        free = np.ones(len(items), bool)
        while free.any():
            weight = need[free].mean(axis=0) / self.limits**2
            left, own = self.limits.copy(), []
            while True:
                fits = free & (need <= left).all(axis=1)
                if fits.any():
                    i = int(np.argmax(np.where(fits, need @ (weight * left), -1.0)))
                    own.append(items[i])
                    left -= need[i]
                    free[i] = False
                    continue
                gap = int(min(left[0], left[2]))
                if self.may_cut and gap >= self.min_cut and left[1] >= 1 and free.any():
                    i = int(np.argmax(np.where(free & (need[:, 1] <= left[1]), need[:, 0], -1.0)))
                    if need[i, 0] > gap and need[i, 1] <= left[1]:
                        head, items[i] = self.cut(items[i], gap)
                        need[i] = (items[i].tokens, items[i].segments, items[i].loss)
                        own.append(head)
                        left -= (head.tokens, head.segments, head.loss)
                break
            if not free.any() and not last and left[0] > 0:
                self.items = own  # waits for more
                return
            yield own

    def powers(self, own: list[Item]) -> Iterator[list[Item]]:
        """A sequence's items as sequences whose lengths are powers of two."""
        left = sum(x.tokens for x in own)
        own = list(own)
        while left:
            room, part = 1 << (left.bit_length() - 1), []
            left -= room
            while room:
                x = own.pop(0)
                if x.tokens > room:
                    x, rest = self.cut(x, room)
                    own.insert(0, rest)
                part.append(x)
                room -= x.tokens
            yield part


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(
    spark: SparkSession, docs: DataFrame, tokenizer: str | None = None, max_tokens: int = 1024, max_segments: int = 128, max_loss: int = 1024, min_cut: int = 8
) -> DataFrame:
    """PIECE rows for docs (doc_id, text). All tokens of a document bear loss."""
    model = spark.sparkContext.broadcast(read_model(tokenizer or default_path()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, packer = encoder(model.value), Packer((max_tokens, max_segments, max_loss), min_cut=min_cut)
        number, rows = TaskContext.get().partitionId() << 40, []

        def put(own: list[Item]) -> None:
            nonlocal number
            at = 0
            for x in own:
                doc, ids, before, total = x.data
                crc = zlib.crc32(memoryview(ids)[4 * x.start : 4 * (x.start + x.tokens)])
                rows.append((doc, before + x.start, x.tokens, crc, total, number, at))
                at += x.tokens
            number += 1

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in PIECE.split(", ")])

        for batch in batches:
            for doc, ids in encoded(batch, enc):
                total = len(ids) // 4
                for before in range(0, total, max_tokens):  # an item that waits holds no more than its own ids
                    part = bytes(ids[4 * before : 4 * (before + max_tokens)])
                    for own in packer.add(Item(len(part) // 4, len(part) // 4, (doc, part, before, total))):
                        put(own)
                    if len(rows) >= 20_000:
                        yield out()
        for own in packer.finish():
            if sum(x.tokens for x in own) < max_tokens:
                for part in packer.powers(own):
                    put(part)
            else:
                put(own)
        if rows:
            yield out()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, PIECE)


def pack_examples(examples: DataFrame, limits: tuple[int, int, int] = (1024, 16, 512)) -> DataFrame:
    """Instruction data: whole examples (id, n_tokens, n_segments, n_loss) placed uncut. Gives id, sequence_id, offset, over.

    Null and negative numbers count as 0. An example beyond a limit is neither cut nor dropped: it has a sequence to
    itself, with over = true. Rows that share an id, or have none, are examples of their own. Other columns are left out."""
    own_limits = np.array(limits, float)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer, number = Packer(limits, may_cut=False), TaskContext.get().partitionId() << 40

        def rows(sequences: Iterator[list[Item]], over: bool = False) -> Iterator[tuple]:
            nonlocal number
            for own in sequences:
                at = 0
                for x in own:
                    yield x.data, number, at, over
                    at += x.tokens
                number += 1

        def table(found: list[tuple]) -> pd.DataFrame:
            out = pd.DataFrame(found, columns=["id", "sequence_id", "offset", "over"])
            return out.astype({"sequence_id": "int64", "offset": "int64", "over": "bool"})

        for frame in frames:
            found = []
            for id_, tokens, segments, loss in frame.itertuples(index=False):
                item = Item(int(tokens), int(loss), None if pd.isna(id_) else id_, segments=int(segments))
                if (np.array([item.tokens, item.segments, item.loss]) > own_limits).any():
                    found += rows([[item]], True)
                elif item.tokens:
                    found += rows(packer.add(item))
                else:  # nothing to place: a sequence of no tokens
                    found += rows([[item]])
            yield table(found)
        yield table(list(rows(packer.finish())))

    number = lambda c: F.greatest(F.lit(0), F.coalesce(F.col(c).cast("long"), F.lit(0))).alias(c)
    rows = examples.select(F.col("id").cast("string").alias("id"), *map(number, ("n_tokens", "n_segments", "n_loss")))
    kind = dict(examples.dtypes)["id"]
    return rows.mapInPandas(work, "id string, sequence_id long, offset long, over boolean").withColumn("id", F.col("id").cast(kind))
