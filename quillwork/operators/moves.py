"""Parallel local moves over arrays: what a task, or for few links the driver, does in a round of moved_communities().

Nodes are numbers below 2**31 in the order of their names. Links (node, other, w) lie in order of node, in blocks; w is whole."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

BLOCK = 250_000  # links
LINKS, CHOICES, SIZES = "node binary, other binary, w binary", "node binary, to binary, inner binary", "node binary, size binary, loops long"
OWN = 1 << 40


def _binary(**columns) -> pa.RecordBatch:
    """One row: each array as its bytes."""
    return pa.RecordBatch.from_pydict({k: pa.array([v.tobytes() if isinstance(v, np.ndarray) else v], pa.binary() if isinstance(v, np.ndarray) else pa.int64()) for k, v in columns.items()})


def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, other, w) to blocks."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= BLOCK:
            yield _block(held)
            held, n = [], 0
    if n:
        yield _block(held)


def _block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    t = pa.Table.from_batches(batches)
    return _binary(node=t["node"].to_numpy().astype(np.int32), other=t["other"].to_numpy().astype(np.int32), w=t["w"].to_numpy().astype(np.int64))


def _links(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for node, other, w in zip(*(batch.column(c) for c in ("node", "other", "w")), strict=True):
            yield np.frombuffer(node.as_buffer(), np.int32), np.frombuffer(other.as_buffer(), np.int32), np.frombuffer(w.as_buffer(), np.int64)


def _starts(sorted_: np.ndarray) -> np.ndarray:
    """Where each value begins."""
    return np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(sorted_) else np.zeros(0, np.int64)


def _sums(keys: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = _starts(keys)
    return keys[at], np.add.reduceat(w[order], at) if len(at) else w[:0]


def _best(keys: np.ndarray, w: np.ndarray, label: np.ndarray, mass: np.ndarray, size: np.ndarray, resolution: float, total: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, the community each wants and its weight to its own; keys hold node and community, in order, the own one too.
    Ties go to the own community, then the greatest."""
    node, to = keys >> 32, keys & 0xFFFFFFFF
    own, s = label[node] == to, size[node].astype(float)
    gain = np.round((w - resolution * (mass[to] - np.where(own, s, 0.0)) * s / total) / total, 15)
    at = _starts(node)
    most = np.repeat(np.maximum.reduceat(gain, at), np.diff(np.append(at, len(node))))
    pick = np.maximum.reduceat(np.where(gain == most, np.where(own, OWN, to), -1), at)
    node = node[at]
    return node, np.where(pick == OWN, label[node], pick), w[own]


def choices(links: Iterable[tuple], label: np.ndarray, mass: np.ndarray, size: np.ndarray, resolution: float, total: float) -> Iterator[tuple]:
    """_best() of blocks, each node once: the sums of a block's last node wait for the next block."""
    keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for node, other, w in links:
        apart = node != other
        first = node[_starts(node)]
        pair = lambda a, b: a.astype(np.int64) << 32 | b
        keys, sums = _sums(np.concatenate([keys, pair(node[apart], label[other[apart]]), pair(first, label[first])]), np.concatenate([sums, w[apart], np.zeros(len(first), np.int64)]))
        cut = np.searchsorted(keys, keys[-1] >> 32 << 32)
        if cut:
            yield _best(keys[:cut], sums[:cut], label, mass, size, resolution, total)
        keys, sums = keys[cut:], sums[cut:]
    if len(keys):
        yield _best(keys, sums, label, mass, size, resolution, total)


def chooser(given) -> Callable:
    """For mapInArrow: blocks to CHOICES; given: a broadcast of choices()' other parameters."""

    def work(batches):
        for node, to, inner in choices(_links(batches), *given.value):
            yield _binary(node=node.astype(np.int32), to=to.astype(np.int32), inner=inner)

    return work


def sizes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks to SIZES: the weight at each node, of loops in all. A node may come again with the next block."""
    for node, other, w in _links(batches):
        at = _starts(node)
        yield _binary(node=node[at], size=np.add.reduceat(w, at), loops=int(w[node == other].sum()))


def contracted(node: np.ndarray, other: np.ndarray, w: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between communities; what is inside one is its loop."""
    keys, w = _sums(label[node].astype(np.int64) << 32 | label[other], w)
    return keys >> 32, keys & 0xFFFFFFFF, w


def contractor(given) -> Callable:
    def work(batches):
        for links in _links(batches):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in contracted(*links, given.value)], ["node", "other", "w"])

    return work


def labeller(given) -> Callable:
    """Rows (node, id) to (node, community), numbers as they are."""

    def work(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(given.value[batch.column("id").to_numpy()].astype(np.int64))], ["node", "community"])

    return work


class Few:
    """Links in memory."""

    def __init__(self, node: np.ndarray, other: np.ndarray, w: np.ndarray):
        order = np.argsort(node, kind="stable")
        self.links = node[order], other[order], w[order]

    def sizes(self, n: int) -> tuple[np.ndarray, int]:
        node, other, w = self.links
        size = np.zeros(n, np.int64)
        np.add.at(size, node, w)
        return size, int(w[node == other].sum())

    def choices(self, *given) -> Iterator[tuple]:
        return choices([self.links], *given)

    def contracted(self, label: np.ndarray) -> Few:
        return Few(*contracted(*self.links, label))

    def close(self) -> None:
        pass


def rounds_of(links, label: np.ndarray, awake: np.ndarray, resolution: float, rounds: int, least_gain: float) -> tuple[np.ndarray, float]:
    """Rounds of parallel moves from label: the labels with the highest modularity seen, and that. Bit i of awake says who may
    move in round i. Numbers without links keep their label and count for nothing."""
    size, loops = links.sizes(len(label))
    total = float(size.sum())
    if not total:
        return label, 0.0
    best, top, still = label, None, 0
    for turn in range(rounds + 1):
        mass = np.zeros(len(label), np.int64)
        np.add.at(mass, label, size)
        to, inner = label.copy(), np.zeros(len(label))
        for node, wanted, own in links.choices(label, mass, size, resolution, total):
            to[node], inner[node] = wanted, own
        # what the round started from: sum over nodes of the weight inside, less the expected
        q = float((inner - resolution * mass[label] * size / total).sum() / total)
        still = 0 if top is None or q > top + least_gain else still + 1
        if top is None or q > top:
            best, top = label, q
        if still >= 3 or np.array_equal(to, label):
            break
        # half of the nodes may move in a round: two that want each other's place do not swap for ever
        label = np.where(awake >> turn % AWAKE & 1, to, label)
    return best, top + loops / total


#: Bits of awake.
AWAKE = 62
