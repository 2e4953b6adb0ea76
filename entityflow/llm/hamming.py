"""Hamming links between 64-bit fingerprints through a Gray-order hierarchical index.

Fingerprints within ``bits`` differing bits agree on at least two of ``bits + 2`` bit blocks. So each fingerprint
joins one group per pair of blocks, keyed by the values of those blocks. A group is sorted by Gray rank, and an index is
built over it: a node holds the bits that all its members share (mask and pattern), without those that its parent
holds already. Pairs of nodes are walked from the top; the differences on shared bits add up on the way down, and a pair
whose sum exceeds ``bits`` is left with all its members. Where even the bits that are not shared can't exceed ``bits``,
all members link at once and no pair is compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityflow.session import settle

# Rows of one group that a task holds; a larger group is cut again on its remaining bits. With 6 blocks, three
# rounds leave 19 free bits, so the last round's groups hold at most 2^19 distinct fingerprints.
GROUP_ROWS = 1 << 16
ROUNDS = 3
CHUNK_ROWS = 1 << 17
FAN = 8
PAIRS_AT_ONCE = 1 << 14

LINKS = "a long, b long, mask long"
KEYS = "mask long, value long, rank long, fp long"


def positions(mask: int) -> list[int]:
    """Free bit positions, highest first."""
    return [i for i in range(63, -1, -1) if not mask >> i & 1]


def block_masks(fixed: int, bits: int) -> list[int]:
    """Masks of ``fixed`` plus each pair of the ``bits + 2`` blocks of free bits."""
    blocks = [sum(1 << int(i) for i in part) for part in np.array_split(positions(fixed), bits + 2)]
    return [fixed | a | b for a, b in combinations(blocks, 2)]


def gray_rank(fp: np.ndarray, mask: int) -> np.ndarray:
    """Position in Gray order by the bits outside ``mask``."""
    rank = np.zeros_like(fp)
    for i in positions(mask):
        rank = rank << np.uint64(1) | fp >> np.uint64(i) & np.uint64(1)
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def spread(bits: int):
    """(mask, fp) rows -> one row per pair of blocks of the free bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fixed in np.unique(np.asarray(batch.column(0))).tolist():
                here = np.asarray(batch.column(0)) == fixed
                fp = np.asarray(batch.column(1))[here].view(np.uint64)
                for mask in block_masks(fixed % (1 << 64), bits):
                    signed = np.uint64(mask).view(np.int64)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(fp), signed)), pa.array((fp & np.uint64(mask)).view(np.int64)),
                        pa.array(gray_rank(fp, mask).view(np.int64)), pa.array(fp.view(np.int64)),
                    ], ["mask", "value", "rank", "fp"])

    return run


class GrayIndex:
    """Groups of fingerprints, each in Gray order, below one list of nodes per level."""

    def __init__(self, group: np.ndarray, fp: np.ndarray):
        self.fp = fp
        low = high = fp  # bits set in all members, and in any
        first = np.arange(len(fp))  # first fingerprint of a node
        self.levels = []
        while True:
            self.levels.append({"mask": ~(low ^ high), "pattern": low, "first": first, "group": group})
            new = np.r_[True, group[1:] != group[:-1]] if len(group) else np.zeros(0, bool)
            if new.all():
                break
            heads = np.flatnonzero(new)
            within = np.arange(len(group)) - np.repeat(heads, np.diff(np.r_[heads, len(group)]))
            starts = np.flatnonzero(within % FAN == 0)
            self.levels[-1]["starts"] = np.r_[starts, len(group)]
            low, high = np.bitwise_and.reduceat(low, starts), np.bitwise_or.reduceat(high, starts)
            first, group = first[starts], group[starts]
        # Shared bits move up: a node keeps those its parent lacks.
        for below, above in zip(self.levels, self.levels[1:]):
            parent = np.repeat(np.arange(len(above["first"])), np.diff(below["starts"]))
            below["own"] = below["mask"] & ~above["mask"][parent]
        self.levels[-1]["own"] = self.levels[-1]["mask"]

    def members(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.r_[self.levels[level]["first"], len(self.fp)]
        return first[node], first[node + 1]

    def links(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of positions that connect all fingerprints within ``bits`` of each other."""
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top]["first"]))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        self._walk(top, roots, roots, np.zeros(len(roots), np.int64), bits, found)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])

    def _walk(self, level, left, right, so_far, bits, found) -> None:
        here = self.levels[level]
        for k in range(0, len(left), PAIRS_AT_ONCE):
            a, b, acc = left[k:k + PAIRS_AT_ONCE], right[k:k + PAIRS_AT_ONCE], so_far[k:k + PAIRS_AT_ONCE]
            if level == 0:
                keep = a != b
                found.append((a[keep], b[keep]))
                continue
            shared = here["mask"][a] & here["mask"][b]
            whole = acc + 64 - np.bitwise_count(shared) <= bits
            if whole.any():
                self._link_all(level, a[whole], b[whole], found)
                a, b, acc, shared = a[~whole], b[~whole], acc[~whole], shared[~whole]
            below, starts = self.levels[level - 1], self.levels[level - 1]["starts"]
            na, nb = starts[a + 1] - starts[a], starts[b + 1] - starts[b]
            pair = np.repeat(np.arange(len(a)), na * nb)
            nth = np.arange(len(pair)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
            i, j = starts[a][pair] + nth // nb[pair], starts[b][pair] + nth % nb[pair]
            ordered = i <= j
            pair, i, j = pair[ordered], i[ordered], j[ordered]
            # Bits that the children share beyond those of their parents, which are counted already.
            more = below["mask"][i] & below["mask"][j] & ~shared[pair]
            total = acc[pair] + np.bitwise_count((below["pattern"][i] ^ below["pattern"][j]) & more)
            near = total <= bits
            self._walk(level - 1, i[near], j[near], total[near], bits, found)

    def _link_all(self, level, a, b, found) -> None:
        for x, y in ((a, b), (b, a)):
            (start, end), (to, _) = self.members(level, x), self.members(level, y)
            n = end - start
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            found.append((np.repeat(start, n) + nth, np.repeat(to, n)))


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of ``n`` positions."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def group_links(group: np.ndarray, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, representative) for each fingerprint that links within its group and isn't the representative."""
    label = roots(len(fp), *GrayIndex(group, fp).links(bits))
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def link_groups(bits: int, limit: int):
    """Sorted (mask, value, rank, fp) rows -> links inside groups, or the rows of groups over ``limit`` marked by mask."""

    def batch(a, b, mask=None):
        a, b = (pa.array(x.view(np.int64)) for x in (a, b))
        return pa.RecordBatch.from_arrays([a, b, pa.array(mask if mask is not None else [None] * len(a), pa.int64())], ["a", "b", "mask"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 3), np.int64)  # rows of groups that are not joined yet: mask, value, fp
        large = None  # key of a group over the limit
        for b in batches:
            rows = np.column_stack([np.asarray(b.column(i)) for i in (0, 1, 3)])
            if large is not None:
                n = int((rows[:, :2] == large).all(1).argmin()) if not (rows[:, :2] == large).all() else len(rows)
                yield batch(rows[:n, 2], rows[:n, 2], rows[:n, 0])
                rows = rows[n:]
                if not len(rows):
                    continue
                large = None
            held = np.concatenate([held, rows])
            last = int((held[:, :2] == held[-1, :2]).all(1).argmax()) if len(held) else 0
            if last >= CHUNK_ROWS:
                yield from joined(held[:last])
                held, last = held[last:], 0
            if len(held) - last > limit:
                yield from joined(held[:last])
                large = held[-1, :2].copy()
                yield batch(held[last:, 2], held[last:, 2], held[last:, 0])
                held = held[:0]
        yield from joined(held)

    def joined(rows):
        if not len(rows):
            return
        new = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)]
        group = np.cumsum(new)
        size = np.bincount(group)[group]
        some = (size > 1) & (size <= limit)
        if some.any():
            yield batch(*group_links(group[some], np.ascontiguousarray(rows[some, 2]).view(np.uint64), bits))
        over = size > limit
        if over.any():
            fp = np.ascontiguousarray(rows[over, 2])
            yield batch(fp, fp, np.ascontiguousarray(rows[over, 0]))

    return run


def hamming_links(fingerprints: DataFrame, bits: int = 4, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links (a, b) that connect all pairs of distinct fingerprints within ``bits`` differing bits.

    ``fingerprints`` has one long column of distinct values. The links span each group of near fingerprints: one row
    per member and group, never all pairs. A group over ``group_rows`` is cut again on its remaining bits, up to
    ROUNDS times; after that it is bounded by the bits that remain. Null fingerprints take no part.
    """
    column = fingerprints.columns[0]
    todo = fingerprints.where(F.col(column).isNotNull()).select(F.lit(0).cast("long").alias("mask"), F.col(column).alias("fp"))
    parts = []
    for n in range(ROUNDS):
        limit = group_rows if n < ROUNDS - 1 else 1 << 62
        rows = (todo.mapInArrow(spread(bits), KEYS).repartition("mask", "value")
                .sortWithinPartitions("mask", "value", "rank").mapInArrow(link_groups(bits, limit), LINKS))
        out = settle(rows, "hamming")
        parts.append(out.where("mask is null").select("a", "b"))
        todo = out.where("mask is not null").select("mask", F.col("a").alias("fp"))
        if todo.isEmpty():
            break
    links = parts[0]
    for more in parts[1:]:
        links = links.union(more)
    return links.where("a != b").distinct()
