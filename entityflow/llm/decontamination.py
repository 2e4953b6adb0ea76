"""Benchmark decontamination by the q-gram lemma.

A stretch of w characters of a benchmark item that occurs in a text with at most k edits shares at least w + 1 - q (k + 1)
of its q-grams with the text, all on diagonals that differ by at most k. So shared q-grams are counted in overlapping bands
of diagonals; where enough of them lie within the length of a stretch is a region. Every stretch of a region that also shares enough
short q-grams is verified by a banded alignment. Items and texts are cut into overlapping blocks, in each of which a whole stretch finds room. Equal
blocks are looked at once, so a line that a text or a benchmark repeats costs no more than its distinct surroundings.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityflow.llm.common import id_and_text, id_type, per_process, small_batches, steps

Q = 10
WINDOW = 100  # characters of a stretch; a shorter item is one stretch
STRIDE = 128  # blocks start at its multiples
EDIT_SHARE = 0.08  # edits per character of a stretch
EXACT_CHARS = 30  # an item of fewer characters, once folded, must stand in the text as it is, between word ends
LEAST_WORDS = 3  # an item of fewer words and of under EXACT_CHARS characters tells nothing
WIDTH = 16  # diagonals from one band to the next
# Characters of benchmark items in one pass over the texts; a larger benchmark takes several.
BLOCK_CHARS = 4_000_000
STEP_CHARS = 1 << 20
FINE_Q = 3  # a stretch is aligned if it also shares enough q-grams of this size
LOT = 1 << 18  # shared q-grams looked at together
FINE_LOT = 1 << 11  # bands in which these are counted together
ALIGN_LOT = 1 << 12  # alignments run together
FILTER_BITS = 22
NO_SIGN, NO_ITEM_SIGN = np.uint32(0xFFFFFFFF), np.uint32(0xFFFFFFFE)
MIX = np.uint64(0x9E3779B97F4A7C15)


def folded(text: str) -> str:
    """Lower case, with every run of other signs than letters and digits as one space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    keep = letter_table()[np.minimum(codes, 0xFFFF)] | (codes > 0xFFFF)
    first = ~keep & np.append(True, keep[:-1])
    return np.where(keep, codes, np.uint32(32))[keep | first].tobytes().decode("utf-32-le").strip(" ")


def letter_table() -> np.ndarray:
    return per_process("letters and digits", lambda: np.fromiter((chr(c).isalnum() for c in range(0x10000)), bool, 0x10000))


def grams(codes: np.ndarray) -> np.ndarray:
    """A 64-bit value of each run of Q characters, by doubling: 1, 2, 4, 8 and then Q characters."""
    def join(a, b):
        return (a * MIX ^ a >> np.uint64(29)) + b

    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    one = codes.astype(np.uint64)
    two = join(one[:-1], one[1:])
    four = join(two[:-2], two[2:])
    eight = join(four[:-4], four[4:])
    return join(eight[:len(codes) - Q + 1], two[8:]) * MIX


def as_codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def allowed(size: int) -> tuple[int, int]:
    """(edits, q-grams shared at least) of a stretch."""
    edits = min(int(size * EDIT_SHARE), (size - Q) // Q)
    return edits, size + 1 - Q * (edits + 1)


def aligned(window: np.ndarray, text: np.ndarray, edits: int) -> np.ndarray:
    """Per row, whether the window occurs in the text with at most ``edits`` edits, on diagonals of the text alone.

    Column j of step i stands for text position i + j - edits - 1, so the band of all rows is one array; text characters
    without a partner run along it and are settled by a running minimum.
    """
    rows, m = window.shape
    n = text.shape[1] - m + 2 * edits + 2
    good = np.zeros(rows, bool)
    if n <= 0:
        return good
    step = np.arange(n, dtype=np.int32)
    lead = np.full((rows, m + edits + 1), NO_SIGN, np.uint32)
    padded = np.hstack([lead[:, :edits + 1], text, lead])
    alive, cost = np.arange(rows), np.zeros((rows, n), np.int32)
    for i in range(m):
        new = cost + (padded[:, i:i + n] != window[:, i:i + 1])
        new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)  # window character without a partner
        cost = np.minimum.accumulate(new - step, axis=1) + step
        if i % 8 == 7:
            some = cost.min(axis=1) <= edits
            if not some.all():
                alive, cost, padded, window = alive[some], cost[some], padded[some], window[some]
                if not len(alive):
                    return good
    good[alive[cost.min(axis=1) <= edits]] = True
    return good


class Index:
    """Distinct blocks of folded items, with all their q-grams behind a bit filter; items to be found as they are apart."""

    def __init__(self, items: list[tuple[int, str]]):
        blocks: dict[str, set[int]] = {}
        exact: dict[str, set[int]] = {}
        for item, text in items:
            if len(text) < EXACT_CHARS:
                if text.count(" ") + 1 >= LEAST_WORDS:
                    exact.setdefault(f" {text} ", set()).add(item)
                continue
            for a in range(0, max(1, len(text) - WINDOW + 1), STRIDE):
                blocks.setdefault(text[a:a + STRIDE + WINDOW - 1], set()).add(item)
        self.exact = None
        if exact:
            self.exact = ahocorasick.Automaton()
            for text, found in exact.items():
                self.exact.add_word(text, found)
            self.exact.make_automaton()
        self.items = list(blocks.values())
        self.size = np.array([len(t) for t in blocks], np.int64)
        self.window = np.minimum(self.size, WINDOW)
        by_size = np.array([allowed(w) if w >= EXACT_CHARS else (0, 1) for w in range(WINDOW + 1)], np.int64)
        self.edits, self.least = by_size[self.window].T
        self.most_edits = int(self.edits.max(initial=0))
        self.fewest = int(self.least.min(initial=1 << 30))
        self.codes = np.concatenate([np.zeros(0, np.uint32), *map(as_codes, blocks)])
        self.start = np.cumsum(self.size) - self.size
        parts = [grams(self.codes[a:a + n]) for a, n in zip(self.start.tolist(), self.size.tolist())]
        gram = np.concatenate([np.zeros(0, np.uint64), *parts])
        block = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(p)) for p in parts]])
        order = np.argsort(gram, kind="stable")
        gram, self.block, self.place = gram[order], block[order], place[order]
        self.gram, self.first = np.unique(gram, return_index=True)
        self.count = np.diff(np.append(self.first, len(gram)))
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.gram >> np.uint64(64 - FILTER_BITS)] = True

    def crowded(self, at: np.ndarray) -> np.ndarray:
        """Which positions lie with enough others within the length of an occurrence."""
        k = self.fewest - 1
        if len(at) <= k:
            return np.zeros(len(at), bool)
        near = np.flatnonzero(at[k:] - at[:len(at) - k] <= WINDOW + self.most_edits)
        inside = np.zeros(len(at) + 1, np.int64)
        np.add.at(inside, near, 1)
        np.add.at(inside, near + k + 1, -1)
        return np.cumsum(inside[:-1]) > 0

    def search(self, pieces: list[np.ndarray]) -> list[set[int]]:
        """Items with a stretch that a piece of a folded text contains within its edits."""
        found: list[set[int]] = [set() for _ in pieces]
        joined = np.concatenate([x for p in pieces for x in (p, [NO_SIGN])]).astype(np.uint32)
        end = np.cumsum([len(p) + 1 for p in pieces]) - 1
        start = end - [len(p) for p in pieces]
        gram = grams(joined)
        at = np.flatnonzero(self.filter[gram >> np.uint64(64 - FILTER_BITS)])
        at = at[self.crowded(at)]
        if not len(at) or not len(self.gram):
            return found
        slot = np.minimum(np.searchsorted(self.gram, gram[at]), len(self.gram) - 1)
        same = self.gram[slot] == gram[at]
        at, slot = at[same], slot[same]
        near = self.crowded(at)
        at, slot = at[near], slot[near]
        # Each position belongs to the block that starts at or before it and to the one before that.
        piece = np.searchsorted(start, at, "right") - 1
        number = (at - start[piece]) // STRIDE
        base = np.concatenate([start[piece] + STRIDE * number, (start[piece] + STRIDE * (number - 1))[number > 0]])
        at, slot, piece = (np.append(x, x[number > 0]) for x in (at, slot, piece))
        inside = at - base <= 2 * STRIDE - Q
        base, at, slot, piece = base[inside], at[inside], slot[inside], piece[inside]
        base, first, owner = np.unique(base, return_index=True, return_inverse=True)
        piece = piece[first]
        # Equal blocks are looked at once.
        seen: dict[bytes, int] = {}
        stop = np.minimum(base + 2 * STRIDE, end[piece])
        like = np.array([seen.setdefault(joined[a:b].tobytes(), k) for k, (a, b) in enumerate(zip(base.tolist(), stop.tolist()))], np.int64)
        order = np.argsort(owner, kind="stable")
        order = order[like[owner[order]] == owner[order]]
        owner, slot, at = owner[order], slot[order], at[order]
        at = at - base[owner]
        entries = np.cumsum(self.count[slot])
        known = self.shares(like, piece)
        a = 0
        while a < len(owner):
            limit = np.searchsorted(entries, LOT + (entries[a - 1] if a else 0), "right")
            b = int(np.searchsorted(owner, owner[min(max(limit, a), len(owner) - 1)]))
            b = len(owner) if limit >= len(owner) else b if b > a else int(np.searchsorted(owner, owner[a], "right"))
            self.hits(owner[a:b], at[a:b], slot[a:b], joined, base, stop, known)
            a = b
        for k, p in zip(like.tolist(), piece.tolist()):
            found[p] |= known[k]
        return found

    @staticmethod
    def shares(like: np.ndarray, piece: np.ndarray) -> dict[int, set[int]]:
        """Items known of each block; blocks that only one piece holds share its set, so an item is settled once for all of them."""
        pieces: dict[int, set[int]] = {}
        for k, p in zip(like.tolist(), piece.tolist()):
            pieces.setdefault(k, set()).add(p)
        own: dict[int, set[int]] = {}
        return {k: own.setdefault(next(iter(held)), set()) if len(held) == 1 else set() for k, held in pieces.items()}

    def hits(self, owner, at, slot, joined, base, stop, known: dict[int, set[int]]) -> None:
        """Adds the items that have a stretch in common with a text block to those known of it."""
        n = self.count[slot]
        entry = np.repeat(self.first[slot] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        block, place = self.block[entry], self.place[entry]
        diagonal = np.repeat(at, n) - place + 2 * STRIDE  # not negative
        pair = np.repeat(owner, n) * len(self.items) + block
        band = diagonal // WIDTH
        over = (diagonal % WIDTH < self.most_edits) & (band > 0)  # also in the overlap of the band before
        # At most 2^20 text blocks, 2^22 item blocks, 2^6 bands and 2^8 places. A q-gram counts once per band.
        key = np.unique(np.append((pair << 6 | band) << 8 | place, ((pair << 6 | band - 1) << 8 | place)[over]))
        group, place = key >> 8, key & 255
        block = (group >> 6) % len(self.items)
        first = np.arange(len(key))
        last = first + self.least[block] - 1
        first, last = first[last < len(key)], last[last < len(key)]
        room = self.window[block[first]] - Q
        enough = (group[first] == group[last]) & (place[last] - place[first] <= room)
        first, last = first[enough], last[enough]
        group, block = group[first], block[first]
        # The stretches that hold all of first to last; those of one group are merged.
        low = np.maximum(0, place[last] + Q - self.window[block])
        high = np.minimum(place[first], self.size[block] - self.window[block])
        low[1:] = np.where(group[1:] == group[:-1], np.maximum(low[1:], high[:-1] + 1), low[1:])
        some = low <= high
        group, block, low, high = group[some], block[some], low[some], high[some]
        left = np.isin(group >> 6, self.open_pairs(group >> 6, known))
        group, block, low, high = group[left], block[left], low[left], high[left]
        group, block, begin, score = self.fine(group, block, low, high, joined, base, stop)
        # The best stretch of each pair settles most of them; then all of the others.
        order = np.lexsort((-score, group >> 6))
        group, block, begin = group[order], block[order], begin[order]
        tried = np.unique(group >> 6, return_index=True)[1]
        done = (group >> 6)[tried][self.occurs(group[tried], block[tried], begin[tried], joined, base, stop)]
        for k, item_block in zip((done // len(self.items)).tolist(), (done % len(self.items)).tolist()):
            known[k] |= self.items[item_block]
        left = np.flatnonzero(np.isin(group >> 6, self.open_pairs(np.setdiff1d(group >> 6, done), known)))
        done = (group >> 6)[left][self.occurs(group[left], block[left], begin[left], joined, base, stop)]
        for x in np.unique(done).tolist():
            known[x // len(self.items)] |= self.items[x % len(self.items)]

    def open_pairs(self, pairs: np.ndarray, known: dict[int, set[int]]) -> list[int]:
        """The pairs whose item block has an item that isn't known of the text block yet."""
        return [x for x in np.unique(pairs).tolist() if not self.items[x % len(self.items)] <= known[x // len(self.items)]]

    def fine(self, group, block, low, high, joined, base, stop) -> tuple[np.ndarray, ...]:
        """(group, block, begin, count) of the stretches that share enough q-grams of FINE_Q characters, counted in their band."""
        every, first, of = np.unique(group, return_index=True, return_inverse=True)
        out = [(group[:0], block[:0], low[:0], low[:0])]
        longest, diagonals = STRIDE + WINDOW - 1, WIDTH + self.most_edits
        for a in range(0, len(every), FINE_LOT):
            g, item = every[a:a + FINE_LOT], block[first[a:a + FINE_LOT]]
            owner = (g >> 6) // len(self.items)
            place = np.arange(longest)
            real = place < self.size[item][:, None]
            mine = np.where(real, self.codes[np.where(real, self.start[item][:, None] + place, 0)], NO_ITEM_SIGN)
            at = (base[owner] + (g & 63) * WIDTH - 2 * STRIDE)[:, None] + np.arange(longest + diagonals)
            within = (at >= base[owner][:, None]) & (at < stop[owner][:, None])
            text = np.where(within, joined[np.where(within, at, 0)], NO_SIGN)
            shared = np.zeros((len(g), longest - FINE_Q + 1), bool)
            for k in range(diagonals):
                same = mine == text[:, k:k + longest]
                shared |= same[:, :-2] & same[:, 1:-1] & same[:, 2:]
            total = np.pad(np.cumsum(shared, axis=1, dtype=np.int32), ((0, 0), (1, 0)))
            rows = np.flatnonzero((of >= a) & (of < a + FINE_LOT))
            asked = np.zeros((len(g), longest + 1), np.int32)
            np.add.at(asked, (of[rows] - a, low[rows]), 1)
            np.add.at(asked, (of[rows] - a, high[rows] + 1), -1)
            row, begin = np.nonzero(np.cumsum(asked, axis=1) > 0)
            window, edits = self.window[item[row]], self.edits[item[row]]
            count = total[row, begin + window - FINE_Q + 1] - total[row, begin]
            enough = count >= window + 1 - FINE_Q * (edits + 1)
            out.append((g[row[enough]], item[row[enough]], begin[enough], count[enough]))
        return tuple(np.concatenate(x) for x in zip(*out))

    def occurs(self, group, block, begin, joined, base, stop) -> np.ndarray:
        """Whether each stretch, ``begin`` of an item block, occurs in its text block near its band."""
        good = np.zeros(len(group), bool)
        owner = (group >> 6) // len(self.items)
        lowest = base[owner] + begin + (group & 63) * WIDTH - 2 * STRIDE
        for size in np.unique(self.window[block]).tolist():
            edits = allowed(size)[0]
            mine = np.flatnonzero(self.window[block] == size)
            for a in range(0, len(mine), ALIGN_LOT):
                part = mine[a:a + ALIGN_LOT]
                window = self.codes[(self.start[block[part]] + begin[part])[:, None] + np.arange(size)]
                at = (lowest[part] - edits)[:, None] + np.arange(WIDTH + self.most_edits + size + 2 * edits)
                within = (at >= base[owner[part], None]) & (at < stop[owner[part], None])
                text = np.where(within, joined[np.where(within, at, 0)], NO_SIGN)
                good[part] = aligned(window, text, edits)
        return good


def find(texts: list[str | None], index: Index) -> list[list[int]]:
    """Items found in each text."""
    found: list[set[int]] = [set() for _ in texts]
    held, owners, size = [], [], 0

    def settle_held():
        for k, items in zip(owners, index.search(held) if held else ()):
            found[k] |= items

    for k, text in enumerate(texts):
        text = folded(text or "")
        if index.exact is not None:
            for _, items in index.exact.iter(f" {text} "):
                found[k] |= items
        codes = as_codes(text)
        # Pieces overlap by a block, so an occurrence lies whole in one of them.
        for a in range(0, len(codes), STEP_CHARS):
            held.append(codes[a:a + STEP_CHARS + 2 * STRIDE])
            owners.append(k)
            size += len(held[-1])
            if size >= STEP_CHARS:
                settle_held()
                held, owners, size = [], [], 0
    settle_held()
    return [sorted(items) for items in found]


def _leaks(items: list[tuple[int, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items)
        for batch in steps(batches):
            found = find(batch.column(1).to_pylist(), index)
            size = np.fromiter(map(len, found), np.int64, len(found))
            keep = pa.array(np.repeat(np.arange(len(found)), size))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), pa.array([i for x in found for i in x], pa.int64())], ["id", "item"])

    return run


def blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """Folded items in lists of about BLOCK_CHARS characters, which travel to the tasks of one pass each."""
    held, size = [], 0
    for row in benchmark.select(F.col(f"`{item_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")).toLocalIterator():
        if row[0] is None or row[1] is None:
            continue
        held.append((row[0], folded(row[1])))
        size += len(held[-1][1])
        if size >= BLOCK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text") -> DataFrame:
    """(id, item) for each text that contains any stretch of WINDOW characters of a benchmark item within its edits.

    Texts and items are compared folded. A shorter item counts as a whole; one under EXACT_CHARS characters must stand in
    the text without edits, between word ends, and hold LEAST_WORDS words. Null items take part in nothing; null texts are
    empty. One pass over the texts per block of items, without a shuffle; an empty benchmark finds nothing.
    """
    rows = id_and_text(docs, id_col, text_col)
    schema = f"id {id_type(docs, id_col)}, item long"
    found = None
    for items in blocks(benchmark, item_col, item_text_col):
        part = rows.mapInArrow(_leaks(items), schema)
        found = part if found is None else found.union(part)
    return rows.sparkSession.createDataFrame([], schema) if found is None else found


def _clean(items: list[tuple[int, str]], column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items)
        for batch in steps(batches, column):
            yield batch.filter(pa.array([not found for found in find(batch.column(column).to_pylist(), index)], pa.bool_()))

    return run


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without any leak, all columns kept; decided where the row is, one filter per block of items."""
    at = docs.columns.index(text_col)
    for items in blocks(benchmark, item_col, item_text_col):
        docs = small_batches(docs).mapInArrow(_clean(items, at), docs.schema)
    return docs
