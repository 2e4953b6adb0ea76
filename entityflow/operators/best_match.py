"""The best weighted ratio of every name over any number of seeds: seeds are visited by falling upper bound.

What two texts can share is at most what their character counts share. From that and their lengths follows an upper
bound of each part of the weighted ratio. A name's seeds are scored from the highest bound down, until no bound that is left
reaches the best score; so few pairs are scored, and the result is that of scoring all. Where bounds tell little, as among
seeds that are alike, seeds that differ only in characters the name lacks have one score, computed once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityflow.operators.similarity import weighted_ratio
from entityflow.session import settle

CLASSES = 48  # characters are counted by code modulo this
NAME_ROWS = 512  # names that meet a block of seeds at once
TASK_BLOCKS = 8  # blocks of seeds that a task takes
KNOWN_SCORES = 200_000  # scores that a task keeps


def histogram(texts: list[str]) -> np.ndarray:
    """How many characters of each class a text has."""
    out = np.zeros((len(texts), CLASSES), np.int32)
    for k, text in enumerate(texts):
        if text:
            out[k] = np.bincount(np.frombuffer(text.encode("utf-32-le"), np.uint32) % CLASSES, minlength=CLASSES)
    return out


class Scorer(dict):
    """The weighted ratio of one name and any text, kept by what of the text matters: its characters that the name has, and where.

    A text enters the ratio whole, as its sorted words, and as its sorted words that the name lacks. Of each only the length
    and the places of the name's characters count, so the others are read as one foreign character.
    """

    def __init__(self, name: str):
        super().__init__()
        self.name, self.words = name, set(name.split())
        foreign = next(c for c in range(len(name) + 1) if chr(c) not in name)
        self.mask = _Mask({ord(c): c for c in name}, foreign)

    def score(self, text: str) -> tuple[float, bool]:
        """The ratio, and whether it had to be computed."""
        words = text.split()
        key = text.translate(self.mask)
        if words != [text]:
            rest = " ".join(sorted(set(words) - self.words)).translate(self.mask)
            key = key, " ".join(sorted(words)).translate(self.mask), rest, frozenset(self.words.intersection(words))
        found = self.get(key)
        if found is not None:
            return found, False
        if len(self) >= KNOWN_SCORES // NAME_ROWS:
            self.clear()
        found = self[key] = weighted_ratio(self.name, text)
        return found, True


class _Mask(dict):
    def __init__(self, own: dict[int, str], foreign: int):
        super().__init__(own)
        self.foreign = foreign

    def __missing__(self, code: int) -> int:
        return self.foreign


class SeedBlock:
    """A count-filter index of seeds: (form, order, canonical), in order of the seeds."""

    def __init__(self, forms: list[str], orders: list[int], canonicals: list[str]):
        order = sorted(range(len(forms)), key=orders.__getitem__)
        self.seeds = [(forms[k], orders[k], canonicals[k]) for k in order]
        self.counts = histogram([f for f, _, _ in self.seeds])
        self.length = self.counts.sum(axis=1)
        words = [f.split() for f, _, _ in self.seeds]
        self.repeats = np.array([len(w) != len(set(w)) for w in words])
        self.by_word: dict[str, list[int]] = {}
        for k, found in enumerate(words):
            for w in set(found):
                self.by_word.setdefault(w, []).append(k)
        self.scored = 0  # pairs that were scored

    def bounds(self, name: str) -> np.ndarray:
        """An upper bound of the weighted ratio of a name and each seed."""
        n, words = len(name), name.split()
        shared = np.minimum(self.counts, histogram([name])[0]).sum(axis=1).astype(np.float64)
        # With a word in common, or one repeated in a text, the word-based parts may reach 100.
        free = self.repeats | (len(words) != len(set(words)))
        for w in set(words):
            free[self.by_word.get(w, [])] = True
        short, long = np.minimum(n, self.length), np.maximum(n, self.length)
        with np.errstate(divide="ignore", invalid="ignore"):
            whole = 200 * shared / (n + self.length)
            window = 200 * shared / (short + shared)
            stretch = long / short
        scale = np.where(stretch <= 8.0, 0.9, 0.6)
        close = np.maximum(whole, 0.95 * np.where(free, 100.0, whole))
        far = np.maximum(whole, scale * np.maximum(window, 0.95 * np.where(free, 100.0, window)))
        bound = np.where(stretch < 1.5, close, far) + 1e-9
        return np.where(short > 0, bound, 0.0)

    def best(self, name: str, least: float = 0.0, scorer: Scorer | None = None) -> tuple[float, int] | None:
        """The highest score and its earliest seed; None if no seed reaches ``least``, a score that is known already."""
        bound, scorer = self.bounds(name), Scorer(name) if scorer is None else scorer
        # A score is never below 0, which the first seed has at least.
        top = (0.0, 0) if least <= 0 else None
        score = max(0.0, least)
        for k in np.argsort(-bound, kind="stable").tolist():
            if bound[k] <= 0 or bound[k] < score:
                break
            found, computed = scorer.score(self.seeds[k][0])
            self.scored += computed
            if found > score or (found == score and (top is None or k < top[1])):
                score, top = found, (found, k)
        return top


def _packed_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            lists = [pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), c) for c in batch.columns]
            yield pa.RecordBatch.from_arrays(lists, batch.schema.names)


def _best_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(names, block, form, seed_order, canonical) -> the best seed of the block for each name that it may be the best of."""
    built: dict[int, SeedBlock] = {}
    known: dict[str, float] = {}
    scorers: dict[str, Scorer] = {}
    for batch in batches:
        for n in range(batch.num_rows):
            row = batch.slice(n, 1).to_pylist()[0]
            names = row["names"]
            if len(scorers) > NAME_ROWS:
                scorers.clear()
            if len(known) > KNOWN_SCORES:
                known.clear()
            if row["block"] not in built:
                if len(built) >= 16:
                    built.clear()
                built[row["block"]] = SeedBlock(row["form"], row["seed_order"], row["canonical"])
            block, found = built[row["block"]], []
            for name in names:
                if name not in scorers:
                    scorers[name] = Scorer(name)
                top = block.best(name, known.get(name, 0.0), scorers[name])
                if top is not None:
                    known[name] = max(known.get(name, 0.0), top[0])
                    found.append((name, *block.seeds[top[1]], top[0]))
            if found:
                columns = list(zip(*found))
                kinds = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["norm", "form", "seed_order", "canonical", "score"])


def best_of_seeds(norms: DataFrame, indexed: DataFrame, block_rows: int) -> DataFrame:
    """(norm, form, seed_order, canonical, score): for each distinct name the best of some blocks of seeds; its best is among them.

    ``indexed`` has (form, seed_order, canonical). Seeds are packed in rows of ``block_rows``, names in rows of NAME_ROWS; each
    row of names meets every row of seeds. Blocks of seeds are dealt to tasks by their number, since a small file of them is much
    work; Spark brings the smaller side to the other or shuffles both by block. Nothing passes through the driver. A name that waits for its next block keeps its best score, which
    spares that block. Without seeds there are no rows.
    """
    seeds = indexed.select("form", F.col("seed_order").cast("int").alias("seed_order"), "canonical")
    blocks = settle(seeds.mapInArrow(_packed_seeds, "form array<string>, seed_order array<int>, canonical array<string>"), "seed-blocks", batch_rows=block_rows)
    blocks = settle(blocks.withColumn("block", F.monotonically_increasing_id()), "numbered-seeds")
    packed = settle(norms.select(F.col("norm").alias("names")).mapInArrow(_packed_seeds, "names array<string>"), "name-blocks", batch_rows=NAME_ROWS)
    met = packed.withColumn("numbers", blocks.agg(F.collect_list("block")).scalar()).withColumn("block", F.explode("numbers")).drop("numbers")
    dealt = blocks.repartition(max(1, math.ceil(blocks.count() / TASK_BLOCKS)))
    rows = dealt.join(met, "block").select("names", "block", "form", "seed_order", "canonical")
    return rows.mapInArrow(_best_of_blocks, "norm string, form string, seed_order int, canonical string, score double")
