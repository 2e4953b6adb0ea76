"""Filter interaction audit: what five quality filters remove, alone, together and in every order.

Four filters look at one text. The fifth, exact repeats, needs other rows: a counting Bloom sketch of all texts clears those
that are surely unique, and only the texts of possible repeats move, to find the smallest id of each by its whole text. A
document's failures are a mask of five bits; counts per mask add up, and every order follows from them.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityflow.llm.common import id_type, small_batches, steps
from entityflow.session import settle

FILTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT = 65  # of a hundred words
MOST_CAPITALS = 5  # of a hundred code points
SIGNS = re.compile(rb"[#$%&*|]")
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
REPEAT = 1 << FILTERS.index("E")

# Words of a long text are counted in pieces of this many bytes.
PIECE_BYTES = 1 << 20
BLANK = re.compile(rb"[\x20\x09-\x0D]")

# The sketch: blocks of counters, as many as texts need at CELLS_PER_TEXT each; a text counts in PROBES of one block.
CELLS_PER_TEXT, BLOCK_CELLS, PROBES = 16, 512, 3


def _words(text: bytes) -> Iterator[list[bytes]]:
    start = 0
    while start < len(text):
        blank = BLANK.search(text, start + PIECE_BYTES)
        end = blank.start() if blank else len(text)
        yield text[start:end].split()
        start = end


def failures(text: str | None) -> int:
    """Mask of the filters A to D that a text fails."""
    text = text or ""
    data = text.encode()
    n, distinct = 0, set()
    for words in _words(data):
        n += len(words)
        distinct.update(words)
    capitals = len(data) - len(data.translate(None, CAPITALS))
    failed = (n < LEAST_WORDS, 100 * len(distinct) < LEAST_DISTINCT * n, 100 * capitals > MOST_CAPITALS * len(text), SIGNS.search(data) is not None)
    return sum(1 << k for k, f in enumerate(failed) if f)


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, 3):
        masks = pa.array([failures(t.as_py()) for t in batch.column(3)], pa.int32())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], masks, *batch.columns[4:]], ["id", "part", "h", "mask", *batch.schema.names[4:]])


def _with_masks(rows: DataFrame, more: str = "") -> DataFrame:
    return small_batches(rows).mapInArrow(_masks, f"id {id_type(rows, 'id')}, part string, h long, mask int{more}")


def repeat_candidates(hashes: DataFrame, cells_per_text: int = CELLS_PER_TEXT) -> DataFrame:
    """(h): the hashes that the counting sketch of all ``hashes`` (a long column h) can't clear.

    A text counts once in each of its cells. Every task counts its own texts, and the partial sketches are merged cell by
    cell. A text with a cell that no other text touched is unique; so each repeated hash returns, and of the others
    about one in two hundred. The sketch grows with the table and is never in one place. Of its counters, only those
    above one are kept, as bits of their block.
    """
    blocks = 1 << max(0, math.ceil(math.log2(max(1, hashes.count()) * cells_per_text / BLOCK_CELLS)))
    spread = F.xxhash64(F.lit(7), F.col("h"))
    probes = F.array(*[F.shiftrightunsigned(spread, 9 * k).bitwiseAND(BLOCK_CELLS - 1).cast("int") for k in range(PROBES)])
    placed = hashes.select("h", F.pmod(F.col("h"), F.lit(blocks)).alias("block"), probes.alias("probes"))
    counts = placed.select("block", F.explode(F.array_distinct("probes")).alias("cell")).groupBy("block", "cell").agg(F.count(F.lit(1)).alias("n"))
    word, bit = F.shiftright("cell", 6), F.expr("shiftleft(1L, cell & 63)")
    bits = [F.coalesce(F.bit_or(F.when(word == w, bit)), F.lit(0).cast("long")).alias(f"w{w}") for w in range(BLOCK_CELLS // 64)]
    sketch = settle(counts.where("n > 1").groupBy("block").agg(*bits), "repeat-sketch").select("block", F.array(*[f"w{w}" for w in range(BLOCK_CELLS // 64)]).alias("bits"))
    held = F.expr("forall(probes, c -> shiftrightunsigned(bits[c >> 6], c & 63) & 1L = 1L)")
    return settle(placed.join(sketch, "block").where(held).select("h").distinct(), "repeat-candidates")


def audit_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", hashed=F.xxhash64) -> DataFrame:
    """(id, part, mask) of every row: bit k of the mask says that the row fails filter k of A to E.

    Null texts are empty, a null part is the empty text. A row fails E if a row with a smaller id has the same text; so rows
    that repeat an id don't make each other repeats, and null ids neither fail nor count. The hash of a text proposes, whole
    texts decide: the smallest id is taken per text, and hashes that two texts share are settled text by text.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    given = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                        hashed(text).cast("long").alias("h"), text.alias("text"))
    rows = settle(_with_masks(given), "masks")
    candidates = repeat_candidates(rows.select("h"))
    # Grouped by text alone, so that a hot hash of the join before it may still be split.
    repeated = given.join(candidates, "h", "left_semi")
    first = F.min("id").alias("first")
    firsts = settle(repeated.groupBy("text").agg(first).select(hashed(F.col("text")).cast("long").alias("h"), "first"), "first-ids")
    firsts = settle(firsts.groupBy("h").agg(F.count(F.lit(1)).alias("texts"), F.min("first").alias("first")), "first-ids-by-hash")
    late = F.when(F.col("id") > F.col("first"), REPEAT).otherwise(0)
    mask = F.col("mask").bitwiseOR(late).alias("mask")
    shared = firsts.where("texts > 1").select("h")
    if shared.isEmpty():
        return rows.join(firsts.select("h", "first"), "h", "left").select("id", "part", mask)
    apart = rows.join(shared, "h", "left_anti").join(firsts.select("h", "first"), "h", "left").select("id", "part", mask)
    texts = given.join(shared, "h", "left_semi")
    exact = texts.join(texts.groupBy("text").agg(first), "text").select("id", "part", "h", "text", "first")
    return apart.unionByName(_with_masks(exact, f", first {id_type(docs, id_col)}").select("id", "part", mask))


def mask_counts(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): rows, and rows whose id is labelled quality 1 or toxic 1 (by any of its labels)."""
    rows = settle(rows, "audit-rows")
    known = labels.select(F.col(f"`{id_col}`").alias("id"), (F.col("quality") == 1).cast("long").alias("good"), (F.col("toxic") == 1).cast("long").alias("toxic"))
    known = settle(known.groupBy("id").agg(*[F.coalesce(F.max(c), F.lit(0).cast("long")).alias(c) for c in ("good", "toxic")]).where("good + toxic > 0"), "labels")
    none = F.lit(0).cast("long")
    labelled = rows.join(known, "id").groupBy("part", "mask").agg(none.alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    plain = rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), none.alias("good"), none.alias("toxic"))
    return plain.unionByName(labelled).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def _orders(filters: str) -> Column:
    """Every step of every order: its filter's bit, and the bits of the filters before it and up to it."""
    found = []
    for order in permutations(range(len(filters))):
        before = 0
        for step, k in enumerate(order, 1):
            after = before | 1 << k
            found.append({"filter_order": "".join(filters[j] for j in order), "step": step, "bit": 1 << k, "before": before, "after": after})
            before = after
    return F.from_json(F.lit(json.dumps(found)), "array<struct<filter_order string, step int, bit int, before int, after int>>")


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from counts per part and mask (at most 2^filters rows a part).

    What a filter removes is what it fails and no filter before it does. Summed over all orders, a row with m failures is
    removed by each of its failed filters in the m-th part of the orders. Parts without rows don't appear.
    """
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    rows = cells.select("part", "cells", F.explode(_orders(filters)).alias("o")).select("part", "cells", "o.*")

    def total(where: str, what: str = "c.n") -> Column:
        return F.expr(f"aggregate(cells, 0L, (a, c) -> a + if({where}, {what}, 0L))")

    fails, here = "(c.mask & bit) != 0", "(c.mask & bit) != 0 AND (c.mask & before) = 0"
    share = f"c.n * ({math.factorial(len(filters))} div bit_count(c.mask))"
    return rows.select(
        "part", "filter_order", "step", total("(c.mask & after) = 0").alias("kept"), total(here).alias("removed"),
        total(f"{fails} AND (c.mask & before) != 0").alias("redundant"), total("c.mask = bit").alias("unique_fails"),
        total(here, "c.good").alias("good_lost"), total(here, "c.toxic").alias("toxic_lost"), total(fails, share).alias("shapley"))
