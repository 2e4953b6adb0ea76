"""SimHash near-duplicate classes: fingerprints per document, linked through the Gray-order index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from entityflow.llm.common import id_and_text, id_type, steps
from entityflow.llm.components import components
from entityflow.llm.hamming import hamming_links
from entityflow.session import settle

HASH_SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4
# Shingles of one text whose bits are counted at once.
BLOCK = 1 << 14


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """Majority bits of the hashes of all word shingles; a tie gives 0."""
    words = text.lower().split()  # on bytes: A-Z only, and the six ASCII separators
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxh64_intdigest(joined, HASH_SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends[width - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for k in range(0, len(ends), BLOCK):
        hashes = np.array([xxh64_intdigest(joined[a:b], HASH_SEED) for a, b in zip(starts[k:k + BLOCK], ends[k:k + BLOCK])], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(ends), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches):
        found = np.fromiter((fingerprint((t or "").encode()) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every row. Null and empty texts get fingerprint zero."""
    return id_and_text(docs, id_col, text_col).mapInArrow(_fingerprints, f"id {id_type(docs, id_col)}, fp long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = MAX_BITS) -> DataFrame:
    """(id, fp, component): every row with its fingerprint and the smallest id of its near-duplicate class.

    Equal fingerprints are merged first, so exact copies cost one key, however many they are. Links between different
    fingerprints come from the Gray-order index, classes from connected components over fingerprints; only fingerprints
    that link with another one are in that graph. Rows are never dropped: repeated rows each return, empty tables
    return no rows, a null id is never the smallest, and a class with null ids only has a null component.
    """
    rows = settle(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = settle(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    label = components(hamming_links(distinct.select("fp"), bits))
    near = distinct.join(label, distinct.fp == label.node, "left").select("fp", F.coalesce("label", "fp").alias("root"), "first")
    near = settle(near, "roots")
    smallest = near.groupBy("root").agg(F.min("first").alias("component"))
    classes = settle(near.join(smallest, "root").select("fp", "component"), "classes")
    return rows.join(classes, "fp").select("id", "fp", "component")


def hex_fingerprint(column):
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their near-duplicate class, all columns kept.

    Decisions go by id. An id that is the smallest of any of its classes stays; of the rows that repeat it, one stays.
    Rows with a null id stay, as no decision can name them.
    """
    return keep_smallest(docs, near_duplicates(docs, id_col, text_col, bits), id_col)


def keep_smallest(docs: DataFrame, classes: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` that ``classes``, rows of (id, component), let stay; see ``one_per_class``."""
    found = classes.where("id is not null")
    by_id = settle(found.groupBy("id").agg(F.max(F.col("id") == F.col("component")).alias("first"), F.count("*").alias("n"))
                   .where("not first or n > 1"), "decisions")
    mine = F.col(f"`{id_col}`")
    kept = docs.join(by_id.select(F.col("id").alias("__id")), F.col("__id") == mine, "left_anti")
    repeated = by_id.where("first").select(F.col("id").alias("__id"))
    if repeated.isEmpty():
        return kept
    return kept.unionByName(docs.join(repeated, F.col("__id") == mine, "left_semi").dropDuplicates([id_col]))
