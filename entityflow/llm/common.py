"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text bytes that one numpy or Arrow step handles at once. A longer single text is a step of its own.
STEP_BYTES = 2 << 20
# Rows and bytes of text that Spark hands to Python at once.
BATCH_ROWS, BATCH_BYTES = "1000", "4m"


def steps(batches: Iterator[pa.RecordBatch], column: int = 1, limit: int = STEP_BYTES, keep: bool = False) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the text column of each piece holds about ``limit`` bytes.

    What another operator's tasks left in this worker is let go, unless ``keep`` says that this task uses it.
    """
    if not keep:
        held = sys.__dict__.get("_entityflow_held", {})
        for key in [k for k in held if isinstance(k, tuple)]:
            del held[key]
    release()
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
        step = np.cumsum(sizes) // limit
        starts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            yield batch.slice(a, b - a)
    release()


def release() -> None:
    """Give memory that this worker no longer uses back to the machine; workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library has no such call
        pass


def small_batches(df: DataFrame) -> DataFrame:
    """Bound what a Python worker holds at once, as texts can be long."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under fixed names; other columns and their names don't matter."""
    return small_batches(docs).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def id_type(docs: DataFrame, id_col: str) -> str:
    return docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()


def crc_mod(id_col: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids give null."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(column.cast("string").cast("binary")) % modulus


def unit_hash(column: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the value and the seed alone."""
    return (F.pmod(F.xxhash64(F.lit(seed), column), F.lit(1 << 40)) / F.lit(float(1 << 40))).cast("double")


def per_process(key: object, make):
    """A value that all tasks of one Python worker share. Under a plain name it stays; under a tuple, such as a loaded
    tokenizer, until an operator without use for it takes the worker."""
    held = sys.__dict__.setdefault("_entityflow_held", {})
    if key not in held:
        held[key] = make()
    return held[key]


def tokenizer(path: str):
    def load():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    return per_process(("tokenizer", path), load)


def text_bytes(column: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
    """The UTF-8 bytes of a text column in one buffer, and where each text starts (and the last one ends). Null is empty."""
    column = pc.fill_null(column.cast(pa.string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2] or pa.py_buffer(b"")
    return data.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]
