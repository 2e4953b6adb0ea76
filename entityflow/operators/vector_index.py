"""An inverted-list index for cosine search: cells, residual product codes, multi-probe search, exact re-ranking.

Every vector lies in the list of its nearest cell, as a short code of what the cell's centre leaves over. A query visits the
lists of its nearest cells only, compares codes, and has its best candidates compared exactly. Cells and code books are fitted on a
bounded sample; all vectors are indexed. Queries and lists are tables that meet by cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entityflow.operators.vectors import SCORE_DIGITS, VECTOR_BATCH, _matrix, _unit
from entityflow.session import settle

# Vectors that cells and code books are fitted on, about; they pass through the driver once.
SAMPLE_VECTORS = 32_768
MAX_CELLS = 1_024
CODE_PARTS, CODE_VALUES = 16, 256  # bytes of a code, and values of each
ROUNDS = 8
LIST_ROWS = 2_048  # vectors of one list row
QUERY_ROWS = 256  # queries that meet a list row at once


@dataclass
class VectorIndex:
    """``lists``: (cell, ids, data) rows, data being the joined codes, of up to LIST_ROWS vectors; ``cells`` and ``books`` are bounded matrices."""

    lists: DataFrame
    cells: np.ndarray
    books: np.ndarray


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1)[None, :] - 2 * rows @ centres.T).argmin(axis=1)


def fit_centres(rows: np.ndarray, n: int, seed: int) -> np.ndarray:
    """k-means; a centre that loses all its rows moves to a row far from its centre."""
    rng = np.random.default_rng(seed)
    centres = rows[rng.choice(len(rows), min(n, len(rows)), replace=False)].copy()
    for _ in range(ROUNDS):
        home = _nearest(rows, centres)
        count = np.bincount(home, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, home, rows)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
        empty = np.flatnonzero(count == 0)
        if len(empty):
            centres[empty] = rows[np.argsort(-((rows - centres[home]) ** 2).sum(axis=1))[:len(empty)]]
    return centres


def _parts(rows: np.ndarray) -> np.ndarray:
    """Rows cut into CODE_PARTS equal pieces, filled up with zeros: (part, row, piece)."""
    width = -(-rows.shape[1] // CODE_PARTS)
    filled = np.pad(rows, ((0, 0), (0, width * CODE_PARTS - rows.shape[1])))
    return filled.reshape(len(rows), CODE_PARTS, width).transpose(1, 0, 2)


def _coded(cells: np.ndarray, books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _unit(_matrix(batch.column(1)))
            home = _nearest(unit, cells)
            codes = np.stack([_nearest(p, b) for p, b in zip(_parts(unit - cells[home]), books)], axis=1).astype(np.uint8)
            packed = pa.array([c.tobytes() for c in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(home.astype(np.int32)), batch.column(0), packed], ["cell", "id", "code"])

    return run


def _packed(size: int):
    """Rows sorted by cell -> one row per cell and up to ``size`` of them: ids and joined bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, ids, data, kind = None, [], [], None

        def row():
            lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids, kind))
            return pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), lists, pa.array([b"".join(data)], pa.binary())], ["cell", "ids", "data"])

        for batch in batches:
            kind = batch.column(1).type
            for c, i, d in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if ids and (c != cell or len(ids) == size):
                    yield row()
                    ids, data = [], []
                cell = c
                ids.append(i)
                data.append(d)
        if ids:
            yield row()

    return run


def build_index(emb: DataFrame, cells: int | None = None, seed: int = 1, id_col: str = "vec_id", vec_col: str = "embedding") -> VectorIndex:
    """Index all vectors of ``emb``; null vectors take no part. Without ``cells``, about the square root of the number of vectors."""
    vectors = emb.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).filter("vec is not null")
    n = vectors.count()
    kind = vectors.schema["id"].dataType.simpleString()
    share = min(1.0, SAMPLE_VECTORS / max(1, n))
    sample = vectors.filter(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("vec")
    rows = sample.toArrow()["vec"].combine_chunks() if n else pa.array([], pa.list_(pa.float64()))
    if not len(rows):  # nothing, or too little to fit on: one cell and empty books
        dims = vectors.select(F.size("vec")).first() if n else None
        unit = np.zeros((1, dims[0] if dims else 1))
    else:
        unit = _unit(_matrix(rows))
    wanted = min(MAX_CELLS, cells or max(1, int(np.sqrt(n))))
    centres = fit_centres(unit, wanted, seed)
    left = _parts(unit - centres[_nearest(unit, centres)])
    width = min(CODE_VALUES, len(unit))
    books = np.stack([fit_centres(p, width, seed + 1 + k) for k, p in enumerate(left)])
    coded = vectors.mapInArrow(_coded(centres, books), f"cell int, id {kind}, code binary")
    in_order = coded.repartition("cell", F.pmod(F.xxhash64("id"), F.lit(16))).sortWithinPartitions("cell", "id")  # a hot cell is spread
    lists = settle(in_order.mapInArrow(_packed(LIST_ROWS), f"cell int, ids array<{kind}>, data binary"), "vector-lists", batch_rows=VECTOR_BATCH)
    return VectorIndex(lists, centres, books)


def _probes(cells: np.ndarray, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _unit(_matrix(batch.column(1)))
            order = np.argsort(-(unit @ cells.T), axis=1, kind="stable")[:, :probes].astype(np.int32)
            data = pa.array([u.tobytes() for u in unit], pa.binary())
            for nth in range(order.shape[1]):
                yield pa.RecordBatch.from_arrays([pa.array(order[:, nth]), batch.column(0), data], ["cell", "id", "unit"])

    return run


def _candidates(cells: np.ndarray, books: np.ndarray, keep: int):
    """(cell, ids, data, query_ids, units) -> the ``keep`` best of the list for each query, by codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                cell, ids, queries = row.column("cell")[0].as_py(), row.column("ids").flatten(), row.column("query_ids").flatten()
                codes = np.frombuffer(row.column("data")[0].as_py(), np.uint8).reshape(-1, CODE_PARTS)
                units = np.frombuffer(row.column("units")[0].as_py(), np.float64).reshape(len(queries), -1)
                scores = np.repeat((units @ cells[cell])[:, None], len(codes), axis=1)
                for part, (piece, book) in enumerate(zip(_parts(units), books)):
                    scores += (piece @ book.T)[:, codes[:, part]]
                best = np.argsort(-scores, axis=1, kind="stable")[:, :keep]
                yield pa.RecordBatch.from_arrays(
                    [queries.take(pa.array(np.repeat(np.arange(len(queries)), best.shape[1]))), ids.take(pa.array(best.ravel())),
                     pa.array(np.take_along_axis(scores, best, 1).ravel())], ["query_id", "id", "guess"])

    return run


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        unit, asked = _unit(_matrix(batch.column(2))), _unit(_matrix(batch.column(3)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(np.round((unit * asked).sum(axis=1), SCORE_DIGITS))], ["query_id", "id", "score"])


def search(index: VectorIndex, emb: DataFrame, queries: DataFrame, k: int = 10, probes: int = 16, keep: int | None = None,
           id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """About the k most similar vectors of every query: (query_id, <id>, score, rank), as ``vectors.similar`` gives them exactly.

    A query (query_id, <vec>) visits ``probes`` cells; the ``keep`` best by code (20 times k unless given) are compared exactly.
    More of either finds more. ``emb`` is the indexed table; ties go to the smaller id.
    """
    keep = keep or 20 * k
    asked = queries.select("query_id", F.col(vec_col).cast("array<double>").alias("vec")).filter("vec is not null")
    kind, asked_kind = (df.schema[c].dataType.simpleString() for df, c in ((emb, id_col), (queries, "query_id")))
    probed = asked.mapInArrow(_probes(index.cells, probes), f"cell int, id {asked_kind}, unit binary").repartition("cell").sortWithinPartitions("cell", "id")
    probed = settle(probed.mapInArrow(_packed(QUERY_ROWS), f"cell int, query_ids array<{asked_kind}>, units binary"), "probes", batch_rows=VECTOR_BATCH)
    met = index.lists.join(probed, "cell").select("cell", "ids", "data", "query_ids", "units")
    guesses = met.mapInArrow(_candidates(index.cells, index.books, keep), f"query_id {asked_kind}, id {kind}, guess double")
    by_guess = Window.partitionBy("query_id").orderBy(F.desc("guess"), "id")
    best = settle(guesses.withColumn("rank", F.row_number().over(by_guess)).filter(F.col("rank") <= keep).select("query_id", "id"), "candidates", batch_rows=64)
    vectors = emb.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    pairs = best.join(vectors, "id").join(asked.withColumnRenamed("vec", "asked"), "query_id").select("query_id", "id", "vec", "asked")
    scored = pairs.mapInArrow(_exact, f"query_id {asked_kind}, id {kind}, score double")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = scored.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("id").alias(id_col), "score", "rank")
