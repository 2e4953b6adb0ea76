"""Exact top-k inner products over integer vectors, pruned by norms and rotated partial sums.

Candidates are sorted by falling length and cut into blocks, queries are cut into blocks, and each pair of blocks is one
row of work. Vectors are rotated onto the principal axes of the candidates, so the first coordinates carry most of an
inner product. By Cauchy-Schwarz the rest adds at most the product of the two residual lengths: a block whose longest
vector can't reach a query's k-th score so far is skipped whole, and inside a block a vector whose partial sum plus
residual bound can't reach it is left out. What remains is scored exactly in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entityflow.llm.common import id_type
from entityflow.session import settle

SCALE = 64.0
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 8192
BROADCAST_BYTES = 128 << 20  # most that the first pass sends to every executor
PIECE = 1024  # candidates that a block scores at once, longest first
LEAD_SHARE = 4  # a partial sum covers this share (one in n) of the axes
SLACK = 1e-6  # relative room for rounding in the bounds, which are in floating point


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: float = SCALE) -> DataFrame:
    """(id, v array<long>, size): floor(scale * x) of usable vectors; those null or with a null or non-finite part are left out."""
    v = F.col("v")
    rows = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(v.isNotNull() & F.coalesce(whole, F.lit(False))).select("id", F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("v"), F.size("v").alias("size"))


def rotation(rows: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes by vector size, from the sums of products of all vectors: per size a table of size^2 numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = np.asarray(batch.column(1))
            for size in np.unique(sizes).tolist():
                m = matrix(batch.column(0).filter(pa.array(sizes == size)), size)
                m /= max(1.0, np.abs(m).max(initial=0))  # only directions count
                sums[size] = sums.get(size, 0) + m.T @ m
        for size, s in sums.items():
            flat = np.ravel(s)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flat), size, np.int32)), pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["size", "at", "x"])

    total = rows.select("v", "size").mapInArrow(run, "size int, at int, x double").groupBy("size", "at").agg(F.sum("x").alias("x"))
    tables: dict[int, np.ndarray] = {0: np.zeros(0)}  # empty vectors have no axes
    for r in total.collect():
        tables.setdefault(r.size, np.zeros(r.size * r.size))[r.at] = r.x
    return {size: np.linalg.svd(np.nan_to_num(t.reshape(size, size)))[0] if size else t.reshape(0, 0) for size, t in tables.items()}


def matrix(lists: pa.Array, size: int) -> np.ndarray:
    return np.asarray(lists.flatten(), np.float64).reshape(len(lists), size)


def whole_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer rows; exact in floating point below 2^53, else in 64-bit integers."""
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1]) < 2.0 ** 53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class Lengths:
    """Rotated vectors with the lengths of their parts after the first axes."""

    def __init__(self, v: np.ndarray, axes: np.ndarray):
        self.v = v
        self.r = v.astype(np.float64) @ axes
        self.lead = max(1, v.shape[1] // LEAD_SHARE) if v.shape[1] else 0
        self.norm = np.sqrt((self.r ** 2).sum(1))
        self.rest = np.sqrt((self.r[:, self.lead:] ** 2).sum(1))


def best(queries: Lengths, query_ids, found: Lengths, ids, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) positions: the k best candidates of each query in this block that can reach ``floor``.

    ``found`` is in order of falling length. The k best so far raise each query's floor. Ties go to the smaller id, so a
    candidate that can only equal the floor stays in.
    """
    kept_q, kept_c, kept_s = (np.zeros(0, np.int64) for _ in range(3))
    floor = floor.astype(np.float64).copy()
    for a in range(0, len(found.v), PIECE):
        part = slice(a, a + PIECE)
        room = SLACK * (1 + queries.norm * found.norm[a])
        live = np.flatnonzero(queries.norm * found.norm[a] + room >= floor)
        if not len(live):
            break
        partial = queries.r[live][:, :queries.lead] @ found.r[part, :found.lead].T
        bound = partial + queries.rest[live, None] * found.rest[None, part]
        q, c = np.nonzero(bound + room[live, None] >= floor[live, None])
        if not len(q):
            continue
        rows, cols = np.unique(q), np.unique(c)
        table = whole_products(queries.v[live[rows]], found.v[part][cols])
        other = query_ids[live[rows], None] != ids[a + cols][None, :]
        if len(cols) > k:
            # The k-th score of this piece alone raises the floor before anything is sorted.
            kth = np.partition(np.where(other, table, np.iinfo(np.int64).min), len(cols) - k, axis=1)[:, len(cols) - k]
            floor[live[rows]] = np.maximum(floor[live[rows]], kth)
        q, c = np.nonzero(other & (table >= floor[live[rows], None]))
        scores, q, c = table[q, c], live[rows[q]], a + cols[c]
        kept_q, kept_c, kept_s = np.append(kept_q, q), np.append(kept_c, c), np.append(kept_s, scores)
        order = np.lexsort((ids[kept_c], -kept_s, kept_q))
        kept_q, kept_c, kept_s = kept_q[order], kept_c[order], kept_s[order]
        heads = np.flatnonzero(np.append(True, kept_q[1:] != kept_q[:-1]))
        nth = np.arange(len(kept_q)) - np.repeat(heads, np.diff(np.append(heads, len(kept_q))))
        top = nth < k
        full = nth == k - 1
        floor[kept_q[full]] = np.maximum(floor[kept_q[full]], kept_s[full])
        kept_q, kept_c, kept_s = kept_q[top], kept_c[top], kept_s[top]
    return kept_q, kept_c, kept_s


def _pack(size_of_block: int, kind: str):
    """Ordered (size, id, v) rows of one partition -> blocks of one size each, numbered by partition and order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, held = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            while held.num_rows:
                sizes = np.asarray(held.column(0))
                n = min(int((sizes == sizes[0]).argmin()) or len(sizes), size_of_block)
                if n == held.num_rows and n < size_of_block:
                    break
                yield block(held.slice(0, n), part, number)
                held, number = held.slice(n), number + 1
        if held is not None and held.num_rows:
            yield block(held, part, number)

    def block(rows, part, number):
        v = np.asarray(rows.column(2).flatten(), np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array([int(rows.column(0)[0].as_py())], pa.int32()), pa.array([(part << 32) + number]),
            pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column(1)), pa.array([v.tobytes()], pa.binary())], ["size", "block", "ids", "data"])

    return run, f"size int, block long, ids array<{kind}>, data binary"


def _search(k: int, axes: dict[int, np.ndarray], with_floor: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {name: batch.column(name)[i] for name in batch.schema.names}
                size = r["size"].as_py()
                take = lambda ids, data: (np.asarray(ids.values), np.frombuffer(data.as_py(), np.int64).reshape(-1, size) if size else np.zeros((len(ids.values), 0), np.int64))  # noqa: B023, E731
                (qi, q), (ci, c) = take(r["query_ids"], r["query_data"]), take(r["ids"], r["data"])
                floor = np.asarray(r["floors"].values, np.float64) if with_floor else np.full(len(qi), -np.inf)
                a, b, s = best(Lengths(q, axes[size]), qi, Lengths(c, axes[size]), ci, k, np.nan_to_num(floor, nan=-np.inf))
                yield pa.RecordBatch.from_arrays([pa.array(qi[a]), pa.array(ci[b]), pa.array(s)], ["query_id", "id", "score"])

    return run


def top_inner_products(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = SCALE,
                       query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` highest integer inner products of each query over all other rows.

    ``is_query`` is a condition on the id column. Ids are whole numbers; rows with a null id take no part. Ties go to the
    smaller id. Vectors meet only vectors of their own size. Rows that repeat an id and its integer vector count once. A query's own id is never
    its answer. Scores beyond 64 bits wrap.

    The first pass searches, for every query, the longest candidates of its size; the k-th score it finds is the query's
    floor in the second pass over all blocks. Each row of the passes is one block of queries and one of candidates, so
    memory grows with neither.
    """
    kind = id_type(vectors, id_col)
    rows = settle(integer_vectors(vectors, id_col, vector_col, scale).where("id is not null").dropDuplicates(["id", "v"]), "vectors")
    axes = rotation(rows)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    pack, schema = _pack(candidate_block, kind)
    sorted_rows = rows.withColumn("norm", -norm).repartitionByRange("size", "norm", "id").sortWithinPartitions("size", "norm", "id").select("size", "id", "v")
    blocks = settle(sorted_rows.mapInArrow(pack, schema), "candidate-blocks")
    pack, schema = _pack(query_block, kind)
    asked = rows.where(is_query(F.col("id")))
    queries = settle(asked.repartitionByRange("size", "id").sortWithinPartitions("size", "id").select("size", "id", "v").mapInArrow(pack, schema)
                     .withColumnRenamed("ids", "query_ids").withColumnRenamed("data", "query_data").withColumnRenamed("block", "query_block"), "query-blocks")
    result = "query_id long, id long, score long"
    heads = blocks.groupBy("size").agg(F.min("block").alias("block"))
    longest = blocks.join(heads, ["size", "block"]).drop("block")
    if sum(8 * size * candidate_block for size in axes) <= BROADCAST_BYTES:  # one block per size
        longest = F.broadcast(longest)
    first = queries.join(longest, "size").select("size", "query_ids", "query_data", "ids", "data").mapInArrow(_search(k, axes, False), result)
    first = settle(first.groupBy("query_id").agg(F.min("score").alias("low"), F.count("*").alias("n")).where(F.col("n") >= k).select("query_id", "low"), "floors")
    # Floors go back into the query blocks in the order of their ids.
    floors = queries.select("query_block", F.posexplode("query_ids").alias("at", "query_id")).join(first, "query_id", "left")
    floors = floors.groupBy("query_block").agg(F.array_sort(F.collect_list(F.struct("at", F.col("low").cast("double").alias("low")))).alias("f"))
    floors = floors.select("query_block", F.transform("f", lambda x: F.coalesce(x["low"], F.lit(float("-inf")))).alias("floors"))
    asked = settle(queries.join(floors, "query_block"), "queries")
    # Pairs of block numbers meet first, then fetch their vectors, so no key gathers them all.
    pairs = asked.select("size", "query_block").join(blocks.select("size", "block"), "size").select("query_block", "block")
    pairs = pairs.join(asked, "query_block").join(blocks.drop("size"), "block").select("size", "query_ids", "query_data", "floors", "ids", "data")
    found = pairs.mapInArrow(_search(k, axes, True), result)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
