"""Cosine similarity: top-k search and exact near-duplicate detection."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from entityflow.session import settle

SCORE_DIGITS = 6
QUERY_BLOCK = 1_000
BLOCK_ROWS = 2_000
MAX_PIVOTS = 1_024
EARLY_BLOCKS = 4
GRID = 8  # groups of a side that meet those of the other
GROUP_ROWS = 100_000


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def similar(emb: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The k most similar vectors of every query, exactly: (query_id, <id>, score, rank).

    Any number of queries (query_id, <vec>). They are packed in blocks of QUERY_BLOCK, a row each, which meet the packed vectors
    in one scan: while the blocks are small, Spark brings them to the vectors, else both are shuffled by block. A block of vectors
    is multiplied with a block of queries and sends on its k best of each. Nothing passes through the driver. Ties go to the
    smaller (integer) id; null vectors take no part. ``vector_index.search`` looks at a part of the vectors only.
    """
    kind, asked_kind = emb.schema[id_col].dataType.simpleString(), queries.schema["query_id"].dataType.simpleString()

    def packed(df: DataFrame, key: str, key_type: str, rows: int, label: str) -> DataFrame:
        vectors = df.select(F.col(key), F.col(vec_col).cast("array<double>").alias("vec")).filter("vec is not null")
        return settle(vectors.mapInArrow(_pack, f"ids array<{key_type}>, units binary"), label, batch_rows=rows)

    blocks = packed(queries, "query_id", asked_kind, QUERY_BLOCK, "query-blocks")
    blocks = settle(blocks.select(F.col("ids").alias("query_ids"), F.col("units").alias("query_units"), F.monotonically_increasing_id().alias("block")), "numbered-queries")
    # Every block number goes with every packed row of vectors; the rows themselves are joined by that number.
    numbers = blocks.agg(F.collect_list("block")).scalar()
    met = packed(emb, id_col, kind, VECTOR_BATCH, "vector-blocks").withColumn("numbers", numbers)
    met = met.withColumn("block", F.explode("numbers")).drop("numbers").join(blocks, "block")
    best = met.select("query_ids", "query_units", "ids", "units").mapInArrow(_best_of_blocks(k), f"query_id {asked_kind}, {id_col} {kind}, score double")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col(id_col))
    return best.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per batch: the ids and the unit vectors."""
    for batch in batches:
        if batch.num_rows:
            ids = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0))
            yield pa.RecordBatch.from_arrays([ids, pa.array([_unit(_matrix(batch.column(1))).tobytes()], pa.binary())], ["ids", "units"])


def _best_of_blocks(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1)
                asked, ids = row.column(0).flatten(), np.asarray(row.column(2).flatten())
                q, v = (np.frombuffer(row.column(c)[0].as_py(), np.float64).reshape(size, -1) for c, size in ((1, len(asked)), (3, len(ids))))
                order = np.argsort(ids, kind="stable")
                scores = np.round(q @ v[order].T, SCORE_DIGITS)
                best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                yield pa.RecordBatch.from_arrays(
                    [asked.take(pa.array(np.repeat(np.arange(len(asked)), best.shape[1]))), pa.array(ids[order][best].ravel()),
                     pa.array(np.take_along_axis(scores, best, 1).ravel())], ["query_id", "id", "score"])

    return run


# --- near duplicates ------------------------------------------------------------------
#
# cos(u, v) >= t means the unit vectors are at most r = sqrt(2 - 2t) apart. Every
# vector has a home cell, that of its nearest pivot. A vector within r of some
# member of cell c lies at most r beyond the plane halfway between c's pivot and
# its own pivot, so only vectors that do are compared with the cell. Vectors travel as packed
# blocks, and each block goes to a fixed number of tasks, not to every cell it is compared with.


def _home_cells(pivots: np.ndarray, id_type: str):
    """Packed rows of one cell each, by id: (cell, ids, units)."""
    lengths = (pivots**2).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit(_matrix(batch.column(1)))
            home = (lengths[None, :] - 2 * unit @ pivots.T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(home.astype(np.int32)), batch.column(0), pa.array([u.tobytes() for u in unit], pa.binary())], ["cell", "id", "unit"])

    return run, f"cell int, id {id_type}, unit binary"


def _packed_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, id, unit), sorted so, -> one row per cell and batch: (cell, ids, units)."""
    for batch in batches:
        cells = np.asarray(batch.column(0))
        ends = [*(np.flatnonzero(np.diff(cells)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
        for start, end in zip([0, *ends], ends):
            part = batch.slice(start, end - start)
            ids = pa.ListArray.from_arrays(pa.array([0, end - start], pa.int32()), part.column(1))
            yield pa.RecordBatch.from_arrays([part.column(0).slice(0, 1), ids, pa.array([b"".join(part.column(2).to_pylist())], pa.binary())], ["cell", "ids", "units"])


def _blocks_of(table: pa.Table) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(cell, ids, unit vectors) of packed rows, by their first id."""
    cells, ids, units = (table.column(c).combine_chunks() for c in ("cell", "ids", "units"))
    found = []
    for k in range(table.num_rows):
        numbers = np.asarray(ids[k].values)
        found.append((cells[k].as_py(), numbers, np.frombuffer(units[k].as_py(), np.float64).reshape(len(numbers), -1)))
    return sorted(found, key=lambda block: block[1][0])


def _earliest_near(pivots: np.ndarray, min_cos: float, id_type: str):
    """For two groups of packed rows: every right vector that has an earlier near left one, with the earliest such id."""
    reach = float(np.sqrt(max(0.0, 2 - 2 * min_cos)))
    lengths = (pivots**2).sum(axis=1)
    gaps = np.sqrt(np.maximum(0.0, lengths[:, None] + lengths[None, :] - 2 * pivots @ pivots.T))
    schema = pa.schema([("id", id_type), ("dup_of", id_type)])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        blocks, found = _blocks_of(left), []
        cells = np.unique([cell for cell, _, _ in blocks]).astype(int)
        place = {cell: n for n, cell in enumerate(cells.tolist())}
        for home, ids, units in _blocks_of(right) if blocks else []:
            # Distance beyond the halfway plane to each cell's pivot; pivots are distinct, so gaps off home are positive.
            beyond = lengths[cells] - lengths[home] - 2 * (units @ pivots[cells].T - (units @ pivots[home])[:, None])
            with np.errstate(divide="ignore", invalid="ignore"):
                sent = beyond / (2 * gaps[home, cells]) <= reach + 1e-9
            if home in place:
                sent[:, place[home]] = True
            earliest, matched = ids.copy(), np.zeros(len(ids), bool)
            for cell, others, vectors in blocks:
                # Until a vector has a match, all ids below its own matter, then those below the match. Ids of a block ascend.
                if others[0] >= earliest.max():
                    break
                asked = np.flatnonzero(sent[:, place[cell]] & (earliest > others[0]))
                if not len(asked):
                    continue
                n = int(np.searchsorted(others, earliest[asked].max()))
                near = units[asked] @ vectors[:n].T >= min_cos
                near &= others[None, :n] < earliest[asked][:, None]
                hit = near.any(axis=1)
                earliest[asked[hit]], matched[asked[hit]] = others[near[hit].argmax(axis=1)], True
            found.append((ids[matched], earliest[matched]))
        columns = [np.concatenate([f[c] for f in found]) if found else [] for c in (0, 1)]
        return pa.table([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    return run


def _meet(left: DataFrame, right: DataFrame, compare, id_type: str, left_groups: int, right_groups: int) -> DataFrame:
    """(id, dup_of): every group of left packed rows meets every group of right ones, a task's work each."""

    def dealt(df: DataFrame, mine: str, groups: int, other: str, others: int) -> DataFrame:
        group = F.pmod(F.xxhash64("cell", F.col("ids")[0], F.size("ids")), F.lit(groups)).cast("int")
        return df.withColumn(mine, group).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    sides = [dealt(left, "lg", left_groups, "rg", right_groups), dealt(right, "rg", right_groups, "lg", left_groups)]
    keyed = [s.select("lg", "rg", "cell", "ids", "units").groupBy("lg", "rg") for s in sides]
    met = keyed[0].cogroup(keyed[1]).applyInArrow(compare, f"id {id_type}, dup_of {id_type}")
    return met.groupBy("id").agg(F.min("dup_of").alias("dup_of"))


def near_duplicates(
    emb: DataFrame,
    min_cos: float,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    pivots: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(id, dup_of): vectors with an earlier near-duplicate, and the earliest such id.

    Exact, and in the worst case quadratic in time: at low thresholds nearly every cell meets every vector. For large tables,
    ``near_duplicates_banded`` compares only vectors that share a key. Every vector with a lower-id vector at cosine >=
    ``min_cos`` is listed. The result has one row per vector instead of one per pair, so a
    story copied n times gives n - 1 rows. Equal vectors are collapsed before
    any comparison. All vectors are first compared with the earliest EARLY_BLOCKS blocks: a match there is final, so a
    crowd of near-copies is settled in one linear pass. Only rows without such a match meet the others, and in a task
    a row with a match meets only ids below it.

    Vectors are packed in blocks of up to ``block_rows``. Groups of blocks meet in a grid, about GRID by GRID of them or as many
    as keep a group at GROUP_ROWS rows; a block travels once per group of the other side. So up to GRID * GROUP_ROWS vectors what
    is shuffled grows as the input, and a task never holds more than two groups.
    """
    id_type = emb.schema[id_col].dataType
    kind = id_type.simpleString()
    copies = emb.select(id_col, vec_col)
    # One row per distinct vector, written once: it is read for the pivots, the cells and the result.
    distinct = settle(
        copies.groupBy(vec_col).agg(F.min(id_col).alias(id_col), F.count(F.lit(1)).alias("n_copies")), "distinct-vectors"
    )
    n = distinct.count()
    if n == 0:
        return copies.select(id_col, F.col(id_col).alias("dup_of")).limit(0)
    wanted = pivots or int(min(MAX_PIVOTS, max(1, n // block_rows)))
    picked = distinct.orderBy(F.xxhash64(vec_col), id_col).limit(wanted).collect()
    pivot_matrix = np.unique(_unit(np.array([r[vec_col] for r in picked], dtype=np.float64)), axis=0)

    # A row without an id is neither earlier nor later than any other.
    numbered = distinct.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).filter("id is not null")
    assign, placed_schema = _home_cells(pivot_matrix, kind)
    placed = settle(numbered.mapInArrow(assign, placed_schema), "vector-cells", batch_rows=VECTOR_BATCH)
    compare = _earliest_near(pivot_matrix, min_cos, to_arrow_type(id_type))

    def packed(df: DataFrame, label: str) -> DataFrame:
        by_cell = df.select("cell", "id", "unit").repartitionByRange("cell", "id").sortWithinPartitions("cell", "id")
        return settle(by_cell.mapInArrow(_packed_cells, f"cell int, ids array<{kind}>, units binary"), label, batch_rows=block_rows)

    def groups(rows: int, most: int) -> int:
        """No more than ``most`` while that keeps a group at GROUP_ROWS, nor more than there are blocks."""
        return max(1, min(most, -(-rows // block_rows)), -(-rows // GROUP_ROWS))

    everything = packed(placed, "vector-blocks")
    early = settle(placed.orderBy("id").limit(EARLY_BLOCKS * block_rows), "early-vectors")
    # One group of early blocks: each block of all vectors travels once.
    first_pass = settle(_meet(packed(early, "early-blocks"), everything, compare, kind, 1, groups(n, GRID * GRID)), "early-matches")
    parts = [first_pass]
    if n > EARLY_BLOCKS * block_rows:
        late = placed.filter(F.col("id") >= early.agg(F.max("id")).scalar())
        rest = settle(late.join(first_pass.select("id"), "id", "left_anti"), "open-vectors")
        right = groups(rest.count(), GRID)
        parts.append(_meet(packed(late, "late-blocks"), packed(rest, "open-blocks"), compare, kind, groups(n, GRID * GRID // min(right, GRID)), right))
    found = settle(reduce(DataFrame.unionByName, parts).groupBy(F.col("id").alias(id_col)).agg(F.min("dup_of").alias("dup_of")), "vector-matches")
    # Further copies of a vector follow its first one, or what that one follows.
    repeated = distinct.filter("n_copies > 1").select(vec_col, F.col(id_col).alias("__first"))
    followers = (
        copies.join(repeated, vec_col).filter(F.col(id_col) != F.col("__first")).select(id_col, "__first")
        .join(found.select(F.col(id_col).alias("__first"), "dup_of"), "__first", "left")
        .select(id_col, F.coalesce("dup_of", "__first").alias("dup_of"))
    )
    return found.unionByName(followers)


# --- near duplicates by banded keys ----------------------------------------------------
#
# A band's key is the sides of some random planes that a vector lies on. A key that too many vectors share is cut
# again by planes through the middle of those vectors, in several independent ways, until every key is small enough to
# compare all its vectors. So however crowded a region is, the work stays linear in the rows and no pair of a key is left out.

BUCKET_ROWS = 1_024
CUT_BITS = 16  # planes that one cut may use, at most
CUT_ROUNDS = 6
VECTOR_BATCH = 4_096


def _compare_blocks(
    left: DataFrame, right: DataFrame, min_cos: float, block_rows: int, id_col: str, vec_col: str, id_type: T.DataType
) -> DataFrame:
    """(cell, id, dup_of): for every right row the lowest-id left row of its cell that is near and earlier.

    Both sides of a cell are cut into blocks of about ``block_rows`` and each
    pair of blocks is one group, so a group holds two blocks however large
    its cell is. Inside a group the rows are compared by one matrix product.
    """

    def sizes(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias(name))

    # One small row per cell.
    counts = settle(sizes(left, "left_blocks").join(sizes(right, "right_blocks"), "cell"), "cell-blocks")

    def block(count: str) -> Column:
        return F.pmod(F.xxhash64(id_col), F.col(count)).cast("int")

    def copies(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    sides = [
        left.join(counts, "cell").withColumn("lb", block("left_blocks")).withColumn("rb", copies("right_blocks")).withColumn("side", F.lit(0)),
        right.join(counts, "cell").withColumn("rb", block("right_blocks")).withColumn("lb", copies("left_blocks")).withColumn("side", F.lit(1)),
    ]
    both = reduce(DataFrame.unionByName, [s.select("cell", "lb", "rb", "side", id_col, vec_col) for s in sides])

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        a = group[group["side"] == 0].sort_values(id_col)
        b = group[group["side"] == 1]
        if a.empty or b.empty:
            return pd.DataFrame({"cell": [], id_col: [], "dup_of": []})
        ids_a, ids_b = a[id_col].to_numpy(), b[id_col].to_numpy()
        near = (_stack(b[vec_col]) @ _stack(a[vec_col]).T >= min_cos) & (ids_a[None, :] < ids_b[:, None])
        hit = near.any(axis=1)
        return pd.DataFrame({"cell": group["cell"].iloc[0], id_col: ids_b[hit], "dup_of": ids_a[near.argmax(axis=1)[hit]]})

    schema = T.StructType([
        left.schema["cell"], T.StructField(id_col, id_type), T.StructField("dup_of", id_type)
    ])
    found = both.groupBy("cell", "lb", "rb").applyInPandas(compare, schema)
    return found.groupBy("cell", id_col).agg(F.min("dup_of").alias("dup_of"))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1]).cast(pa.list_(pa.float64()))


def _mixed(key: np.ndarray, more: np.ndarray) -> np.ndarray:
    """A 64-bit key of two numbers."""
    with np.errstate(over="ignore"):
        z = (key.astype(np.uint64) + more.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        return ((z ^ (z >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)).view(np.int64)


def _band_keys(bands: int, bits: int, seed: int, dims: int):
    planes = np.random.default_rng(seed).normal(size=(dims, bands * bits))
    powers = 1 << np.arange(bits, dtype=np.int64)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _unit(_matrix(batch.column(1)))
            key = ((unit @ planes > 0).reshape(len(unit), bands, bits) * powers).sum(axis=2)
            for band in range(bands):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(unit), band, np.int32)), pa.array(key[:, band]), batch.column(0), _lists(unit)], ["band", "key", "id", "vec"])

    return keys


def _cut_keys(splits: int, seed: int, dims: int):
    """(band, key, id, vec, middle, planes) -> each row under ``splits`` new keys, by that many planes through the middle of its key."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            band, key, planes = (np.asarray(batch.column(c)) for c in ("band", "key", "planes"))
            away = _matrix(batch.column("vec")) - _matrix(batch.column("middle"))
            used = np.arange(CUT_BITS) < planes[:, None]
            for way in range(splits):
                code = np.zeros(len(key), np.int64)
                for b in np.unique(band).tolist():
                    mine = band == b
                    sides = away[mine] @ np.random.default_rng((seed, way, b)).normal(size=(dims, CUT_BITS)) > 0
                    code[mine] = ((sides & used[mine]) << np.arange(CUT_BITS)).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("band"), pa.array(_mixed(key, code * splits + way + 1)), batch.column("id"), batch.column("vec")], ["band", "key", "id", "vec"])

    return cut


def _near_in_bucket(min_cos: float):
    """Rows sorted by key and id -> the earliest near row of the key for each row that has one."""

    def matches(ids: np.ndarray, unit: np.ndarray) -> Iterator[pa.RecordBatch]:
        near = np.tril(unit @ unit.T >= min_cos, -1)
        hit = near.any(axis=1)
        if hit.any():
            yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(ids[near.argmax(axis=1)[hit]])], ["id", "dup_of"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # band, key, id and vectors of the last key so far
        for batch in batches:
            rows = [*(np.asarray(batch.column(c)) for c in range(3)), _matrix(batch.column(3))]
            if held is not None:
                rows = [np.concatenate([a, b]) for a, b in zip(held, rows)]
            starts = np.flatnonzero(np.r_[True, (np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)])
            for a, b in zip(starts.tolist(), starts[1:].tolist()):
                if b - a > 1:
                    yield from matches(rows[2][a:b], rows[3][a:b])
            held = [r[starts[-1]:] for r in rows]
        if held is not None and len(held[0]) > 1:
            yield from matches(held[2], held[3])

    return run


def near_duplicates_banded(
    emb: DataFrame,
    min_cos: float,
    bands: int = 24,
    bits: int = 12,
    seed: int = 1,
    bucket_rows: int = BUCKET_ROWS,
    splits: int = 3,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """(id, dup_of): vectors that share a key with an earlier vector at cosine >= ``min_cos``.

    A band's key is the sides of ``bits`` random planes that a vector lies on; two vectors at angle a share it with
    probability (1 - a / pi) ^ bits, so with the defaults vectors at cosine 0.98 meet in some band with probability 0.999
    and vectors at right angles in 0.6 %. A key of more than ``bucket_rows`` vectors is cut in ``splits`` independent ways by
    planes through its middle, as many as its size needs, again and again. A pair of a crowded key parts in all ways of a cut
    only if it is not much closer than the others of the key; and crowded vectors share most bands, each cut by its
    own planes. All vectors of a key are compared exactly, so every row listed is right; ``dup_of`` is the earliest match found.
    What CUT_ROUNDS can't cut is compared block by block, spread over tasks. Vectors of one direction are collapsed first;
    null vectors take no part. Ids are integers.
    """
    id_type = emb.schema[id_col].dataType
    length = F.sqrt(F.aggregate(vec_col, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    direction = F.transform(vec_col, lambda x: F.when(F.col("__length") > 0, F.round(x.cast("double") / F.col("__length"), 10)).otherwise(F.lit(0.0)) + F.lit(0.0))
    copies = emb.filter(F.col(vec_col).isNotNull()).withColumn("__length", length).select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"), direction.alias("way"))
    distinct = settle(copies.groupBy("way").agg(F.min(F.struct("id", "vec")).alias("r"), F.count(F.lit(1)).alias("n_copies")).select("way", "r.*", "n_copies"), "distinct-vectors")
    some = distinct.select(F.size("vec")).first()
    if some is None:
        return emb.select(id_col, F.col(id_col).alias("dup_of")).limit(0)
    dims, kind = some[0], id_type.simpleString()
    columns = f"band int, key long, id {kind}, vec array<double>"
    found_columns = f"id {kind}, dup_of {kind}"
    rows = settle(distinct.select("id", "vec").mapInArrow(_band_keys(bands, bits, seed, dims), columns), "band-keys", batch_rows=VECTOR_BATCH)
    found = []
    for number in range(CUT_ROUNDS + 1):
        sizes = settle(rows.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "key-sizes")
        small = rows.join(sizes.filter(F.col("n") <= bucket_rows).select("band", "key"), ["band", "key"], "left_semi")
        small = small.repartition("band", "key").sortWithinPartitions("band", "key", "id")
        found.append(settle(small.mapInArrow(_near_in_bucket(min_cos), found_columns), "key-matches", batch_rows=VECTOR_BATCH))
        crowded = sizes.filter(F.col("n") > bucket_rows)
        if crowded.isEmpty():
            break
        rows = rows.join(crowded, ["band", "key"])
        if number == CUT_ROUNDS:
            cells = rows.select(F.xxhash64("band", "key").alias("cell"), "id", "vec")
            found.append(settle(_compare_blocks(cells, cells, min_cos, bucket_rows, "id", "vec", id_type).select("id", "dup_of"), "key-matches"))
            break
        # The middle of a key's vectors, and as many planes as leave half a bucket on average.
        middle = rows.groupBy("band", "key").agg(F.array(*[F.avg(F.get("vec", F.lit(k))) for k in range(dims)]).alias("middle"),
                                                 F.least(F.lit(CUT_BITS), F.ceil(F.log2(F.first("n") / bucket_rows)) + 1).cast("int").alias("planes"))
        placed = rows.drop("n").join(settle(middle, "key-middles"), ["band", "key"])
        rows = settle(placed.mapInArrow(_cut_keys(splits, seed + 1 + number, dims), columns), "cut-keys", batch_rows=VECTOR_BATCH)
    found = settle(reduce(DataFrame.unionByName, found).groupBy("id").agg(F.min("dup_of").alias("dup_of")), "vector-matches")
    # Further vectors of a direction follow its first one, or what that one follows.
    repeated = distinct.filter("n_copies > 1").select("way", F.col("id").alias("__first"))
    followers = (
        copies.join(repeated, "way").filter(F.col("id") != F.col("__first")).select("id", "__first")
        .join(found.select(F.col("id").alias("__first"), "dup_of"), "__first", "left")
        .select("id", F.coalesce("dup_of", "__first").alias("dup_of"))
    )
    return found.unionByName(followers).select(F.col("id").alias(id_col), "dup_of")
