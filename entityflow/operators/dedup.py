"""First-seen dedup, page windows, target cut-off, seen-set and exact TTL dedup."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from entityflow.schemas import PAGE_CAP, PAGE_SIZE
from entityflow.session import settle

FIRST_SEEN_ORDER = ("source_rank", "page_no", "row_id")
WINDOW_FAN = 32


def first_seen(df: DataFrame, key: str, order: Sequence[str] = FIRST_SEEN_ORDER) -> DataFrame:
    """The first row of every key in the given order.

    The rank filter becomes a partial and a final group limit: each map task
    keeps one row per key before the shuffle, so a key holding a third of all
    rows still sends only one row per task. Sorting by the key's hash first
    spares comparing long texts with equal beginnings, as URLs have.
    """
    by_key = Window.partitionBy(F.xxhash64(key), F.col(key)).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(by_key)).filter("__rn = 1").drop("__rn")


def contiguous_pages(df: DataFrame, source: str = "source_rank", page: str = "page_no", first_page: int = 0) -> DataFrame:
    """(source, page) pairs before the first missing page: paging a source stops at an empty page."""
    pages = df.filter(F.col(page) >= first_page).select(source, page).distinct()
    in_order = Window.partitionBy(source).orderBy(page)
    position = F.row_number().over(in_order) - 1 + F.lit(first_page)
    return pages.withColumn("__pos", position).filter(F.col("__pos") == F.col(page)).select(source, page)


def target_grains(
    df: DataFrame,
    key: str,
    target: int | None = None,
    source: str = "source_rank",
    page: str | None = "page_no",
) -> DataFrame:
    """Grains (pages, or whole sources) read before the unique-row target is met; all grains without a target (None or 0).

    A grain is kept while the count of unique keys first seen in earlier
    grains is below the target, so the last kept grain may overshoot it. Only
    the key and the grain (non-negative integers) are read; the cumulative
    sum runs per source, and across sources on one row each.
    """
    grain = [source] if page is None else [source, page]
    # Source rank and page number in one long: its minimum is a plain hash aggregate.
    packed = F.shiftleft(F.col(source).cast("bigint"), 32) + (F.lit(0) if page is None else F.col(page))
    unpacked = [F.shiftright("__g", 32).cast(df.schema[source].dataType).alias(source)]
    if page is not None:
        unpacked.append(F.col("__g").bitwiseAND(F.lit(0xFFFFFFFF)).cast(df.schema[page].dataType).alias(page))
    earliest = df.groupBy(key).agg(F.min(packed).alias("__g"))
    fresh = earliest.select(*unpacked).groupBy(*grain).agg(F.count(F.lit(1)).alias("new_rows"))
    # A grain whose every key was seen before still counts as read.
    grains = df.select(*grain).distinct().join(fresh, grain, "left").fillna(0, ["new_rows"])

    totals = grains.groupBy(source).agg(F.sum("new_rows").alias("__source_rows"))
    before_source = Window.orderBy(source).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("__before", F.coalesce(F.sum("__source_rows").over(before_source), F.lit(0)))
    grains = grains.join(offsets.select(source, "__before"), source)
    if page is not None:
        before_page = Window.partitionBy(source).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)
        within = F.coalesce(F.sum("new_rows").over(before_page), F.lit(0))
        grains = grains.withColumn("__before", F.col("__before") + within)
    return (
        (grains.filter(F.col("__before") < target) if target else grains)
        .withColumn("running_total", F.col("__before") + F.col("new_rows"))
        .select(*grain, "new_rows", "running_total")
    )


def take_until(
    df: DataFrame,
    key: str,
    target: int | None = None,
    source: str = "source_rank",
    page: str | None = "page_no",
    order: Sequence[str] = FIRST_SEEN_ORDER,
) -> DataFrame:
    """First-seen rows of the grains read until the target is met; of all grains without a target (None or 0).

    The kept grains are a prefix of the reading order, so the input is cut to
    them first and only that prefix is deduplicated.
    """
    if not target:
        return first_seen(df, key, order)
    grain = [source] if page is None else [source, page]
    kept = target_grains(df, key, target, source, page).select(*grain)
    return first_seen(df.join(kept, grain, "left_semi"), key, order)


def page_window(
    df: DataFrame,
    category: str = "category",
    order: Sequence[Column] | None = None,
    page_size: int = PAGE_SIZE,
    cap: int | None = PAGE_CAP,
    salt_by: str = "paper_url",
    salts: int | None = None,
) -> DataFrame:
    """Newest-first pages per category; adds ``page_no`` and ``feed_rank``. Rows beyond ``cap`` are outside the feed; None keeps all.

    There are only a few categories, so ranking straight by category would put a whole category in one task. With a cap,
    rows are ranked within (category, salt) and no more than ``cap`` of each survive; WINDOW_FAN salts then merge into one, until
    one is left, so no task ever ranks more than WINDOW_FAN * cap rows besides its first share. Without one, rows are
    sorted across tasks and each adds the rows of its category in the tasks before it.
    """
    order = order or [F.col("published").desc_nulls_last(), F.col("paper_url")]
    if cap is None:
        ranked = _ranked_across_tasks(df, category, order)
    else:
        salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranked = df.withColumn("__salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)))
        while True:
            local = Window.partitionBy(category, "__salt").orderBy(*order)
            ranked = ranked.withColumn("__rn", F.row_number().over(local)).filter(F.col("__rn") <= cap)
            if salts == 1:
                break
            salts = -(-salts // WINDOW_FAN)
            ranked = ranked.withColumn("__salt", F.pmod("__salt", F.lit(salts))).drop("__rn")
        ranked = ranked.drop("__salt")
    return ranked.withColumn("page_no", F.floor((F.col("__rn") - 1) / page_size).cast("int")).withColumnRenamed(
        "__rn", "feed_rank"
    )


def _ranked_across_tasks(df: DataFrame, category: str, order: Sequence[Column]) -> DataFrame:
    """Adds ``__rn``, the rank within the category. The sorted rows are written once, as their split must not change."""
    placed = settle(df.repartitionByRange(F.col(category), *order).withColumn("__part", F.spark_partition_id()), "ranked-rows")
    sizes = placed.groupBy(category, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(category).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    sizes = sizes.select(F.col(category).alias("__category"), F.col("__part").alias("__in"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    local = Window.partitionBy(category, "__part").orderBy(*order)
    ranked = placed.withColumn("__rn", F.row_number().over(local))
    ranked = ranked.join(sizes, F.col(category).eqNullSafe(F.col("__category")) & (F.col("__part") == F.col("__in")))
    return ranked.withColumn("__rn", (F.col("__rn") + F.col("__before")).cast("int")).drop("__part", "__category", "__in", "__before")


def unseen(new: DataFrame, seen: DataFrame, key: str = "url_key") -> DataFrame:
    """Rows whose key is not in the seen table.

    No hand-made Bloom filter: the anti join is exact, and the optimizer
    broadcasts the seen keys when they are measured to be small.
    """
    return new.join(seen.select(key), key, "left_anti")


# --- exact time-to-live dedup ---------------------------------------------------
#
# What one stretch of a key's timeline accepts depends on the rest through a single number: the time from which on the key is
# open again. So a stretch is a map from the open time at its start to the open time at its end. Each task makes these maps
# for its stretches on its own; they compose along the timeline; then each stretch marks its accepted times on its own.

CHUNK_TIMES = 1 << 15  # times of one stretch


def jump_map(times: np.ndarray, ttl_us: int) -> tuple[np.ndarray, np.ndarray | None]:
    """(upto, opens): a key open from at most upto[i] (and after upto[i-1]) is open from opens[i] on, after the sorted ``times``.

    Only open times that an earlier accepted time can leave count; they are less than a TTL after the first time. A key that
    is open later than all of ``upto`` stays as it is. Without ``opens``, each is its upto plus the TTL.
    """
    n = len(times)
    after = np.searchsorted(times, times + ttl_us)
    jump = np.where(after < n, after, np.arange(n))
    while True:
        further = jump[jump]
        if (further == jump).all():
            break
        jump = further
    reach = min(n, int(np.searchsorted(times, times[0] + ttl_us - 1)) + 1)
    last = jump[:reach]
    ends = np.flatnonzero(np.r_[last[1:] != last[:-1], True])
    if (last[ends] == ends).all():
        return times[ends], None
    return times[ends], times[last[ends]] + ttl_us


def accepted_times(times: np.ndarray, open_at: int, ttl_us: int) -> list[int]:
    """The accepted ones of sorted times of a key that is open from ``open_at`` on."""
    ordered, out = times.tolist(), []
    at = bisect_left(ordered, open_at)
    while at < len(ordered):
        out.append(ordered[at])
        at = bisect_left(ordered, ordered[at] + ttl_us, at)
    return out


def _accepted_of_runs(times: np.ndarray, starts: np.ndarray, ttl_us: int) -> np.ndarray:
    """Which times are accepted; each run from one start to the next is the whole timeline of a key."""
    fresh = np.ones(len(times), bool)
    fresh[1:] = np.diff(times) >= ttl_us
    fresh[starts] = True
    # A time one TTL after the one before it starts an island. Islands shorter than a TTL accept only their first time.
    heads = np.flatnonzero(fresh)
    tails = np.r_[heads[1:], len(times)]
    for a, b in zip(*(x[times[tails - 1] - times[heads] >= ttl_us].tolist() for x in (heads, tails))):
        ordered = times[a:b].tolist()
        at = bisect_left(ordered, ordered[0] + ttl_us)
        while at < len(ordered):
            fresh[a + at] = True
            at = bisect_left(ordered, ordered[at] + ttl_us, at)
    return fresh


def _chunks(ttl_us: int, chunk_times: int, key_type: pa.DataType):
    """Sorted (key, us) rows of a task -> its keys' accepted times, or stretches with jump maps for keys that may go on elsewhere."""
    lists = pa.list_(pa.int64())
    schema = pa.schema([("key", key_type), ("first", pa.int64()), ("open", pa.bool_()), ("times", lists), ("upto", lists), ("opens", lists)])

    def stretch(key: pa.Scalar, times: np.ndarray) -> pa.RecordBatch:
        upto, opens = jump_map(times, ttl_us)
        columns = [pa.array([key.as_py()], key_type), pa.array([int(times[0])]), pa.array([True]), pa.array([times], lists), pa.array([upto], lists), pa.array([opens], lists)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def whole(keys: pa.Array, times: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        fresh = _accepted_of_runs(times, starts, ttl_us)
        ends = np.r_[0, np.cumsum(np.add.reduceat(fresh, starts))].astype(np.int32)
        found = pa.ListArray.from_arrays(pa.array(ends), pa.array(times[fresh]))
        none = pa.nulls(len(starts), lists)
        return pa.RecordBatch.from_arrays([keys.take(pa.array(starts)), pa.array(times[starts]), pa.array(np.zeros(len(starts), bool)), found, none, none], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, apart = None, [], True  # the run that the last batch ended with; apart: it is one of the task's first or was cut

        def cut(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal held
            times = np.concatenate(held) if held else np.zeros(0, np.int64)
            while len(times) >= least:
                yield stretch(key, times[:chunk_times])
                times = times[chunk_times:]
            held = [times] if len(times) else []

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, times = batch.column(0).cast(key_type), np.asarray(batch.column(1))
            starts = np.r_[0, np.flatnonzero(np.asarray(pc.not_equal(keys[1:], keys[:-1]))) + 1]
            goes_on = key is not None and keys[0] == key
            if key is not None and not goes_on:
                if apart:
                    yield from cut(1)
                else:
                    yield whole(pa.array([key.as_py()], key_type), np.concatenate(held), np.zeros(1, np.int64))
                held = []
            if goes_on or key is None:  # the first run of this batch is not a whole timeline
                end = int(starts[1]) if len(starts) > 1 else len(times)
                held.append(times[:end])
                key, apart = keys[0], apart or not goes_on
                if len(starts) == 1:
                    if sum(map(len, held)) >= 2 * chunk_times:
                        apart = True
                        yield from cut(chunk_times)
                    continue
                if apart:
                    yield from cut(1)
                else:
                    yield whole(pa.array([key.as_py()], key_type), np.concatenate(held), np.zeros(1, np.int64))
                held, starts = [], starts[1:]
            if len(starts) > 1:
                a, b = int(starts[0]), int(starts[-1])
                yield whole(keys[a:b], times[a:b], starts[:-1] - a)
            key, held, apart = keys[int(starts[-1])], [times[int(starts[-1]):]], False
        if key is not None:  # the last run may go on in the next task
            yield from cut(1)

    return run


def _open_times(key_type: pa.DataType):
    """Stretches of keys in order -> the open time at the start of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, open_at = None, 0
        for batch in batches:
            found = []
            for key, upto, opens, ttl_us in zip(*(batch.column(c) for c in ("key", "upto", "opens", "ttl_us"))):
                if last is None or key != last:
                    last, open_at = key, np.iinfo(np.int64).min
                found.append(int(open_at))
                upto_values = upto.values.to_numpy(zero_copy_only=False)
                at = int(np.searchsorted(upto_values, open_at))
                if at < len(upto_values):
                    open_at = upto_values[at] + ttl_us.as_py() if not opens.is_valid else opens.values[at].as_py()
            yield pa.RecordBatch.from_arrays([batch.column("key").cast(key_type), batch.column("first"), pa.array(found, pa.int64())], ["key", "first", "open_at"])

    return run


def _marked(ttl_us: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [accepted_times(t.values.to_numpy(zero_copy_only=False), e.as_py(), ttl_us) for t, e in zip(batch.column("times"), batch.column("open_at"))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.list_(pa.int64()))], ["key", "times"])

    return run


def ttl_dedup(df: DataFrame, key: str, ts: str, ttl_hours: int = 24, chunk_times: int = CHUNK_TIMES) -> DataFrame:
    """Accepted (key, time) pairs: a repeat within the TTL of the last accepted row is a no-op.

    A repeat does not extend the TTL; a row exactly one TTL later is accepted. Rows without a key or time drop. Times are first
    reduced to distinct (key, time) pairs and put in order across tasks, so a hot key is spread over many. A task decides the
    keys that lie wholly inside it. Of a key that may go on in another task, it makes stretches of at most ``chunk_times`` times
    with their jump maps. Only the maps, a row per stretch, are then read in order, one at a time; where a TTL holds
    few times they are far smaller than the times. The number of jobs is constant.
    """
    ttl_us = int(ttl_hours) * 3_600 * 1_000_000
    stamped = df.select(F.col(key).alias("key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("us")).filter("key is not null and us is not null")
    times = settle(stamped.distinct(), "ttl-times")
    kind = times.schema["key"].dataType
    arrow_kind, name = to_arrow_type(kind), kind.simpleString()
    in_order = times.repartitionByRange("key", "us").sortWithinPartitions("key", "us")
    columns = f"key {name}, first long, open boolean, times array<long>, upto array<long>, opens array<long>"
    chunks = settle(in_order.mapInArrow(_chunks(ttl_us, chunk_times, arrow_kind), columns), "ttl-chunks", batch_rows=CHUNK_TIMES)
    stretches = chunks.filter("open")
    maps = stretches.select("key", "first", "upto", "opens", F.lit(ttl_us).alias("ttl_us")).repartition("key").sortWithinPartitions("key", "first")
    opened = settle(maps.mapInArrow(_open_times(arrow_kind), f"key {name}, first long, open_at long"), "ttl-open-times", batch_rows=64)
    marked = stretches.select("key", "first", "times").join(opened, ["key", "first"]).mapInArrow(_marked(ttl_us), f"key {name}, times array<long>")
    accepted = chunks.filter("not open").select("key", "times").unionByName(marked)
    return accepted.select(F.col("key").alias(key), F.explode("times").alias("us")).select(key, F.timestamp_micros("us").alias(ts))
