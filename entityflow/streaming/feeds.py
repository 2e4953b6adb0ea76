"""Fresh rows, exact TTL dedup, watermark dedup and the seen-set on an arriving feed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from entityflow.functions.times import as_instant, fresh_range
from entityflow.operators.dedup import accepted_times, unseen
from entityflow.schemas import FRESHNESS_HOURS
from entityflow.session import path_exists, settle
from entityflow.streaming import seen as seen_table


def fresh_stream(stream: DataFrame, ts: str = "ts", hours: int | None = FRESHNESS_HOURS, now=None) -> DataFrame:
    """The freshness rule on arriving rows; ``now`` defaults to the micro-batch time."""
    span = hours or FRESHNESS_HOURS
    clock = F.current_timestamp() if now is None else as_instant(now)
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{span} hours")
    return timed.filter(fresh_range(ts, clock, span))


def dedup_stream(stream: DataFrame, key: str, ts: str = "ts", ttl_hours: int = 24) -> DataFrame:
    """Cheap dedup: repeats within at least the window drop.

    Expired keys are evicted lazily, so a later repeat can drop as well;
    ``ttl_dedup_stream`` is the exact rule.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{int(ttl_hours)} hours")
    return timed.dropDuplicatesWithinWatermark([key])


GROUP, KEYLESS = "__group", ""


class TtlProcessor(StatefulProcessor):
    """State of a key: from when on it is open again, and the times that wait for the watermark, in order. One read and one write
    of it per key and micro-batch; a timer at the first waiting time."""

    def __init__(self, ts: str, ttl_us: int):
        self.ts, self.ttl_us = ts, ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("ttl", "open_at bigint, waiting binary")

    def held(self) -> tuple[int, np.ndarray]:
        state = self.state.get()
        return (np.iinfo(np.int64).min, np.empty(0, np.int64)) if state is None else (state[0], np.frombuffer(state[1], np.int64))

    def hold(self, open_at: int, waiting: np.ndarray) -> None:
        self.state.update((open_at, waiting.tobytes()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        yield from ()  # arriving rows only wait
        if key[0] == KEYLESS:
            return
        open_at, waiting = self.held()
        parts = [waiting]
        for chunk in rows:
            times = chunk[self.ts].astype("datetime64[us]").astype("int64").to_numpy()
            # Up to its open time a key is settled: what comes before that repeats an accepted row.
            parts.append(np.unique(times[times >= open_at]))
        together = np.unique(np.concatenate(parts))
        if len(together) == len(waiting):
            return
        self.hold(open_at, together)
        if not len(waiting) or together[0] < waiting[0]:
            self.handle.registerTimer(int(together[0]) // 1_000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """No row can come any more for times up to the watermark: they are decided in order."""
        passed = timerValues.getCurrentWatermarkInMs() * 1_000
        open_at, waiting = self.held()
        due = int(np.searchsorted(waiting, passed, "right"))
        kept = accepted_times(waiting[:due], open_at, self.ttl_us)
        open_at, waiting = kept[-1] + self.ttl_us if kept else open_at, waiting[due:]
        if len(waiting):
            self.handle.registerTimer(int(waiting[0]) // 1_000 + 1)
        elif open_at > passed:  # looks again when the key is open, so that an idle key leaves the store
            self.handle.registerTimer(-(-open_at // 1_000))
        if len(waiting) or open_at > passed:
            if due:
                self.hold(open_at, waiting)
        else:
            self.state.clear()
        if kept:
            yield pd.DataFrame({GROUP: pd.Series([key[0]] * len(kept), dtype=object), self.ts: pd.to_datetime(kept, unit="us")})

    def close(self) -> None:
        pass


def ttl_dedup_stream(stream: DataFrame, key: str, ts: str = "ts", ttl_hours: int = 24, lateness_hours: int = 24) -> DataFrame:
    """Accepted (key, time) pairs, exact: a repeat within the TTL of the last accepted row is a no-op.

    Rows may arrive in any order, up to ``lateness_hours`` behind the newest one; what is older has missed its turn. A time
    waits until the watermark has passed it and is then decided in time order, as ``ttl_dedup`` does, so the result is the
    same however the rows are dealt to micro-batches. The state of a key is the time it is open again and its waiting times,
    8 bytes each; an idle key leaves the store. Only (key, time) travel to the stateful step; repeats at the same instant and
    times before a settled open time aren't kept. Rows without a time drop; a row without a key is never a result but moves
    the watermark, so one of them, later than the last row by more than the lateness, closes a stream that ends. State is held in RocksDB (``session.configure``). Bound a batch with ``maxFilesPerTrigger`` or
    ``maxBytesPerTrigger`` on the source.
    """
    ttl_us = int(ttl_hours) * 3_600 * 1_000_000
    # Keys travel as text, as pandas would turn whole numbers beside a null into floats.
    group = F.when(F.col(key).isNull(), KEYLESS).otherwise(F.concat(F.lit("="), F.col(key).cast("string"))).alias(GROUP)
    pairs = stream.select(group, F.col(ts).cast("timestamp").alias(ts)).filter(F.col(ts).isNotNull())

    def distinct_in_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keyless = batch[GROUP] == KEYLESS
            yield pd.concat([batch[~keyless].drop_duplicates(), batch[keyless].nlargest(1, ts)])

    thinned = pairs.mapInPandas(distinct_in_batch, pairs.schema).withWatermark(ts, f"{int(lateness_hours)} hours")
    accepted = thinned.groupBy(GROUP).transformWithStateInPandas(TtlProcessor(ts, ttl_us), f"{GROUP} string, {ts} timestamp", "Append", "EventTime")
    return accepted.select(F.substring(GROUP, 2, 1 << 30).cast(stream.schema[key].dataType).alias(key), ts)


def unseen_stream(
    stream: DataFrame, sink: str, seen: str, checkpoint: str, key: str = "url_key", use_filter: bool = True, **trigger
) -> StreamingQuery:
    """Start a query that writes rows with an unseen key to ``sink`` and adds the keys to ``seen``.

    Each micro-batch writes its own ``batch`` folder of both tables and looks its keys up in the generations that the batch before
    it left (see ``seen``): a bounded number of them, and of each only the slots whose Bloom filter may hold a key;
    ``use_filter`` off reads all slots of the batch's keys, with the same result. A batch repeated after a failure replaces its own
    output and gives the same result. A missing ``seen`` table means that nothing was seen; a table that can't be read is an
    error, and one without manifests is taken in as one generation.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        generations = seen_table.manifest(spark, seen, batch_id - 1)
        if generations is None:
            generations = []
            if path_exists(spark, seen):
                earlier = settle(spark.read.parquet(seen).filter(F.col("batch") < batch_id).select(key).distinct(), "earlier-keys")
                if not earlier.isEmpty():
                    generations = [seen_table.write_generation(earlier, key, seen, f"_merged/before-{batch_id}", 1)]
        rows = unseen(batch, seen_table.known_keys(batch, key, seen, generations, use_filter), key) if generations else batch
        # One row per key within the batch, the smallest in column order, so a rerun picks the same.
        new = rows.groupBy(key).agg(F.min(F.struct(*[c for c in batch.columns if c != key])).alias("r")).select(key, "r.*")
        new.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
        seen_table.add_batch(spark.read.parquet(f"{sink}/batch={batch_id}"), key, seen, batch_id, generations)

    return (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def run_to_table(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet table until the available input is used up."""
    return (
        stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
