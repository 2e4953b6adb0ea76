"""The table of seen keys of a stream: generations merged by size, each with a blocked Bloom filter.

Every micro-batch adds one generation of keys. Once GENERATIONS of one level are there, they become one of the next level, so
a batch has few of them to look at, however long the stream runs. A generation's filter tells which of its slots may hold a
key of the batch; only those are read exactly, so the filter never changes a result. What belongs to the table after a batch
stands in that batch's manifest, written last: a batch that is repeated starts from the one before it and replaces its own folders.
"""

from __future__ import annotations

import math
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from entityflow.session import path_exists, settle

SLOT = "slot"
SEEN_SLOTS = 64
GENERATIONS = 4
BITS_PER_KEY, BLOCK_BITS, PROBES = 16, 512, 4
MANIFEST = "name string, level int, blocks long"


def slot_of(key: str):
    return F.pmod(F.xxhash64(key), F.lit(SEEN_SLOTS)).cast("int")


def _placed(keys: DataFrame, key: str, blocks) -> DataFrame:
    """Keys with their slot, block of the filter and bits there."""
    spread = F.xxhash64(F.lit(11), F.col(key))
    probes = F.array(*[F.shiftrightunsigned(spread, 9 * k).bitwiseAND(BLOCK_BITS - 1).cast("int") for k in range(PROBES)])
    return keys.select(key, slot_of(key).alias(SLOT), F.pmod(F.xxhash64(F.lit(13), F.col(key)), blocks).alias("block"), probes.alias("probes"))


def write_generation(keys: DataFrame, key: str, seen: str, name: str, level: int) -> tuple[str, int, int]:
    """Write distinct keys, a written table, below ``seen/name``, in folders by slot, and their filter; returns the manifest row."""
    keys.select(key, slot_of(key).alias(SLOT)).repartition(SLOT).sortWithinPartitions(SLOT, key).write.mode("overwrite").partitionBy(SLOT).parquet(f"{seen}/{name}")
    blocks = 1 << max(0, math.ceil(math.log2(max(1, keys.count()) * BITS_PER_KEY / BLOCK_BITS)))
    bits = _placed(keys, key, F.lit(blocks)).select("block", F.explode("probes").alias("bit"))
    word = F.shiftright("bit", 6)
    words = [F.coalesce(F.bit_or(F.when(word == w, F.expr("shiftleft(1L, bit & 63)"))), F.lit(0).cast("long")) for w in range(BLOCK_BITS // 64)]
    bits.groupBy("block").agg(F.array(*words).alias("words")).write.mode("overwrite").parquet(f"{seen}/_filters/{name.strip('_')}")
    return name, level, blocks


def manifest(spark: SparkSession, seen: str, batch_id: int) -> list[tuple[str, int, int]] | None:
    """The generations after a batch; None if it has no manifest."""
    place = f"{seen}/_manifests/after-{batch_id}"
    if not path_exists(spark, place):
        return None
    rows = spark.read.schema(MANIFEST).parquet(place).collect()  # a few per level
    return sorted((tuple(r) for r in rows), key=lambda r: (-r[1], r[0]))


def known_keys(keys: DataFrame, key: str, seen: str, generations: list[tuple[str, int, int]], use_filter: bool = True) -> DataFrame:
    """Those of the seen keys among which all seen ones of ``keys`` are."""
    spark, found = keys.sparkSession, []
    schema = StructType([keys.schema[key], StructField(SLOT, IntegerType())])
    asked = settle(keys.select(key).distinct(), "asked-keys")
    for name, _, blocks in generations:
        placed = _placed(asked, key, F.lit(blocks))
        if use_filter:
            held = F.expr("forall(probes, p -> shiftrightunsigned(words[p >> 6], p & 63) & 1L = 1L)")
            placed = placed.join(spark.read.schema("block long, words array<long>").parquet(f"{seen}/_filters/{name.strip('_')}"), "block").where(held)
        slots = [r[0] for r in placed.select(SLOT).distinct().collect()]  # at most SEEN_SLOTS numbers
        if slots:
            generation = spark.read.schema(schema).parquet(f"{seen}/{name}")
            found.append(generation.where(F.col(SLOT).isin(slots)).select(key))
    return reduce(DataFrame.unionByName, found) if found else asked.limit(0)


def add_batch(keys: DataFrame, key: str, seen: str, batch_id: int, generations: list[tuple[str, int, int]]) -> None:
    """Add a batch's new keys as a generation, merge what is due and write the manifest."""
    spark = keys.sparkSession
    now = [*generations, write_generation(keys, key, seen, f"batch={batch_id}", 0)]
    level = 0
    while sum(g[1] == level for g in now) >= GENERATIONS:
        due = [g for g in now if g[1] == level]
        parts = [spark.read.schema(keys.select(key).schema).parquet(f"{seen}/{name}") for name, _, _ in due]
        merged = write_generation(settle(reduce(DataFrame.unionByName, parts).distinct(), "merged-keys"), key, seen, f"_merged/level{level + 1}-{batch_id}", level + 1)
        now = [g for g in now if g[1] != level] + [merged]
        level += 1
    names, levels, blocks = zip(*now)
    rows = pa.table({"name": pa.array(names, pa.string()), "level": pa.array(levels, pa.int32()), "blocks": pa.array(blocks, pa.int64())})
    spark.createDataFrame(rows).coalesce(1).write.mode("overwrite").parquet(f"{seen}/_manifests/after-{batch_id}")
