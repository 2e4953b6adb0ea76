"""Union of sources and the run reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from entityflow.schemas import ROW_TARGETS


def union_sources(frames: Mapping[str, DataFrame] | Sequence[DataFrame], tag: str = "source_name") -> DataFrame:
    """Bag union; a mapping also tags every row with its source name."""
    if isinstance(frames, Mapping):
        frames = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)


def counts_by_source(df: DataFrame, source: str, rank: str) -> DataFrame:
    """Rows per source with the running total in source order (one row per source is summed)."""
    counts = df.groupBy(source, rank).agg(F.count(F.lit(1)).alias("new_rows"))
    running = Window.orderBy(rank, source).rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("running_total", F.sum("new_rows").over(running))


def run_summary(tables: Mapping[str, DataFrame], mapping_log: DataFrame | None = None) -> DataFrame:
    """Row count per record type, plus one line for the mapping log."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("record_type"), "n_rows") for name, df in tables.items()]
    if mapping_log is not None:
        parts.append(
            mapping_log.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("MAPPING_LOG").alias("record_type"), "n_rows")
        )
    return reduce(DataFrame.unionByName, parts)


def target_check(summary: DataFrame, targets: Mapping[str, int] = ROW_TARGETS) -> DataFrame:
    """Record types that have a row target, with whether it was met."""
    wanted = None
    for name, target in targets.items():
        wanted = F.when(F.col("record_type") == name, target) if wanted is None else wanted.when(F.col("record_type") == name, target)
    return (
        summary.withColumn("target", wanted)
        .filter(F.col("target").isNotNull())
        .withColumn("met", F.col("n_rows") >= F.col("target"))
    )


def source_status(expected: DataFrame, rows: DataFrame, source: str) -> DataFrame:
    """Every expected source with its row count; one that gave nothing shows 0 and 'no rows'."""
    counts = rows.groupBy(source).agg(F.count(F.lit(1)).alias("n_rows"))
    return (
        expected.select(source).distinct().join(counts, source, "left").fillna(0, ["n_rows"])
        .withColumn("status", F.when(F.col("n_rows") > 0, "ok").otherwise("no rows"))
    )


def or_empty(spark: SparkSession, build, schema) -> tuple[DataFrame, str | None]:
    """(rows, error): a source whose reader fails contributes an empty table and its message."""
    try:
        return build(), None
    except Exception as error:  # one failing source must not stop the others
        return spark.createDataFrame([], schema), f"{type(error).__name__}: {error}"
