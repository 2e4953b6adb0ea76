"""A left lookup that keeps rows without a key off the hot path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NULL_SPREAD = 4096


def left_lookup(left: DataFrame, right: DataFrame, key: str, spread_by: str) -> DataFrame:
    """``left`` left-joined to ``right`` (unique text ``key``), null keys spread out.

    A plain left join shuffles every null-key row to the same partition. Null
    keys can match nothing, so each is replaced by one of many made-up keys
    holding a NUL character; ``spread_by`` (any varied column) picks which.
    Broadcast or sort-merge is left to measured sizes; a hot real key is split
    by the skew-join rule, which may split the left side of a left join.
    """
    probe = "__probe_key"
    filler = F.concat(F.lit("\0"), F.pmod(F.xxhash64(spread_by), F.lit(NULL_SPREAD)).cast("string"))
    probed = left.withColumn(probe, F.coalesce(F.col(key), filler))
    return probed.join(right.withColumnRenamed(key, probe), probe, "left").drop(probe)
