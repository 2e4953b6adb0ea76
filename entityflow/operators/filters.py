"""Row filters: required fields, freshness, quarantine, enum check."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityflow.functions.text import as_col
from entityflow.functions.times import fresh_range
from entityflow.schemas import FRESHNESS_HOURS, PRICING_VALUES


def has_value(value) -> Column:
    """Neither null nor empty."""
    return F.coalesce(F.length(as_col(value)), F.lit(0)) > 0


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows whose every listed text column is neither null nor empty."""
    # "<> ''" is already unknown for null, and it reaches the file scan.
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() & (F.col(c) != "") for c in cols]))


def fresh_only(df: DataFrame, ts_col: str, now, hours: int | None = FRESHNESS_HOURS) -> DataFrame:
    """Rows inside the freshness window; unparsable (null) times drop."""
    return df.filter(fresh_range(ts_col, now, hours))


def split_bad(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): a malformed value is null after the try-functions, never a failure.

    The quarantine keeps the row and lists the columns that could not be read.
    """
    faults = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]), lambda x: x.isNotNull()
    )
    good = df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
    bad = df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])).withColumn("faults", faults)
    return good, bad


def valid_enum(df: DataFrame, col: str = "pricingModel", allowed: Sequence[str] = tuple(PRICING_VALUES)) -> DataFrame:
    return df.filter(F.col(col).isin(list(allowed)))


def unmatched(mapping_log: DataFrame) -> DataFrame:
    """Names without a confident match, kept for review."""
    return mapping_log.filter(~F.col("matched_seed"))


def under_size_cap(pages: DataFrame, body: str, max_bytes: int | None = None) -> DataFrame:
    """Bodies at most ``max_bytes`` long; runs before any Python stage. None keeps all."""
    return pages if max_bytes is None else pages.filter(F.octet_length(body) <= max_bytes)


def rejected_bodies(pages: DataFrame, body: str, max_bytes: int | None = None, keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """What ``under_size_cap`` leaves out: the ``keep`` columns, bytes and reason."""
    size = F.octet_length(body)
    reason = F.when(size.isNull(), "no body").when(size > max_bytes if max_bytes is not None else F.lit(False), "over the size cap")
    return pages.select(*keep, size.alias("bytes"), reason.alias("reason")).filter(F.col("reason").isNotNull())
