"""Time texts of a table to instants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityflow.functions.times import clean_time_text, fuzzy_time, read_time
from entityflow.operators.filters import fresh_only
from entityflow.operators.pin import pin
from entityflow.schemas import FRESHNESS_HOURS


def add_time(df: DataFrame, raw: str, out: str, now, fuzzy: bool = False) -> DataFrame:
    """Adds ``out``, the instant a time text stands for, each text read once."""
    read = pin(pin(df, "__text", clean_time_text(raw)), out, read_time(F.col("__text"), now)).drop("__text")
    if fuzzy:
        read = pin(read, out, F.coalesce(F.col(out), fuzzy_time(raw, F.col(out), now)))
    return read


def fresh_by_text(df: DataFrame, raw: str, out: str, now, hours: int | None = FRESHNESS_HOURS, fuzzy: bool = False) -> DataFrame:
    """Rows whose time text lies inside the freshness window, with the instant in ``out``."""
    return fresh_only(add_time(df, raw, out, now, fuzzy), out, now, hours)
