"""Relative and absolute time texts, and the freshness rule."""

from __future__ import annotations

from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityflow.functions.text import as_col, empty_to_null, strip
from entityflow.schemas import FRESHNESS_HOURS

# Words meaning "now", unit lengths in microseconds, clock skew allowed.
NOW_WORDS = ["just now", "moments ago", "now"]
SECOND_US = 1_000_000
UNIT_US = {
    "second": SECOND_US,
    "minute": 60 * SECOND_US,
    "hour": 3_600 * SECOND_US,
    "day": 86_400 * SECOND_US,
    "week": 7 * 86_400 * SECOND_US,
    "month": 30 * 86_400 * SECOND_US,
    "year": 365 * 86_400 * SECOND_US,
}
RELATIVE = r"(?U)([0-9]+)\s*(second|minute|hour|day|week|month|year)s?\s*ago"
YEAR_ONE_US = -62_135_596_800 * SECOND_US
FUTURE_SKEW_MINUTES = 5

ISO_SHAPE = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$"
)
COMPACT_DATE = r"^[0-9]{8}$"

# Absolute dates besides ISO are first rewritten to year|month|day. Named months
# take either order and may lack the year ('sep 9, 2026', '9 september 2026',
# 'sep 9'); all-numeric dates with the year last are read month first.
MONTH_DATE = (
    r"^(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,? +)?(?=[a-z]|[0-9]+ [a-z]+\.?,? [0-9]{4}$)(?:([0-9]{1,2}) )?"
    r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
    r"(?:uary|ruary|ch|il|e|y|ust|t|tember|ober|ember)?\.?(?: ([0-9]{1,2}))?(?:,? ([0-9]{4}))?$"
)
# A clock time after a date, with an optional half of the day and offset; and words that may come before a date.
CLOCK = (
    r"(?:,? +|t)(?:at +)?([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:\.[0-9]{1,9})?)?"
    r"(?: ?([ap])\.?m\.?)?(?: ?\(?(z|utc|gmt|[+-][0-9]{2}:?[0-9]{2})\)?)?$"
)
LEAD_WORDS = r"^(?:last +)?(?:updated|posted|published|modified|date)(?: +on)?:? +"
YEAR_FIRST = r"^([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})$"
YEAR_LAST = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$"


def as_instant(now) -> Column:
    """A timestamp column from a column, datetime (naive = UTC) or ISO text."""
    if isinstance(now, Column):
        return now.cast("timestamp")
    if isinstance(now, datetime):
        aware = now if now.tzinfo else now.replace(tzinfo=timezone.utc)
        return F.lit(aware)
    return F.lit(now).cast("timestamp")


def parse_iso(value) -> Column:
    """ISO-8601 text to an instant, null on failure.

    The shape is checked first: a bare year or a bare clock time would
    otherwise be read as 1 January or as today.
    """
    text = as_col(value)
    return F.when(text.rlike(ISO_SHAPE), F.try_to_timestamp(text)).when(
        text.rlike(COMPACT_DATE), F.try_to_timestamp(text, F.lit("yyyyMMdd"))
    )


def _relative(text: Column, now: Column) -> Column:
    count = F.regexp_extract(text, RELATIVE, 1).try_cast("bigint")
    lengths = F.create_map(*[F.lit(x) for pair in UNIT_US.items() for x in pair])
    length = F.element_at(lengths, F.regexp_extract(text, RELATIVE, 2))
    micros = F.try_subtract(F.unix_micros(now), F.try_multiply(count, length))
    # Nothing before year 1: that and a count too large to multiply are null.
    return F.timestamp_micros(F.nullif(F.greatest(micros, F.lit(YEAR_ONE_US - 1)), F.lit(YEAR_ONE_US - 1)))


def _absolute(text: Column, now: Column) -> Column:
    named = F.regexp_replace(text, MONTH_DATE, "$4|$2|$1$3")
    dated = F.concat(F.when(named.startswith("|"), F.year(now).cast("string")).otherwise(""), named)
    numbers = F.regexp_replace(F.regexp_replace(text, YEAR_FIRST, "$1|$2|$3"), YEAR_LAST, "$3|$1|$2")
    return (
        F.when(text.rlike(ISO_SHAPE.replace("T", "t").replace("Z", "z")), F.try_to_timestamp(F.upper(text)))
        .when(text.rlike(COMPACT_DATE), F.try_to_timestamp(text, F.lit("yyyyMMdd")))
        .when(text.rlike(MONTH_DATE), F.try_to_timestamp(dated, F.lit("yyyy|MMM|d")))
        .when(text.rlike(r"^[0-9]+/[0-9]+/[0-9]+$"), F.try_to_timestamp(numbers, F.lit("yyyy|M|d")))
    )


def _number(text: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(text, CLOCK, group).try_cast("int"), F.lit(0))


def _dated_clock(text: Column, now: Column) -> Column:
    """A date with a clock time, or a date after a word such as 'updated'; null for anything else."""
    hour, minute, second = (_number(text, g) for g in (1, 2, 3))
    half, zone = F.regexp_extract(text, CLOCK, 4), F.regexp_replace(F.regexp_extract(text, CLOCK, 5), ":", "")
    hour24 = F.when(half == "", hour).otherwise(hour % 12 + F.when(half == "p", 12).otherwise(0))
    valid = F.when(half == "", hour < 24).otherwise(hour.between(1, 12)) & (minute < 60) & (second < 60)
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    offset = F.when(zone.rlike("^[+-]"), sign * (F.substring(zone, 2, 2).try_cast("int") * 60 + F.substring(zone, 4, 2).try_cast("int"))).otherwise(0)
    seconds = (hour24 * 60 + minute - offset) * 60 + second
    plain = F.get(F.transform(F.array(F.regexp_replace(text, CLOCK, "")), lambda date: _absolute(date, now)), F.lit(0))
    moment = F.timestamp_micros(F.unix_micros(plain) + seconds.cast("bigint") * SECOND_US)
    return F.when(text.rlike(CLOCK), F.when(valid, moment)).otherwise(plain)


@F.pandas_udf(T.TimestampType())
def _fuzzy_dates(texts: pd.Series, nows: pd.Series) -> pd.Series:
    """Lenient reading of the texts no fixed shape covers; missing parts come from ``now``."""
    from dateutil import parser

    def read(text, now):
        if not text or pd.isna(now):
            return None
        try:
            got = parser.parse(text, fuzzy=True, default=now.replace(hour=0, minute=0, second=0, microsecond=0))
        except (ValueError, OverflowError):
            return None
        if got.tzinfo is not None:
            got = got.astimezone(timezone.utc).replace(tzinfo=None)
        return got

    nows = [n.tz_localize(None).to_pydatetime() if not pd.isna(n) else n for n in nows]
    return pd.Series([read(t, n) for t, n in zip(texts, nows)], dtype="datetime64[us]")


def clean_time_text(value) -> Column:
    """What the time rules look at: stripped and lower-cased."""
    return F.lower(strip(value))


def read_time(text: Column, now) -> Column:
    """The native time rules on an already cleaned text."""
    now = as_instant(now)
    return (
        F.when(text.isin(NOW_WORDS), now)
        .when(text == "yesterday", now - F.expr("INTERVAL 24 HOURS"))
        .when(text.rlike(RELATIVE), _relative(text, now))
        .otherwise(F.coalesce(_absolute(text, now), F.when(
            text.rlike(CLOCK) | text.rlike(LEAD_WORDS),
            F.get(F.transform(F.array(F.regexp_replace(text, LEAD_WORDS, "")), lambda rest: _dated_clock(rest, now)), F.lit(0)),
        )))
    )


def parse_time(value, now, fuzzy: bool = False) -> Column:
    """Time text to an instant: now-words, yesterday, '<n> <unit>s ago', then absolute dates, with or without a clock time.

    Absolute dates without an offset are UTC, a date without a year takes the
    year of ``now``. Unreadable text is null, never a guess. ``fuzzy=True``
    adds a lenient reader for the remainder (an Arrow batch function, called
    for rows no native rule could read). To filter on the result, prefer
    ``operators.timed.add_time``.
    """
    # The lambda variable holds the cleaned text, so it is made once for all rules.
    native = F.get(F.transform(F.array(clean_time_text(value)), lambda text: read_time(text, now)), F.lit(0))
    return F.coalesce(native, fuzzy_time(value, native, now)) if fuzzy else native


def fuzzy_time(value, native: Column, now) -> Column:
    """Lenient reading where ``native`` is null; relative wording is never guessed at."""
    raw = as_col(value)
    leftover = F.when(native.isNull() & ~clean_time_text(raw).rlike(RELATIVE), empty_to_null(raw))
    return _fuzzy_dates(leftover, as_instant(now))


def fresh_range(ts, now, hours: int | None = FRESHNESS_HOURS) -> Column:
    """The freshness rule as a bare range: null stays null, so a filter can push it to the scan."""
    span = hours or FRESHNESS_HOURS
    ts, now = as_col(ts), as_instant(now)
    low = now - F.expr(f"INTERVAL {int(span)} HOURS")
    high = now + F.expr(f"INTERVAL {FUTURE_SKEW_MINUTES} MINUTES")
    # One evaluation of ``ts``, however long its expression; a plain column still becomes a range.
    return F.call_function("between", ts, low, high)


def is_fresh(ts, now, hours: int | None = FRESHNESS_HOURS) -> Column:
    """Within the last ``hours`` and at most five minutes ahead, both ends included; null is stale.

    ``hours`` of 0 or None means the default window.
    """
    return F.coalesce(fresh_range(ts, now, hours), F.lit(False))
