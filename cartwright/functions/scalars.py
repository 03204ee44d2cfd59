"""Null-safe arithmetic, clocks, buckets and labels as Spark expressions."""

from __future__ import annotations

import calendar
from collections.abc import Sequence
from datetime import date, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright import names as N

MICROS_PER_DAY = 86_400_000_000
MICROS_PER_MINUTE = 60_000_000


# -- missing values ---------------------------------------------------------

def null_if_nan(c: Column) -> Column:
    """NaN counts as missing everywhere, so averages and sums skip it."""
    return F.nanvl(c, F.lit(None).cast("double"))


def ratio(num: Column, den: Column) -> Column:
    """Division in which x/0 is missing rather than an error or infinity."""
    return F.try_divide(num, den)


def number_or_zero(c: Column) -> Column:
    """Coerce to double; unparsable, missing and NaN become 0."""
    return F.coalesce(F.nanvl(c.try_cast("double"), F.lit(0.0)), F.lit(0.0))


def floor_negative(c: Column) -> Column:
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def clip(c: Column, low: Column, high: Column) -> Column:
    """Clip to [low, high], keeping a missing value missing."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, low), high))


# -- keys -------------------------------------------------------------------

def text_key(c: Column) -> Column:
    """Trimmed text id; a float-looking integer loses its fraction."""
    return F.regexp_replace(F.trim(c.cast("string")), r"^(-?\d+)\.0+$", "$1")


def long_key(c: Column) -> Column:
    """Integer id from text that may read ``123`` or ``123.0``."""
    return F.trim(c.cast("string")).try_cast("decimal(38,6)").try_cast("bigint")


# -- clocks -----------------------------------------------------------------

def utc_clock(c: Column, dtype: T.DataType) -> Column:
    """UTC wall clock (no zone) of an instant, a zone-less UTC value or text.

    Text that cannot be parsed becomes NULL; text without an offset is UTC.
    """
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.TimestampType):
        return F.convert_timezone(None, F.lit("UTC"), c)
    text = c.cast("string")
    has_offset = text.rlike(r"(?i)\d{1,2}:\d{2}.*(Z|UTC|[+-]\d{2}:?\d{2})\s*$")
    instant = F.convert_timezone(None, F.lit("UTC"), text.try_cast("timestamp"))
    return F.when(has_offset, instant).otherwise(text.try_cast("timestamp_ntz"))


def local_clock(c: Column, dtype: T.DataType, zone: str) -> Column:
    """Wall clock in ``zone`` of a UTC feed, as a timestamp without zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_clock(c, dtype))


def window_bounds(run_date: date, months: int, zone: str | None = None) -> tuple[Column, Column]:
    """Half-open window [run - months, run) as foldable timestamp literals.

    With ``zone`` the local midnights are turned into UTC, so the predicate is
    put on the raw column and reaches the scan.
    """
    end = F.lit(run_date).cast("timestamp_ntz")
    start = F.add_months(F.lit(run_date), -months).cast("timestamp_ntz")
    if zone is None:
        return start, end
    to_utc = lambda c: F.convert_timezone(F.lit(zone), F.lit("UTC"), c)
    return to_utc(start), to_utc(end)


def window_instants(run_date: date, months: int, zone: str) -> tuple[Column, Column]:
    """The same window as literals of type TIMESTAMP, whatever the session's time zone."""
    month = run_date.year * 12 + run_date.month - 1 - months
    year, month = divmod(month, 12)
    day = min(run_date.day, calendar.monthrange(year, month + 1)[1])
    midnight = lambda y, m, d: F.lit(datetime(y, m, d, tzinfo=ZoneInfo(zone)))
    return midnight(year, month + 1, day), midnight(run_date.year, run_date.month, run_date.day)


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def floor_days(start: Column, end: Column) -> Column:
    """Whole days from start to end, rounded down (-10 h is -1 day)."""
    return F.floor(micros_between(start, end) / F.lit(MICROS_PER_DAY)).cast("bigint")


def minutes_between(start: Column, end: Column) -> Column:
    return micros_between(start, end) / F.lit(MICROS_PER_MINUTE)


def daypart(ts: Column) -> Column:
    hour = F.hour(ts)
    out = None
    for name, first, last in N.DAYPART_HOURS:
        inside = hour.between(first, last)
        out = F.when(inside, name) if out is None else out.when(inside, name)
    return out.otherwise(N.DAYPART_FALLBACK)


def weekend_flag(ts: Column) -> Column:
    """1 on Saturday and Sunday."""
    return F.coalesce((F.weekday(ts) >= 5).cast("int"), F.lit(0))


# -- buckets and labels -----------------------------------------------------

def bin_index(price: Column, bins: Sequence[float] = N.PRICE_BINS) -> Column:
    """Index of the half-open bin [a, b) that holds ``price``; else NULL."""
    out = F.when(price < F.lit(bins[0]), F.lit(None).cast("int"))
    for i, upper in enumerate(bins[1:]):
        out = out.when(price < F.lit(upper), F.lit(i))
    return out


def price_bucket(
    price: Column,
    bins: Sequence[float] = N.PRICE_BINS,
    labels: Sequence[str] = N.BUCKET_LABELS,
) -> Column:
    idx = bin_index(price, bins)
    return F.when(idx.isNotNull(), F.get(F.array(*map(F.lit, labels)), idx))


def normalize_label(c: Column) -> Column:
    """Lower-case name with every run of non-word characters as one ``_``."""
    return F.lower(F.btrim(F.regexp_replace(c, r"(?U)\W+", "_"), F.lit("_")))


def as_list(c: Column, dtype: T.DataType) -> Column:
    """Array of strings from an array, or from text that spells a list; else empty."""
    empty = F.array().cast("array<string>")
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(c.cast("array<string>"), empty)
    if isinstance(dtype, T.StringType):
        return F.coalesce(F.from_json(c, "array<string>"), empty)
    return empty


def channel_label(flags: dict[str, Column]) -> Column:
    """Label of the set of channels used, e.g. ``OC + Swiggy``; own app alone is ``OC only``."""
    present = [F.when(flags[ch], F.lit(text)) for ch, text in N.CHANNEL_LABELS]
    joined = F.concat_ws(" + ", *present)
    own_only = N.CHANNEL_LABELS[0][1]
    return F.when(joined == own_only, f"{own_only} only").otherwise(joined)
