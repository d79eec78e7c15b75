"""Time rules (DAT1-12).

Representation: an instant is carried as ``timestamp_ntz`` holding the UTC wall clock. Every conversion
below is independent of ``spark.sql.session.timeZone``, so results do not move when a cluster runs in
another zone, and they compare directly with engines that store naive UTC timestamps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.functions.casting import col_of

# Study defaults.
STUDY_TZ = "America/New_York"
REFRESH_CUTOFF = "05:00:00"
DAYS_PER_MONTH = 30.4375  # duration month = 365.25 / 12 days (DAT5)
PHASE_CUT_MONTHS = 2.9     # < 2.9 months -> baseline, >= 2.9 -> follow-up (DAT6)


ZONE_SUFFIX = "(Z|z|[+-][0-9]{2}(:?[0-9]{2})?)$"


def text_to_instant(name: str) -> Column:
    """ISO-8601 text column ``name`` -> UTC wall clock; bad text -> NULL.

    Text with a zone (Z, +02:00) is parsed as an instant and brought to UTC; the session-zone round trip
    cancels out. Text without a zone is read as a UTC wall clock directly (casting to timestamp_ntz would
    silently drop a zone, hence the two branches). SQL text, parsed in one call.
    """
    c = f"`{name}`"
    zoned = f"convert_timezone(current_timezone(), 'UTC', CAST(try_cast({c} AS TIMESTAMP) AS TIMESTAMP_NTZ))"
    return F.expr(f"CASE WHEN trim({c}) RLIKE '{ZONE_SUFFIX}' THEN {zoned} ELSE try_cast({c} AS TIMESTAMP_NTZ) END")


def to_instant(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` as a UTC ``timestamp_ntz``, chosen by the column's type (DAT1, DAT8).

    string -> parsed (bad text -> NULL); timestamp (with zone) -> UTC wall clock; timestamp_ntz -> as is
    (taken as UTC); date -> midnight.
    """
    dtype = df.schema[name].dataType
    c = col_of(name)
    if isinstance(dtype, T.StringType):
        return text_to_instant(name)
    if isinstance(dtype, T.TimestampType):
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp_ntz")
    raise TypeError(f"column {name!r} of type {dtype.simpleString()} is not a time")


def local_wallclock(instant: Column | str, tz: str = STUDY_TZ) -> Column:
    """UTC wall clock -> wall clock in ``tz`` (DAT2)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), col_of(instant))


def local_date(instant: Column | str, tz: str = STUDY_TZ) -> Column:
    """Calendar date in ``tz``: 2025-07-29 03:30 UTC is 2025-07-28 in New York (DAT3)."""
    return F.to_date(local_wallclock(instant, tz))


def months_since(later: Column, earlier: Column) -> Column:
    """Whole-day difference divided by the duration month (DAT5); not ``months_between``."""
    return F.datediff(later, earlier).cast("double") / F.lit(DAYS_PER_MONTH)


def phase_label(months: Column, cut: float = PHASE_CUT_MONTHS, before: str = "BL", after: str = "QT") -> Column:
    """'BL' below the cut, 'QT' at or above it, NULL for NULL (DAT6)."""
    return F.when(months < F.lit(cut), F.lit(before)).when(months >= F.lit(cut), F.lit(after))


def _hms(text: str) -> tuple[int, int, int]:
    h, m, s = (int(x) for x in text.split(":"))
    return h, m, s


def last_refresh(instant: Column | str, tz: str = STUDY_TZ, cutoff: str = REFRESH_CUTOFF) -> Column:
    """Most recent daily refresh at ``cutoff`` local time, strictly before the given instant (DAT11).

    Exactly at the cutoff counts as not yet refreshed (yesterday's refresh). The result is a UTC wall
    clock; the local cutoff moves with daylight saving (09:00 or 10:00 UTC for New York). Unlike the
    study code, the day is the day of the argument, not today's date (quirk Q12).
    """
    h, m, s = _hms(cutoff)
    local = local_wallclock(instant, tz)
    day = F.to_date(local)
    cut_today = F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day), F.lit(h), F.lit(m), F.lit(s))
    refresh_day = F.when(local > cut_today, day).otherwise(F.date_sub(day, 1))
    local_refresh = F.make_timestamp_ntz(F.year(refresh_day), F.month(refresh_day), F.dayofmonth(refresh_day),
                                         F.lit(h), F.lit(m), F.lit(s))
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), local_refresh)


def format_refresh(refresh: Column | str, tz: str = STUDY_TZ, label: str = "Last updated:") -> Column:
    """'Last updated: YYYY-MM-DD HH:MM:SS <zone>' in local time (DAT12)."""
    local = local_wallclock(refresh, tz)
    return F.concat_ws(" ", F.lit(label), F.date_format(local, "yyyy-MM-dd"), F.date_format(local, "HH:mm:ss"),
                       F.lit(tz))


# Bucket column names of the time-series combine (DAT7).
BUCKET_COLUMNS = {"day": "file_date", "month": "year_month", "hour": "datetime_hour", "minute": "datetime_minute"}


def floor_time(instant: Column, unit: str) -> Column:
    """Floor a UTC wall clock to the hour or minute (DAT7)."""
    if unit not in ("hour", "minute"):
        raise ValueError(f"unit must be 'hour' or 'minute', not {unit!r}")
    # built from the fields: date_trunc would truncate in the session zone
    minute = F.minute(instant) if unit == "minute" else F.lit(0)
    return F.make_timestamp_ntz(F.year(instant), F.month(instant), F.dayofmonth(instant), F.hour(instant), minute,
                                F.lit(0))


def floor_month(day: Column) -> Column:
    """First day of the month of a date (DAT7)."""
    return F.trunc(day, "month")
