"""Time columns. Event time is a count of microseconds; all hours and days are UTC.

The arithmetic does not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000

# Written dates: date alone, or date and time with an optional offset.
ISO_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}"
    r"(?:[T ](?:[01]\d|2[0-3])(?::[0-5]\d(?::[0-5]\d(?:[.,]\d+)?)?)?(?:Z|[+-]\d{2}(?::?[0-5]\d)?)?)?$"
)


def event_day(time_us: Column) -> Column:
    """UTC day ``YYYY-MM-DD`` of a microsecond count."""
    day_start = time_us - F.pmod(time_us, F.lit(DAY_US))
    return F.date_from_unix_date((day_start / DAY_US).cast("int")).cast("string")


def hour_key(time_us: Column) -> Column:
    """UTC hour ``YYYY-MM-DDTHH`` of a microsecond count."""
    hour = F.floor(F.pmod(time_us, F.lit(DAY_US)) / HOUR_US).cast("int")
    return F.concat(event_day(time_us), F.lit("T"), F.lpad(hour.cast("string"), 2, "0"))


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a timestamp without time zone."""
    second = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return (
        F.unix_date(ts.cast("date")).cast("bigint") * DAY_US
        + F.hour(ts).cast("bigint") * HOUR_US
        + F.minute(ts).cast("bigint") * 60_000_000
        + second
    )


def created_day(created_at: Column) -> Column:
    return F.substring(created_at, 1, 10)


def created_hour(created_at: Column) -> Column:
    """``YYYY-MM-DDTHH`` as written by the client."""
    return F.substring(created_at, 1, 13)


def is_iso_time(text: Column) -> Column:
    """True if the text is a valid date, with or without a time of day."""
    day = F.substring(text, 1, 10).try_cast("date")
    return F.coalesce(F.when(text.rlike(ISO_PATTERN), day.isNotNull()), F.lit(False))


def written_date(created_at: Column) -> Column:
    """Date in the written offset (not moved to UTC); null if the text is no date."""
    return F.when(is_iso_time(created_at), F.substring(created_at, 1, 10))


def written_hour(created_at: Column) -> Column:
    """Hour 0-23 in the written offset; a date alone has hour 0."""
    hour = F.when(F.length(created_at) > 10, F.substring(created_at, 12, 2).cast("int")).otherwise(0)
    return F.when(is_iso_time(created_at), hour)


def trailing_days(last: Column, days: int) -> Column:
    """List of the ``days`` dates that end at ``last``, newest first, as text."""
    dates = F.sequence(last, F.date_sub(last, days - 1), F.expr("interval -1 day"))
    return F.transform(dates, lambda d: d.cast("string"))
