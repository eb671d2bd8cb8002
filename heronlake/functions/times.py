"""Times: parsing to UTC, the local date, hour and weekday (UTC+7), windows of days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "+07:00"
#: Formats beside ISO-8601, tried in this order; names of weekdays are cut off before.
FORMATS = ["d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm", "dd/MM/yyyy", "dd-MM-yyyy HH:mm"]


def to_utc(raw: Column, naive_zone: str = ZONE) -> Column:
    """The instant of a time in any of the known formats, null if none fits; a time without an offset is of naive_zone."""
    bare = F.regexp_replace(F.trim(raw), r"^(?i)(mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+", "")
    bare = F.regexp_replace(bare, r"\bGMT$", "+0000")
    parsed = F.coalesce(F.try_to_timestamp(bare), *(F.try_to_timestamp(bare, F.lit(f)) for f in FORMATS))
    zoned = bare.rlike(r"(?i)(z|[+-][0-9]{2}:?[0-9]{2}|\b[a-z]{3,4})$")
    return F.when(zoned, parsed).otherwise(F.to_utc_timestamp(parsed, naive_zone))


def iso(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def local(ts: Column) -> Column:
    return F.from_utc_timestamp(ts.cast("timestamp"), ZONE)


def time_fields(ts: Column) -> list[Column]:
    """publish_date, publish_hour, publish_dow (0 is Monday); null where the time is unknown."""
    at = local(ts)
    return [F.to_date(at).alias("publish_date"), F.hour(at).alias("publish_hour"), F.weekday(at).alias("publish_dow")]


def bucket_label(ts: Column, hours: int = 4) -> Column:
    """The start of the tumbling bucket, as YYYY-MM-DDTHH in UTC."""
    at = ts.cast("timestamp")
    start = F.date_trunc("day", at) + F.make_interval(hours=(F.floor(F.hour(at) / hours) * hours).cast("int"))
    return F.date_format(start, "yyyy-MM-dd'T'HH")


def since(time: str, as_of, days: int) -> Column:
    """The last days + 1 calendar days up to as_of; without an upper bound, as rolling windows have it.

    The comparison is with a literal on the time itself, so it is pushed down to the scan.
    """
    return F.col(time) >= F.lit(_day(as_of, -days))


def before_that(time: str, as_of, days: int) -> Column:
    """The `days` days before those."""
    return (F.col(time) >= F.lit(_day(as_of, -2 * days))) & (F.col(time) < F.lit(_day(as_of, -days)))


def _day(as_of, shift: int):
    from datetime import date, datetime, timedelta

    day = as_of if isinstance(as_of, date) and not isinstance(as_of, datetime) else as_of.date()
    return day + timedelta(days=shift)
