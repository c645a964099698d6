"""Dates, run times and the names of months and weekdays."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar order of the heat map.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def parse_date_key(key: Column) -> Column:
    """Date of a YYYYMMDD key. Anything else raises, whatever the session's ANSI setting is."""
    text = key.cast("string")
    day = F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date")
    bad = F.raise_error(F.concat(F.lit("not a YYYYMMDD date key: "), text)).cast("date")
    return F.when(text.isNull(), F.lit(None).cast("date")).otherwise(F.coalesce(day, bad))


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMM")


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "E")


def utc_now() -> datetime:
    """The present time in UTC, without a zone, as run times are stored."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


def as_utc(moment: datetime) -> datetime:
    """The moment in UTC, without a zone; a moment without one is taken to be UTC."""
    if moment.tzinfo is None:
        return moment
    return moment.astimezone(timezone.utc).replace(tzinfo=None)


def timestamp_literal(moment: datetime) -> Column:
    """A zone-free timestamp literal; a zoned ``moment`` is taken to UTC first."""
    return F.lit(as_utc(moment).isoformat(sep=" ")).cast("timestamp_ntz")


def instant_literal(moment: datetime) -> Column:
    """The same moment as an instant, for columns that carry a zone; no zone means UTC."""
    return F.lit(moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc))


def iso_utc(run_ts: Column) -> Column:
    """ISO text with seconds and the UTC offset, the form the run log and the reports use."""
    return F.date_format(run_ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def run_id(run_ts: Column) -> Column:
    """Twenty digits from the year to the microsecond."""
    return F.date_format(run_ts, "yyyyMMddHHmmssSSSSSS")
