"""Time columns and day windows. Nothing here reads the clock."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The zone the collectors stamp in, and its hard-written offset.
LANDING_ZONE = "Asia/Seoul"
LANDING_OFFSET = "+09:00"


def instant(col: str | Column) -> Column:
    """Zoned text (or any time column) as an instant."""
    return F.col(col).cast("timestamp") if isinstance(col, str) else col.cast("timestamp")


def wall_time(col: str | Column) -> Column:
    """Zoned text as the time on the wall: the offset is dropped, not applied."""
    return F.col(col).cast("timestamp_ntz") if isinstance(col, str) else col.cast("timestamp_ntz")


def minutes_between(start: Column, end: Column) -> Column:
    """Fractional minutes from start to end."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(60_000_000.0)


def collect_time_text(col: str | Column) -> Column:
    """`2024-1-5 7:30` as `2024-01-05T07:30:00+09:00`; text that is no time gives NULL."""
    parsed = F.try_to_timestamp(col, F.lit("yyyy-M-d H:m"))
    return F.date_format(parsed, f"yyyy-MM-dd'T'HH:mm:ss'{LANDING_OFFSET}'")


def landing_parts(df: DataFrame, ts: str, hourly: bool = True, zone: str = LANDING_ZONE) -> DataFrame:
    """Add unpadded year, month, day[, hour] of the instant `ts` on the collectors' wall clock."""
    local = F.convert_timezone(None, F.lit(zone), instant(ts).cast("timestamp_ntz"))
    parts = {"year": F.year(local), "month": F.month(local), "day": F.dayofmonth(local)}
    if hourly:
        parts["hour"] = F.hour(local)
    return df.withColumns(parts)


def partition_date() -> Column:
    """The day a row's folder stands for; the keys may be text."""
    return F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))


def within_days(df: DataFrame, first: date, last: date) -> DataFrame:
    """Keep the folders of first..last. A filter on the time column alone would not prune them."""
    if not {"year", "month", "day"} <= {c.lower() for c in df.columns}:
        return df
    return df.where(partition_date().between(F.lit(first), F.lit(last)))


def day_window(as_of: date, day_start: time, zone: str) -> tuple[datetime, datetime]:
    """The day that ends on `as_of` at `day_start`, as instants."""
    end = datetime.combine(as_of, day_start, tzinfo=ZoneInfo(zone))
    start = datetime.combine(as_of - timedelta(days=1), day_start, tzinfo=ZoneInfo(zone))
    return start, end


def landing_days(start: datetime, end: datetime) -> tuple[date, date]:
    """Folder days that instants between start and end land in."""
    zone = ZoneInfo(LANDING_ZONE)
    return start.astimezone(zone).date(), end.astimezone(zone).date()


def instant_literal(moment: datetime) -> Column:
    """An aware datetime as a literal that does not depend on the session's zone."""
    return F.lit(moment.astimezone(ZoneInfo("UTC")).strftime("%Y-%m-%d %H:%M:%S.%f+00:00")).cast("timestamp")


def wall_literal(moment: datetime) -> Column:
    """A naive datetime as a literal without zone."""
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
