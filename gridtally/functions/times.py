"""Time text: parsing, validity, truncation, calendar anchors, zone display."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two stored time formats and the queue's ten-digit hour.
COMPACT = "yyyyMMddHHmmss"
DASHED = "yyyy-MM-dd HH:mm:ss"
HOUR_STAMP = "yyyyMMddHH"


def parse_time(text: Column) -> Column:
    """Timestamp of a 10-, 14- or 19-character time, null when it is none of them.

    Parsing is strict: month 13 or hour 25 is null, it does not roll over.
    """
    t = F.trim(text)
    size = F.length(t)
    return (
        F.when(size == 10, F.try_to_timestamp(F.concat(t, F.lit("0000")), F.lit(COMPACT)))
        .when(size == 14, F.try_to_timestamp(t, F.lit(COMPACT)))
        .when(size == 19, F.try_to_timestamp(t, F.lit(DASHED)))
    )


def moment(now: datetime | str | None) -> Column:
    """The reference instant of a job: a fixed one when given, else the current one."""
    return F.current_timestamp() if now is None else F.lit(str(now)).cast("timestamp")


def not_in_future(ts: Column, now: datetime | str | None, tolerance_seconds: int = 0) -> Column:
    """True for a parsed time at most ``tolerance_seconds`` past ``now``; false for null."""
    limit = moment(now) + F.make_dt_interval(secs=F.lit(tolerance_seconds))
    return F.coalesce(ts <= limit, F.lit(False))


def is_valid_time(text: Column, now: datetime | str | None, tolerance_seconds: int = 0) -> Column:
    return not_in_future(parse_time(text), now, tolerance_seconds)


def is_valid_range(start: str, end: str) -> bool:
    """Driver-side check of a job's time range: both parse and ``end`` is the later time."""

    def parsed(text: str) -> datetime | None:
        text = text.strip()
        fmt = "%Y%m%d%H%M%S" if len(text) == 14 else "%Y-%m-%d %H:%M:%S"
        try:
            return datetime.strptime(text, fmt)
        except ValueError:
            return None

    since, until = parsed(start), parsed(end)
    return since is not None and until is not None and until > since


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def to_compact(ts: Column) -> Column:
    return F.date_format(ts, COMPACT)


def to_dashed(ts: Column) -> Column:
    return F.date_format(ts, DASHED)


def hour_stamp(ts: Column) -> Column:
    return F.date_format(ts, HOUR_STAMP)


def stamp_to_hour(stamp: Column) -> Column:
    return F.try_to_timestamp(F.concat(F.trim(stamp), F.lit("0000")), F.lit(COMPACT))


def epoch_seconds(text: Column) -> Column:
    return F.unix_timestamp(parse_time(text))


def hours(n: int) -> Column:
    return F.make_dt_interval(hours=F.lit(n))


def days(n: int) -> Column:
    return F.make_dt_interval(days=F.lit(n))


def add_months(ts: Column, n: int) -> Column:
    """Calendar shift that keeps the time of day; the day is clipped to the month's end."""
    return ts + F.make_ym_interval(F.lit(0), F.lit(n))


def add_years(ts: Column, n: int) -> Column:
    return ts + F.make_ym_interval(F.lit(n), F.lit(0))


def calendar_anchors(ts: Column) -> dict[str, Column]:
    """The eleven boundaries around an instant, by name."""
    hour = F.date_trunc("hour", ts)
    day = F.date_trunc("day", ts)
    month = F.date_trunc("month", ts)
    return {
        "current_minute": F.date_trunc("minute", ts),
        "current_hour": hour,
        "last_hour": hour - hours(1),
        "last_two_hour": hour - hours(2),
        "next_hour": hour + hours(1),
        "current_day": day,
        "last_day": day - days(1),
        "next_day": day + days(1),
        "current_month": month,
        "last_month": add_months(month, -1),
        "next_month": add_months(month, 1),
    }


def in_zone(ts: Column, zone: str) -> Column:
    """Display text of a UTC instant in another zone."""
    return F.date_format(F.from_utc_timestamp(ts, zone), DASHED)
