"""Time helpers on zone-less timestamps that hold UTC."""

from __future__ import annotations

import re
from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, functions as F

# Boards shift by the constant EST offset, period names are
# resolved in Eastern time with daylight saving.
BOARD_ZONE = "-05:00"
CALENDAR_ZONE = "America/New_York"

# Period name -> (grain, whole periods back).
PERIODS = {
    "day": ("day", 0),
    "yesterday": ("day", 1),
    "week": ("week", 0),
    "last-week": ("week", 1),
    "month": ("month", 0),
    "last-month": ("month", 1),
}


def _ntz(col: Column) -> Column:
    return col.cast("timestamp_ntz")


def moment(at: datetime) -> Column:
    """A zone-less literal.  It goes through text: a ``datetime`` literal would
    pass the zones of the Python process and of the session on its way."""
    return _ntz(F.lit(at.isoformat(sep=" ")))


# The seconds of the years 1 to 9999, which a timestamp can hold.
_FIRST_S, _LAST_S = -62135596800, 253402300799


def epoch_s(seconds: Column) -> Column:
    """Epoch seconds to timestamp, NULL outside of the years 1 to 9999."""
    fits = F.when(seconds.between(_FIRST_S, _LAST_S), seconds)
    return moment(datetime(1970, 1, 1)) + F.make_dt_interval(secs=fits.try_cast("decimal(18,6)"))


def epoch_ms(millis: Column) -> Column:
    """Epoch milliseconds to timestamp; fractions are kept to the microsecond."""
    return epoch_s(millis / F.lit(1000))


def bucket(ts: Column, grain: str, zone: str | None = None) -> Column:
    """Start of the day, week (Monday), month, quarter or year of ``ts``."""
    # Dates have no zone, so the session's zone cannot move a bucket.
    date = (shift_zone(ts, zone) if zone else _ntz(ts)).cast("date")
    return _ntz(date if grain == "day" else F.trunc(date, grain))


def shift_zone(ts: Column, zone: str = BOARD_ZONE) -> Column:
    """UTC wall time to the wall time of ``zone``.

    A fixed offset is plain addition; only named zones need the zone rules,
    which Spark looks up by name for every row.
    """
    fixed = re.fullmatch(r"([+-])(\d\d):(\d\d)", zone)
    if fixed is None:
        return F.convert_timezone(F.lit("UTC"), F.lit(zone), _ntz(ts))
    sign, hours, minutes = fixed.groups()
    offset = timedelta(hours=int(hours), minutes=int(minutes))
    return _ntz(ts) + F.lit(offset if sign == "+" else -offset)


def within(ts: Column, as_of: datetime, hours: int = 24) -> Column:
    """Closed interval of the last ``hours`` before ``as_of``."""
    return ts.between(moment(as_of - timedelta(hours=hours)), moment(as_of))


def period_start(grain: str, local: datetime, back: int = 0) -> datetime:
    """Start of the period ``back`` periods before the one that holds ``local``."""
    day = datetime(local.year, local.month, local.day)
    if grain == "day":
        return day - timedelta(days=back)
    if grain == "week":
        return day - timedelta(days=day.weekday() + 7 * back)
    if grain == "month":
        months = day.year * 12 + day.month - 1 - back
        return datetime(months // 12, months % 12 + 1, 1)
    raise ValueError(f"unknown grain: {grain}")


def resolve_period(
    period: str, as_of: datetime, zone: str = CALENDAR_ZONE
) -> tuple[str, datetime]:
    """Period name and UTC moment to (grain, local start of that period)."""
    if period not in PERIODS:
        raise ValueError(f"unknown period: {period}")
    grain, back = PERIODS[period]
    local = as_of.replace(tzinfo=ZoneInfo("UTC")).astimezone(ZoneInfo(zone))
    return grain, period_start(grain, local, back)


def in_period(ts: Column, grain: str, start: datetime, zone: str = BOARD_ZONE) -> Column:
    """Raw range on the stored UTC column for one local period.

    A plain comparison with literals reaches the file scan, which a filter on
    a truncated expression does not.
    """
    return in_local_range(ts, start, period_start(grain, start, -1), zone)


def in_local_range(ts: Column, start: datetime, end: datetime, zone: str = BOARD_ZONE) -> Column:
    """``start <= ts < end`` for local bounds and a stored UTC column."""
    to_utc = lambda local: F.convert_timezone(
        F.lit(zone), F.lit("UTC"), moment(local)
    )
    return (ts >= to_utc(start)) & (ts < to_utc(end))


def stamp(ts: Column) -> Column:
    """``Mar  8,  3:05 PM``: day and hour are padded with a space."""
    pad = lambda pattern: F.lpad(F.date_format(ts, pattern), 2, " ")
    return F.concat(
        F.date_format(ts, "MMM"), F.lit(" "), pad("d"), F.lit(", "), pad("h"),
        F.date_format(ts, ":mm a"),
    )


def send_at(now: datetime, published: Column, key: Column, seed: int = 0) -> Column:
    """Staggered send time: ``now`` plus the published minute and second, each
    with 0..9 of jitter taken from a hash so that a rerun gives the same time."""
    jitter = lambda salt: F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(10))
    mins = F.minute(published) + jitter(2 * seed)
    secs = F.second(published) + jitter(2 * seed + 1)
    return moment(now) + F.make_dt_interval(
        mins=mins.cast("int"), secs=secs.cast("decimal(18,6)")
    )
