"""Event times and durations, independent of the session's time zone.

Times are kept zone-less and in UTC.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_SECOND = 1_000_000


def moment(time: datetime) -> Column:
    """A literal zone-less time, the same in every session."""
    return F.lit(time.isoformat(sep=" ")).cast("timestamp_ntz")


def _epoch() -> Column:
    return moment(datetime(1970, 1, 1))


def from_micros(micros: Column) -> Column:
    seconds = (micros.cast("decimal(20,0)") / _SECOND).cast("decimal(18,6)")
    return _epoch() + F.make_dt_interval(secs=seconds)


def event_time(text: Column) -> Column:
    """ISO-8601 text to a zone-less UTC time; null when it is no time.

    Text without an offset is read as UTC, whatever the session's zone is.
    """
    offset = text.rlike(r"\d:\d{1,2}(:\d{1,2}(\.\d*)?)?\s*([A-Za-z]|[+-])")
    absolute = from_micros(F.unix_micros(F.when(offset, text).try_cast("timestamp")))
    return F.coalesce(absolute, F.when(~offset, text).try_cast("timestamp_ntz"))


def iso_text(ts: Column) -> Column:
    """A zone-less UTC time as ISO-8601 text with its offset."""
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit("+00:00"))


def instant(ts: Column) -> Column:
    """A zone-less UTC time as a timestamp, which a watermark needs."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), ts))


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds from 1970 to a zone-less UTC time."""
    return F.timestamp_diff("SECOND", _epoch(), ts)


def sale_end(start: Column, days: int = 14) -> Column:
    return start + F.make_dt_interval(F.lit(days))
