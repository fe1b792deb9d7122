"""Event-time helpers.

Event time travels as epoch milliseconds (``ts``) at the edges and as a
TIMESTAMP_NTZ wall clock (``event_time``) inside. Converting through NTZ
arithmetic keeps results independent of the session time zone unless a zone
is asked for explicitly.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

_UNIT_MICROS = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
    "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def interval_micros(text: str) -> int:
    """'5 minutes' / '6 seconds' / '1 day' -> microseconds (fixed-length units)."""
    total = 0
    parts = re.findall(r"(\d+)\s*([a-zA-Z]+)", text)
    if not parts:
        raise ValueError(f"cannot read interval {text!r}")
    for qty, unit in parts:
        key = unit.lower().rstrip("s")
        if key not in _UNIT_MICROS:
            raise ValueError(f"unsupported interval unit {unit!r} in {text!r}")
        total += int(qty) * _UNIT_MICROS[key]
    return total


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_to_epoch_micros(c) -> Column:
    return F.timestamp_diff("MICROSECOND", _epoch(), _col(c))


def ntz_to_epoch_millis(c) -> Column:
    return F.timestamp_diff("MILLISECOND", _epoch(), _col(c))


def epoch_micros_to_ntz(c) -> Column:
    return F.timestamp_add("MICROSECOND", _col(c), _epoch())


def epoch_millis_to_ntz(c, tz: str | None = "UTC") -> Column:
    """Wall clock of an epoch-millis instant in ``tz`` (None = session zone)."""
    utc_wall = F.timestamp_add("MILLISECOND", _col(c), _epoch())
    if tz == "UTC":
        return utc_wall
    target = F.current_timezone() if tz is None else F.lit(tz)
    return F.convert_timezone(F.lit("UTC"), target, utc_wall)


def date_string(c_ntz) -> Column:
    return F.date_format(_col(c_ntz), "yyyy-MM-dd")


def hour_string(c_ntz) -> Column:
    return F.date_format(_col(c_ntz), "HH")


def with_log_parts(df, ts_col: str = "ts", tz: str | None = "UTC"):
    """Add ``event_time``, ``log_date`` ('yyyy-MM-dd') and ``log_hour`` ('HH')
    derived from epoch-millis ``ts`` in an explicit zone."""
    wall = epoch_millis_to_ntz(ts_col, tz)
    return (df.withColumn("event_time", wall)
              .withColumn("log_date", date_string("event_time"))
              .withColumn("log_hour", hour_string("event_time")))


def previous_day(date: str) -> str:
    import datetime as _dt
    return (_dt.date.fromisoformat(date) - _dt.timedelta(days=1)).isoformat()


def day_range(col_ntz, first_date: str, last_date: str) -> Column:
    """Half-open range predicate on an NTZ column covering whole days; a plain
    comparison on the stored column, so it reaches the Parquet scan."""
    import datetime as _dt
    end = (_dt.date.fromisoformat(last_date) + _dt.timedelta(days=1)).isoformat()
    c = _col(col_ntz)
    return (c >= F.lit(first_date).cast("timestamp_ntz")) & (c < F.lit(end).cast("timestamp_ntz"))


def bucket_index(us: Column, step_us: int) -> Column:
    """floor(us / step) for epoch micros: the difference is an exact multiple
    of ``step`` so the division is exact well past year 2100."""
    step = F.lit(step_us)
    return ((us - F.pmod(us, step)) / step).cast("long")
