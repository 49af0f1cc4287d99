"""Epoch-millisecond text to timestamps and calendar parts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last millisecond of the years 1 to 9999 (UTC).
EARLIEST_MS = -62135596800000
LATEST_MS = 253402300799999
# A decimal number, with blanks around it or an exponent if need be.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def start_time(ts: str) -> Column:
    """Timestamp of an epoch-millisecond text column; NULL if absent, not a number or out of range."""
    # The cast alone would also take numbers in hexadecimal or with a type letter behind them.
    ms = F.when(F.col(ts).rlike(NUMBER), F.col(ts).try_cast("double"))
    whole = F.floor(ms)
    # floor(x + 0.5) because round() of a double goes through big decimals.
    micros = whole * 1000 + F.floor((ms - whole) * 1000 + 0.5)
    return F.when(ms.between(EARLIEST_MS, LATEST_MS), F.timestamp_micros(micros))


def epoch_ms_text(ts: str) -> Column:
    """Inverse of `start_time`: a timestamp column as epoch-millisecond text."""
    return F.unix_millis(F.col(ts).cast("timestamp")).cast("string")


def calendar_parts(time: str) -> dict[str, Column]:
    """Calendar columns of a timestamp: ISO week, and weekday 1 = Sunday to 7 = Saturday."""
    return {
        "hour": F.hour(time),
        "day": F.dayofmonth(time),
        "week": F.weekofyear(time),
        "month": F.month(time),
        "year": F.year(time),
        "weekday": F.dayofweek(time),
    }
