"""Time truncation and tumbling-window columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_millis(instant: Column) -> Column:
    """Drop everything below the millisecond."""
    return F.date_trunc("millisecond", instant)


def hour_of(instant: Column) -> Column:
    return F.date_trunc("hour", instant)


def tumbling(time_col: str, size: str, offset: str | None = None) -> Column:
    """Tumbling window struct of ``size`` (for example ``"10 seconds"``).

    ``offset`` shifts the grid away from the epoch, for windows that count from
    the moment a collector was started.
    """
    return F.window(time_col, size, startTime=offset)
