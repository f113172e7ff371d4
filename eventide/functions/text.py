"""Text forms of numbers and instants."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed2_sql(number: str) -> str:
    """SQL text for ``%.2f``.

    ``format_number`` rounds the exact binary value, ties to even, as C-style
    formatting does; ``format_string('%.2f')`` rounds the printed value half up
    and turns 0.125 into 0.13.
    """
    return f"format_number({number}, '0.00')"


def rfc3339(instant: Column) -> Column:
    """Whole-second UTC instant, e.g. 2024-01-01T14:00:00Z."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'Z'")
