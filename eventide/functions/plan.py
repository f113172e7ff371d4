"""Plan shaping."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, *columns: Column) -> DataFrame:
    """Add aliased columns that are evaluated once per row.

    A filter on a derived column is pushed below the projection that defines it,
    which copies the whole definition into the predicate. For a JSON parse that
    is referenced dozens of times the copies multiply. Predicates do not move
    through a generator, so the columns come out of a one-row ``inline``. The
    projection before it keeps the expressions themselves out of the generator,
    which would interpret them when one has no generated code.
    """
    staged = df.select("*", F.struct(*columns).alias("_once"))
    return staged.select(*df.columns, F.inline(F.array("_once")))
