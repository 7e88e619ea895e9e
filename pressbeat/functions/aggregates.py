"""Small aggregate helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_count() -> Column:
    """count(*), as a column expression."""
    return F.count(F.lit(1))
