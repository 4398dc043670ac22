"""Time spent per visited page."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def duration_per_visit(visits: Column, duration: Column) -> Column:
    """32-bit ratio; null where there were no visits or an input is null."""
    return F.try_divide(duration, visits).cast("float")


def lenient_duration_per_visit(visits: Column, duration: Column, dtype: str = "float") -> Column:
    """Ratio that is 0 where the strict form has no value."""
    return F.coalesce(F.try_divide(duration, visits), F.lit(0.0)).cast(dtype)
