"""Column expressions shared by the operators. All are Spark built-ins, evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

def half_up(value: Column, places: int) -> Column:
    """Round half up through a decimal, so that float noise cannot flip a tie between runs."""
    return F.round(value.cast(DecimalType(38, places + 4)), places).cast("double")


def middle(value: Column, accuracy: int = 10_000) -> Column:
    """Median as an element of the data, for groupings with very many groups.

    The digest merges before the shuffle and stays small for any group size. The contract, at any
    size, is a rank that is off by at most rows / accuracy; groups that are few and huge have
    ``order_stats.quantiles``, which is exact.
    """
    return F.percentile_approx(value, 0.5, accuracy)


def spread(value: Column) -> Column:
    """Sample standard deviation, 0 for a single observation."""
    return F.coalesce(F.stddev_samp(value), F.lit(0.0))


def index_of(value: Column, level: Column) -> Column:
    """value / level, null where the level is not positive."""
    return F.when(level > 0, value / level)


def group_index(value: str, keys: list[str]) -> Column:
    """A value against the plain mean of its group; meant for already aggregated slot rows."""
    return index_of(F.col(value), F.avg(value).over(Window.partitionBy(*keys)))


def floor_bin(value: Column, width: float) -> Column:
    return F.floor(value / F.lit(width)) * F.lit(width)
