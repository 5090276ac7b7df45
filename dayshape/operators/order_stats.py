"""Exact quantiles of large groups without bringing a group into one task.

A first pass counts values per logarithmic bin: a few thousand bins per group, combined before the
shuffle. The running count over the bins tells which bin holds each wanted rank. A second pass
cuts each of those bins into equal parts between its smallest and largest value, as values far from
zero may all share a bin, and finds the part. A third reads only those parts and counts their
distinct values, so even a value repeated in a third of all rows is one row by the time it is
ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bins per doubling of the value; a bin spans 0.27 % of its value.
BINS_PER_OCTAVE = 256
# log2 of the smallest positive double is -1074: the shift keeps every bin on its sign's side.
OCTAVE_SHIFT = 1100


# Beyond every finite double's bin: the infinities, and NaN, which is ordered last.
INFINITE_BIN = 2 * OCTAVE_SHIFT * BINS_PER_OCTAVE
# Parts that a wanted bin is cut into.
PARTS = 4096


def log_bin(value: Column) -> Column:
    """A bin number that never decreases as the value grows, over all doubles; NaN is last."""
    x = value.cast("double")
    infinite = float("inf")
    finite = F.when(F.abs(x) < infinite, x)
    depth = F.floor((F.log2(F.abs(finite)) + OCTAVE_SHIFT) * BINS_PER_OCTAVE).cast("int")
    return (
        F.when(F.isnan(x), INFINITE_BIN + 1)
        .when(x == infinite, INFINITE_BIN)
        .when(x == -infinite, -INFINITE_BIN)
        .when(x == 0, 0)
        .when(x > 0, depth)
        .otherwise(-depth)
    )


def _ranked(share: Column, total: Column, interpolate: bool) -> Column:
    """1-based ranks needed for a share: one element, or the two around the exact position."""
    if interpolate:
        low = F.floor(share * (total - 1)).cast("bigint") + 1
        return F.array(low, F.least(low + 1, total))
    rank = (total - F.floor(total - share * total)).cast("bigint")
    return F.array(F.greatest(rank, F.lit(1).cast("bigint")))


def quantiles(
    df: DataFrame,
    column: str,
    shares: Sequence[float],
    by: Sequence[str] = (),
    interpolate: bool = False,
) -> DataFrame:
    """Rows (by..., share, value). Without interpolation the value is an element of the data.

    Nulls are left out; NaN is a value, above all others. ``by`` is meant for few groups (slots,
    classes, regions, models): each takes thousands of rows in a task that cumulates its bins.
    """
    keys = list(by)
    value = F.col(column)
    numbers = df.where(value.isNotNull()).select(
        *keys, value.alias("v"), log_bin(value).alias("bin"), F.lit(0).alias("one")
    )

    def located(counts: DataFrame, at: str, ranks: DataFrame, within: list[str]) -> DataFrame:
        """For each wanted rank the ``at`` that holds it, and its rank in there."""
        same = Window.partitionBy("one", *within).orderBy(at)
        upto = counts.withColumn("upto", F.sum("n").over(same)).withColumnsRenamed(
            {c: f"__{c}" for c in [*within]}
        )
        here = [F.col(f"__{c}").eqNullSafe(F.col(c)) for c in within]
        inside = (F.col("rank") > F.col("upto") - F.col("n")) & (F.col("rank") <= F.col("upto"))
        met = ranks.join(upto.drop("one"), [*here, inside] if here else inside)
        return met.withColumn("rank", F.col("rank") - (F.col("upto") - F.col("n"))).drop(
            "upto", "n", *(f"__{c}" for c in within)
        )

    def only(rows: DataFrame, ranks: DataFrame, columns: list[str], more: tuple = ()) -> DataFrame:
        """The rows in the bins or parts where a wanted rank lies."""
        names = {c: f"__{c}" for c in [*columns, *more]}
        picked = ranks.select(*names).distinct().withColumnsRenamed(names)
        same = [F.col(c).eqNullSafe(F.col(names[c])) for c in columns]
        return rows.join(picked, same).drop(*(names[c] for c in columns))

    bins = numbers.groupBy("one", *keys, "bin").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    totals = bins.groupBy(*keys).agg(F.sum("n").alias("total"))
    ranks = totals.withColumn(
        "share", F.explode(F.array(*[F.lit(float(s)) for s in shares]))
    ).withColumn("rank", F.explode(_ranked(F.col("share"), F.col("total"), interpolate)))
    ranks = located(bins, "bin", ranks, keys)

    low, high = F.col("__low").cast("double"), F.col("__high").cast("double")
    place = F.floor((F.col("v").cast("double") - low) / (high - low) * PARTS)
    ordinary = (high > low) & (F.abs(F.col("bin")) < INFINITE_BIN)
    cut = only(numbers, ranks, [*keys, "bin"], ("low", "high")).withColumn(
        "part", F.when(ordinary, place).otherwise(0).cast("int")
    ).drop("__low", "__high")
    parts = cut.groupBy("one", *keys, "bin", "part").agg(F.count(F.lit(1)).alias("n"))
    ranks = located(parts, "part", ranks.drop("low", "high"), [*keys, "bin"])

    values = only(cut, ranks, [*keys, "bin", "part"]).groupBy("one", *keys, "bin", "part", "v").agg(
        F.count(F.lit(1)).alias("n")
    )
    found = located(values, "v", ranks, [*keys, "bin", "part"])
    if not interpolate:
        return found.select(*keys, "share", F.col("v").alias("value"))
    position = F.col("share") * (F.col("total") - 1)
    weight = F.max(position - F.floor(position))
    return (
        found.groupBy(*keys, "share")
        .agg((F.min("v") + (F.max("v") - F.min("v")) * weight).alias("value"))
    )


def quantile_row(
    df: DataFrame, column: str, shares: Sequence[float], interpolate: bool = False
) -> DataFrame:
    """The quantiles of a whole column as one row (q0, q1, ...), in the order of the shares."""
    found = quantiles(df, column, shares, interpolate=interpolate)
    return found.agg(
        *[
            F.max(F.when(F.col("share") == F.lit(float(s)), F.col("value"))).alias(f"q{i}")
            for i, s in enumerate(shares)
        ]
    )
