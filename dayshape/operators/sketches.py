"""Mergeable summaries: quantiles and distinct counts of any span of periods without the fact.

One scan leaves a row per group with a KLL sketch for each measure and an HLL sketch for each key.
Rows of kept sketches merge into those of longer spans or coarser groups, so a new period costs one
scan of that period. The exact paths stay in `order_stats` and `quality`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUANTILE_K = 800
DISTINCT_LG_K = 12


def rank_error(k: int = QUANTILE_K) -> float:
    """How far a quantile's rank may be off, as a share of the rows, in 99 of 100 cases.

    Up to ``k`` values a sketch holds them all. The figure doesn't depend on the number of rows or
    of merges.
    """
    return 2.296 / k**0.9021


def distinct_error(lg_k: int = DISTINCT_LG_K) -> float:
    """The standard error of a distinct count, as a share of it."""
    return 1.04 / 2 ** (lg_k / 2)


def _measure(name: str) -> Column:
    """The values a sketch takes: NaN, like null, is none."""
    x = F.col(name).cast("double")
    return F.when(~F.isnan(x), x)


def _key(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    return F.col(name) if kind in ("int", "bigint", "string", "binary") else F.col(name).cast("string")


def sketch(
    df: DataFrame,
    by: Sequence[str] = (),
    measures: Sequence[str] = (),
    keys: Sequence[str] = (),
    k: int = QUANTILE_K,
    lg_k: int = DISTINCT_LG_K,
) -> DataFrame:
    """A row per group: n_rows, and for each measure its count, range, sum and quantile sketch
    (``n_x``, ``min_x``, ``max_x``, ``sum_x``, ``quantiles_x``), for each key its sketch ``distinct_x``.

    Sketches are built in the tasks that scan and merged after the shuffle, so a group that holds
    most rows is no hot key. Nulls count as rows alone.
    """
    parts = [F.count(F.lit(1)).alias("n_rows")]
    for name in measures:
        x = _measure(name)
        parts += [
            F.count(x).alias(f"n_{name}"),
            F.min(x).alias(f"min_{name}"),
            F.max(x).alias(f"max_{name}"),
            F.sum(x).alias(f"sum_{name}"),
            F.kll_sketch_agg_double(x, k).alias(f"quantiles_{name}"),
        ]
    parts += [F.hll_sketch_agg(_key(df, name), lg_k).alias(f"distinct_{name}") for name in keys]
    return df.groupBy(*by).agg(*parts)


def merge(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows of `sketch` merged into coarser groups, in the same layout."""
    ways = {"n": F.sum, "min": F.min, "max": F.max, "sum": F.sum,
            "quantiles": F.kll_merge_agg_double, "distinct": F.hll_union_agg}
    parts = []
    for name in sketches.columns:
        way = ways.get(name.split("_", 1)[0]) if "_" in name else None
        if way is not None and name not in by:
            parts.append(way(F.col(name)).alias(name))
    return sketches.groupBy(*by).agg(*parts)


def sketch_quantiles(
    sketches: DataFrame, measure: str, shares: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Rows (by..., share, value): elements of the data whose rank is off by `rank_error` at most.

    The value of a group without a measured row is null.
    """
    asked = F.array(*[F.lit(float(s)) for s in shares])
    known = F.col(f"n_{measure}") > 0
    values = F.when(known, F.kll_sketch_get_quantile_double(f"quantiles_{measure}", asked))
    pairs = [
        F.struct(F.lit(float(share)).alias("share"), F.get("__values", F.lit(i)).alias("value"))
        for i, share in enumerate(shares)
    ]
    return sketches.withColumn("__values", values).select(*by, F.inline(F.array(*pairs)))


def sketch_distinct(sketches: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows (by..., column, n_distinct) estimated from the kept sketches."""
    pairs = [
        F.struct(F.lit(name).alias("column"), F.hll_sketch_estimate(f"distinct_{name}").alias("n_distinct"))
        for name in keys
    ]
    return sketches.select(*by, F.inline(F.array(*pairs)))


def rank_gap(df: DataFrame, found: DataFrame, measure: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows (by..., share, gap): how far the rank of each found value is off, over all rows.

    A value that occurs often takes up a range of ranks; the gap is 0 if the share lies in it.
    """
    keys = list(by)
    # One row per group: its values and shares, few, travel along with each measured row.
    told = found.groupBy(*keys).agg(F.collect_list(F.struct("share", "value")).alias("asked"))
    x = _measure(measure)
    rows = df.select(*keys, x.alias("x")).where("x is not null")
    rows = rows.join(told, keys) if keys else rows.withColumn("asked", told.select("asked").scalar())
    each = rows.select(*keys, "x", F.inline("asked"))
    counted = each.groupBy(*keys, "share").agg(
        (F.count_if(F.col("x") < F.col("value")) / F.count(F.lit(1))).alias("low"),
        (F.count_if(F.col("x") <= F.col("value")) / F.count(F.lit(1))).alias("high"),
    )
    gap = F.greatest(F.col("low") - F.col("share"), F.col("share") - F.col("high"), F.lit(0.0))
    return counted.select(*keys, "share", gap.alias("gap"))
