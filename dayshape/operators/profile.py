"""Daily profiles: what an entity, a class or a region does in each time slot.

The fact is always reduced to (key, slot) first, with partial aggregation before the shuffle.
The windows then run over slot rows only: a group holds at most one row per slot, however many
measurements stand behind it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayshape.functions import group_index, half_up, index_of, middle, spread
from dayshape.operators.order_stats import quantiles
from dayshape.spec import Spec


def slot_profile(df: DataFrame, spec: Spec) -> DataFrame:
    """Per (entity, slot): observations, mean, median, deviation and component means."""
    measure = F.col(spec.measure)
    return df.groupBy(spec.entity, spec.slot).agg(
        F.count(F.lit(1)).alias("observations"),
        half_up(F.avg(measure), 2).alias("mean_measure"),
        half_up(middle(measure), 2).alias("median_measure"),
        half_up(spread(measure), 2).alias("sd_measure"),
        *[half_up(F.avg(c), 2).alias(f"mean_{c}") for c in spec.components],
    )


def with_peak_index(profile: DataFrame, spec: Spec) -> DataFrame:
    """The slot mean against the entity's plain mean of its (rounded) slot means."""
    return profile.withColumn(
        "peak_index", half_up(group_index("mean_measure", [spec.entity]), 4)
    )


def peak_index(df: DataFrame, spec: Spec) -> DataFrame:
    return with_peak_index(slot_profile(df, spec), spec)


def index_by(df: DataFrame, keys: Sequence[str], spec: Spec) -> DataFrame:
    """Unrounded slot means of a group, and each against the group's mean slot."""
    keys = list(keys)
    slots = df.groupBy(*keys, spec.slot).agg(
        F.count(F.lit(1)).alias("observations"),
        F.avg(spec.measure).alias("mean_measure"),
    )
    return slots.withColumn("peak_index", group_index("mean_measure", keys))


def peak_index_exact(df: DataFrame, spec: Spec) -> DataFrame:
    return index_by(df, [spec.entity], spec)


def mean_index_by_slot(profile: DataFrame, spec: Spec) -> DataFrame:
    return profile.groupBy(spec.slot).agg(
        half_up(F.avg("peak_index"), 3).alias("mean_peak_index")
    )


def dead_entities(profile: DataFrame, spec: Spec) -> DataFrame:
    """How many entities never measured anything, so that no index exists."""
    return profile.where(F.col("peak_index").isNull()).agg(
        F.countDistinct(spec.entity).alias("dead_entities")
    )


def entity_peak(profile: DataFrame, spec: Spec, min_total: int = 24) -> DataFrame:
    """Sharpest slot of each entity that was observed often enough."""
    return (
        profile.groupBy(spec.entity)
        .agg(
            F.max("peak_index").alias("max_peak_index"),
            F.sum("observations").alias("total_observations"),
        )
        .where(F.col("total_observations") >= min_total)
    )


def region_sharpness(df: DataFrame, spec: Spec) -> DataFrame:
    """Level and sharpest slot of each region."""
    return (
        index_by(df, [spec.region_name], spec)
        .groupBy(spec.region_name)
        .agg(
            half_up(F.avg("mean_measure"), 1).alias("mean_level"),
            half_up(F.max("peak_index"), 3).alias("peak_sharpness"),
        )
        .dropna()
    )


def slot_summary(df: DataFrame, spec: Spec) -> DataFrame:
    return df.groupBy(spec.slot).agg(
        F.count(F.lit(1)).alias("observations"),
        half_up(F.avg(spec.measure), 1).alias("mean_measure"),
        *[half_up(F.avg(c), 1).alias(f"mean_{c}") for c in spec.components],
    )


def slot_distribution(df: DataFrame, spec: Spec) -> DataFrame:
    """Level, median and 90th percentile of each slot over the whole fact."""
    levels = df.groupBy(spec.slot).agg(
        F.count(F.lit(1)).alias("observations"),
        F.avg(spec.measure).alias("mean_measure"),
    )
    tails = (
        quantiles(df, spec.measure, [0.5, 0.9], by=[spec.slot])
        .groupBy(spec.slot)
        .agg(
            F.max(F.when(F.col("share") == 0.5, F.col("value"))).alias("median_measure"),
            F.max(F.when(F.col("share") == 0.9, F.col("value"))).alias("p90_measure"),
        )
    )
    return levels.join(tails, spec.slot, "left")


def peak_trough(slots: DataFrame, spec: Spec) -> DataFrame:
    """Busiest and quietest slot (the earlier one on a tie) and the ratio of their means."""
    level = F.col("mean_measure")
    return slots.agg(
        F.max_by(spec.slot, F.struct(level, -F.col(spec.slot))).alias("peak_slot"),
        F.max(level).alias("peak_mean"),
        F.min_by(spec.slot, F.struct(level, F.col(spec.slot))).alias("trough_slot"),
        F.min(level).alias("trough_mean"),
    ).withColumn("peak_trough_ratio", index_of(F.col("peak_mean"), F.col("trough_mean")))


def entity_dim(df: DataFrame, spec: Spec, places: int = 6) -> DataFrame:
    """One row per entity: earliest known attributes, class flag, first and last period.

    "Earliest" is by date, then by value, so the result does not depend on row order. The fact is
    first reduced to its distinct attribute sets by a hash aggregate (few per entity); choosing
    among those needs ordered structs, which would otherwise sort every fact row.
    """
    known = [*spec.attributes, *spec.coordinates]
    variants = df.groupBy(spec.entity, *known).agg(
        F.min(spec.date).alias("seen"),
        F.max("is_major").alias("is_major"),
        F.min(spec.period).alias("first_period"),
        F.max(spec.period).alias("last_period"),
    )

    def earliest(name: str):
        order = F.when(F.col(name).isNotNull(), F.struct("seen", name))
        return F.min_by(name, order)

    return variants.groupBy(spec.entity).agg(
        *[earliest(a).alias(a) for a in spec.attributes],
        *[half_up(earliest(c), places).alias(c) for c in spec.coordinates],
        F.max("is_major").alias("is_major"),
        F.min("first_period").alias("first_period"),
        F.max("last_period").alias("last_period"),
    )


def region_dim(df: DataFrame, spec: Spec) -> DataFrame:
    """Entities and authorities per region.

    Distinct triples come first: the two distinct counts then expand that short list instead of
    the fact, and a region holding most rows is spread over all tasks.
    """
    return (
        df.select(spec.region, spec.region_name, spec.authority, spec.entity)
        .distinct()
        .groupBy(spec.region, spec.region_name)
        .agg(
            F.countDistinct(spec.entity).alias("entities"),
            F.countDistinct(spec.authority).alias("authorities"),
        )
    )


def period_break(df: DataFrame, spec: Spec) -> DataFrame:
    return df.groupBy(spec.period).agg(
        F.count(F.lit(1)).alias("observations"),
        F.avg(spec.measure).alias("mean_measure"),
    )


def base_index(df: DataFrame, spec: Spec, columns: Sequence[str]) -> DataFrame:
    """Component means per period, the first period being 100."""
    yearly = df.groupBy(spec.period).agg(*[F.avg(c).alias(c) for c in columns])
    # One row per period reaches this window, so a single task holds no more than a calendar.
    since_start = Window.partitionBy(F.lit(1)).orderBy(spec.period)
    return yearly.select(
        spec.period,
        *[
            index_of(100 * F.col(c), F.first(c).over(since_start)).alias(f"index_{c}")
            for c in columns
        ],
    )
