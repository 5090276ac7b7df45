"""Planner queries over the star schema. Values are bound, never pasted into SQL text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from dayshape.functions import half_up
from dayshape.operators.order_stats import quantile_row
from dayshape.operators.star import Star
from dayshape.spec import Spec


def same_key(key: Column, text: str, kind: DataType) -> Column:
    """A key given as text. The typed half can be pushed to a scan; the other tells 7 from 007."""
    typed = key if isinstance(kind, StringType) else key == F.lit(text).try_cast(kind)
    as_text = key.cast("string") == F.lit(text)
    return as_text if isinstance(kind, StringType) else typed & as_text


def entity_profile(star: Star, spec: Spec, entity_id: str, min_observations: int = 1) -> DataFrame:
    """The day of one entity. The id is a literal of the plan, so any string is a mere value."""
    least = int(min_observations)

    def own(table: DataFrame) -> DataFrame:
        return table.where(same_key(F.col(spec.entity), entity_id, table.schema[spec.entity].dataType))

    slots = own(star.profile).where(F.col("observations") >= least)
    place = own(star.entity).select(spec.entity, spec.klass, spec.authority)
    rounded = {"mean_measure": 1, "peak_index": 3}
    values = [half_up(F.col(name), places).alias(name) for name, places in rounded.items()]
    found = slots.join(place, spec.entity).select(
        spec.slot, "observations", *values, spec.authority, spec.klass
    )
    return found.orderBy(spec.slot)


def entity_peak_map(star: Star, peaks: DataFrame, spec: Spec) -> DataFrame:
    """Where the sharp entities are; entities without a place or an index are left out."""
    return (
        star.entity.join(peaks, spec.entity)
        .select(spec.entity, *spec.coordinates, "max_peak_index", "is_major")
        .dropna()
    )


def class_peak(star: Star, spec: Spec, min_observations: int = 5) -> DataFrame:
    """When each class peaks and how sharply, over sufficiently observed profile rows."""
    rows = star.profile.where(F.col("observations") >= min_observations)
    return (
        rows.join(star.entity.select(spec.entity, spec.klass), spec.entity)
        .groupBy(spec.klass, spec.slot)
        .agg(
            F.count(F.lit(1)).alias("links"),
            half_up(F.avg("peak_index"), 4).alias("mean_peak_index"),
            half_up(F.avg("mean_measure"), 1).alias("mean_measure"),
        )
        .orderBy(spec.klass, spec.slot)
    )


def class_pivot(
    class_rows: DataFrame, spec: Spec, dimension: DataFrame, min_links: int = 0
) -> DataFrame:
    """Slot x class table of the mean index, with a column for every class of the dimension."""
    classes = dimension.select(spec.klass).dropna().distinct().orderBy(spec.klass)
    return (
        class_rows.where(F.col("links") >= min_links)
        .groupBy(spec.slot)
        .pivot(spec.klass, [row[0] for row in classes.collect()])
        .agg(F.max("mean_peak_index"))
        .orderBy(spec.slot)
    )


def sharpest(
    star: Star,
    spec: Spec,
    columns: Sequence[str],
    limit: int = 10,
    min_observations: int = 5,
) -> DataFrame:
    """The profile rows with the highest index, with dimension columns; ties by entity and slot."""
    wanted = [c for c in columns if c not in (spec.entity, spec.slot)]
    top = (
        star.profile.where(F.col("observations") >= min_observations)
        .join(star.entity.select(spec.entity, *wanted), spec.entity)
        .orderBy(F.desc_nulls_last("peak_index"), spec.entity, spec.slot)
        .limit(int(limit))
    )
    return top.select(
        *columns,
        F.col(spec.slot).alias("peak_slot"),
        half_up(F.col("peak_index"), 3).alias("peak_index"),
        half_up(F.col("mean_measure"), 1).alias("peak_measure"),
        "observations",
    )


def annual_trend(
    annual: DataFrame, spec: Spec, flow: str, first_period: int = 2000, last_period: int = 2025
) -> DataFrame:
    """Entities and mean flow per period, over the known flows."""
    return (
        annual.where(F.col(spec.period).between(first_period, last_period))
        .where(F.col(flow).isNotNull())
        .groupBy(spec.period)
        .agg(F.count(F.lit(1)).alias("links"), half_up(F.avg(flow), 1).alias("mean_flow"))
        .orderBy(spec.period)
    )


def region_star(star: Star, spec: Spec) -> DataFrame:
    """Profile rows with the class and region of their entity; unplaced entities drop out."""
    return (
        star.profile.join(star.entity.select(spec.entity, spec.klass, spec.region), spec.entity)
        .join(star.region.select(spec.region, spec.region_name), spec.region)
    )


def region_summary(star: Star, spec: Spec, min_links: int = 1) -> DataFrame:
    """Entities, unweighted mean level and sharpest index of each region.

    The profile is folded to one row per entity before regions are attached, so a region holding
    most entities costs one row per entity and no distinct count.
    """
    per_entity = star.profile.groupBy(spec.entity).agg(
        F.sum("mean_measure").alias("level_sum"),
        F.count("mean_measure").alias("level_rows"),
        F.max("peak_index").alias("sharpest"),
    )
    return (
        per_entity.join(star.entity.select(spec.entity, spec.region), spec.entity)
        .join(star.region.select(spec.region, spec.region_name), spec.region)
        .groupBy(spec.region_name)
        .agg(
            F.count(F.lit(1)).alias("entities"),
            half_up(F.sum("level_sum") / F.sum("level_rows"), 1).alias("mean_measure"),
            half_up(F.max("sharpest"), 3).alias("sharpest_peak_index"),
        )
        .where(F.col("entities") >= min_links)
        .orderBy(F.desc("mean_measure"), spec.region_name)
    )


def latest_period(annual: DataFrame, profile: DataFrame, spec: Spec, flow: str) -> DataFrame:
    """The last period, its mean flow, and the number of profiled entities."""
    trend = annual.where(F.col(flow).isNotNull()).groupBy(spec.period).agg(F.avg(flow).alias("m"))
    entities = profile.agg(F.countDistinct(spec.entity).alias("entities"))
    return trend.agg(
        F.max(spec.period).alias("latest_period"),
        half_up(F.max_by("m", spec.period), 1).alias("latest_mean_flow"),
    ).withColumn("entities", entities.scalar())
