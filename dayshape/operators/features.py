"""Leakage-safe features: what is known of an entity before the period to forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayshape.functions import half_up, index_of, spread
from dayshape.operators.clean import period_split
from dayshape.operators.quality import component_identity, corr_with
from dayshape.sources import write_tables
from dayshape.spec import FeatureSet, Spec, Split


# The columns of an entity's history.
HISTORY = ("hist_mean", "hist_sd", "hist_periods")


def entity_history(train: DataFrame, spec: Spec) -> DataFrame:
    """Mean, deviation and distinct periods of each entity, from training rows only."""
    return train.groupBy(spec.entity).agg(
        half_up(F.avg(spec.measure), 2).alias("hist_mean"),
        half_up(spread(F.col(spec.measure)), 2).alias("hist_sd"),
        F.countDistinct(spec.period).alias("hist_periods"),
    )


def history_defaults(history: DataFrame) -> DataFrame:
    """One row: what to assume of an entity that training never saw."""
    return history.agg(
        F.coalesce(F.avg("hist_mean"), F.lit(0.0)).alias("hist_mean"),
        F.coalesce(F.avg("hist_sd"), F.lit(0.0)).alias("hist_sd"),
        F.lit(0).cast("bigint").alias("hist_periods"),
    )


def attach_history(block: DataFrame, history: DataFrame, spec: Spec, join: str | None = None) -> DataFrame:
    """Add the training history to every row; unseen entities get the mean history.

    The defaults are a scalar subquery of the plan, so nothing is collected while it is built. The
    history has a row per entity and grows with the data: with ``join="merge"`` (a hint) it is never
    sent through the driver, whatever its size. Without a hint Spark broadcasts a small one.
    """
    default = history_defaults(history).select(F.struct("hist_mean", "hist_sd").alias("d")).scalar()
    return block.join(history.hint(join) if join else history, spec.entity, "left").withColumns(
        {
            "hist_mean": F.coalesce("hist_mean", default.getField("hist_mean")),
            "hist_sd": F.coalesce("hist_sd", default.getField("hist_sd")),
            "hist_periods": F.coalesce("hist_periods", F.lit(0).cast("bigint")),
        }
    )


def _period_sums(train: DataFrame, spec: Spec) -> DataFrame:
    """Per (entity, period): rows n, and sum and squares of the measure around a centre.

    The centre is the mean of the entity's first period, so little is lost to cancellation and no
    later value has a part in it. Rows without a measure count for nothing.
    """
    x = F.col(spec.measure).cast("double")
    per_period = train.groupBy(spec.entity, spec.period).agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.var_pop(x).alias("var")
    )
    # One row per period of an entity reaches the window.
    whole = Window.partitionBy(spec.entity)
    measured = F.when(F.col("n") > 0, F.struct(F.col(spec.period), "n"))
    center = F.min_by("mean", measured).over(whole)
    off = F.col("mean") - F.col("center")
    return per_period.withColumn("center", center).select(
        spec.entity,
        spec.period,
        "n",
        "center",
        F.coalesce(F.col("n") * off, F.lit(0.0)).alias("off"),
        F.coalesce(F.col("n") * (F.col("var") + off * off), F.lit(0.0)).alias("squares"),
    )


def _from_sums(n: Column, center: Column, off: Column, squares: Column) -> tuple[Column, Column]:
    """Mean and sample deviation (0 for a single row) from sums around a centre."""
    mean = F.when(n > 0, half_up(center + off / n, 2))
    left = F.greatest(squares - off * off / n, F.lit(0.0))
    return mean, F.when(n > 1, half_up(F.sqrt(left / (n - 1)), 2)).when(n == 1, 0.0)


def attach_earlier(block: DataFrame, train: DataFrame, spec: Spec) -> DataFrame:
    """Add to every row the entity's history of the training periods before the row's own.

    Running sums over (entity, period) end before the row's period, so neither the row nor anything
    later has a part in its history. An entity without earlier rows gets the mean of all training
    rows of earlier periods with no deviation, and 0 where there is none at all. A row without a
    period has nothing before it.
    """
    sums = _period_sums(train, spec).where(F.col(spec.period).isNotNull())
    asked = block.select(spec.entity, spec.period).where(F.col(spec.period).isNotNull()).distinct()
    # Periods that are only asked for take part with no rows of their own.
    places = sums.select(spec.entity, spec.period).union(asked).distinct()
    own = Window.partitionBy(spec.entity)
    before = own.orderBy(F.col(spec.period).cast("bigint")).rangeBetween(Window.unboundedPreceding, -1)
    filled = places.join(sums, [spec.entity, spec.period], "left").withColumn("center", F.max("center").over(own))
    n = F.coalesce(F.sum("n").over(before), F.lit(0))
    running = filled.select(
        spec.entity,
        spec.period,
        n.alias("n"),
        "center",
        F.sum("off").over(before).alias("off"),
        F.sum("squares").over(before).alias("squares"),
        F.coalesce(F.count_if(F.col("n") > 0).over(before), F.lit(0)).alias("hist_periods"),
    )
    mean, deviation = _from_sums(F.col("n"), F.col("center"), F.col("off"), F.col("squares"))
    history = running.select(
        spec.entity, spec.period, mean.alias("hist_mean"), deviation.alias("hist_sd"), "hist_periods"
    )
    # What is known of all entities before a period: one row per period.
    x = F.col(spec.measure).cast("double")
    calendar = (
        train.groupBy(spec.period)
        .agg(F.count(x).alias("rows"), F.sum(x).alias("total"))
        .unionByName(
            block.select(spec.period).distinct().select(
                spec.period, F.lit(0).cast("bigint").alias("rows"), F.lit(0.0).alias("total")
            )
        )
        .groupBy(spec.period)
        .agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"))
        .where(F.col(spec.period).isNotNull())
    )
    until = Window.partitionBy(F.lit(1)).orderBy(F.col(spec.period).cast("bigint")).rangeBetween(Window.unboundedPreceding, -1)
    common = calendar.select(
        spec.period, (F.sum("total").over(until) / F.nullif(F.sum("rows").over(until), F.lit(0))).alias("common")
    )
    return (
        block.join(history, [spec.entity, spec.period], "left")
        .join(common, spec.period, "left")
        .select(
            *block.columns,
            F.coalesce("hist_mean", half_up(F.col("common"), 2), F.lit(0.0)).alias("hist_mean"),
            F.coalesce("hist_sd", F.lit(0.0)).alias("hist_sd"),
            F.coalesce("hist_periods", F.lit(0).cast("bigint")).alias("hist_periods"),
        )
    )


def attach_others(train: DataFrame, spec: Spec) -> DataFrame:
    """Add to every training row the entity's history without the row itself.

    Sum, squares and count of the entity lose the row's share, so no row is compared with another.
    The only row of an entity gets the mean history of the other entities, and 0 if there is none.
    Rows without a measure have nothing to leave out. A share is taken out by subtraction, so the
    deviation is as exact as doubles are against the largest value of the entity.
    """
    sums = _period_sums(train, spec)
    own = Window.partitionBy(spec.entity)
    totals = sums.select(
        spec.entity,
        spec.period,
        F.col("n").alias("__here"),
        F.col("center").alias("__center"),
        F.sum("n").over(own).alias("__n"),
        F.sum("off").over(own).alias("__off"),
        F.sum("squares").over(own).alias("__squares"),
        F.count_if(F.col("n") > 0).over(own).alias("__periods"),
    )
    entities = totals.groupBy(spec.entity).agg(
        *[F.max(f"__{c}").alias(c) for c in ("n", "center", "off", "squares")]
    )
    mean, deviation = _from_sums(F.col("n"), F.col("center"), F.col("off"), F.col("squares"))
    known = entities.select(mean.alias("m"), deviation.alias("d")).where(F.col("m").isNotNull())
    others = known.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum("m").alias("m"), F.sum("d").alias("d")).alias("o")).scalar()

    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in (spec.entity, spec.period)]
    met = train.join(totals.withColumnsRenamed({c: f"__{c}" for c in (spec.entity, spec.period)}), same)
    x = F.col(spec.measure).cast("double")
    has = x.isNotNull().cast("int")
    gap = F.coalesce(x - F.col("__center"), F.lit(0.0))
    mean, deviation = _from_sums(
        F.col("__n") - has, F.col("__center"), F.col("__off") - gap, F.col("__squares") - gap * gap
    )
    count = others.getField("n") - has
    rest = others.getField("m") - F.coalesce(half_up(x, 2), F.lit(0.0))
    return met.select(
        *train.columns,
        F.coalesce(mean, F.when(count > 0, half_up(rest / count, 2)), F.lit(0.0)).alias("hist_mean"),
        F.coalesce(deviation, F.when(count > 0, half_up(others.getField("d") / count, 2)), F.lit(0.0)).alias("hist_sd"),
        (F.col("__periods") - F.when(F.col("__here") == has, has).otherwise(0)).alias("hist_periods"),
    )


def feature_blocks(
    df: DataFrame,
    spec: Spec,
    split: Split,
    directory: str | None = None,
    history: str = "whole",
    join: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Training and test block, both carrying the history of the training block alone.

    ``history`` says what a training row knows of its entity: "whole" (all training rows, the row
    itself among them), "earlier" (training periods before its own) or "others" (all training rows
    but itself). A test row always has the whole training history, as all of it lies before.

    With a directory the history is written there and read back: both blocks and the defaults
    then share one computation, and its size is known when the joins are planned. ``join`` is the
    hint of `attach_history`.
    """
    train, test = period_split(df, spec, split)
    found = entity_history(train, spec)
    if directory is not None:
        paths = write_tables({f"history_{split.name}": found}, directory)
        found = df.sparkSession.read.parquet(*paths.values())
    ways = {
        "whole": lambda: attach_history(train, found, spec, join),
        "earlier": lambda: attach_earlier(train, train, spec),
        "others": lambda: attach_others(train, spec),
    }
    if history not in ways:
        raise ValueError(f"history is one of {sorted(ways)}, not {history!r}")
    return ways[history](), attach_history(test, found, spec, join)


def relative_target(block: DataFrame, spec: Spec, name: str = "relative_measure") -> DataFrame:
    """The measure against the entity's training mean: the shape of the day without the level.

    The history baseline predicts 1 everywhere here, so any skill is skill about the slot.
    """
    return block.withColumn(name, index_of(F.col(spec.measure), F.col("hist_mean")))


def leakage_guard(features: FeatureSet, spec: Spec) -> None:
    """Refuse a feature list holding a barred column, and say why each is barred."""
    caught = [f"{c} ({spec.barred[c]})" for c in sorted(set(features.names) & set(spec.barred))]
    if caught:
        raise ValueError("barred columns used as features: " + ", ".join(caught))


def leakage_evidence(
    df: DataFrame,
    measure: str,
    candidates: Sequence[str],
    parts: Sequence[str] = (),
    max_corr: float = 0.95,
    tolerance: float = 0,
    min_share: float = 0.99,
) -> DataFrame:
    """Candidates the data itself speaks against: near copies or summands of the measure."""
    strong = corr_with(df, measure, candidates).where(F.abs("r") > max_corr)
    report = strong.select("column", F.lit("correlates with the measure").alias("reason"))
    suspects = [c for c in candidates if c in parts]
    if suspects:
        share = component_identity(df, measure, parts, tolerance)
        named = share.where(F.col("share") >= min_share).select(
            F.explode(F.array(*[F.lit(c) for c in suspects])).alias("column"),
            F.lit("is a summand of the measure").alias("reason"),
        )
        report = report.unionByName(named)
    return report
