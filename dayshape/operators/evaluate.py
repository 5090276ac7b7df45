"""Scores and diagnostics over predictions.

Predictions of all models and splits form one long table (split, model, entity, slot, class,
actual, prediction). Every summary is one aggregate over all its rows; adding a class, slot or
region to the keys gives the same figures per group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayshape.operators.order_stats import quantiles
from dayshape.spec import Spec

MODEL_KEYS = ("split", "model")
HISTORY_BASELINE = "entity_history"
MEAN_BASELINE = "global_mean"


def _error_sums(prediction: Column, actual: Column) -> list[Column]:
    error = prediction - actual
    return [
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
    ]


def _metrics(mse: Column, mae: Column, variance: Column) -> dict[str, Column]:
    """R2 sets the squared error against the spread of the scored rows themselves."""
    return {
        "rmse": F.sqrt(mse),
        "mae": mae,
        "r2": F.when(variance > 0, 1 - mse / variance),
    }


def score(predictions: DataFrame, by: Sequence[str] = MODEL_KEYS) -> DataFrame:
    """RMSE, MAE and R2 per group, in one pass, all over the rows with both values known."""
    actual, prediction = F.col("actual"), F.col("prediction")
    known = actual.isNotNull() & prediction.isNotNull()
    sums = predictions.groupBy(*by).agg(
        F.count_if(known).alias("n_rows"),
        *_error_sums(prediction, actual),
        F.var_pop(F.when(known, actual)).alias("variance"),
    )
    found = _metrics(F.col("mse"), F.col("mae"), F.col("variance"))
    return sums.select(*by, "n_rows", *[c.alias(n) for n, c in found.items()])


def with_efficiency(results: DataFrame, seconds: DataFrame) -> DataFrame:
    """Add training seconds and R2 bought per second."""
    per_second = F.when(F.col("train_seconds") > 0, F.col("r2") / F.col("train_seconds"))
    return results.join(seconds, list(MODEL_KEYS), "left").withColumn("r2_per_second", per_second)


def baseline_predictions(
    train: DataFrame, test: DataFrame, spec: Spec, split: str
) -> DataFrame:
    """The two naive forecasts of each test row, in the layout of model predictions."""
    overall = train.agg(F.avg(spec.measure).alias("m")).scalar()
    forecasts = F.array(
        F.struct(F.lit(MEAN_BASELINE).alias("model"), overall.alias("prediction")),
        F.struct(F.lit(HISTORY_BASELINE).alias("model"), F.col("hist_mean").alias("prediction")),
    )
    return test.select(
        F.lit(split).alias("split"),
        spec.entity,
        spec.slot,
        spec.klass,
        F.col(spec.measure).cast("double").alias("actual"),
        F.inline(forecasts),
    ).select("split", "model", spec.entity, spec.slot, spec.klass, "actual", "prediction")


def trivial_baselines(train: DataFrame, test: DataFrame, spec: Spec, split: str) -> DataFrame:
    """Scores of the two naive forecasts, by the rules of every other score.

    ``train`` may be the plain training rows: only the mean of their measure is taken.
    """
    return score(baseline_predictions(train, test, spec, split))


def store_predictions(predictions: DataFrame, path: str) -> DataFrame:
    """The long table with a folder per split and model: summaries read those they ask for.

    Rows of one model are dealt out by adaptive execution, so a large model is many files.
    """
    predictions.hint("rebalance", *MODEL_KEYS).write.mode("overwrite").partitionBy(*MODEL_KEYS).parquet(path)
    # Folder names are texts, whatever they look like.
    schema = predictions.schema
    return predictions.sparkSession.read.schema(schema).parquet(path).select(*predictions.columns)


def results_table(*parts: DataFrame) -> DataFrame:
    """Baselines and models of all splits in one table; figures a part lacks stay null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def skill(results: DataFrame, baseline: str = HISTORY_BASELINE) -> DataFrame:
    """Gain over the history baseline, absolute and as a share of what it leaves unexplained."""
    base = F.max(F.when(F.col("model") == baseline, F.col("r2"))).over(
        Window.partitionBy("split")
    )
    left_over = 1 - F.col("base_r2")
    return (
        results.withColumn("base_r2", base)
        .withColumn("r2_gain", F.col("r2") - F.col("base_r2"))
        .withColumn("skill", F.when(left_over > 0, F.col("r2_gain") / left_over))
        .drop("base_r2")
    )


def best_breakdown(
    results: DataFrame,
    baselines: Sequence[str] = (MEAN_BASELINE, HISTORY_BASELINE),
    reference: str = HISTORY_BASELINE,
) -> DataFrame:
    """Best model per split: its R2 as baseline + added by the model, and what is unexplained."""
    is_model = ~F.col("model").isin(list(baselines))
    best = F.max(F.when(is_model, F.struct("r2", "model")))
    return (
        results.groupBy("split")
        .agg(
            best.alias("best"),
            F.max(F.when(F.col("model") == reference, F.col("r2"))).alias("baseline_r2"),
        )
        .select(
            "split",
            F.col("best.model").alias("best_model"),
            F.col("best.r2").alias("best_r2"),
            "baseline_r2",
            (F.col("best.r2") - F.col("baseline_r2")).alias("added_r2"),
            (1 - F.col("best.r2")).alias("unexplained"),
        )
    )


def model_rank(results: DataFrame) -> DataFrame:
    order = Window.partitionBy("split").orderBy(F.desc_nulls_last("r2"), "model")
    return results.select("split", "model", "r2", F.row_number().over(order).alias("place"))


def align_models(results: DataFrame, value: str) -> DataFrame:
    """One row per model name with its value in each split there is; null where it was not run."""
    return results.groupBy("model").pivot("split").agg(F.max(value))


def profile_actual_pred(predictions: DataFrame, spec: Spec) -> DataFrame:
    return predictions.groupBy(*MODEL_KEYS, spec.slot).agg(
        F.avg("actual").alias("mean_actual"), F.avg("prediction").alias("mean_prediction")
    )


def residual_by_slot(predictions: DataFrame, spec: Spec) -> DataFrame:
    """Systematic error per slot, which an overall score averages away."""
    residual = F.col("prediction") - F.col("actual")
    return predictions.groupBy(*MODEL_KEYS, spec.slot).agg(
        F.avg(residual).alias("mean_residual"),
        F.stddev_samp(residual).alias("sd_residual"),
        F.count(residual).alias("n_rows"),
    )


def error_by_class(predictions: DataFrame, spec: Spec) -> DataFrame:
    residual = F.col("prediction") - F.col("actual")
    return (
        predictions.groupBy(*MODEL_KEYS, spec.klass)
        .agg(
            F.avg(F.abs(residual)).alias("mae"),
            F.avg(residual).alias("bias"),
            F.avg("actual").alias("mean_actual"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        .orderBy(*MODEL_KEYS, F.desc("mean_actual"), spec.klass)
    )


def density_2d(predictions: DataFrame, cells: int = 45, share: float = 0.995) -> DataFrame:
    """Rows per cell of a square grid over (actual, predicted), up to a high quantile of actual.

    The upper edge belongs to the last cell. What lies below 0 is in cell -1, what lies above the
    limit in cell ``cells``, what is null in cell null, so the counts add up to all rows.
    """
    limits = quantiles(
        predictions, "actual", [share], by=list(MODEL_KEYS), interpolate=True
    ).select(*MODEL_KEYS, F.col("value").alias("limit"))
    limited = predictions.join(limits, list(MODEL_KEYS), "left")
    limit = F.col("limit")

    def cell(name: str) -> Column:
        x = F.col(name)
        inside = F.least(F.floor(x * cells / limit), F.lit(cells - 1))
        edge = F.when(x < 0, -1).when(x > limit, cells)
        return F.when(x.isNotNull(), edge.when(limit > 0, inside).otherwise(0)).cast("bigint")

    return limited.groupBy(
        *MODEL_KEYS, cell("actual").alias("actual_cell"), cell("prediction").alias("predicted_cell")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


def split_profile(blocks: Mapping[str, tuple[DataFrame, DataFrame]], spec: Spec) -> DataFrame:
    """Rows and target spread of the training and test block of each split."""

    def describe(split: str, block: str, rows: DataFrame) -> DataFrame:
        return rows.agg(
            F.count(F.lit(1)).alias("n_rows"), F.stddev_pop(spec.measure).alias("target_sd")
        ).select(F.lit(split).alias("split"), F.lit(block).alias("block"), "n_rows", "target_sd")

    parts = [
        describe(split, block, rows)
        for split, pair in blocks.items()
        for block, rows in zip(("train", "test"), pair, strict=True)
    ]
    return reduce(DataFrame.unionByName, parts)


def top_features(weights: DataFrame, value: str = "weight", limit: int = 15) -> DataFrame:
    """The features with the largest weight in absolute terms."""
    return weights.orderBy(F.desc_nulls_last(F.abs(value)), "feature").limit(limit)


def importance_share(weights: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Total importance of named groups of input columns; one-hot slots count to their column.

    A one-hot slot is named after its column's encoded form, "<column>_hot", and its category.
    """
    owner = {column: name for name, columns in groups.items() for column in columns}
    label = F.lit("other")
    for column in sorted(owner, key=len):
        own = (F.col("feature") == column) | F.col("feature").startswith(f"{column}_hot_")
        label = F.when(own, F.lit(owner[column])).otherwise(label)
    return weights.groupBy(label.alias("feature_group")).agg(
        F.sum("weight").alias("importance")
    )
