"""Least squares in closed form: one aggregate over the rows, a small system in the driver.

Categories are never spread into vectors. Rows are folded to one cell per combination of
categories, with counts and sums of products of the numeric columns; the cells give every entry of
the normal equations: sums per pair of numbers, per category and number, and counts per pair of
categories. What reaches the driver is one number per pair of columns, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from itertools import combinations, combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayshape.operators.features import relative_target
from dayshape.spec import FeatureSet, Spec

INTERCEPT = "intercept"
MOST_COLUMNS = 4096
# A direction in which the columns vary less than this, against the most varied, is no direction.
SINGULAR = 1e-9

Key = tuple[str, str | None]


@dataclass(frozen=True)
class Line:
    """Weights by (column, category); the category is null for numbers and the intercept."""

    features: FeatureSet
    weights: Mapping[Key, float]
    n_rows: int

    def table(self, spark) -> DataFrame:
        """(feature, category, weight); a category is its value as text, null for null."""
        rows = [
            (column, None if told in (None, "") else told[1:], float(w))
            for (column, told), w in sorted(self.weights.items(), key=str)
        ]
        return spark.createDataFrame(rows, "feature string, category string, weight double")

    def prediction(self) -> Column:
        """The forecast of a row, as an expression. A category that training never saw adds nothing."""
        total = F.lit(self.weights[INTERCEPT, None])
        for name in self.features.numeric:
            total = total + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * self.weights[name, None]
        for name in self.features.categorical:
            own = {c: w for (column, c), w in self.weights.items() if column == name}
            if not own:
                continue
            known = F.create_map(*[F.lit(x) for c, w in own.items() for x in (c, float(w))])
            total = total + F.coalesce(F.element_at(known, category(name)), F.lit(0.0))
        return total


def category(name: str) -> Column:
    """Null is a category of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))


def cells(df: DataFrame, features: FeatureSet, label: str) -> DataFrame:
    """A row per combination of categories: n and the sums of products of numbers and label.

    A missing number counts as 0, a row without a label not at all. Numbers are taken around a
    provisional centre, the values of any one row, so little is lost to cancellation.
    """
    numbers = [*features.numeric, label]
    known = df.where(F.col(label).isNotNull()).select(
        *[category(c).alias(c) for c in features.categorical],
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"__{i}") for i, c in enumerate(numbers)],
    )
    values = [F.col(f"__{i}").alias(f"c{i}") for i in range(len(numbers))]
    centre = known.select(F.struct(*values).alias("c")).limit(1).scalar()
    around = known.withColumn("c", centre).select(
        *features.categorical,
        *[(F.col(f"__{i}") - F.col(f"c.c{i}")).alias(f"x{i}") for i in range(len(numbers))],
        *[F.col(f"c.c{i}").alias(f"c{i}") for i in range(len(numbers))],
    )
    pairs = combinations_with_replacement(range(len(numbers)), 2)
    return around.groupBy(*features.categorical).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.max(f"c{i}").alias(f"c{i}") for i in range(len(numbers))],
        *[F.sum(f"x{i}").alias(f"s{i}") for i in range(len(numbers))],
        *[F.expr(f"sum(x{i} * x{j}) AS p{i}_{j}") for i, j in pairs],
    )


def moments_of(folded: DataFrame, features: FeatureSet) -> DataFrame:
    """The cells summed up over everything, over each category, and over each pair of categories."""
    names = list(features.categorical)
    if not names:
        return folded
    sums = [c for c in folded.columns if c not in names and c[0] in "nsp"]
    centres = [c for c in folded.columns if c not in names and c[0] == "c"]
    sets = [[], *[[c] for c in names], *[list(p) for p in combinations(names, 2)]]
    return folded.groupingSets([[F.col(c) for c in s] for s in sets], *names).agg(
        *[F.sum(c).alias(c) for c in sums],
        *[F.max(c).alias(c) for c in centres],
    )


def fit_line(df: DataFrame, features: FeatureSet, label: str) -> Line | None:
    """Least squares of the label on numbers and categories; None without a row.

    Of each categorical column the first category has weight 0. Directions that the rows don't
    determine (a constant column, a copy of another) are left at the smallest weights.
    """
    names, numeric = list(features.categorical), list(features.numeric)
    rows = moments_of(cells(df, features, label), features).limit(MOST_COLUMNS**2 + 1).collect()
    if len(rows) > MOST_COLUMNS**2:
        raise ValueError(f"more than {MOST_COLUMNS} columns")
    k = len(numeric) + 1  # the label is the last
    whole = next((r for r in rows if r["n"] is not None and all(r[c] is None for c in names)), None)
    if whole is None or not whole["n"]:
        return None
    keys: list[Key] = [(c, None) for c in numeric]
    for c in names:
        own = sorted(r[c] for r in rows if r[c] is not None and all(r[o] is None for o in names if o != c))
        keys += [(c, x) for x in own[1:]]
    place = {key: i for i, key in enumerate(keys)}
    size = len(keys)
    n = whole["n"]
    gram, total = np.zeros((size, size)), np.zeros(size)
    against, label_sum = np.zeros(size), whole[f"s{k - 1}"]
    for i in range(k - 1):
        total[i], against[i] = whole[f"s{i}"], whole[f"p{i}_{k - 1}"]
        for j in range(i, k - 1):
            gram[i, j] = gram[j, i] = whole[f"p{i}_{j}"]
    for r in rows:
        here = [place[c, r[c]] for c in names if r[c] is not None and (c, r[c]) in place]
        told = sum(r[c] is not None for c in names)
        if told == 1 and here:
            at = here[0]
            total[at] = gram[at, at] = r["n"]
            against[at] = r[f"s{k - 1}"]
            for i in range(k - 1):
                gram[at, i] = gram[i, at] = r[f"s{i}"]
        elif told == 2 and len(here) == 2:
            gram[here[0], here[1]] = gram[here[1], here[0]] = r["n"]
    # Around the means, the intercept drops out of the system.
    spread = gram - np.outer(total, total) / n
    target = against - total * label_sum / n
    scale = np.sqrt(np.maximum(np.diag(spread), 0))
    scale[scale == 0] = 1
    found = np.linalg.pinv(spread / np.outer(scale, scale), rcond=SINGULAR, hermitian=True) @ (target / scale) / scale
    centres = np.array([whole[f"c{i}"] for i in range(k)])
    means = total / n
    means[: k - 1] += centres[: k - 1]
    weights = {key: float(w) for key, w in zip(keys, found, strict=True)}
    weights[INTERCEPT, None] = float(label_sum / n + centres[k - 1] - means @ found)
    return Line(features, weights, n)


def predict_line(line: Line, block: DataFrame, split: str, name: str, layout: tuple[str, ...], actual: str, scale: str | None = None) -> DataFrame:
    """Scored rows in the long layout of all predictions; with ``scale``, forecasts are times that column."""
    forecast = line.prediction()
    if scale is not None:
        forecast = forecast * F.col(scale)
    return block.select(
        F.lit(split).alias("split"),
        F.lit(name).alias("model"),
        *layout,
        F.col(actual).cast("double").alias("actual"),
        forecast.alias("prediction"),
    )


def relative_forecast(
    train: DataFrame, test: DataFrame, spec: Spec, features: FeatureSet, split: str, name: str = "relative line"
) -> DataFrame | None:
    """A line fitted on the measure against the entity's training mean, scaled back to the measure.

    Both blocks carry the training history, so what is fitted is the shape of the slots alone and a
    forecast has the level of its entity. Rows whose history isn't positive have no ratio to learn
    from and are forecast at their history times the common shape. None without a training row.
    """
    ratio = "__ratio"
    line = fit_line(relative_target(train, spec, ratio), features, ratio)
    if line is None:
        return None
    layout = (spec.entity, spec.slot, spec.klass)
    return predict_line(line, test, split, name, layout, spec.measure, "hist_mean")
