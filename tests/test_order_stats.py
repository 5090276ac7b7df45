import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayshape.operators.order_stats import log_bin, quantile_row, quantiles

SHARES = [0.0, 0.01, 0.25, 0.5, 0.9, 0.995, 1.0]


def samples():
    rng = np.random.default_rng(5)
    return {
        "one": [3.5],
        "pair": [-1.0, 4.0],
        "ties": [2.0] * 40 + [1.0] * 3 + [9.0],
        "signs": list(np.round(rng.normal(0, 50, 501), 2)) + [0.0, -0.0],
        "wide": list(rng.lognormal(0, 6, 700)),
        "tiny": list(rng.random(300) * 1e-12),
        "counts": [float(v) for v in rng.poisson(400, 800)],
    }


@pytest.fixture(scope="module")
def frame(spark):
    data = [(g, float(v)) for g, values in samples().items() for v in values]
    data += [("one", None), (None, 5.0), (None, 6.0)]
    return spark.createDataFrame(data, "g string, x double").repartition(5)


def by_key(df):
    return {(r["g"], r["share"]): r["value"] for r in df.collect()}


def test_discrete_quantiles_are_the_ranked_elements(frame):
    found = by_key(quantiles(frame, "x", SHARES, by=["g"]))
    for g, values in {**samples(), None: [5.0, 6.0]}.items():
        ordered = sorted(values)
        for s in SHARES:
            rank = max(1, len(ordered) - math.floor(len(ordered) - s * len(ordered)))
            assert found[g, s] == ordered[rank - 1], (g, s)


def test_interpolated_quantiles_match_numpy(frame):
    found = by_key(quantiles(frame, "x", SHARES, by=["g"], interpolate=True))
    for g, values in samples().items():
        for s in SHARES:
            assert found[g, s] == pytest.approx(np.quantile(values, s), rel=1e-12, abs=1e-300)


def test_whole_column_and_integer_values(spark):
    df = spark.range(1, 1002).withColumn("x", F.col("id").cast("int"))
    row = quantile_row(df, "x", [0.5, 0.25]).first()
    assert (row["q0"], row["q1"]) == (501, 251)
    assert isinstance(row["q0"], int)


def test_bins_never_decrease(spark):
    rng = np.random.default_rng(1)
    values = np.unique(np.concatenate([
        rng.normal(0, 1, 500), rng.lognormal(0, 30, 500), -rng.lognormal(0, 30, 500),
        [0.0, 5e-324, -5e-324, 1.7e308, -1.7e308],
    ]))
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    bins = [r[0] for r in df.orderBy("x").select(log_bin(F.col("x"))).collect()]
    assert bins == sorted(bins)


def test_a_third_of_equal_rows_is_counted_not_moved(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id").cast("double")).alias("x")
    )
    values = sorted(5.0 if i % 3 == 0 else float(i) for i in range(9000))
    row = quantile_row(df, "x", [0.2, 0.5]).first()
    assert (row["q0"], row["q1"]) == (values[1799], values[4499])


def test_nan_and_infinities_are_values_nan_last(spark):
    inf, nan = float("inf"), float("nan")
    data = [1.0, 2.0, nan, nan, nan, -inf, inf, inf]
    df = spark.createDataFrame([(v,) for v in data], "x double")
    found = [r["value"] for r in quantiles(df, "x", [0.0, 0.25, 0.5, 0.6, 1.0]).orderBy("share").collect()]
    assert found[:4] == [-inf, 1.0, inf, inf] and math.isnan(found[4])


def test_many_values_in_one_relative_bin_are_spread_over_parts(spark):
    df = spark.range(50_000).select((1.7e9 + F.col("id")).alias("x"))
    assert df.select(log_bin(F.col("x"))).distinct().count() == 1
    found = quantiles(df, "x", [0.25, 0.5], interpolate=True).orderBy("share").collect()
    assert [r["value"] for r in found] == [1.7e9 + 49_999 * s for s in (0.25, 0.5)]
