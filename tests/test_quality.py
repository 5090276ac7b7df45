import numpy as np
import pytest
from pyspark.sql import functions as F

from dayshape.operators import quality


def test_moments_histogram_and_fences(spark, rows):
    rng = np.random.default_rng(2)
    x = np.round(rng.lognormal(4, 1, 2000), 2)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    row = quality.moments(df, "x").first()
    centred = x - x.mean()
    assert row["mean"] == pytest.approx(x.mean(), abs=0.005)
    assert row["median"] == sorted(x)[999]
    assert row["sd"] == pytest.approx(x.std(ddof=1), abs=0.005)
    assert row["skewness"] == pytest.approx((centred**3).mean() / x.std() ** 3, abs=5e-4)
    assert row["kurtosis"] == pytest.approx((centred**4).mean() / x.var() ** 2 - 3, abs=5e-4)
    bins = quality.histogram(df, "x", width=100)
    assert bins.agg(F.sum("n_rows")).first()[0] == len(x)
    fences = quality.iqr_outliers(df, "x").first()
    q1, q3 = sorted(x)[499], sorted(x)[1499]
    beyond = (x < q1 - 1.5 * (q3 - q1)) | (x > q3 + 1.5 * (q3 - q1))
    assert (fences["q1"], fences["q3"], fences["outliers"]) == (q1, q3, int(beyond.sum()))
    clipped = quality.clip_at_quantile(df, "x", 0.99).agg(F.max("clipped")).first()[0]
    assert clipped == pytest.approx(np.quantile(x, 0.99), rel=1e-12)


def test_correlations_match_numpy_even_far_from_zero(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(1e6, 1, 3000)
    b = a * 2 + rng.normal(0, 1, 3000)
    c = rng.normal(0, 1, 3000)
    data = [(float(i), float(j), float(k), 1.0) for i, j, k in zip(a, b, c)]
    data += [(1.0, None, 2.0, 1.0)]
    df = spark.createDataFrame(data, "a double, b double, c double, flat double")
    found = {(r["left"], r["right"]): r["r"]
             for r in quality.corr_matrix(df, ["a", "b", "c", "flat"]).collect()}
    truth = np.corrcoef([a, b, c])
    for i, left in enumerate("abc"):
        for j, right in enumerate("abc"):
            assert found[left, right] == pytest.approx(truth[i, j], abs=2e-6)
    assert found["a", "flat"] is None and found["flat", "flat"] == 1.0
    assert len(found) == 16


def test_correlations_hold_with_means_far_beyond_the_spread(spark):
    rng = np.random.default_rng(6)
    steps = rng.integers(-50, 50, (2000, 2)) / 8
    a, b = steps[:, 0], steps[:, 0] + steps[:, 1]
    df = spark.createDataFrame([(float(4e9 + i), float(j - 4e9)) for i, j in zip(a, b)], "a double, b double")
    found = {(r["left"], r["right"]): r["r"] for r in quality.corr_matrix(df, ["a", "b"]).collect()}
    assert found["a", "b"] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-6)
    assert quality.corr_matrix(df.limit(0), ["a", "b"]).where("r is not null and left <> right").count() == 0


def test_missing_values_and_identity(spark, rows):
    df = spark.createDataFrame(
        [("PA", 1.0, 3, 1, 2), ("MB", None, 5, None, 5), ("MB", None, 9, 4, 4)],
        "klass string, length double, total int, p int, q int",
    )
    assert rows(quality.null_profile(df, ["length", "p", "q"])) == [
        (3, "length", 2), (3, "p", 1), (3, "q", 0)]
    assert rows(quality.missing_by_class(df, "klass", "length")) == [
        ("MB", 2, 2, 100.0), ("PA", 1, 0, 0.0)]
    identity = quality.component_identity(df, "total", ["p", "q"]).first()
    assert (identity["n_rows"], identity["n_exact"]) == (3, 2)
    assert rows(quality.cardinality(df, ["klass"], ["total"])) == [
        ("approximate", "total", 3), ("exact", "klass", 2)]


def test_constraint_reports(spark, rows):
    child = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "ghost"), (None, "a")],
                                  "id int, parent string")
    parent = spark.createDataFrame([("a",), ("b",)], "key string")
    assert rows(quality.key_violations(child, ["id"])) == [(1, 2), (None, 1)]
    assert rows(quality.fk_violations(child, "parent", parent, "key")) == [("ghost", 1)]
    checks = quality.check_violations(
        child, {"small id": F.col("id") < 3, "known": F.col("parent") != "ghost"})
    assert rows(checks) == [("known", 1), ("small id", 1)]
    assert rows(quality.notnull_violations(child, ["id", "parent"])) == [("id", 1), ("parent", 1)]


def test_null_profiles_cover_every_column_of_every_table(spark, rows):
    one = spark.createDataFrame([(1, None, [1]), (2, "x", None)], "a int, b string, c array<int>")
    found = rows(quality.null_profiles({"one": one, "none": one.limit(0).select("a")}), "table", "column", "n_rows", "nulls")
    assert found == [("none", "a", 0, 0), ("one", "a", 2, 0), ("one", "b", 2, 1), ("one", "c", 2, 1)]
