import numpy as np
import pytest
from pyspark.sql import functions as F

from dayshape.operators import evaluate, features, models
from dayshape.operators.normal import INTERCEPT, fit_line, relative_forecast
from dayshape.presets import ROADS
from dayshape.spec import FeatureSet, Split

SPLIT = Split("primary", train_until=2019, test_from=2023)


@pytest.fixture(scope="module")
def block(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(4000):
        a, c = rng.normal(1e6, 3), rng.normal(0, 1)
        k, g = ("x", "y", None)[i % 3], f"g{i % 11}"
        y = 2.5 * a - 7 * c + {"x": 0, "y": 30, None: -12}[k] + 3 * (i % 11) + rng.normal(0, 0.1)
        rows.append((float(a), float(c) if i % 50 else None, k, g, float(y), i))
    return spark.createDataFrame(rows, "a double, c double, k string, g string, y double, id int")


def test_one_number_is_the_regression_line(block):
    line = fit_line(block, FeatureSet((), ("a",)), "y")
    slope, intercept, n = block.agg(F.regr_slope("y", "a"), F.regr_intercept("y", "a"), F.count("y")).first()
    assert line.weights["a", None] == pytest.approx(slope, rel=1e-9)
    assert line.weights[INTERCEPT, None] == pytest.approx(intercept, rel=1e-6)
    assert line.n_rows == n


def test_numbers_and_categories_match_mllib_and_lstsq(block):
    both = FeatureSet(("k", "g"), ("a", "c"))
    line = fit_line(block, both, "y")
    mine = {r["id"]: r["p"] for r in block.select("id", line.prediction().alias("p")).collect()}
    filled = block.fillna({"c": 0.0})
    encode = models.encoder(both).fit(filled)
    scored = models.linear("y").fit(encode.transform(filled)).transform(encode.transform(filled))
    assert all(mine[r["id"]] == pytest.approx(r["prediction"], abs=0.02) for r in scored.select("id", "prediction").collect())
    data = filled.toPandas()
    x = np.column_stack([np.ones(len(data)), data["a"] - 1e6, data["c"],
                         *[(data["k"].fillna("") == v) for v in ("x", "y")], *[(data["g"] == f"g{i}") for i in range(1, 11)]]).astype(float)
    w = np.linalg.lstsq(x, data["y"] - 2.5e6, rcond=None)[0]
    assert np.allclose([mine[i] - 2.5e6 for i in data["id"]], x @ w, atol=1e-4)
    assert line.weights["c", None] == pytest.approx(w[2], abs=1e-6)


def test_undetermined_columns_and_odd_blocks(spark, block):
    copies = block.select("a", (F.col("a") * 2).alias("b"), F.lit(3.0).alias("flat"), "y")
    line = fit_line(copies, FeatureSet((), ("a", "b", "flat")), "y")
    slope = block.agg(F.regr_slope("y", "a")).first()[0]
    assert line.weights["a", None] + 2 * line.weights["b", None] == pytest.approx(slope, rel=1e-6)
    assert line.weights["flat", None] == 0
    assert fit_line(block.limit(0), FeatureSet(("k",), ("a",)), "y") is None
    assert fit_line(block.withColumn("y", F.lit(None).cast("double")), FeatureSet((), ("a",)), "y") is None
    single = fit_line(block.limit(1), FeatureSet(("k",), ("a",)), "y")
    assert single.n_rows == 1 and single.weights["a", None] == 0
    new = block.withColumn("k", F.lit("never seen")).select(fit_line(block, FeatureSet(("k",), ()), "y").prediction().alias("p"))
    assert new.where("p is null").count() == 0
    table = fit_line(block, FeatureSet(("k",), ()), "y").table(spark)
    assert {(r[0], r[1]) for r in table.collect()} == {("k", "x"), ("k", "y"), (INTERCEPT, None)}


def test_only_cells_are_summed_up(spark, block, tmp_path):
    from dayshape.operators.normal import cells, moments_of

    both = FeatureSet(("k", "g"), ("a", "c"))
    block.write.parquet(str(tmp_path / "b"))
    folded = cells(spark.read.parquet(str(tmp_path / "b")), both, "y")
    assert folded.count() == 33
    assert moments_of(folded, both).count() == 1 + 3 + 11 + 33


def test_a_relative_line_finds_the_shape_of_the_slots(spark):
    rng = np.random.default_rng(3)
    level = rng.lognormal(5, 1, 25)
    rows = []
    for i in range(5000):
        e, h, y = int(rng.integers(25)), int(rng.integers(7, 19)), int(rng.integers(2010, 2026))
        rows.append((f"E{e}", "PA", h, y, float(level[e] * (1 + 0.5 * np.sin(h)) * rng.normal(1, 0.05))))
    facts = spark.createDataFrame(rows, "count_point_id string, road_category string, hour int, year int, all_motor_vehicles double")
    train, test = features.feature_blocks(facts, ROADS, SPLIT)
    shape = FeatureSet((ROADS.slot,), ())
    scored = relative_forecast(train, test, ROADS, shape, "primary")
    base = evaluate.trivial_baselines(train, test, ROADS, "primary")
    table = evaluate.skill(evaluate.results_table(base, evaluate.score(scored)))
    skill = {r["model"]: r["skill"] for r in table.collect()}
    assert skill["relative line"] > 0.8 > skill["entity_history"] == 0
    assert relative_forecast(train.limit(0), test, ROADS, shape, "primary") is None
