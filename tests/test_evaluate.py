import numpy as np
import pytest
from pyspark.sql import functions as F

from dayshape.operators import evaluate
from dayshape.presets import ROADS


@pytest.fixture(scope="module")
def predictions(spark):
    data = [("primary", "m", "A", 7, "PA", 10.0, 12.0), ("primary", "m", "A", 8, "PA", 20.0, 16.0),
            ("primary", "m", "B", 7, "MB", 6.0, 6.0), ("primary", "flat", "B", 7, "MB", 5.0, 4.0)]
    return spark.createDataFrame(
        data, "split string, model string, count_point_id string, hour int, "
              "road_category string, actual double, prediction double")


def test_scores_by_hand(predictions, rows):
    found = {r["model"]: r for r in evaluate.score(predictions).collect()}
    assert found["m"]["rmse"] == pytest.approx((20 / 3) ** 0.5)
    assert found["m"]["mae"] == 2 and found["m"]["n_rows"] == 3
    assert found["m"]["r2"] == pytest.approx(1 - 20 / 104)
    assert found["flat"]["r2"] is None
    by_class = evaluate.error_by_class(predictions.where("model = 'm'"), ROADS)
    assert rows(by_class, "road_category", "mae", "bias", "mean_actual", "n_rows") == [
        ("MB", 0.0, 0.0, 6.0, 1), ("PA", 3.0, -1.0, 15.0, 2)]
    slots = evaluate.residual_by_slot(predictions.where("model = 'm'"), ROADS)
    assert rows(slots, "hour", "mean_residual", "n_rows") == [(7, 1.0, 2), (8, -4.0, 1)]
    shape = evaluate.profile_actual_pred(predictions.where("model = 'm'"), ROADS)
    assert rows(shape, "hour", "mean_actual", "mean_prediction") == [(7, 8.0, 9.0),
                                                                    (8, 20.0, 16.0)]


def test_tables_over_results(spark, rows):
    base = spark.createDataFrame(
        [("primary", "global_mean", -0.1), ("primary", "entity_history", 0.8),
         ("control", "entity_history", 0.5)], "split string, model string, r2 double")
    fitted = spark.createDataFrame(
        [("primary", "a", 0.85, 2.0), ("primary", "tuned", 0.9, 0.0), ("control", "a", 0.4, 4.0)],
        "split string, model string, r2 double, train_seconds double")
    table = evaluate.results_table(base, fitted)
    assert table.where("train_seconds IS NULL").count() == 3
    skilled = evaluate.skill(table)
    assert dict(rows(skilled.where("split = 'primary'"), "model", "skill")) == pytest.approx(
        {"a": 0.25, "tuned": 0.5, "entity_history": 0.0, "global_mean": -4.5})
    aligned = evaluate.align_models(skilled, "skill").select("model", "primary", "control")
    assert rows(aligned.where("model = 'tuned'")) == [("tuned", pytest.approx(0.5), None)]
    best = {r["split"]: r for r in evaluate.best_breakdown(table).collect()}
    assert best["primary"]["best_model"] == "tuned"
    assert best["primary"]["added_r2"] == pytest.approx(0.1)
    assert best["control"]["added_r2"] == pytest.approx(-0.1)
    places = rows(evaluate.model_rank(table).where("place = 1"), "split", "model")
    assert places == [("control", "entity_history"), ("primary", "tuned")]
    rated = evaluate.with_efficiency(table.drop("train_seconds"), fitted.drop("r2"))
    assert dict(rows(rated.where("model = 'a'"), "split", "r2_per_second")) == pytest.approx(
        {"primary": 0.425, "control": 0.1})


def test_baselines_agree_with_scored_rows(spark, rows):
    train = spark.createDataFrame([("A", 1.0), ("A", 3.0), ("B", 8.0)],
                                  "count_point_id string, all_motor_vehicles double")
    test = spark.createDataFrame(
        [("A", 7, "PA", 4.0, 2.0), ("B", 8, "MB", 9.0, 8.0)],
        "count_point_id string, hour int, road_category string, all_motor_vehicles double, "
        "hist_mean double")
    wide = evaluate.trivial_baselines(train, test, ROADS, "primary")
    long = evaluate.score(evaluate.baseline_predictions(train, test, ROADS, "primary"))
    one, other = ({r["model"]: (r["n_rows"], r["rmse"], r["mae"], r["r2"]) for r in d.collect()}
                  for d in (wide, long))
    assert one.keys() == other.keys()
    for model in one:
        assert one[model] == pytest.approx(other[model])
    assert one["entity_history"][2] == 1.5


def test_density_counts_every_row(spark):
    rng = np.random.default_rng(4)
    actual = rng.gamma(2, 50, 4000)
    data = [("s", "m", float(a), float(a * rng.uniform(0.8, 1.2))) for a in actual]
    df = spark.createDataFrame(data, "split string, model string, actual double, prediction double")
    odd = [("s", "m", -1.0, 5.0), ("s", "m", None, 5.0), ("s", "m", 5.0, None)]
    limit = np.quantile(actual.tolist() + [-1.0, 5.0], 0.995)
    cells = evaluate.density_2d(df.unionAll(spark.createDataFrame(odd, df.schema)))
    assert cells.agg(F.sum("n_rows")).first()[0] == len(data) + 3
    beyond = cells.where("actual_cell = 45").agg(F.sum("n_rows")).first()[0]
    assert beyond == (actual > limit).sum()
    assert {r[0] for r in cells.where("actual_cell < 0 or actual_cell is null").select("actual_cell").collect()} == {-1, None}


def test_stored_predictions_prune_and_keep_their_texts(spark, rows, tmp_path):
    df = spark.createDataFrame(
        [("1", "007", "E1", 8, "PA", 1.0, 2.0), ("1", "lin ear/on x", "E1", 8, "PA", 1.0, None), ("2", "007", "E2", 9, None, 3.0, 4.0)],
        "split string, model string, count_point_id string, hour int, road_category string, actual double, prediction double")
    kept = evaluate.store_predictions(df, str(tmp_path / "p"))
    assert kept.schema == df.schema and rows(kept) == rows(df)
    plan = kept.where("split = '1' and model = '007'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_naive_scores_follow_the_rule_of_all_scores(spark):
    train = spark.createDataFrame([(10.0,), (20.0,)], "all_motor_vehicles double")
    test = spark.createDataFrame(
        [("E1", 8, "PA", 12.0, 11.0), ("E1", 9, "PA", None, 11.0), ("E2", 8, "PA", 30.0, None)],
        "count_point_id string, hour int, road_category string, all_motor_vehicles double, hist_mean double")
    found = {r["model"]: r for r in evaluate.trivial_baselines(train, test, ROADS, "s").collect()}
    assert found["global_mean"]["n_rows"] == 2 and found["global_mean"]["mae"] == 9.0
    assert found["entity_history"]["n_rows"] == 1 and found["entity_history"]["mae"] == 1.0
