import random

import pytest
from pyspark.sql import functions as F

from dayshape.operators import reports, star
from dayshape.presets import ROADS

# An id that exists, closed by a quote, bracket or comment with SQL behind it.
HOSTILE = [f"E1{close} {sql}" for close in ("'", "')", '"', "/*") for sql in ("or true", "; select 2")]


@pytest.fixture(scope="module")
def small(spark):
    region = spark.createDataFrame([("1", "North", 2, 1)],
                                   "region_id string, region_name string, entities bigint, "
                                   "authorities bigint")
    entity = spark.createDataFrame(
        [("E1", "1", "Wold", "Mill Way", "PA", "trunk", 1, 53.25, 0.75, 2004, 2018),
         ("E2", None, "Fenby", "Reed Lane", "MB", "lane", 0, None, None, 2001, 2002)],
        "count_point_id string, region_id string, local_authority_name string, road_name string, "
        "road_category string, road_type string, is_major int, latitude double, "
        "longitude double, first_period int, last_period int")
    profile = spark.createDataFrame(
        [("E1", 11, 6, 711.04, 1.3), ("E1", 15, 6, 383.0, 0.7), ("E2", 11, 3, 40.0, 2.2),
         ("E2", 9, 30, 20.0, 1.3)],
        "count_point_id string, hour int, observations bigint, mean_measure double, "
        "peak_index double")
    annual = spark.createDataFrame([("E1", 2000, 100), ("E2", 2000, None), ("E1", 2001, 300)],
                                   "count_point_id string, year int, flow int")
    return star.Star(region, entity, profile, annual)


def test_entity_profile_and_hostile_ids(small, rows):
    found = reports.entity_profile(small, ROADS, "E1")
    assert rows(found) == [(11, 6, 711.0, 1.3, "Wold", "PA"), (15, 6, 383.0, 0.7, "Wold", "PA")]
    for text in [*HOSTILE, "nobody"]:
        assert reports.entity_profile(small, ROADS, text).count() == 0
    for text in ("1 or true", "0); select 1", "many"):
        with pytest.raises(ValueError, match="invalid literal"):
            reports.entity_profile(small, ROADS, "E1", text)
        with pytest.raises(ValueError, match="invalid literal"):
            reports.sharpest(small, ROADS, ["road_name"], limit=text)
    assert small.region.count() == 1


def test_class_peak_and_pivot(small, rows):
    table = reports.class_peak(small, ROADS, min_observations=5)
    assert rows(table) == [("MB", 9, 1, 1.3, 20.0), ("PA", 11, 1, 1.3, 711.0),
                           ("PA", 15, 1, 0.7, 383.0)]
    pivot = reports.class_pivot(table, ROADS, small.entity)
    assert rows(pivot, "hour", "MB", "PA") == [(11, None, 1.3), (15, None, 0.7), (9, 1.3, None)]
    assert reports.class_pivot(table, ROADS, small.entity, min_links=2).count() == 0


def test_sharpest_orders_ties_by_entity(small):
    top = reports.sharpest(small, ROADS, ["road_name"], limit=2, min_observations=5)
    assert [tuple(r) for r in top.collect()] == [("Mill Way", 11, 1.3, 711.0, 6),
                                                 ("Reed Lane", 9, 1.3, 20.0, 30)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_trend_region_and_latest(small, rows):
    assert rows(reports.annual_trend(small.annual, ROADS, "flow")) == [(2000, 1, 100.0),
                                                                      (2001, 1, 300.0)]
    assert rows(reports.region_summary(small, ROADS)) == [("North", 1, 547.0, 1.3)]
    assert reports.region_summary(small, ROADS, min_links=2).count() == 0
    assert rows(reports.latest_period(small.annual, small.profile, ROADS, "flow")) == [
        (2001, 300.0, 2)]
    peaks = small.profile.groupBy("count_point_id").agg(F.max("peak_index").alias("max_peak_index"))
    assert rows(reports.entity_peak_map(small, peaks, ROADS)) == [("E1", 53.25, 0.75, 1.3, 1)]


def test_dedupe_is_stable_under_shuffling(spark, rows):
    data = [(i % 7, i % 3, f"v{i}") for i in range(200)]
    expected = None
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k int, p int, v string").repartition(6)
        single = star.dedupe_by_key(df, ["k"], ["p", "v"])
        found = rows(single)
        assert len(found) == 7 and (expected is None or found == expected)
        expected = found
    planned = star.dedupe_by_key(df, ["k"], ["p", "v"])
    plan = planned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_keys_are_repaired_and_unknown_rows_dropped(spark, small, rows):
    child = spark.createDataFrame([("a", "1"), ("b", "9"), ("c", None)], "id string, region_id string")
    assert rows(star.repair_fk(child, "region_id", small.region, "region_id"), "id", "region_id") == [
        ("a", "1"), ("b", None), ("c", None)]
    fact = spark.createDataFrame([("E1", 1), ("E404", 2), (None, 3)], "count_point_id string, x int")
    assert rows(star.keep_known(fact, small.entity, ROADS), "x") == [(1,)]
    assert star.drop_report(fact, small.entity, ROADS).first()[0] == 2
    annual = spark.createDataFrame(
        [("E1", 1999, 1), ("E1", 2000, 5), ("E1", 2000, 4), ("E404", 2000, 7)],
        "count_point_id string, year int, flow int")
    assert rows(star.annual_fact(annual, small.entity, ROADS, ["flow"]), "year", "flow") == [(2000, 4)]
