import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from dayshape.operators import profile
from dayshape.presets import ROADS

SPEC = replace(ROADS, components=("cars",), attributes=("region_id", "road_category"))


def facts(spark, data):
    return spark.createDataFrame(data, "count_point_id string, hour int, cars int, "
                                       "all_motor_vehicles int")


def test_profile_by_hand(spark, rows):
    df = facts(spark, [("A", 7, 1, 10), ("A", 7, 2, 20), ("A", 7, None, 60), ("A", 8, 4, 10),
                       ("B", 7, 0, 0)])
    found = profile.peak_index(df, SPEC)
    columns = ("count_point_id", "hour", "observations", "mean_measure", "median_measure",
               "sd_measure", "mean_cars", "peak_index")
    assert rows(found, *columns) == [
        ("A", 7, 3, 30.0, 20.0, 26.46, 1.5, 1.5),
        ("A", 8, 1, 10.0, 10.0, 0.0, 4.0, 0.5),
        ("B", 7, 1, 0.0, 0.0, 0.0, 0.0, None),
    ]
    assert profile.dead_entities(found, SPEC).first()[0] == 1
    assert rows(profile.mean_index_by_slot(found, SPEC)) == [(7, 1.5), (8, 0.5)]
    assert rows(profile.entity_peak(found, SPEC, min_total=2)) == [("A", 1.5, 4)]


def test_index_averages_to_one_for_every_entity(spark):
    rng = random.Random(3)
    data = [(f"E{rng.randint(0, 30)}", rng.randint(7, 18), 1, rng.randint(1, 900))
            for _ in range(4000)]
    df = facts(spark, data)
    for table in (profile.peak_index(df, SPEC), profile.peak_index_exact(df, SPEC)):
        means = table.groupBy("count_point_id").agg(F.avg("peak_index"))
        assert all(r[1] == pytest.approx(1, abs=1e-4) for r in means.collect())


def test_level_does_not_change_the_exact_index(spark, rows):
    data = [("A", h, 1, v) for h, v in ((7, 100), (8, 250), (9, 50))]
    lane = facts(spark, data)
    motorway = lane.withColumn("all_motor_vehicles", F.col("all_motor_vehicles") * 50)
    one, other = (dict(rows(profile.peak_index_exact(d, SPEC), "hour", "peak_index"))
                  for d in (lane, motorway))
    assert one == pytest.approx(other)


def test_entity_dim_takes_the_earliest_known_value(spark, rows):
    data = [
        ("A", dt.date(2001, 1, 1), 2001, None, "PA", 51.0, -1.0, 1),
        ("A", dt.date(2002, 1, 1), 2002, "9", "MB", 51.1, None, 0),
        ("A", dt.date(2003, 1, 1), 2003, "1", "MB", 51.2, -2.0, 0),
        ("B", dt.date(2003, 1, 1), 2003, "7", "TM", None, None, 1),
        ("B", dt.date(2003, 1, 1), 2003, "3", "TM", None, None, 1),
    ]
    schema = ("count_point_id string, count_date date, year int, region_id string, "
              "road_category string, latitude double, longitude double, is_major int")
    expected = [("A", "9", "PA", 51.0, -1.0, 1, 2001, 2003),
                ("B", "3", "TM", None, None, 1, 2003, 2003)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, schema).repartition(4)
        assert rows(profile.entity_dim(df, SPEC)) == expected


def test_regions_classes_and_base(spark, rows):
    data = [("A", "1", "N", "x", 7, 2000, 10.0), ("A", "1", "N", "x", 8, 2001, 30.0),
            ("B", "1", "N", "y", 7, 2000, 20.0), ("C", "2", "S", "z", 7, 2001, 8.0)]
    schema = ("count_point_id string, region_id string, region_name string, "
              "local_authority_name string, hour int, year int, all_motor_vehicles double")
    df = spark.createDataFrame(data, schema)
    assert rows(profile.region_dim(df, SPEC)) == [("1", "N", 2, 2), ("2", "S", 1, 1)]
    assert rows(profile.region_sharpness(df, SPEC)) == [("N", 22.5, 1.333), ("S", 8.0, 1.0)]
    assert rows(profile.base_index(df, SPEC, ["all_motor_vehicles"])) == [
        (2000, 100.0), (2001, pytest.approx(100 * 19 / 15))]
    slots = profile.slot_distribution(df, SPEC)
    assert rows(slots)[0][:2] == (7, 3)
    found = profile.peak_trough(slots, SPEC).first()
    assert (found["peak_slot"], found["trough_slot"]) == (8, 7)
