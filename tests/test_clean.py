import datetime as dt
from dataclasses import replace

from pyspark.sql import Observation

from dayshape.operators import clean
from dayshape.presets import ROADS

SPEC = replace(ROADS, required=("latitude", "longitude"))
RAW = (
    "count_point_id string, direction_of_travel string, year int, count_date string, hour int, "
    "region_id string, region_name string, local_authority_name string, road_category string, "
    "latitude double, longitude double, cars_and_taxis int, all_motor_vehicles int"
)


def raw(spark, *changes):
    base = {
        "count_point_id": "A", "direction_of_travel": " n ", "year": 2019,
        "count_date": "2019-06-08", "hour": 8, "region_id": "1", "region_name": "R",
        "local_authority_name": "L", "road_category": "PA", "latitude": 51.0,
        "longitude": -1.0, "cars_and_taxis": 60, "all_motor_vehicles": 80,
    }
    return spark.createDataFrame([tuple({**base, **c}.values()) for c in changes], RAW)


def test_codes_fold(spark, rows):
    codes = [f"{left}{c}{right}" for c in "xYz" for left in ("", "  ") for right in ("", " ")]
    df = raw(spark, *[{"direction_of_travel": form} for c in codes for form in (c, c.swapcase())])
    folded = clean.normalise_code(df, "direction_of_travel")
    assert {r[0] for r in rows(folded, "direction_of_travel")} == {"X", "Y", "Z"}


def test_slot_window_is_inclusive(spark, rows):
    low, high = 9, 14
    df = raw(spark, *[{"hour": h} for h in range(24)])
    kept = {h for (h,) in rows(clean.slot_window(df, replace(SPEC, slot_range=(low, high))), "hour")}
    assert kept == set(range(low, high + 1))


def test_zero_is_a_measurement_but_null_and_negative_are_not(spark, rows):
    df = raw(spark, *[{"all_motor_vehicles": v} for v in (0, 5, None, -1)])
    assert rows(clean.require_measure(df, SPEC), "all_motor_vehicles") == [(0,), (5,)]


def test_class_flag(spark, rows):
    spec = replace(SPEC, major_classes=("one", "two"))
    df = raw(spark, *[{"road_category": c} for c in ("one", "three", "two", "ONE", None)])
    flags = dict(rows(clean.class_flag(df, spec), "road_category", "is_major"))
    assert {c for c, flag in flags.items() if flag == 1} == {"one", "two"} and len(flags) == 5


def test_dates_parse_or_go(spark, rows):
    df = raw(spark, *[{"count_date": d} for d in ("2020-02-29", "2019-02-29", "x", None)])
    assert rows(clean.safe_date(df, "count_date"), "count_date") == [(dt.date(2020, 2, 29),)]


def test_share_without_component(spark, rows):
    df = raw(spark, {}, {"cars_and_taxis": None}, {"all_motor_vehicles": 0},
             {"all_motor_vehicles": 3, "cars_and_taxis": 1})
    shares = clean.non_component_share(df, "all_motor_vehicles", "cars_and_taxis")
    assert rows(shares, "non_component_share") == [(0.25,), (0.6667,), (1.0,), (None,)]


def test_clean_fact_and_its_losses(spark, rows):
    df = raw(
        spark,
        {},
        {"hour": 3, "all_motor_vehicles": None},
        {"all_motor_vehicles": None},
        {"all_motor_vehicles": -4},
        {"latitude": None},
        {"count_date": "08/06/2019"},
        {"count_date": "2019-06-10", "road_category": "MCU"},
    )
    seen = Observation()
    cleaned = clean.clean_fact(df, SPEC, losses=seen)
    columns = ("direction_of_travel", "count_date", "day_of_week", "month", "is_weekend",
               "is_major", "non_component_share")
    assert rows(cleaned, *columns) == [
        ("N", dt.date(2019, 6, 10), "Monday", 6, 0, 0, 0.25),
        ("N", dt.date(2019, 6, 8), "Saturday", 6, 1, 1, 0.25),
    ]
    expected = {"rows_in": 7, "lost_slot": 1, "lost_measure": 2, "lost_required": 1,
                "lost_date": 1, "rows_out": 2}
    assert clean.cleaning_losses(df, SPEC).first().asDict() == expected
    assert seen.get == expected


def test_domain_check_ignores_null(spark, rows):
    df = raw(spark, *[{"direction_of_travel": d} for d in ("N", "Q", "Q", None)])
    assert rows(clean.domain_check(df, "direction_of_travel", ["N"])) == [("Q", 2)]
