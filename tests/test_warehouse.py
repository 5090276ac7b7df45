import csv
import random

from dayshape.operators import models, reports
from dayshape.plans.warehouse import build_warehouse
from dayshape.presets import (
    ANNUAL_COLUMNS,
    CONTROL,
    COUNT_COLUMNS,
    PRIMARY,
    ROAD_FEATURES,
    ROADS,
)
from dayshape.sources import scan_periods


def feed(path):
    """A small road feed with every known defect, its columns in an order of its own."""
    rng = random.Random(9)
    columns = ["sequence", *reversed(COUNT_COLUMNS)]
    total = 0
    with open(path, "w", newline="") as handle:
        writer = csv.DictWriter(handle, columns)
        writer.writeheader()
        for site in range(8):
            major = site % 2 == 0
            for year in range(2012, 2026):
                for hour in range(7, 19):
                    cars = rng.randint(20, 60) * (site + 1) + (80 if hour in (8, 17) else 0)
                    parts = {"two_wheeled_motor_vehicles": 1, "cars_and_taxis": cars,
                             "buses_and_coaches": 2, "LGVs": 5, "all_HGVs": 3}
                    writer.writerow({
                        "sequence": total, "count_point_id": f"{site}", "year": year,
                        "direction_of_travel": rng.choice(["N", "n", "s", " S"]),
                        "count_date": f"{year}-0{rng.randint(3, 9)}-1{rng.randint(0, 9)}",
                        "hour": hour, "region_id": site % 3, "region_name": f"Region {site % 3}",
                        "local_authority_id": site, "local_authority_name": f"Authority {site}",
                        "road_name": f"R{site}", "road_category": "PA" if major else "MCU",
                        "road_type": "Major" if major else "Minor", "easting": 1.0,
                        "northing": 2.0, "latitude": 50 + site, "longitude": -site,
                        "link_length_km": 1.5 if major else "NA", "pedal_cycles": 4,
                        "all_motor_vehicles": cars + 11, **parts,
                    })
                    total += 1
        good = {**{c: 1 for c in COUNT_COLUMNS}, "count_point_id": "0", "year": 2015,
                "count_date": "2015-05-05", "hour": 9, "road_category": "PA", "sequence": 0}
        for bad in ({"hour": 3}, {"all_motor_vehicles": "NA"}, {"latitude": "NA"},
                    {"count_date": "someday"}):
            writer.writerow({**good, **bad})
    return total


def annual(path):
    with open(path, "w", newline="") as handle:
        writer = csv.DictWriter(handle, list(ANNUAL_COLUMNS))
        writer.writeheader()
        for site, year, flow in (("0", 2015, 900), ("0", 2015, 900), ("1", 2016, "NA"),
                                 ("1", 1999, 5), ("404", 2016, 7)):
            writer.writerow({"count_point_id": site, "year": year, "road_category": "PA",
                             "link_length_km": 1, "estimation_method": "Counted",
                             "all_motor_vehicles": flow})


def test_feed_to_star_to_forecast(spark, rows, tmp_path):
    counts, yearly, out = (str(tmp_path / n) for n in ("c.csv", "a.csv", "out"))
    total = feed(counts)
    annual(yearly)
    star, losses = build_warehouse(spark, counts, yearly, out)
    assert losses == {"rows_in": total + 4, "rows_out": total, "lost_slot": 1,
                      "lost_measure": 1, "lost_required": 1, "lost_date": 1}
    assert star.profile.count() == 8 * 12 and star.region.count() == 3
    assert rows(star.annual, "count_point_id", "year") == [("0", 2015), ("1", 2016)]
    peaks = reports.class_peak(star, ROADS, min_observations=5).orderBy("mean_peak_index")
    assert {r["hour"] for r in peaks.tail(2)} <= {8, 17}
    assert reports.entity_profile(star, ROADS, "3").count() == 12

    facts = scan_periods(spark, f"{out}/counts.parquet", "year")
    assert {r[0] for r in facts.select("direction_of_travel").distinct().collect()} == {"N", "S"}
    for split in (PRIMARY, CONTROL):
        run = models.run_split(facts, ROADS, ROAD_FEATURES, split,
                               {"linear": models.linear(ROADS.measure)},
                               directory=str(tmp_path / split.name))
        assert run.predictions.count() == 8 * 12 * 3
