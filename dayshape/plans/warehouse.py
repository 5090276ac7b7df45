"""The whole batch job on a road-count feed: CSV in, clean fact and star schema out.

    spark-submit -m dayshape.plans.warehouse counts.csv annual.csv out_dir
"""

from __future__ import annotations

import sys

from pyspark.sql import Observation, SparkSession

from dayshape.operators.clean import clean_fact
from dayshape.operators.star import Star, build_star, load_report, star_violations
from dayshape.presets import ANNUAL_COLUMNS, COUNT_COLUMNS, ROADS
from dayshape.sources import read_named, scan_periods, write_by_period, write_tables

ANNUAL_FLOW = "annual_measure"


def build_warehouse(
    spark: SparkSession, counts_path: str, annual_path: str, out_dir: str
) -> tuple[Star, dict[str, int]]:
    """Write the clean fact by year, the annual table and the star; returns the star and losses.

    The losses are counted while the fact is written, so cleaning is a single pass over the feed.
    """
    losses = Observation()
    clean = clean_fact(read_named(spark, counts_path, COUNT_COLUMNS), ROADS, losses)
    write_by_period(clean, f"{out_dir}/counts.parquet", ROADS.period)

    annual = read_named(spark, annual_path, ANNUAL_COLUMNS).withColumnRenamed(
        ROADS.measure, ANNUAL_FLOW
    )
    stored = write_tables({"annual": annual}, out_dir)["annual"]
    star = build_star(
        scan_periods(spark, f"{out_dir}/counts.parquet", ROADS.period),
        spark.read.parquet(stored),
        ROADS,
        annual_columns=[ANNUAL_FLOW, "estimation_method", "link_length_km"],
        directory=out_dir,
    )
    return star, losses.get


def main() -> None:
    counts_path, annual_path, out_dir = sys.argv[1:4]
    spark = SparkSession.builder.appName("dayshape-warehouse").getOrCreate()
    star, losses = build_warehouse(spark, counts_path, annual_path, out_dir)
    print(losses)
    fact = scan_periods(spark, f"{out_dir}/counts.parquet", ROADS.period)
    load_report(fact, spark.read.parquet(f"{out_dir}/annual.parquet"), star, ROADS).show(truncate=False)
    star_violations(star, ROADS).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
