from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from dayshape.operators import reports, star
from dayshape.operators.planner import Planner, planner, rows_per_id
from dayshape.plans.bindings import HOSTILE
from dayshape.spec import Spec

SHOPS = Spec(
    entity="shop", slot="hour", measure="visits", klass="kind", period="year", date="day", code="door",
    region="area", region_name="area_name", authority="town", attributes=("area", "town", "kind"),
    coordinates=("x", "y"), slot_range=(7, 18), components=(),
)
SHOP_COLUMNS = "shop string, hour int, year int, day date, visits double, kind string, area string, area_name string, town string, x double, y double, is_major int"


@pytest.fixture(scope="module")
def facts(spark):
    rows = spark.range(3000).select(
        F.concat(F.lit("s"), F.col("id") % 40).alias("shop"),
        (7 + F.col("id") % 12).cast("int").alias("hour"),
        (2000 + F.col("id") % 3).cast("int").alias("year"),
        F.lit("2001-01-02").cast("date").alias("day"),
        (1 + F.col("id") * 37 % 101).cast("double").alias("visits"),
        F.concat(F.lit("k"), F.col("id") % 4).alias("kind"),
        F.concat(F.lit("a"), F.col("id") % 5).alias("area"),
        F.concat(F.lit("Area "), F.col("id") % 5).alias("area_name"),
        F.concat(F.lit("t"), F.col("id") % 8).alias("town"),
        F.lit(1.0).alias("x"),
        F.lit(2.0).alias("y"),
        (F.col("id") % 2).cast("int").alias("is_major"),
    )
    return rows


@pytest.fixture(scope="module")
def annual(spark):
    return spark.range(200).select(
        F.concat(F.lit("s"), F.col("id") % 40).alias("shop"),
        (1998 + (F.col("id") / 40).cast("int")).cast("int").alias("year"),
        (F.col("id") - 3).cast("double").alias("flow"),
    )


@pytest.fixture(scope="module")
def built(facts, annual, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("star"))
    return star.build_star(facts, annual, SHOPS, ["flow"], first_period=1990, directory=place, buckets=8), place


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_give_what_the_frames_give(spark, built, rows):
    with planner(spark, built[0], SHOPS, "flow") as ask:
        pairs = [
            (ask.entity_profile("s7"), reports.entity_profile(built[0], SHOPS, "s7")),
            (ask.entity_profile("s7", 7), reports.entity_profile(built[0], SHOPS, "s7", 7)),
            (ask.class_peak(2), reports.class_peak(built[0], SHOPS, 2)),
            (ask.sharpest(("town", "kind"), 7, 2), reports.sharpest(built[0], SHOPS, ["town", "kind"], 7, 2)),
            (ask.annual_trend(1999, 2001), reports.annual_trend(built[0].annual, SHOPS, "flow", 1999, 2001)),
            (ask.region_summary(2), reports.region_summary(built[0], SHOPS, 2)),
        ]
    for asked, framed in pairs:
        assert asked.columns == framed.columns
        assert rows(asked) == rows(framed) and asked.count() > 0


@pytest.mark.parametrize("text", [*HOSTILE[1:], "s7' --", "s7\\", "", "s7 ", ":id", "S7", "{entity}"])
def test_hostile_texts_are_only_values(spark, built, text):
    before = [t.count() for t in built[0].tables().values()]
    with planner(spark, built[0], SHOPS, "flow") as ask:
        assert ask.entity_profile(text).count() == 0
        for call in (ask.entity_profile, ask.class_peak, ask.region_summary, ask.annual_trend):
            with pytest.raises(ValueError, match="whole number"):
                call(*(["s7"] if call == ask.entity_profile else []), text)
        with pytest.raises(ValueError, match="whole number"):
            ask.sharpest(("town",), limit=text)
    assert [t.count() for t in built[0].tables().values()] == before


def test_typed_keys_tell_apart_texts_of_one_number(spark, rows):
    facts = spark.createDataFrame([(7, "x"), (7, "y"), (70, "z"), (None, "n")], "id bigint, v string")
    found = rows_per_id(facts, "id", ["7", "007", " 7", "7.0", "70", "8", *HOSTILE[1:]])
    assert dict(rows(found)) == {"7": 2, "70": 1} | {t: 0 for t in ("007", " 7", "7.0", "8", *HOSTILE[1:])}
    named = facts.select(F.col("id").cast("string").alias("odd `name"))
    assert rows(rows_per_id(named, "odd `name", ["7", "' or ''='"])) == [("' or ''='", 0), ("7", 2)]


def test_a_closed_planner_drops_its_views_alone(spark, built):
    before = {t.name for t in spark.catalog.listTables()}
    one, other = (Planner(spark, built[0], SHOPS, "flow") for _ in range(2))
    one.close()
    assert other.class_peak(1).count() > 0
    other.close()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_one_entity_reads_one_bucket_and_joins_need_no_shuffle(spark, built):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for key, value in zip(kept, ("-1", "false"), strict=True):
            spark.conf.set(key, value)
        joined = built[0].profile.join(built[0].entity, "shop")
        assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
        with planner(spark, built[0], SHOPS, "flow") as ask:
            day = plan_of(ask.entity_profile("s7"))
        assert day.count("SelectedBucketsCount: 1 out of 8") == 2
        assert "EqualTo(shop,s7)" in day
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)


def test_rules_are_counted_while_tables_are_written(spark, facts, annual, tmp_path, rows):
    bad = facts.withColumns(
        {
            "hour": F.when(F.col("shop") == "s1", 3).otherwise(F.col("hour")),
            "visits": F.when(F.col("shop") == "s2", -F.col("visits")).otherwise(F.col("visits")),
            "kind": F.when(F.col("shop") != "s3", F.col("kind")),
            "area_name": F.when(F.col("area") != "a4", F.col("area_name")),
            "is_major": F.when(F.col("shop") == "s5", 7).when(F.col("shop") == "s6", None).otherwise(F.col("is_major")),
        }
    )
    made = star.build_star(bad, annual, SHOPS, ["flow"], first_period=1990, directory=str(tmp_path), buckets=4)
    wanted = {
        ("dim_region", "area_name not null"): 1,
        ("dim_entity", "kind not null"): 1,
        ("dim_entity", "is_major not null"): 1,
        ("dim_entity", "flag in (0, 1)"): 1,
        ("fact_profile", "slot in window"): 1,
        ("fact_profile", "mean >= 0"): bad.where("shop = 's2'").select("hour").distinct().count(),
        ("fact_annual", "year in range"): 80,
        ("fact_annual", "flow >= 0"): 3,
    }
    assert {k: n for k, n in made.observed.items() if n} == wanted
    # The same counts from the tables as they lie there, and no broken key.
    lazy = star.star_violations(replace(made, observed={}), SHOPS, "flow")
    assert rows(star.star_violations(made, SHOPS)) == rows(lazy)
    assert {(t, r): n for t, r, n in rows(lazy) if n} == wanted
    assert star.star_violations(star.build_star(bad, annual, SHOPS, ["flow"], first_period=1990), SHOPS, "flow").where(
        "violations > 0").count() == len(wanted)


def test_a_stored_star_opens_in_another_session(spark, built, rows):
    again = star.open_star(spark.newSession(), SHOPS, built[1], buckets=8)
    for name, table in built[0].tables().items():
        assert rows(again.tables()[name]) == rows(table)
    assert again.profile.schema == built[0].profile.schema


def test_load_report_tells_repaired_regions_from_unknown_ones(spark, built, facts, annual, rows):
    whole = built[0]
    placed = whole.region.where("area <> 'a2'")
    entity = star.repair_fk(whole.entity.where("shop <> 's0'"), "area", placed, "area")
    nowhere = facts.withColumn("area", F.when(F.col("shop") != "s7", F.col("area")))
    found = star.load_report(nowhere, annual, replace(whole, region=placed, entity=entity), SHOPS)
    repaired = facts.where("area = 'a2' and shop <> 's7'").select("shop").distinct().count()
    assert dict(rows(found)) == {
        "annual rows dropped": 5,
        "profile rows dropped": facts.where("shop = 's0'").count(),
        "region keys repaired": repaired,
    }
