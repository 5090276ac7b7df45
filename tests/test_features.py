import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from dayshape.operators import clean, features
from dayshape.plans import bindings, catalog
from dayshape.presets import CONTROL, PRIMARY, ROAD_FEATURES, ROADS
from dayshape.spec import FeatureSet


@pytest.fixture(scope="module")
def yearly(spark):
    data = [(f"E{e}", y, 7 + y % 12, 100 * e + y - 2000 + k) for e in range(1, 5)
            for y in range(2000, 2026) for k in (0, 4)]
    data.append(("NEW", 2024, 8, 50))
    return spark.createDataFrame(
        data, "count_point_id string, year int, hour int, all_motor_vehicles int")


def test_splits_are_ordered_disjoint_and_bounded(yearly):
    for split in (PRIMARY, CONTROL):
        train, test = clean.period_split(yearly, ROADS, split)
        late = train.agg(F.max("year")).first()[0]
        first, last = test.agg(F.min("year"), F.max("year")).first()
        assert late == split.train_until < first == split.test_from
        assert last == (split.test_until or 2025)


def test_history_ignores_the_test_block(yearly, rows):
    train, _ = clean.period_split(yearly, ROADS, PRIMARY)
    changed = yearly.withColumn(
        "all_motor_vehicles",
        F.when(F.col("year") > 2019, 9999).otherwise(F.col("all_motor_vehicles")))
    other, _ = clean.period_split(changed, ROADS, PRIMARY)
    assert rows(features.entity_history(train, ROADS)) == rows(features.entity_history(other, ROADS))
    row = features.entity_history(train, ROADS).where("count_point_id = 'E1'").first()
    assert (row["hist_mean"], row["hist_periods"]) == (111.5, 20)


def test_unseen_entity_gets_the_mean_history(yearly, tmp_path):
    for directory in (None, str(tmp_path)):
        _, test = features.feature_blocks(yearly, ROADS, PRIMARY, directory)
        row = test.where("count_point_id = 'NEW'").first()
        assert (row["hist_mean"], row["hist_periods"]) == (pytest.approx(261.5), 0)
        assert row["hist_sd"] > 0
        assert test.count() == 4 * 3 * 2 + 1


def test_history_join_keeps_the_rows_of_a_hot_entity(spark, yearly, rows):
    hot = yearly.unionByName(yearly.where("count_point_id = 'E2'").withColumn(
        "k", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("k"))
    train, test = clean.period_split(hot, ROADS, PRIMARY)
    history = features.entity_history(train, ROADS)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    found = []
    for threshold in (limit, "-1"):  # with and without a broadcast
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        joined = features.attach_history(test, history, ROADS)
        found.append(rows(joined, *sorted(joined.columns)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert found[0] == found[1] and len(found[0]) == test.count()


def test_guard_names_the_barred_column_and_its_reason():
    features.leakage_guard(ROAD_FEATURES, ROADS)
    for column in ROADS.barred:
        with pytest.raises(ValueError, match=column):
            features.leakage_guard(FeatureSet((), (*ROAD_FEATURES.numeric, column)), ROADS)


def test_evidence_finds_summands_and_copies(spark, rows):
    df = spark.range(500).select(
        (F.col("id") % 13).alias("p"), (F.col("id") * 7 % 11).alias("q"), F.rand(1).alias("noise")
    ).withColumn("total", F.col("p") + F.col("q")).withColumn("copy", F.col("total") * 3 + 1)
    found = features.leakage_evidence(df, "total", ["p", "q", "noise", "copy"], parts=["p", "q"])
    assert {r[0] for r in rows(found, "column")} == {"p", "q", "copy"}


def test_relative_target_is_free_of_the_level(yearly):
    _, test = features.feature_blocks(yearly, ROADS, PRIMARY)
    known = features.relative_target(test.where("hist_periods > 0"), ROADS)
    spread = known.groupBy("count_point_id").agg(F.avg("relative_measure").alias("m")).agg(
        F.min("m"), F.max("m")).first()
    assert 1.0 < spread[0] <= spread[1] < 1.2


@pytest.fixture(scope="module")
def uneven(spark):
    """Entities with one row, one period, gaps, repeated rows, nulls and values far from zero."""
    rnd = random.Random(4)
    data = [(i, f"E{rnd.randrange(12)}", rnd.choice([2001, 2002, 2005, 2007, 2024]), 10**7 + rnd.randrange(900) / 4)
            for i in range(160)]
    data += [(200, "ONCE", 2005, 5.0), (201, "LATE", 2024, 7.0), (202, "E1", 2005, None), (203, "NIL", 2005, None),
             (204, "E2", None, 6.0), (205, None, 2002, 8.0), (206, None, 2005, 9.0)]
    return spark.createDataFrame(data, "id int, count_point_id string, year int, all_motor_vehicles double"), data


def near(found, wanted):
    return all(a == b or abs(a - b) < 0.011 for a, b in zip(found, wanted, strict=True))


def test_earlier_history_holds_only_periods_before(uneven):
    df, data = uneven
    train, test = features.feature_blocks(df, ROADS, PRIMARY, history="earlier")
    seen = [d for d in data if d[2] is not None and d[2] <= 2019 and d[3] is not None]
    rows = train.collect()
    assert len(rows) == sum(1 for d in data if d[2] is not None and d[2] <= 2019)
    for r in rows:
        own = [d[3] for d in seen if d[1] == r["count_point_id"] and d[1] is not None and d[2] < r["year"]]
        every = [d[3] for d in seen if d[2] < r["year"]]
        mean = statistics.fmean(own) if own else statistics.fmean(every) if every else 0
        periods = len({d[2] for d in seen if d[1] == r["count_point_id"] and d[1] is not None and d[2] < r["year"]})
        spread = statistics.stdev(own) if len(own) > 1 else 0
        assert near((r["hist_mean"], r["hist_sd"], r["hist_periods"]), (mean, spread, periods))
    whole = features.feature_blocks(df, ROADS, PRIMARY)[1]
    assert sorted(map(tuple, test.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


def test_history_of_others_leaves_the_row_out(uneven):
    df, data = uneven
    train, _ = features.feature_blocks(df, ROADS, PRIMARY, history="others")
    rows = {r["id"]: r for r in train.collect()}
    known = [d for d in data if d[2] is not None and d[2] <= 2019]
    assert set(rows) == {d[0] for d in known}
    means = {e: statistics.fmean([d[3] for d in known if d[1] == e and d[3] is not None])
             for e in {d[1] for d in known if d[3] is not None}}
    for d in known:
        own = [o[3] for o in known if o[1] == d[1] and o[0] != d[0] and o[3] is not None]
        found = rows[d[0]]
        if own:
            assert near((found["hist_mean"], found["hist_sd"]),
                        (statistics.fmean(own), statistics.stdev(own) if len(own) > 1 else 0))
        else:
            rest = [m for e, m in means.items() if e != d[1]]
            assert near([found["hist_mean"]], [statistics.fmean(rest)])
        assert found["hist_periods"] == len({o[2] for o in known if o[1] == d[1] and o[0] != d[0] and o[3] is not None})


def test_no_value_of_the_row_itself_or_of_later_ones_enters(uneven):
    df, _ = uneven
    when = df.where("id = 7").first()["year"]
    for way, value in (("earlier", 1e12), ("others", 1e7 + 9000)):
        column = F.when(F.col("id") == 7, value).otherwise(F.col("all_motor_vehicles"))
        changed = df.withColumn("all_motor_vehicles", column)
        before, after = (
            {r["id"]: (r["hist_mean"], r["hist_sd"], r["hist_periods"], r["year"])
             for r in features.feature_blocks(x, ROADS, PRIMARY, history=way)[0].collect()}
            for x in (df, changed)
        )
        assert before.get(7) == after.get(7)
        moved = {i for i in before if before[i] != after[i]}
        assert 7 not in moved and moved
        if way == "earlier":
            assert all(before[i][3] > when for i in moved)
    with pytest.raises(ValueError, match="history is one of"):
        features.feature_blocks(df, ROADS, PRIMARY, history="mine")


def test_histories_of_an_empty_block(spark, uneven):
    for way in ("earlier", "others"):
        assert features.feature_blocks(uneven[0].limit(0), ROADS, PRIMARY, history=way)[0].count() == 0


def test_history_and_customers_never_pass_the_driver(spark, yearly):
    def plan_of(df):
        return df._jdf.queryExecution().toString()

    blocks = features.feature_blocks(yearly, ROADS, PRIMARY, join="merge")
    for block in blocks:
        assert "SortMergeJoin" in plan_of(block) and "BroadcastHashJoin" not in plan_of(block)
    sf = "/root/testdata/sf0.001"
    for facts, key in ((bindings.yearly(spark, sf), "o_custkey"), (bindings.hourly(spark, sf), "user_id")):
        assert re.search(rf"SortMergeJoin \[{key}#", plan_of(facts))
        assert not re.search(rf"BroadcastHashJoin \[{key}#", plan_of(facts))
    for block in catalog._blocks(spark, sf, bindings.PRIMARY):
        assert not re.search(r"BroadcastHashJoin \[o_custkey#", plan_of(block))
    stored = catalog._stored_blocks(spark, sf, bindings.PRIMARY)
    assert all("Join" not in plan_of(block) for block in stored)
