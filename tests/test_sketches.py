import numpy as np
import pytest
from pyspark.sql import functions as F

from dayshape import sources
from dayshape.operators import quality, sketches


@pytest.fixture(scope="module")
def measured(spark):
    """60,000 rows of three groups, one of which holds most; odd values and a group without any."""
    rng = np.random.default_rng(8)
    x = rng.lognormal(3, 2, 60_000)
    rows = [(int(i % 7), "hot" if i % 10 else "cold", float(v), int(i % 977)) for i, v in enumerate(x)]
    rows += [(0, "hot", None, None), (1, "hot", float("nan"), 1), (2, "none", None, None)]
    return spark.createDataFrame(rows, "day int, g string, x double, k int")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_kept_quantiles_are_within_the_stated_rank_error(spark, measured, tmp_path):
    daily = sketches.sketch(measured, ["day", "g"], ["x"])
    daily.write.parquet(str(tmp_path / "s"))
    kept = spark.read.parquet(str(tmp_path / "s"))
    shares = [0.01, 0.25, 0.5, 0.9, 0.999]
    found = sketches.sketch_quantiles(sketches.merge(kept, ["g"]), "x", shares, ["g"])
    values = {(r["g"], r["share"]): r["value"] for r in found.collect()}
    for group in ("hot", "cold"):
        x = np.array([r[0] for r in measured.where(f"g = '{group}' and x is not null and not isnan(x)").select("x").collect()])
        for share in shares:
            value = values[group, share]
            assert value in x
            low, high = (x < value).mean(), (x <= value).mean()
            assert low - sketches.rank_error() <= share <= high + sketches.rank_error()
    assert all(values["none", s] is None for s in shares)
    gaps = sketches.rank_gap(measured.where("not isnan(x)"), found, "x", ["g"]).collect()
    assert len(gaps) == 2 * len(shares) and max(r["gap"] for r in gaps) <= sketches.rank_error()


def test_merging_reads_the_sketches_alone_and_sketching_reads_once(spark, measured, tmp_path):
    measured.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    made = sketches.sketch(fact, ["day"], ["x"], ["g", "k"])
    assert plan_of(made).count("FileScan") == 1 and "Expand" not in plan_of(made)
    made.write.parquet(str(tmp_path / "kept"))
    whole = sketches.merge(spark.read.parquet(str(tmp_path / "kept")))
    assert "kept" in plan_of(whole) and "fact" not in plan_of(whole)
    row = whole.first()
    known = measured.where("x is not null and not isnan(x)").agg(F.count("x"), F.min("x"), F.max("x"), F.sum("x")).first()
    assert (row["n_rows"], row["n_x"], row["min_x"], row["max_x"]) == (60_003, *known[:3])
    assert row["sum_x"] == pytest.approx(known[3])


def test_merged_distinct_equals_direct_and_is_near_exact(spark, measured):
    keys = ["g", "k", "day"]
    daily = sketches.sketch(measured, ["day"], keys=keys)
    merged = {r[0]: r[1] for r in sketches.sketch_distinct(sketches.merge(daily), keys).collect()}
    direct = {r[0]: r[1] for r in sketches.sketch_distinct(sketches.sketch(measured, keys=keys), keys).collect()}
    exact = {r[0]: r[1] for r in quality.exact_distinct(measured, keys).collect()}
    assert merged == direct
    assert exact == {"g": 3, "k": 977, "day": 7}
    assert all(abs(merged[k] - exact[k]) <= 5 * sketches.distinct_error() * exact[k] for k in keys)


def test_exact_distinct_needs_no_expand_and_knows_odd_values(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", 0.0, None), (1, "", -0.0, None), (2, None, float("nan"), None), (None, "a", float("nan"), None)],
        "i int, s string, d double, n string")
    found = quality.exact_distinct(df, ["i", "s", "d", "n"])
    assert rows(found) == [("d", 2), ("i", 2), ("n", 0), ("s", 2)]
    assert "Expand" not in plan_of(quality.exact_distinct(df, ["i", "s"]))
    assert rows(quality.exact_distinct(df.limit(0), ["i"])) == [("i", 0)]
    empty = sketches.sketch(df.limit(0), measures=["d"])
    assert sketches.sketch_quantiles(empty, "d", [0.5]).first()["value"] is None


def test_smallest_hashes_do_not_depend_on_partitions_and_merge(spark, rows):
    df = spark.range(5000).select("id", (F.col("id") % 7).cast("string").alias("v"))
    first = sources.smallest_hashes(df, ["id"], 300)
    assert first.count() == 300
    for parts in (1, 13):
        assert rows(sources.smallest_hashes(df.repartition(parts), ["id"], 300)) == rows(first)
    halves = [sources.smallest_hashes(df.where(c), ["id"], 300) for c in ("id < 2000", "id >= 2000")]
    assert rows(sources.smallest_hashes(halves[0].unionAll(halves[1]), ["id"], 300)) == rows(first)
    assert sources.smallest_hashes(df, ["id"], 9000).count() == 5000
    share = first.where("v = '3'").count() / 300
    assert 0.08 < share < 0.22
    nulls = df.withColumn("id", F.when(F.col("id") > 10, F.col("id")))
    assert sources.smallest_hashes(nulls, ["id", "v"], 5000).count() == 5000
