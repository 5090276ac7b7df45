import pytest
from pyspark.sql import functions as F

from dayshape import sources


def write_csv(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_missing_marker_becomes_null_and_order_is_free(spark, rows, tmp_path):
    path = write_csv(tmp_path, "a.csv", "extra,length,id,total\nx,1.5,A,100\ny,NA,B,NA\n")
    df = sources.read_named(spark, path, {"id": "string", "total": "int", "length": "double"})
    assert df.dtypes == [("id", "string"), ("total", "int"), ("length", "double")]
    assert rows(df) == [("A", 100, 1.5), ("B", None, None)]


def test_missing_column_is_named(spark, tmp_path):
    path = write_csv(tmp_path, "b.csv", "id,hour\nA,7\n")
    with pytest.raises(ValueError, match="total"):
        sources.read_named(spark, path, {"id": "string", "total": "int"})


def test_period_layout_prunes_directories(spark, tmp_path):
    path = str(tmp_path / "facts")
    df = spark.range(300).select("id", (F.col("id") % 3 + 2000).cast("int").alias("year"))
    sources.write_by_period(df, path, "year")
    late = sources.scan_periods(spark, path, "year", first=2001, last=2001)
    assert late.count() == 100
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert len({p.name for p in (tmp_path / "facts").glob("year=*")}) == 3


def test_row_counts_largest_first(spark):
    counts = sources.row_counts({"a": spark.range(3), "b": spark.range(5), "c": spark.range(3)})
    assert [tuple(r) for r in counts.collect()] == [("b", 5), ("a", 3), ("c", 3)]


def test_sample_is_seeded_and_keeps_small_tables_whole(spark):
    assert sources.sample_rows(spark.range(50), target=100, seed=1).count() == 50
    big = spark.range(20_000)
    first = sources.sample_rows(big, target=1000, seed=42).collect()
    assert 800 < len(first) < 1200
    assert first == sources.sample_rows(big, target=1000, seed=42).collect()
