"""Reading and writing: CSV bound by header name, Parquet laid out by period, table counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_named(spark: SparkSession, path: str, columns: Mapping[str, str]) -> DataFrame:
    """CSV columns picked by header name and cast; text that is no value of its type is null.

    The file's own column order plays no part, and columns not asked for are never parsed.
    """
    # Binding by name reads the header only: no inference pass over the data.
    text = spark.read.option("header", True).option("inferSchema", False).csv(path)
    absent = sorted(set(columns) - set(text.columns))
    if absent:
        raise ValueError(f"{path} lacks the columns {absent}; it has {text.columns}")
    return text.select(
        [
            (text[name] if kind == "string" else text[name].try_cast(kind)).alias(name)
            for name, kind in columns.items()
        ]
    )


def write_by_period(df: DataFrame, path: str, period: str) -> None:
    """Parquet with one directory per period.

    The rebalance hint brings a period's rows together, then lets adaptive execution split the
    heavy periods and merge the light ones, so neither file count nor task size follows the
    number of periods.
    """
    df.hint("rebalance", period).write.mode("overwrite").partitionBy(period).parquet(path)


def scan_periods(
    spark: SparkSession, path: str, period: str, first: int | None = None, last: int | None = None
) -> DataFrame:
    """A scan that lists only the directories of the periods asked for."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.where(F.col(period) >= first)
    if last is not None:
        rows = rows.where(F.col(period) <= last)
    return rows


def write_tables(tables: Mapping[str, DataFrame], directory: str) -> dict[str, str]:
    """Write each table as plain Parquet under the directory; returns the paths."""
    paths = {name: f"{directory}/{name}.parquet" for name in tables}
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(paths[name])
    return paths


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, the largest first. A Parquet count reads footers, not columns."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy(F.desc("n_rows"), "table")


def sample_rows(df: DataFrame, target: int, seed: int) -> DataFrame:
    """A seeded random sample of about ``target`` rows; everything when there are fewer."""
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return df.where(F.rand(seed) * total.scalar() < target)


def key_hash(keys: Sequence[str | Column]) -> Column:
    """A hash of the keys as hexadecimal text, the same on every engine with MD5; null is empty."""
    named = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("")) for k in named]).cast("binary"))


def smallest_hashes(df: DataFrame, keys: Sequence[str | Column], size: int) -> DataFrame:
    """A sample of exactly ``size`` rows (all, if fewer): those whose keys have the smallest hashes.

    It depends on the keys alone, not on partitions, order or engine, and the sample of a union is
    among the samples of its parts, so samples of new data can be merged into kept ones. Every task
    keeps ``size`` rows at most. Rows with equal keys should be equal, or which of them is taken at
    the edge is open.
    """
    return df.withColumn("__hash", key_hash(keys)).orderBy("__hash").limit(int(size)).drop("__hash")


def register(df: DataFrame, view: str) -> None:
    """Make a table available to Spark SQL under a name."""
    df.createOrReplaceTempView(view)
