"""Distribution summaries, missing values, and key and constraint reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayshape.functions import floor_bin, half_up
from dayshape.operators.order_stats import quantile_row


def _long(row: DataFrame, names: Sequence[str], label: str, value: str) -> DataFrame:
    """One row of named results as (label, value) rows."""
    return row.unpivot([], list(names), label, value)


def moments(df: DataFrame, column: str, places: int = 3) -> DataFrame:
    """Mean, median, sample deviation, population skewness and excess kurtosis, range."""
    x = F.col(column)
    median = quantile_row(df, column, [0.5]).select("q0")
    return df.agg(
        half_up(F.avg(x), 2).alias("mean"),
        half_up(F.stddev_samp(x), 2).alias("sd"),
        half_up(F.skewness(x), places).alias("skewness"),
        half_up(F.kurtosis(x), places).alias("kurtosis"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
    ).withColumn("median", half_up(median.scalar(), 2))


def histogram(df: DataFrame, column: str, width: float = 100) -> DataFrame:
    """Rows per bin, over all rows; those without a value have the bin null."""
    return (
        df.select(floor_bin(F.col(column), width).cast("bigint").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def corr_matrix(df: DataFrame, columns: Sequence[str], places: int = 6) -> DataFrame:
    """Pearson correlations (left, right, r) over the rows where every column is known.

    All pairs share one aggregate of plain sums of products, which stays inside generated code
    where one correlation function per pair would outgrow it. The sums are taken around the values
    of any one row, so little is lost to cancellation; that row is a scalar subquery which ends at
    the first row found, so the table is read once, whatever the number of columns.
    """
    known = df.selectExpr(*[f"CAST(`{c}` AS DOUBLE) AS `{c}`" for c in columns]).dropna()
    near = known.select(F.struct(*columns).alias("near")).limit(1).scalar()
    centred = known.select(*[(F.col(c) - near.getField(c)).alias(c) for c in columns])
    pairs = combinations_with_replacement(columns, 2)
    sums = centred.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.expr(f"sum(`{c}`) AS `s {c}`") for c in columns],
        *[F.expr(f"sum(`{a}` * `{c}`) AS `p {a} {c}`") for a, c in pairs],
    )

    def cell(left: str, right: str) -> str:
        a, c = sorted((left, right), key=columns.index)
        return (
            f"struct('{left}' AS left, '{right}' AS right, `s {left}` AS l, `s {right}` AS r, "
            f"`p {a} {c}` AS lr, `p {left} {left}` AS ll, `p {right} {right}` AS rr)"
        )

    cells = ", ".join(cell(left, right) for left in columns for right in columns)
    lines = sums.selectExpr("n", f"inline(array({cells}))")

    def joint(both: str, one: str, other: str) -> Column:
        return F.col(both) - F.col(one) * F.col(other) / F.col("n")

    scale = F.sqrt(joint("ll", "l", "l") * joint("rr", "r", "r"))
    r = F.when(scale > 0, joint("lr", "l", "r") / scale)
    diagonal = F.col("left") == F.col("right")
    return lines.select(
        "left", "right", F.when(diagonal, 1.0).otherwise(half_up(r, places)).alias("r")
    )


def corr_with(
    df: DataFrame, measure: str, columns: Sequence[str], places: int = 6
) -> DataFrame:
    """Correlation of each column with the measure, in one aggregate."""
    row = df.agg(
        *[half_up(F.corr(F.col(c).cast("double"), F.col(measure).cast("double")), places).alias(c)
          for c in columns]
    )
    return _long(row, columns, "column", "r")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and nulls of each column, in one pass."""
    columns = list(columns or df.columns)
    row = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    return row.unpivot(["__rows"], columns, "column", "nulls").withColumnRenamed(
        "__rows", "n_rows"
    )


def null_profiles(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and nulls of every column of every table (table, column, n_rows, nulls), one pass a table."""
    parts = [null_profile(df).select(F.lit(name).alias("table"), "*") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def missing_by_class(df: DataFrame, klass: str, column: str) -> DataFrame:
    """Rows, missing values and their percentage per class."""
    absent = F.col(column).isNull()
    return df.groupBy(klass).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(absent).alias("n_null"),
        half_up(100 * F.avg(absent.cast("double")), 1).alias("pct_null"),
    )


def component_identity(
    df: DataFrame, measure: str, parts: Sequence[str], tolerance: float = 0
) -> DataFrame:
    """On how many rows the parts (missing ones counted as 0) add up to the measure."""
    total = sum((F.coalesce(F.col(p), F.lit(0)) for p in parts), F.lit(0))
    holds = F.abs(total - F.col(measure)) <= F.lit(tolerance)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(holds).alias("n_exact"),
    ).withColumn("share", F.when(F.col("n_rows") > 0, F.col("n_exact") / F.col("n_rows")))


def exact_distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, n_distinct), nulls left out.

    Each row gives one (column, value) pair per column, and equal pairs are reduced in the task
    that read them; several exact counts in one aggregate would copy every row whole, once per
    column, before anything is reduced.
    """

    def text(name: str) -> Column:
        kind = dict(df.dtypes)[name]
        # The two zeros are one value.
        return (F.col(name) + F.lit(0).cast(kind) if kind in ("double", "float") else F.col(name)).cast("string")

    pairs = [F.struct(F.lit(c).alias("column"), text(c).alias("value")) for c in columns]
    values = df.select(F.inline(F.array(*pairs))).distinct()
    found = values.groupBy("column").agg(F.count("value").alias("n_distinct"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(found, "column", "left").select("column", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"))


def cardinality(
    df: DataFrame, exact: Sequence[str] = (), approximate: Sequence[str] = (), rsd: float = 0.05
) -> DataFrame:
    """Distinct values per column; sketches for wide domains, exact counts for narrow ones."""
    parts = []
    if exact:
        parts.append(exact_distinct(df, exact).select(F.lit("exact").alias("method"), "column", "n_distinct"))
    if approximate:
        row = df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in approximate])
        found = _long(row, approximate, "column", "n_distinct")
        parts.append(found.select(F.lit("approximate").alias("method"), "column", "n_distinct"))
    return reduce(DataFrame.unionByName, parts)


def iqr_outliers(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, fences at ``reach`` interquartile ranges, and the rows beyond them."""
    x = F.col(column)
    quarters = quantile_row(df, column, [0.25, 0.75])
    fences = quarters.select(
        F.struct(
            F.col("q0").cast("double").alias("q1"),
            F.col("q1").cast("double").alias("q3"),
            (F.col("q0") - reach * (F.col("q1") - F.col("q0"))).alias("low"),
            (F.col("q1") + reach * (F.col("q1") - F.col("q0"))).alias("high"),
        ).alias("f")
    )
    f = fences.scalar()
    beyond = (x < f.getField("low")) | (x > f.getField("high"))
    counted = df.select(beyond.alias("beyond")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("beyond").alias("outliers")
    )
    return counted.select(
        *[f.getField(n).alias(n) for n in ("q1", "q3", "low", "high")],
        "n_rows",
        "outliers",
        F.when(F.col("n_rows") > 0, F.col("outliers") / F.col("n_rows")).alias("share"),
    )


def clip_at_quantile(
    df: DataFrame, column: str, share: float = 0.99, name: str = "clipped"
) -> DataFrame:
    """Cap a column at its quantile (linear interpolation between the two nearest values)."""
    cap = quantile_row(df, column, [share], interpolate=True).select("q0").scalar()
    return df.withColumn(name, F.least(F.col(column), cap))


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are repeated or incomplete, with their rows."""
    incomplete = sum((F.col(k).isNull().cast("int") for k in keys), F.lit(0)) > 0
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where((F.col("n_rows") > 1) | incomplete)
    )


def fk_violations(
    child: DataFrame, foreign: str, parent: DataFrame, key: str
) -> DataFrame:
    """Foreign values without a parent, with their rows. A null key refers to nothing.

    The child is reduced to its distinct values before the join, so a value that fills the fact
    is one row of the join.
    """
    used = (
        child.where(F.col(foreign).isNotNull())
        .groupBy(F.col(foreign).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = parent.select(F.col(key).alias("value"))
    return used.join(known, "value", "left_anti")


def check_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows failing each rule, all rules in one pass. An unknown outcome passes, as in SQL CHECK."""
    names = list(rules)
    row = df.agg(*[F.count_if(~rules[n]).alias(n) for n in names])
    return _long(row, names, "rule", "violations")


def notnull_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return null_profile(df, columns).select(F.col("column"), F.col("nulls").alias("violations"))
