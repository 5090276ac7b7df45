"""Row rules and derived columns that turn a raw feed into the clean fact."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from dayshape.functions import half_up
from dayshape.spec import Spec, Split

RAW_DATE = "__date_text"


def normalise_code(df: DataFrame, column: str) -> DataFrame:
    """Fold spellings of one code together: no surrounding blanks, upper case."""
    return df.withColumn(column, F.upper(F.trim(column)))


def in_slots(spec: Spec) -> Column:
    return F.col(spec.slot).between(*spec.slot_range)


def has_measure(spec: Spec) -> Column:
    """Measured and not below the floor. Zero is a measurement."""
    return F.col(spec.measure).isNotNull() & (F.col(spec.measure) >= F.lit(spec.min_measure))


def has_all(columns: Iterable[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns], F.lit(True))


def slot_window(df: DataFrame, spec: Spec) -> DataFrame:
    return df.where(in_slots(spec))


def require_measure(df: DataFrame, spec: Spec) -> DataFrame:
    return df.where(has_measure(spec))


def require_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.where(has_all(columns))


def class_flag(df: DataFrame, spec: Spec, name: str = "is_major") -> DataFrame:
    member = F.col(spec.klass).isin(list(spec.major_classes))
    return df.withColumn(name, F.when(member, 1).otherwise(0))


def iso_date(text: Column) -> Column:
    """Null, not an error, for text that is no ISO date."""
    return F.try_to_date(text, "yyyy-MM-dd")


def safe_date(df: DataFrame, column: str) -> DataFrame:
    """Replace ISO text by a date and drop the rows where that fails."""
    return df.withColumn(column, iso_date(F.col(column))).where(F.col(column).isNotNull())


def calendar_features(df: DataFrame, date: str) -> DataFrame:
    return df.withColumns(
        {
            "day_of_week": F.date_format(date, "EEEE"),
            "month": F.month(date),
            "is_weekend": F.when(F.dayofweek(date).isin(1, 7), 1).otherwise(0),
        }
    )


def non_component_share(
    df: DataFrame, measure: str, component: str, name: str = "non_component_share"
) -> DataFrame:
    """Share of the measure not due to one component; undefined for an empty measure."""
    rest = F.col(measure) - F.coalesce(F.col(component), F.lit(0))
    return df.withColumn(name, F.when(F.col(measure) > 0, half_up(rest / F.col(measure), 4)))


def cleaning_rules(spec: Spec) -> dict[str, Column]:
    """The row rules in the order they are applied."""
    return {
        "slot": in_slots(spec),
        "measure": has_measure(spec),
        "required": has_all(spec.required),
        "date": iso_date(F.col(spec.date)).isNotNull(),
    }


def first_broken_rule(spec: Spec) -> Column:
    """Name of the rule that removes the row, null for rows that stay."""
    return F.coalesce(
        *[
            F.when(~F.coalesce(rule, F.lit(False)), F.lit(name))
            for name, rule in cleaning_rules(spec).items()
        ]
    )


def clean_fact(df: DataFrame, spec: Spec, losses: Observation | None = None) -> DataFrame:
    """Raw rows to the clean fact in one narrow pass: no shuffle and no action.

    With an ``Observation`` the rows read, the rows kept and the rows lost to each rule are
    counted while the result is being written, so measuring costs no further pass.
    """
    if losses is not None:
        broken = first_broken_rule(spec)
        df = df.observe(
            losses,
            F.count(F.lit(1)).alias("rows_in"),
            *[F.count_if(broken == name).alias(f"lost_{name}") for name in cleaning_rules(spec)],
            F.count_if(broken.isNull()).alias("rows_out"),
        )
    kept = df.where(reduce(and_, cleaning_rules(spec).values()))
    kept = normalise_code(kept, spec.code)
    kept = kept.withColumnRenamed(spec.date, RAW_DATE)
    kept = kept.withColumn(spec.date, iso_date(F.col(RAW_DATE))).drop(RAW_DATE)
    kept = calendar_features(class_flag(kept, spec), spec.date)
    if spec.main_component is not None:
        kept = non_component_share(kept, spec.measure, spec.main_component)
    return kept


def cleaning_losses(df: DataFrame, spec: Spec) -> DataFrame:
    """One row: rows in, rows out and rows lost to each rule, in a single aggregate."""
    broken = first_broken_rule(spec)
    return df.select(broken.alias("broken")).agg(
        F.count(F.lit(1)).alias("rows_in"),
        *[F.count_if(F.col("broken") == name).alias(f"lost_{name}") for name in cleaning_rules(spec)],
        F.count_if(F.col("broken").isNull()).alias("rows_out"),
    )


def period_split(df: DataFrame, spec: Spec, split: Split) -> tuple[DataFrame, DataFrame]:
    """Earlier periods for training, later ones for testing; never mixed, a gap allowed."""
    period = F.col(spec.period)
    test = period >= split.test_from
    if split.test_until is not None:
        test = test & (period <= split.test_until)
    return df.where(period <= split.train_until), df.where(test)


def domain_check(df: DataFrame, column: str, allowed: Iterable[str]) -> DataFrame:
    """Values outside a declared code set, with their rows. Null is no value."""
    return (
        df.where(~F.col(column).isin(list(allowed)))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
