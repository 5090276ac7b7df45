"""The star schema: deduplicated dimensions and facts with repaired keys, stored by entity."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dayshape.operators.profile import entity_dim, peak_index, region_dim
from dayshape.operators.quality import check_violations, fk_violations, key_violations
from dayshape.spec import Spec

TABLES = ("dim_region", "dim_entity", "fact_profile", "fact_annual")
# Tables that are looked up or joined by entity.
BY_ENTITY = ("dim_entity", "fact_profile", "fact_annual")
REPAIRED = "region keys repaired"


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key under a total order.

    Spark keeps one row per key in every task before the shuffle (window group limit), so a key
    with very many copies costs its final task one row per input task.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).where(F.col("__place") == 1).drop("__place")


def repair_fk(child: DataFrame, foreign: str, parent: DataFrame, key: str) -> DataFrame:
    """Null a foreign key that has no parent; the row itself stays."""
    known = parent.select(F.col(key).alias(foreign)).dropna().distinct()
    known = known.withColumn("__known", F.lit(True))
    marked = child.join(known, foreign, "left")
    repaired = marked.withColumn(foreign, F.when(F.col("__known"), F.col(foreign)))
    return repaired.select(child.columns)


def keep_known(fact: DataFrame, entities: DataFrame, spec: Spec) -> DataFrame:
    """Fact rows whose entity has a dimension row."""
    return fact.join(entities.select(spec.entity), spec.entity, "left_semi")


def drop_report(fact: DataFrame, entities: DataFrame, spec: Spec) -> DataFrame:
    """How many rows ``keep_known`` leaves out (rows without an entity included).

    Rows are counted per entity before the join, so only one row per entity is shuffled.
    """
    sizes = fact.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("n_rows"))
    unknown = sizes.join(entities.select(spec.entity), spec.entity, "left_anti")
    return unknown.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("dropped_rows"))


def annual_fact(
    annual: DataFrame,
    entities: DataFrame,
    spec: Spec,
    order: Sequence[str],
    first_period: int = 2000,
    last_period: int = 2100,
) -> DataFrame:
    """One row per (entity, period) of the known entities, inside the period range."""
    in_range = annual.where(F.col(spec.period).between(first_period, last_period))
    single = dedupe_by_key(in_range, [spec.entity, spec.period], order)
    return keep_known(single, entities, spec)


@dataclass(frozen=True)
class Star:
    """The four tables; ``observed`` has (table, rule) -> rows, where they were counted on writing."""

    region: DataFrame
    entity: DataFrame
    profile: DataFrame
    annual: DataFrame
    observed: Mapping[tuple[str, str], int] = field(default_factory=dict)

    def tables(self) -> dict[str, DataFrame]:
        return dict(zip(TABLES, (self.region, self.entity, self.profile, self.annual), strict=True))


# The periods that a yearly row may have.
PERIOD_RANGE = (2000, 2100)


def row_rules(spec: Spec, flow: str | None = None) -> dict[str, dict[str, Column]]:
    """What must hold for every row of each table: columns that are never null, and value rules.

    A NOT NULL rule is named after its column; ``flow`` is the measure of the yearly table.
    """
    low, high = spec.slot_range

    def known(*columns: str) -> dict[str, Column]:
        return {f"{c} not null": F.col(c).isNotNull() for c in columns}

    annual = {f"{spec.period} in range": F.col(spec.period).between(*PERIOD_RANGE)}
    if flow is not None:
        annual[f"{flow} >= 0"] = F.col(flow) >= 0
    return {
        "dim_region": known(spec.region_name),
        "dim_entity": known(spec.klass, "is_major") | {"flag in (0, 1)": F.col("is_major").isin(0, 1)},
        "fact_profile": known(spec.entity, spec.slot, "observations", "mean_measure")
        | {
            "slot in window": F.col(spec.slot).between(low, high),
            "observations > 0": F.col("observations") > 0,
            "mean >= 0": F.col("mean_measure") >= 0,
        },
        "fact_annual": known(spec.entity, spec.period) | annual,
    }


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def register_table(
    spark: SparkSession, name: str, path: str, schema: StructType, by: str | None, buckets: int
) -> DataFrame:
    """Name the Parquet files of a folder as a table; with ``by``, bucketed and sorted by that column."""
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    layout = f" CLUSTERED BY ({quoted(by)}) SORTED BY ({quoted(by)}) INTO {int(buckets)} BUCKETS" if by else ""
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {quoted(name)} ({columns}) USING parquet{layout} LOCATION '{place}'")
    return spark.table(quoted(name))


def store_table(
    table: DataFrame,
    name: str,
    path: str,
    rules: Mapping[str, Column],
    by: str | None = None,
    buckets: int = 16,
    counts: Mapping[str, Column] | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """Write one table and count, in the same pass, the rows that break each rule.

    An unknown outcome passes, as in SQL CHECK. Bucketed rows are dealt by entity before they are
    written, one task per bucket; the rules are counted after that, in the tasks that write, so a
    task that runs again is counted once.
    """
    spark = table.sparkSession
    kept = register_table(spark, name, path, table.schema, by, buckets)
    watched = {rule: F.count_if(~holds) for rule, holds in rules.items()} | dict(counts or {})
    rows = table.repartition(buckets, by) if by else table
    if not watched:
        rows.write.insertInto(quoted(name))
        return kept, {}
    seen = Observation()
    rows = rows.observe(seen, *[count.alias(f"c{i}") for i, count in enumerate(watched.values())])
    rows.write.insertInto(quoted(name))
    return kept, {rule: seen.get[f"c{i}"] for i, rule in enumerate(watched)}


def store_star(
    star: Star, spec: Spec, directory: str, flow: str | None = None, buckets: int = 16
) -> Star:
    """The star as tables below a directory, with the rules of its rows counted on writing.

    Dimension and facts are bucketed and sorted by entity with one number of buckets: joining them
    needs no shuffle, and one entity's rows are in one bucket. Choose ``buckets`` so that a bucket
    of the profile fits a task; the files stay readable with `open_star`.
    """
    rules = row_rules(spec, flow)
    prefix = f"star_{uuid.uuid4().hex}"
    stored, observed = {}, {}
    for name, table in star.tables().items():
        by = spec.entity if name in BY_ENTITY else None
        stored[name], found = store_table(
            table, f"{prefix}_{name}", f"{directory}/{name}", rules[name], by, buckets
        )
        observed |= {(name, rule): n for rule, n in found.items()}
    return Star(*stored.values(), observed=observed)


def open_star(spark: SparkSession, spec: Spec, directory: str, buckets: int = 16) -> Star:
    """A star stored by `store_star` or `build_star`, named again in this session."""
    prefix = f"star_{uuid.uuid4().hex}"
    found = []
    for name in TABLES:
        path = f"{directory}/{name}"
        by = spec.entity if name in BY_ENTITY else None
        schema = spark.read.parquet(path).schema
        found.append(register_table(spark, f"{prefix}_{name}", path, schema, by, buckets))
    return Star(*found)


def build_star(
    fact: DataFrame,
    annual: DataFrame,
    spec: Spec,
    annual_columns: Sequence[str],
    first_period: int = 2000,
    last_period: int = 2100,
    directory: str | None = None,
    buckets: int = 16,
) -> Star:
    """Two dimensions and two facts from the clean fact and the yearly table.

    With a directory each table is stored and read back as soon as it is defined, so later
    tables and queries start from stored rows of known size, not again from the raw fact; what
    breaks a rule of its rows is counted while it is written. The first of ``annual_columns`` is
    the yearly measure.
    """
    rules = row_rules(spec, annual_columns[0] if annual_columns else None)
    prefix = f"star_{uuid.uuid4().hex}"
    observed: dict[tuple[str, str], int] = {}

    def settle(name: str, table: DataFrame, counts: Mapping[str, Column] | None = None) -> DataFrame:
        if directory is None:
            return table
        by = spec.entity if name in BY_ENTITY else None
        stored, found = store_table(
            table, f"{prefix}_{name}", f"{directory}/{name}", rules[name], by, buckets, counts
        )
        observed.update({(name, rule): n for rule, n in found.items()})
        return stored

    regions = dedupe_by_key(
        region_dim(fact, spec).where(F.col(spec.region).isNotNull()),
        [spec.region],
        [spec.region_name],
    )
    regions = settle("dim_region", regions)
    entities = repair_fk(entity_dim(fact, spec), spec.region, regions, spec.region)
    entities = entities.select(
        spec.entity,
        *spec.attributes,
        "is_major",
        *spec.coordinates,
        "first_period",
        "last_period",
    )
    entities = settle("dim_entity", entities)
    profile = keep_known(peak_index(fact, spec), entities, spec).select(
        spec.entity,
        spec.slot,
        "observations",
        "mean_measure",
        "median_measure",
        "sd_measure",
        *[f"mean_{c}" for c in spec.components],
        "peak_index",
    )
    yearly = annual_fact(
        annual, entities, spec, list(annual_columns), first_period, last_period
    ).select(spec.entity, spec.period, *annual_columns)
    return Star(
        regions, entities, settle("fact_profile", profile), settle("fact_annual", yearly), observed
    )


def _told(table: str, found: DataFrame) -> DataFrame:
    return found.select(F.lit(table).alias("table"), "rule", F.col("violations").cast("bigint"))


def key_rules(star: Star, spec: Spec) -> DataFrame:
    """Rows (table, rule, violations) for keys and references of the four tables.

    Keys count the key values that are repeated or incomplete, references the rows.
    """
    keys = {
        "dim_region": (star.region, [spec.region]),
        "dim_entity": (star.entity, [spec.entity]),
        "fact_profile": (star.profile, [spec.entity, spec.slot]),
        "fact_annual": (star.annual, [spec.entity, spec.period]),
    }
    references = {
        "dim_entity": (star.entity, spec.region, star.region),
        "fact_profile": (star.profile, spec.entity, star.entity),
        "fact_annual": (star.annual, spec.entity, star.entity),
    }
    parts = []
    for table, (rows, columns) in keys.items():
        broken = key_violations(rows, columns).agg(F.count(F.lit(1)).alias("violations"))
        parts.append(_told(table, broken.withColumn("rule", F.lit("key"))))
    for table, (rows, foreign, parent) in references.items():
        orphans = fk_violations(rows, foreign, parent, foreign)
        total = orphans.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("violations"))
        parts.append(_told(table, total.withColumn("rule", F.lit(f"known {foreign}"))))
    return reduce(DataFrame.unionByName, parts)


def star_violations(star: Star, spec: Spec, flow: str | None = None) -> DataFrame:
    """Rows (table, rule, violations): keys, references and the row rules of the four tables.

    Row rules that were counted on writing cost no scan; a star without such counts is read once
    per table.
    """
    if star.observed:
        rows = [(table, rule, int(n)) for (table, rule), n in star.observed.items()]
        spark = star.region.sparkSession
        found = spark.createDataFrame(rows, "table string, rule string, violations bigint")
    else:
        tables = star.tables()
        parts = [
            _told(name, check_violations(tables[name], rules))
            for name, rules in row_rules(spec, flow).items()
        ]
        found = reduce(DataFrame.unionByName, parts)
    return key_rules(star, spec).unionByName(found)


def load_report(fact: DataFrame, annual: DataFrame, star: Star, spec: Spec) -> DataFrame:
    """Rows (step, n_rows): what building the star left out or changed.

    Facts are counted per entity before they meet the dimension. A region key is repaired if the
    fact names a region for the entity and the dimension has none.
    """
    per_entity = fact.groupBy(spec.entity).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(spec.region).alias("placed_rows")
    )
    dimension = star.entity.select(
        spec.entity, F.lit(True).alias("known"), F.col(spec.region).isNull().alias("unplaced")
    )
    met = per_entity.join(dimension, spec.entity, "left").agg(
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n_rows"))), F.lit(0)).alias("profile rows dropped"),
        F.count_if(F.col("unplaced") & (F.col("placed_rows") > 0)).alias(REPAIRED),
    )
    yearly = drop_report(annual, star.entity, spec).select(
        F.lit("annual rows dropped").alias("step"), F.col("dropped_rows").alias("n_rows")
    )
    return met.unpivot([], ["profile rows dropped", REPAIRED], "step", "n_rows").unionByName(yearly)
