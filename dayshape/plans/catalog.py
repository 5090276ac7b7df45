"""One named query per operator, bound to the test tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayshape import sources
from dayshape.functions import half_up
from dayshape.operators import clean, evaluate, features, models, profile, quality, reports, sketches, star
from dayshape.operators.normal import fit_line, predict_line, relative_forecast
from dayshape.operators.planner import planner, rows_per_id
from dayshape.plans import bindings as b
from dayshape.plans.bindings import HOURLY, LINE_FEATURES, LINES, PRIMARY, SPLITS, YEARLY
from dayshape.spec import FeatureSet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}



def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def plain(df: DataFrame, places: int = 6, exact: tuple[str, ...] = ()) -> DataFrame:
    """Whole numbers as bigint and computed doubles rounded, so that results compare by value."""
    columns = []
    for name, kind in df.dtypes:
        if kind in ("int", "smallint", "tinyint"):
            columns.append(F.col(name).cast("bigint").alias(name))
        elif kind == "double" and name not in exact:
            columns.append(half_up(F.col(name), places).alias(name))
        else:
            columns.append(F.col(name))
    return df.select(columns)


def scratch(spark: SparkSession) -> str:
    """A new folder below the cluster's shared one; a local folder only in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/dayshape-{uuid.uuid4()}"
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="dayshape-")


# ---- sources and sinks ---------------------------------------------------------------------


ORDER_COLUMNS = {
    "o_orderkey": "bigint",
    "o_orderpriority": "string",
    "o_totalprice": "double",
    "year": "int",
}


@query
def read_csv_named(spark, sf_dir):
    text = b.orders(spark, sf_dir).select(
        "year",
        F.when(F.col("o_orderkey") % 97 == 0, "NA")
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("o_totalprice"),
        "o_orderstatus",
        "o_orderpriority",
        "o_orderkey",
    )
    path = f"{scratch(spark)}/orders.csv"
    text.write.option("header", True).csv(path)
    return plain(sources.read_named(spark, path, ORDER_COLUMNS), exact=("o_totalprice",))


def _orders_by_year(spark, sf_dir) -> str:
    path = f"{scratch(spark)}/orders.parquet"
    rows = b.orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice", "month", "year")
    sources.write_by_period(rows, path, "year")
    return path


@query
def write_partitioned(spark, sf_dir):
    path = _orders_by_year(spark, sf_dir)
    return plain(sources.scan_periods(spark, path, "year"), exact=("o_totalprice",))


@query
def scan_pruned(spark, sf_dir):
    path = _orders_by_year(spark, sf_dir)
    late = sources.scan_periods(spark, path, "year", first=2000)
    return plain(late.groupBy("month").agg(F.avg("o_totalprice").alias("mean_price")), 4)


@query
def write_tables(spark, sf_dir):
    facts = b.hourly_clean(spark, sf_dir)
    paths = sources.write_tables(
        {
            "dim_entity": profile.entity_dim(facts, HOURLY),
            "dim_region": profile.region_dim(facts, HOURLY),
        },
        scratch(spark),
    )
    return plain(
        spark.read.parquet(paths["dim_entity"])
        .join(spark.read.parquet(paths["dim_region"]), "r_regionkey")
        .select("user_id", "r_name", "entities", "authorities")
    )


def _star(spark, sf_dir, directory: str | None = None) -> star.Star:
    return star.build_star(
        b.hourly_clean(spark, sf_dir),
        b.annual_flow(spark, sf_dir).withColumnRenamed("o_custkey", "user_id"),
        HOURLY,
        annual_columns=["flow"],
        first_period=1996,
        last_period=2100,
        directory=directory,
    )


def _profile_star(spark, sf_dir) -> star.Star:
    """The star's dimensions and profile without its filters, all lazy."""
    facts = b.hourly_clean(spark, sf_dir)
    return star.Star(
        region=profile.region_dim(facts, HOURLY),
        entity=profile.entity_dim(facts, HOURLY),
        profile=profile.peak_index(b.events_clean(spark, sf_dir), HOURLY),
        annual=b.annual_flow(spark, sf_dir).withColumnRenamed("o_custkey", "user_id"),
    )


STORED: dict[tuple[str, str], star.Star] = {}


def _planner_star(spark, sf_dir) -> star.Star:
    """That star, stored by entity once per application: what all planner queries read."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in STORED:
        STORED[key] = star.store_star(_profile_star(spark, sf_dir), HOURLY, scratch(spark), "flow")
    return STORED[key]


@query
def build_star(spark, sf_dir):
    built = _star(spark, sf_dir, scratch(spark))

    def facet(name: str, table: DataFrame, total) -> DataFrame:
        broken = sum(n for (owner, _), n in built.observed.items() if owner == name)
        return table.agg(F.count(F.lit(1)).alias("n_rows"), total.alias("total")).select(
            F.lit(name).alias("table"), "n_rows", "total", F.lit(broken).cast("bigint").alias("violations")
        )

    parts = [
        facet("dim_region", built.region, F.sum(F.col("entities").cast("double"))),
        facet("dim_entity", built.entity, F.sum("lat")),
        facet("fact_profile", built.profile, F.sum("peak_index")),
        facet("fact_annual", built.annual, F.sum("flow")),
    ]
    return plain(evaluate.results_table(*parts), 2)


def _defective_star(spark, sf_dir) -> star.Star:
    """A star built from rows that break its rules, then robbed of entities and given repeated rows."""
    user = F.col("user_id")
    flag = F.when(F.col("c_mktsegment").isin(list(HOURLY.major_classes)), 1).otherwise(0)
    facts = b.hourly(spark, sf_dir).withColumns(
        {
            "value": F.when(user % 11 == 0, -F.col("value")).otherwise(F.col("value")),
            "c_mktsegment": F.when(user % 13 != 0, F.col("c_mktsegment")),
            "r_name": F.when(F.col("r_regionkey") != 3, F.col("r_name")),
            "is_major": F.when(user % 17 == 0, 2).otherwise(flag),
        }
    )
    flow = F.when(user % 19 == 0, -F.col("flow")).otherwise(F.col("flow"))
    annual = b.annual_flow(spark, sf_dir).withColumnRenamed("o_custkey", "user_id").withColumn("flow", flow)
    built = star.build_star(facts, annual, HOURLY, ["flow"], first_period=1990, directory=scratch(spark))
    return replace(
        built,
        entity=built.entity.where("user_id % 7 <> 0"),
        profile=built.profile.unionAll(built.profile.where("hour = 9")),
    )


@query
def star_check(spark, sf_dir):
    return star.star_violations(_defective_star(spark, sf_dir), HOURLY)


@query
def load_report(spark, sf_dir):
    whole = _planner_star(spark, sf_dir)
    placed = whole.region.where("r_regionkey <> 2")
    entity = star.repair_fk(whole.entity.where("user_id % 7 <> 0"), "r_regionkey", placed, "r_regionkey")
    found = replace(whole, region=placed, entity=entity)
    return plain(star.load_report(b.hourly_clean(spark, sf_dir), whole.annual, found, HOURLY))


@query
def table_scale(spark, sf_dir):
    return sources.row_counts({n: b.table(spark, sf_dir, n) for n in b.TABLES})


@query
def prediction_sample(spark, sf_dir):
    train, test = features.feature_blocks(b.lines(spark, sf_dir), LINES, PRIMARY, scratch(spark))
    scored = evaluate.baseline_predictions(train, test, LINES, "primary")
    cents = F.round(F.col("actual") * 100).cast("bigint")
    picked = sources.smallest_hashes(scored, ["model", LINES.entity, LINES.slot, cents], 20_000)
    path = f"{scratch(spark)}/predictions.parquet"
    picked.write.parquet(path)
    return plain(spark.read.parquet(path), 4, exact=("actual",))


@query
def sql_slot_view(spark, sf_dir):
    sources.register(b.events_clean(spark, sf_dir), "hourly_facts")
    return spark.sql(
        """
        SELECT CAST(hour AS BIGINT) AS hour, count(*) AS observations,
               CAST(round(CAST(avg(value) AS DECIMAL(38, 5)), 1) AS DOUBLE) AS mean_measure,
               CAST(round(CAST(avg(k) AS DECIMAL(38, 5)), 1) AS DOUBLE) AS mean_k
        FROM hourly_facts GROUP BY hour
        """
    )


# ---- projections, filters, predicates ------------------------------------------------------


@query
def normalise_code(spark, sf_dir):
    rows = clean.normalise_code(b.hourly_raw(spark, sf_dir), "event_type")
    return rows.select("event_id", "event_type")


@query
def slot_window(spark, sf_dir):
    rows = clean.slot_window(b.events(spark, sf_dir), HOURLY)
    return plain(rows.select("event_id", "user_id", "hour", "value"), exact=("value",))


@query
def require_measure(spark, sf_dir):
    rows = clean.require_measure(b.hourly_raw(spark, sf_dir), HOURLY)
    return rows.select("event_id", "value")


@query
def require_present(spark, sf_dir):
    gaps = b.yearly(spark, sf_dir).withColumns(
        {
            "c_acctbal": F.when(F.col("o_custkey") % 83 != 0, F.col("c_acctbal")),
            "lon": F.when(F.col("o_orderkey") % 97 != 0, F.col("lon")),
        }
    )
    return clean.require_present(gaps, YEARLY.required).select("o_orderkey", "c_acctbal", "lon")


@query
def class_flag(spark, sf_dir):
    rows = clean.class_flag(b.yearly(spark, sf_dir), YEARLY)
    return plain(rows.select("o_orderkey", "c_mktsegment", "is_major"))


def _dates_as_text(spark, sf_dir) -> DataFrame:
    key = F.col("o_orderkey")
    return b.orders(spark, sf_dir).withColumn(
        "order_date",
        F.when(key % 101 == 0, "1999-02-30")
        .when(key % 103 == 0, "unknown")
        .otherwise(F.date_format("order_date", "yyyy-MM-dd")),
    )


@query
def safe_date(spark, sf_dir):
    return clean.safe_date(_dates_as_text(spark, sf_dir), "order_date").select(
        "o_orderkey", "order_date"
    )


@query
def calendar_features(spark, sf_dir):
    rows = clean.calendar_features(b.events(spark, sf_dir), "day")
    return plain(rows.select("event_id", "day_of_week", "month", "is_weekend"))


@query
def non_component_share(spark, sf_dir):
    gaps = b.lines(spark, sf_dir).withColumns(
        {
            "l_extendedprice": F.when(F.col("l_orderkey") % 89 == 0, 0.0).otherwise(
                F.col("l_extendedprice")
            ),
            "net_price": F.when(F.col("l_orderkey") % 97 != 0, F.col("net_price")),
        }
    )
    rows = clean.non_component_share(gaps, "l_extendedprice", "net_price")
    return plain(
        rows.select("l_orderkey", "l_linenumber", "l_partkey", "non_component_share"),
        exact=("non_component_share",),
    )


@query
def clean_fact(spark, sf_dir):
    rows = clean.clean_fact(b.hourly_raw(spark, sf_dir), HOURLY)
    return plain(
        rows.select(
            "event_id", "user_id", "year", "hour", "day", "value", "event_type", "k",
            "c_mktsegment", "n_name", "r_name", "lat", "lon",
            "is_major", "day_of_week", "month", "is_weekend", "non_component_share",
        ),
        exact=("value", "lat", "lon", "non_component_share"),
    )


@query
def cleaning_losses(spark, sf_dir):
    return clean.cleaning_losses(b.hourly_raw(spark, sf_dir), HOURLY)


@query
def period_split(spark, sf_dir):
    facts = b.orders(spark, sf_dir)
    parts = []
    for split in SPLITS:
        blocks = zip(("train", "test"), clean.period_split(facts, YEARLY, split), strict=True)
        for name, rows in blocks:
            parts.append(
                rows.groupBy("year")
                .agg(F.count(F.lit(1)).alias("n_rows"))
                .select(F.lit(split.name).alias("split"), F.lit(name).alias("block"),
                        "year", "n_rows")
            )
    return plain(evaluate.results_table(*parts))


@query
def domain_check(spark, sf_dir):
    return clean.domain_check(b.events(spark, sf_dir), "event_type", b.EVENT_TYPES)


# ---- joins ---------------------------------------------------------------------------------


@query
def attach_history(spark, sf_dir):
    facts = b.orders(spark, sf_dir)
    train, test = clean.period_split(facts, YEARLY, PRIMARY)
    rows = features.attach_history(test, features.entity_history(train, YEARLY), YEARLY)
    return plain(rows.select("o_orderkey", "o_custkey", "hist_mean", "hist_sd", "hist_periods"), 4)


@query
def entity_profile(spark, sf_dir):
    with planner(spark, _planner_star(spark, sf_dir), HOURLY) as ask:
        return plain(ask.entity_profile("7"))


@query
def entity_peak_map(spark, sf_dir):
    built = _planner_star(spark, sf_dir)
    gaps = built.entity.withColumn("lat", F.when(F.col("user_id") % 7 != 0, F.col("lat")))
    peaks = profile.entity_peak(built.profile, HOURLY)
    return plain(reports.entity_peak_map(replace(built, entity=gaps), peaks, HOURLY))


@query
def region_star(spark, sf_dir):
    rows = reports.region_star(_planner_star(spark, sf_dir), HOURLY)
    return plain(
        rows.select("user_id", "hour", "mean_measure", "peak_index", "c_mktsegment", "r_name")
    )


def _orphans(spark, sf_dir) -> DataFrame:
    """Orders of which some name a customer that does not exist."""
    key = F.col("o_custkey")
    return b.orders(spark, sf_dir).withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 97 == 0, -key - 1).otherwise(key)
    )


def _customers(spark, sf_dir) -> DataFrame:
    return b.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))


@query
def repair_fk(spark, sf_dir):
    rows = star.repair_fk(
        _orphans(spark, sf_dir), "o_custkey", b.table(spark, sf_dir, "customer"), "c_custkey"
    )
    return rows.select("o_orderkey", "o_custkey")


@query
def keep_known(spark, sf_dir):
    facts, known = _orphans(spark, sf_dir), _customers(spark, sf_dir)
    kept = star.keep_known(facts, known, YEARLY)
    dropped = star.drop_report(facts, known, YEARLY)
    totals = kept.agg(F.count(F.lit(1)).alias("kept_rows"), F.sum("o_totalprice").alias("kept_sum"))
    return plain(totals.withColumn("dropped_rows", dropped.scalar()), 2)


@query
def annual_fact(spark, sf_dir):
    twice = b.annual_flow(spark, sf_dir)
    copy = twice.where("o_custkey % 5 = 0").withColumn("flow", F.col("flow") + 1)
    orphan = twice.where("o_custkey % 50 = 0").withColumn("o_custkey", -F.col("o_custkey") - 1)
    rows = star.annual_fact(
        twice.unionByName(copy).unionByName(orphan),
        _customers(spark, sf_dir),
        YEARLY,
        order=["flow"],
        first_period=1996,
        last_period=2000,
    )
    return plain(rows.select("o_custkey", "year", "flow"), 2)


@query
def align_models(spark, sf_dir):
    results = evaluate.skill(_model_results(spark, sf_dir))
    return plain(evaluate.align_models(results, "skill"))


# ---- aggregations --------------------------------------------------------------------------


@query
def dedupe_by_key(spark, sf_dir):
    rows = b.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax",
    )
    order = [c for c in rows.columns if c not in ("l_orderkey", "l_linenumber")]
    return plain(
        star.dedupe_by_key(rows, ["l_orderkey", "l_linenumber"], order),
        exact=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    )


@query
def slot_profile(spark, sf_dir):
    return plain(profile.slot_profile(b.events_clean(spark, sf_dir), HOURLY))


@query
def entity_peak(spark, sf_dir):
    rows = profile.peak_index(b.events_clean(spark, sf_dir), HOURLY)
    return plain(profile.entity_peak(rows, HOURLY))


@query
def entity_dim(spark, sf_dir):
    facts = b.yearly(spark, sf_dir).withColumn(
        "o_orderpriority", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority"))
    )
    return plain(profile.entity_dim(facts, YEARLY))


@query
def region_dim(spark, sf_dir):
    return plain(profile.region_dim(b.hourly_clean(spark, sf_dir), HOURLY))


@query
def slot_summary(spark, sf_dir):
    return plain(profile.slot_summary(b.events_clean(spark, sf_dir), HOURLY))


@query
def class_peak(spark, sf_dir):
    with planner(spark, _planner_star(spark, sf_dir), HOURLY) as ask:
        return plain(ask.class_peak())


@query
def annual_trend(spark, sf_dir):
    whole = _planner_star(spark, sf_dir)
    gaps = whole.annual.withColumn("flow", F.when(F.col("user_id") % 11 != 0, F.col("flow")))
    with planner(spark, replace(whole, annual=gaps), HOURLY, "flow") as ask:
        return plain(ask.annual_trend(1996, 2000))


@query
def region_summary(spark, sf_dir):
    with planner(spark, _planner_star(spark, sf_dir), HOURLY) as ask:
        return plain(ask.region_summary())


@query
def slot_distribution(spark, sf_dir):
    return plain(profile.slot_distribution(b.events_clean(spark, sf_dir), HOURLY))


@query
def peak_trough(spark, sf_dir):
    slots = profile.slot_distribution(b.events_clean(spark, sf_dir), HOURLY)
    return plain(profile.peak_trough(slots, HOURLY))


@query
def period_break(spark, sf_dir):
    return plain(profile.period_break(b.orders(spark, sf_dir), YEARLY), 4)


@query
def moments(spark, sf_dir):
    return plain(quality.moments(b.events_clean(spark, sf_dir), "value"))


@query
def histogram(spark, sf_dir):
    return quality.histogram(b.events_clean(spark, sf_dir), "value", width=10)


@query
def corr_matrix(spark, sf_dir):
    facts = b.lines(spark, sf_dir).withColumn(
        "l_tax", F.when(F.col("l_orderkey") % 97 != 0, F.col("l_tax"))
    )
    columns = ["month", "l_quantity", "l_discount", "l_tax", "p_size", "net_price",
               "l_extendedprice"]
    return quality.corr_matrix(facts, columns)


LINE_NUMERICS = ["month", "l_quantity", "l_discount", "l_tax", "p_size", "net_price"]


@query
def corr_with_measure(spark, sf_dir):
    return quality.corr_with(b.lines(spark, sf_dir), "l_extendedprice", LINE_NUMERICS)


@query
def quality_profile(spark, sf_dir):
    """Every column of every given table, and of the raw feed with its defects."""
    tables = {n: b.table(spark, sf_dir, n) for n in b.TABLES}
    return quality.null_profiles(tables | {"raw": b.hourly_raw(spark, sf_dir).drop("c_name", "r_regionkey")})


@query
def missing_by_class(spark, sf_dir):
    gaps = b.yearly(spark, sf_dir).withColumn(
        "link_length",
        F.when((F.col("is_major") == 1) | (F.col("o_orderkey") % 5 == 0), F.col("o_totalprice")),
    )
    return quality.missing_by_class(gaps, "c_mktsegment", "link_length")


@query
def component_identity(spark, sf_dir):
    facts = b.lines(spark, sf_dir).withColumn(
        "discount_value", F.when(F.col("l_orderkey") % 97 != 0, F.col("discount_value"))
    )
    return plain(
        quality.component_identity(
            facts, "l_extendedprice", ["net_price", "discount_value"], tolerance=1e-6
        )
    )


@query
def cardinality(spark, sf_dir):
    facts = b.hourly_clean(spark, sf_dir)
    exact = ["year", "hour", "r_name", "event_type", "user_id"]
    found = quality.cardinality(facts, exact, ["user_id", "hour"])
    estimate = F.max(F.when(F.col("method") == "approximate", F.col("n_distinct")))
    truth = F.max(F.when(F.col("method") == "exact", F.col("n_distinct")))
    return found.groupBy("column").agg(
        truth.alias("n_distinct"),
        # Five standard errors of the sketch.
        F.when(estimate.isNotNull(), (F.abs(estimate - truth) <= 0.25 * truth).cast("bigint"))
        .alias("estimate_close"),
    )


@query
def iqr_outliers(spark, sf_dir):
    return plain(quality.iqr_outliers(b.events_clean(spark, sf_dir), "value"))


SHARES = [0.05, 0.25, 0.5, 0.75, 0.9, 0.99]


@query
def kept_quantiles(spark, sf_dir):
    """Quantiles per slot from sketches kept per day and slot, held against the whole fact."""
    facts = b.events_clean(spark, sf_dir)
    daily = sketches.sketch(facts, ["day", "hour"], ["value"])
    kept = spark.read.parquet(sources.write_tables({"sketches": daily}, scratch(spark))["sketches"])
    found = sketches.sketch_quantiles(sketches.merge(kept, ["hour"]), "value", SHARES, ["hour"])
    gaps = sketches.rank_gap(facts, found, "value", ["hour"])
    near = F.col("gap") <= sketches.rank_error()
    return plain(gaps.select("hour", "share", near.cast("bigint").alias("near")))


@query
def kept_distinct(spark, sf_dir):
    """Distinct counts of all days from sketches kept per day, against direct and exact ones."""
    facts = b.hourly_clean(spark, sf_dir)
    keys = ["user_id", "hour", "n_name"]
    daily = sketches.sketch(facts, ["day"], keys=keys)
    kept = spark.read.parquet(sources.write_tables({"sketches": daily}, scratch(spark))["sketches"])
    merged = sketches.sketch_distinct(sketches.merge(kept), keys)
    direct = sketches.sketch_distinct(sketches.sketch(facts, keys=keys), keys)
    exact = quality.exact_distinct(facts, keys)
    both = exact.join(merged.withColumnRenamed("n_distinct", "merged"), "column").join(
        direct.withColumnRenamed("n_distinct", "direct"), "column"
    )
    far = F.abs(F.col("merged") - F.col("n_distinct")) / F.col("n_distinct")
    # Five standard errors.
    return both.select(
        "column",
        "n_distinct",
        (F.col("merged") == F.col("direct")).cast("bigint").alias("same_merged"),
        (far <= 5 * sketches.distinct_error()).cast("bigint").alias("near"),
    )


@query
def mean_index_by_slot(spark, sf_dir):
    rows = profile.peak_index(b.events_clean(spark, sf_dir), HOURLY)
    return plain(profile.mean_index_by_slot(rows, HOURLY))


@query
def dead_entities(spark, sf_dir):
    facts = b.events_clean(spark, sf_dir).withColumn(
        "value", F.when(F.col("user_id") % 10 == 3, 0.0).otherwise(F.col("value"))
    )
    return profile.dead_entities(profile.peak_index_exact(facts, HOURLY), HOURLY)


@query
def entity_history(spark, sf_dir):
    train, _ = clean.period_split(b.orders(spark, sf_dir), YEARLY, PRIMARY)
    return plain(features.entity_history(train, YEARLY))


@query
def class_pivot(spark, sf_dir):
    rows = reports.class_peak(_planner_star(spark, sf_dir), HOURLY)
    return plain(reports.class_pivot(rows, HOURLY, b.table(spark, sf_dir, "customer")))


@query
def clip_at_quantile(spark, sf_dir):
    peaks = profile.entity_peak(profile.peak_index(b.events_clean(spark, sf_dir), HOURLY), HOURLY)
    return plain(
        quality.clip_at_quantile(peaks, "max_peak_index").select(
            "user_id", "max_peak_index", "clipped"
        )
    )


@query
def latest_period(spark, sf_dir):
    built = _planner_star(spark, sf_dir)
    return plain(reports.latest_period(built.annual, built.profile, HOURLY, "flow"))


# ---- windows -------------------------------------------------------------------------------


@query
def peak_index(spark, sf_dir):
    return plain(profile.peak_index(b.events_clean(spark, sf_dir), HOURLY))


@query
def peak_index_exact(spark, sf_dir):
    return plain(profile.peak_index_exact(b.events_clean(spark, sf_dir), HOURLY))


@query
def index_by_class(spark, sf_dir):
    return plain(profile.index_by(b.hourly_clean(spark, sf_dir), ["c_mktsegment"], HOURLY))


@query
def index_by_daytype(spark, sf_dir):
    facts = clean.calendar_features(b.events_clean(spark, sf_dir), "day")
    return plain(profile.index_by(facts, ["is_weekend"], HOURLY))


@query
def region_sharpness(spark, sf_dir):
    return plain(profile.region_sharpness(b.hourly_clean(spark, sf_dir), HOURLY))


@query
def base_index(spark, sf_dir):
    return plain(
        profile.base_index(b.lines(spark, sf_dir), LINES, ["net_price", "discount_value"])
    )


@query
def model_rank(spark, sf_dir):
    return plain(evaluate.model_rank(_model_results(spark, sf_dir)))


# ---- top-k ---------------------------------------------------------------------------------


@query
def sharpest(spark, sf_dir):
    with planner(spark, _planner_star(spark, sf_dir), HOURLY) as ask:
        return plain(ask.sharpest(("c_name", "c_mktsegment", "n_name")))


@query
def sharpest_named(spark, sf_dir):
    rows = reports.sharpest(
        _planner_star(spark, sf_dir),
        HOURLY,
        ["n_name", "c_mktsegment"],
        limit=15,
        min_observations=6,
    )
    return plain(rows.drop("observations"))


@query
def top_features(spark, sf_dir):
    weights = quality.corr_with(b.lines(spark, sf_dir), "l_extendedprice", LINE_NUMERICS)
    return evaluate.top_features(
        weights.withColumnsRenamed({"column": "feature", "r": "weight"})
    )


# ---- constraints and bound parameters ------------------------------------------------------


@query
def pk_violations(spark, sf_dir):
    rows = b.table(spark, sf_dir, "lineitem")
    return plain(quality.key_violations(rows, ["l_orderkey", "l_linenumber"]))


@query
def fk_violations(spark, sf_dir):
    facts = _orphans(spark, sf_dir).withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 89 != 0, F.col("o_custkey"))
    )
    return quality.fk_violations(
        facts, "o_custkey", b.table(spark, sf_dir, "customer"), "c_custkey"
    )


@query
def check_violations(spark, sf_dir):
    rows = profile.peak_index(b.events(spark, sf_dir), HOURLY).withColumns(
        {
            "observations": F.col("observations") - 1,
            "mean_measure": F.when(
                F.col("user_id") % 9 != 0, F.col("mean_measure") - 1
            ),
            "flag": (F.col("user_id") % 3).cast("int"),
            "year": (F.col("hour") + 1990).cast("int"),
        }
    )
    return quality.check_violations(
        rows,
        {
            "flag in (0, 1)": F.col("flag").isin(0, 1),
            "slot in window": F.col("hour").between(7, 18),
            "observations > 0": F.col("observations") > 0,
            "mean >= 0": F.col("mean_measure") >= 0,
            "year in range": F.col("year").between(2000, 2100),
        },
    )


@query
def notnull_violations(spark, sf_dir):
    return quality.notnull_violations(
        b.hourly_raw(spark, sf_dir), ["event_id", "value", "lat", "c_mktsegment"]
    )


@query
def bound_params(spark, sf_dir):
    """Rows per id given as text: the texts are arguments of one query over the orders."""
    return rows_per_id(b.orders(spark, sf_dir), "o_custkey", b.HOSTILE)


# ---- features and models -------------------------------------------------------------------


@query
def leakage_guard(spark, sf_dir):
    features.leakage_guard(LINE_FEATURES, LINES)
    return features.leakage_evidence(
        b.lines(spark, sf_dir),
        "l_extendedprice",
        ["month", "l_quantity", "l_discount", "net_price", "discount_value"],
        parts=["net_price", "discount_value"],
        tolerance=1e-6,
    )


@query
def feature_blocks(spark, sf_dir):
    train, test = features.feature_blocks(
        b.orders(spark, sf_dir), YEARLY, PRIMARY, scratch(spark)
    )
    both = train.select(F.lit("train").alias("block"), "*").unionByName(
        test.select(F.lit("test").alias("block"), "*")
    )
    return plain(both.select("block", "o_orderkey", "hist_mean", "hist_sd", "hist_periods"), 4)


def _row_histories(spark, sf_dir, history: str) -> DataFrame:
    train, _ = features.feature_blocks(b.orders(spark, sf_dir), YEARLY, PRIMARY, scratch(spark), history)
    return plain(train.select("o_orderkey", "hist_mean", "hist_sd", "hist_periods"), 2)


@query
def history_earlier(spark, sf_dir):
    return _row_histories(spark, sf_dir, "earlier")


@query
def history_others(spark, sf_dir):
    return _row_histories(spark, sf_dir, "others")


def _training_lines(spark, sf_dir) -> DataFrame:
    train, _ = features.feature_blocks(
        b.lines(spark, sf_dir), LINES, PRIMARY, scratch(spark)
    )
    gaps = F.when(F.col("l_partkey") % 31 != 0, F.col("p_type"))
    return train.withColumn("p_type", gaps).select(LINES.measure, *LINE_FEATURES.names)


@query
def encode_features(spark, sf_dir):
    train = _training_lines(spark, sf_dir)
    block = models.encoder(LINE_FEATURES).fit(train).transform(train)
    means = block.agg(
        Summarizer.metrics("mean", "count").summary(F.col(models.RAW_VECTOR)).alias("s")
    )
    named = F.arrays_zip(
        F.array(*[F.lit(n) for n in models.slot_names(block)]).alias("feature"),
        vector_to_array("s.mean").alias("mean"),
    )
    return plain(means.select(F.inline(named)))


def _dealt_lines(spark, sf_dir) -> DataFrame:
    """The training lines dealt evenly; they are counted before the history is joined to them."""
    plain_train, _ = clean.period_split(b.lines(spark, sf_dir), LINES, PRIMARY)
    return models.dealt(_training_lines(spark, sf_dir), models.parts_for(plain_train))


def _weights(spark, sf_dir, *names: str) -> DataFrame:
    with models.kept_in_memory(_dealt_lines(spark, sf_dir)) as block:
        encoded = models.encoder(LINE_FEATURES).fit(block).transform(block)
        offered = models.learners(LINES.measure)
        fits = [models.fit(name, offered[name], encoded, "primary") for name in names]
    return evaluate.results_table(*[models.interpret(encoded, fitted) for fitted in fits])


@query
def fit_linear(spark, sf_dir):
    return _weights(spark, sf_dir, "linear")


@query
def fit_closed_form(spark, sf_dir):
    """A line on one number, and one on a category with gaps: the weights of both."""
    train, _ = clean.period_split(b.lines(spark, sf_dir), LINES, PRIMARY)
    gaps = train.withColumn("l_returnflag", F.when(F.col("l_partkey") % 31 != 0, F.col("l_returnflag")))
    parts = [
        fit_line(gaps, found, LINES.measure).table(spark).withColumn("model", F.lit(name))
        for name, found in (("number", FeatureSet((), ("l_quantity",))), ("category", FeatureSet(("l_returnflag",), ())))
    ]
    return plain(evaluate.results_table(*parts), 4)


@query
def fit_forest(spark, sf_dir):
    return _weights(spark, sf_dir, "forest")


@query
def fit_gbt(spark, sf_dir):
    return _weights(spark, sf_dir, "boosted")


@query
def interpret(spark, sf_dir):
    return _weights(spark, sf_dir, "linear", "forest")


@query
def importance_share(spark, sf_dir):
    return evaluate.importance_share(
        _weights(spark, sf_dir, "forest"),
        {"history": features.HISTORY, "slot": ["month"], "class": ["p_type"]},
    )


@query
def tune_forest(spark, sf_dir):
    """Folds, their rows and grid points; the errors, which SQL can't tell, only as known and positive."""
    with models.kept_in_memory(_dealt_lines(spark, sf_dir)) as block:
        encoded = models.encoder(LINE_FEATURES).fit(block).transform(block)
        found = models.cross_validate(encoded, LINES.measure, "primary")
    rows = found.table(spark).withColumn("scored", (F.col("rmse") > 0).cast("bigint")).drop("rmse")
    return plain(rows)


@query
def run_split(spark, sf_dir):
    facts = b.lines(spark, sf_dir)
    parts = []
    for split in SPLITS:
        run = models.run_split(facts, LINES, LINE_FEATURES, split, directory=scratch(spark))
        scores = evaluate.with_efficiency(
            evaluate.score(run.predictions), models.fit_seconds(spark, run.fits)
        )
        parts += [evaluate.trivial_baselines(run.train, run.test, LINES, split.name), scores]
    return evaluate.skill(evaluate.results_table(*parts))


@query
def relative_target(spark, sf_dir):
    _, test = features.feature_blocks(
        b.orders(spark, sf_dir), YEARLY, PRIMARY, scratch(spark)
    )
    rows = features.relative_target(test, YEARLY)
    return plain(rows.select("o_orderkey", "relative_measure"))


# ---- evaluation ----------------------------------------------------------------------------


def _blocks(spark, sf_dir, split):
    return features.feature_blocks(b.yearly(spark, sf_dir), YEARLY, split, scratch(spark), join="merge")


def _stored_blocks(spark, sf_dir, split) -> tuple[DataFrame, DataFrame]:
    """The blocks' columns that models and layout need, joined once: several models read them."""
    needed = (YEARLY.entity, YEARLY.slot, YEARLY.klass, YEARLY.measure, *features.HISTORY)
    blocks = zip(("train", "test"), _blocks(spark, sf_dir, split), strict=True)
    paths = sources.write_tables({name: rows.select(*needed) for name, rows in blocks}, scratch(spark))
    return spark.read.parquet(paths["train"]), spark.read.parquet(paths["test"])


STORED_PREDICTIONS: dict[tuple[str, str], DataFrame] = {}


def _predictions(spark, sf_dir) -> DataFrame:
    """Forecasts of all models on both splits, in the long layout, stored once per application.

    The naive forecasts, lines on one feature and, on the primary split, a line on the relative
    target. The control split has two models fewer, as when tuning runs on the primary split alone.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in STORED_PREDICTIONS:
        wanted = {"primary": ("hist_mean", "month"), "control": ("hist_mean",)}
        layout, label = (YEARLY.entity, YEARLY.slot, YEARLY.klass), YEARLY.measure
        parts = []
        for split in SPLITS:
            train, test = _stored_blocks(spark, sf_dir, split)
            plain_train, _ = clean.period_split(b.orders(spark, sf_dir), YEARLY, split)
            parts.append(evaluate.baseline_predictions(plain_train, test, YEARLY, split.name))
            for column in wanted[split.name]:
                line = fit_line(train, FeatureSet((), (column,)), label)
                parts.append(predict_line(line, test, split.name, f"linear on {column}", layout, label))
            if split is PRIMARY:
                month = FeatureSet((), ("month",))
                parts.append(relative_forecast(train, test, YEARLY, month, split.name))
        path = f"{scratch(spark)}/predictions"
        STORED_PREDICTIONS[key] = evaluate.store_predictions(evaluate.results_table(*parts), path)
    return STORED_PREDICTIONS[key]


def _model_results(spark, sf_dir) -> DataFrame:
    return evaluate.score(_predictions(spark, sf_dir))


@query
def score(spark, sf_dir):
    return plain(evaluate.score(_predictions(spark, sf_dir)), 4)


@query
def trivial_baselines(spark, sf_dir):
    parts = []
    for split in SPLITS:
        _, test = _blocks(spark, sf_dir, split)
        train, _ = clean.period_split(b.orders(spark, sf_dir), YEARLY, split)
        parts.append(evaluate.trivial_baselines(train, test, YEARLY, split.name))
    return plain(evaluate.results_table(*parts), 4)


@query
def results_table(spark, sf_dir):
    return plain(_model_results(spark, sf_dir), 4)


@query
def skill(spark, sf_dir):
    return plain(
        evaluate.skill(_model_results(spark, sf_dir)).select("split", "model", "r2_gain", "skill")
    )


@query
def best_breakdown(spark, sf_dir):
    return plain(evaluate.best_breakdown(_model_results(spark, sf_dir)))


@query
def profile_actual_pred(spark, sf_dir):
    return plain(evaluate.profile_actual_pred(_predictions(spark, sf_dir), YEARLY), 4)


@query
def residual_by_slot(spark, sf_dir):
    return plain(evaluate.residual_by_slot(_predictions(spark, sf_dir), YEARLY), 4)


@query
def error_by_class(spark, sf_dir):
    return plain(evaluate.error_by_class(_predictions(spark, sf_dir), YEARLY), 4)


@query
def density_2d(spark, sf_dir):
    return plain(evaluate.density_2d(_predictions(spark, sf_dir)))


@query
def split_profile(spark, sf_dir):
    facts = b.orders(spark, sf_dir)
    blocks = {s.name: clean.period_split(facts, YEARLY, s) for s in SPLITS}
    return plain(evaluate.split_profile(blocks, YEARLY), 4)
