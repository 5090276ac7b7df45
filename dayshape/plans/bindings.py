"""The operators' roles on the test tables: hourly events, yearly orders, order lines.

The test tables hold no nulls, orphans or misspellings, so the ``*_raw`` variants put defects in
by expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayshape.operators.features import HISTORY
from dayshape.spec import FeatureSet, Spec, Split, barred

HOURLY = Spec(
    entity="user_id",
    slot="hour",
    measure="value",
    klass="c_mktsegment",
    period="year",
    date="day",
    code="event_type",
    region="r_regionkey",
    region_name="r_name",
    authority="n_name",
    components=("k",),
    main_component="k",
    required=("lat", "lon"),
    attributes=("r_regionkey", "n_name", "c_name", "c_mktsegment"),
    coordinates=("lat", "lon"),
    major_classes=("AUTOMOBILE", "MACHINERY"),
)

YEARLY = Spec(
    entity="o_custkey",
    slot="month",
    measure="o_totalprice",
    klass="c_mktsegment",
    period="year",
    date="order_date",
    code="o_orderpriority",
    region="r_regionkey",
    region_name="r_name",
    authority="n_name",
    required=("c_acctbal", "lon"),
    attributes=("r_regionkey", "n_name", "c_name", "c_mktsegment", "o_orderpriority"),
    coordinates=("c_acctbal", "lon"),
    major_classes=("AUTOMOBILE", "MACHINERY"),
    slot_range=(1, 12),
)

LINES = Spec(
    entity="l_partkey",
    slot="month",
    measure="l_extendedprice",
    klass="p_type",
    period="year",
    date="ship_date",
    code="l_returnflag",
    region="s_nationkey",
    region_name="s_nationkey",
    authority="s_nationkey",
    components=("net_price", "discount_value"),
    main_component="net_price",
    slot_range=(1, 12),
    barred=barred(
        measure=("l_extendedprice",),
        observed=("net_price", "discount_value"),
        period=("year",),
        identity=("l_partkey",),
    ),
)

LINE_FEATURES = FeatureSet(
    categorical=("l_returnflag", "l_linestatus", "p_type"),
    numeric=("month", "l_quantity", "l_discount", "l_tax", "p_size",
             *HISTORY),
)

PRIMARY = Split("primary", train_until=1998, test_from=2000)
CONTROL = Split("control", train_until=1996, test_from=1997, test_until=1998)
SPLITS = (PRIMARY, CONTROL)

# The given tables.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
# Their columns.
COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}
# Texts given as the key 7: one that is it, others that carry SQL behind a quote, bracket or comment.
HOSTILE = ("7", *(f"7{close} {sql}" for close in ("'", "')", '"', "`") for sql in ("or true", "/* x */; select 1")))
# Declared codes; the data holds two more, which the domain check must find.
EVENT_TYPES = ("click", "view", "error")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_places(facts: DataFrame, spark: SparkSession, sf_dir: str, customer: str) -> DataFrame:
    """Facts with the customer, nation and region they belong to.

    Customers grow with the facts, so neither side of their join is sent through the driver.
    """
    who = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", customer)
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    placed = facts.join(who.hint("merge"), customer).join(nation, "c_nationkey").join(region, "n_regionkey")
    return placed.select(
        *facts.columns,
        "c_name",
        "c_mktsegment",
        "c_acctbal",
        "n_name",
        F.col("c_nationkey").cast("double").alias("lon"),
        F.col("n_regionkey").alias("r_regionkey"),
        "r_name",
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly facts without attributes, for operators that need none."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.year("ts").alias("year"),
        F.hour("ts").alias("hour"),
        F.to_date("ts").alias("day"),
        "value",
        "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = with_places(events(spark, sf_dir), spark, sf_dir, "user_id")
    return facts.withColumnRenamed("c_acctbal", "lat")


def hourly_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly facts inside the slot window, with the class flag."""
    facts = hourly(spark, sf_dir)
    flag = F.when(F.col("c_mktsegment").isin(list(HOURLY.major_classes)), 1).otherwise(0)
    return facts.where(F.col("hour").between(*HOURLY.slot_range)).withColumn("is_major", flag)


def events_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where(F.col("hour").between(*HOURLY.slot_range))


def hourly_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly facts as a feed would bring them: text dates, mixed codes, gaps, negatives."""
    e = F.col("event_id")
    return hourly(spark, sf_dir).withColumns(
        {
            "day": F.when(e % 101 == 0, "n/a").otherwise(F.date_format("day", "yyyy-MM-dd")),
            "event_type": F.when(e % 3 == 0, F.concat(F.lit(" "), "event_type", F.lit("  ")))
            .when(e % 3 == 1, F.upper("event_type"))
            .otherwise(F.col("event_type")),
            "value": F.when(e % 97 == 0, None)
            .when(e % 89 == 0, -F.col("value") - 1)
            .otherwise(F.col("value")),
            "lat": F.when(F.col("user_id") % 83 != 0, F.col("lat")),
        }
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly facts without attributes."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        "o_orderstatus",
        "o_totalprice",
        F.to_date("o_orderdate").alias("order_date"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    )


def yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("c_mktsegment").isin(list(YEARLY.major_classes)), 1).otherwise(0)
    facts = with_places(orders(spark, sf_dir), spark, sf_dir, "o_custkey")
    return facts.withColumn("is_major", flag)


def annual_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean order value per (customer, year): the yearly table of the star schema."""
    return (
        orders(spark, sf_dir)
        .groupBy("o_custkey", "year")
        .agg(F.round(F.avg("o_totalprice").cast("decimal(38,6)"), 2).cast("double").alias("flow"))
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_price"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("discount_value"),
        F.to_date("l_shipdate").alias("ship_date"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
    )
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_type", "p_size"
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"
    )
    return rows.join(part, "l_partkey").join(supplier, "l_suppkey")
