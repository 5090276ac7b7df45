"""Helpers of the text operators: words, Arrow columns, stored tables, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lower-cases A-Z and turns every other ASCII character that is no letter or digit into a space.
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def plain_words(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of letters, digits and non-ASCII characters."""
    return (text or b"").translate(PLAIN).split()


def spaced_words(text: bytes | None) -> list[bytes]:
    """Runs between ASCII white space (space, tab to carriage return), unchanged."""
    return (text or b"").split()


def bytes_of(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    wide = pa.types.is_large_string(column.type)
    return column.cast(pa.large_binary() if wide else pa.binary()).to_pylist()


def by_batch(
    make: Callable[[pa.RecordBatch], pa.RecordBatch | None],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that handles each batch on its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := make(batch)) is not None:
                yield out

    return run


def batch_of(**columns: tuple[pa.DataType, object]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for kind, values in columns.values()], names=list(columns)
    )


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@cache
def own_folder(application: str) -> str:
    """A folder for the results of one local session."""
    return tempfile.mkdtemp(prefix="dayshape-")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only a local session without one gets its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = own_folder(spark.sparkContext.applicationId)
    return found.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back: its lineage ends there."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.stored_at = path
    return found


def dropped(*tables: DataFrame) -> None:
    """Deletes tables made by stored() that nothing reads any more."""
    for table in tables:
        jvm = table.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def components(edges: DataFrame, name: str) -> DataFrame:
    """(id, root) for every end of the edges (a, b): root is the smallest id that is connected.

    Each round gives a vertex the smallest root among its neighbours' and then follows that
    root's own root, so a path of n edges takes about log(n) rounds. Rows are reduced per vertex
    before each shuffle, so a vertex with very many edges is no hot key.
    """
    both = edges.select("a", "b").where("a <> b")
    both = stored(both.unionAll(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), name)
    last = stored(both.groupBy(F.col("a").alias("id")).agg(F.min(F.least("a", "b")).alias("root")), name)
    roots = last
    while True:
        near = (
            both.join(roots.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("root").alias("near"))
        )
        pulled = roots.join(near, "id").select("id", "root", F.least("root", "near").alias("best"))
        # A root learns what its members found, and members follow their root.
        told = pulled.groupBy(F.col("root").alias("id")).agg(F.min("best").alias("told"))
        up = roots.select(F.col("id").alias("best"), F.col("root").alias("above"))
        after = stored(
            pulled.join(told, "id", "left")
            .withColumn("best", F.least("best", "told"))
            .join(up, "best", "left")
            .select("id", "root", F.least("best", "above").alias("next")),
            name,
        )
        dropped(last)
        last, changed = after, after.where("next <> root").limit(1).count()
        roots = after.select("id", F.col("next").alias("root"))
        if not changed:
            dropped(both)
            return roots


def linked(
    members: DataFrame,
    fits: Callable[[str, str], str],
    confirm: Callable[[DataFrame], DataFrame],
    name: str,
    rest: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(id, root) of the components that confirmed links between candidates make.

    members is (key, rep, size, weight): rows with one key are candidates for links, and those of a
    high weight are likely to be linked with many others. fits(size, size) is a condition without
    which two can't be linked; confirm takes pairs (a, b) and returns the links among them. It runs
    in three rounds: in each bucket, all are held against the heaviest; where a bucket still spans
    several components, against the heaviest outside that one's; then fitting pairs of different
    components. Pairs within a component have nothing to add, so a bucket of near copies costs
    about as many comparisons as it has rows. For the last round, rest takes (rep, size, root) of
    all members of buckets that are still open and returns the pairs to confirm; without it these
    are all pairs of a bucket.
    """

    def against(rows: DataFrame, centers: DataFrame) -> DataFrame:
        return (
            rows.join(centers, "key")
            .where("root <> c.root")
            .where(fits("size", "c.size"))
            .select(F.least("rep", "c.rep").alias("a"), F.greatest("rep", "c.rep").alias("b"))
            .distinct()
        )

    def heaviest(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(F.max(F.struct("weight", "rep", "size", "root")).alias("c"))

    def spanning(roots: DataFrame) -> DataFrame:
        rooted = members.join(roots.withColumnRenamed("id", "rep"), "rep", "left").select(
            "key", "rep", "size", "weight", F.coalesce("root", "rep").alias("root")
        )
        ends = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        return stored(rooted.join(ends.where("low < high").select("key"), "key", "left_semi"), f"{name}-open")

    def confirmed(pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs, f"{name}-pairs")
        found = stored(confirm(pairs), f"{name}-links")
        dropped(pairs)
        return found

    def all_pairs(rows: DataFrame) -> DataFrame:
        other = rows.select("key", *(F.col(c).alias(f"{c}2") for c in ("rep", "size", "root")))
        return (
            rows.join(other, "key")
            .where("root < root2")
            .where(fits("size", "size2"))
            .select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b"))
            .distinct()
        )

    alone = members.withColumn("root", F.col("rep"))
    first = confirmed(against(alone, heaviest(alone)))
    open_ = spanning(components(first, f"{name}-roots"))
    outside = open_.join(heaviest(open_), "key").where("root <> c.root").drop("c")
    second = confirmed(against(open_, heaviest(outside)))
    dropped(open_)
    open_ = spanning(components(first.unionAll(second), f"{name}-roots"))
    third = confirmed(all_pairs(open_) if rest is None else rest(open_.select("rep", "size", "root").distinct()))
    roots = components(first.unionAll(second).unionAll(third), f"{name}-roots")
    dropped(open_, first, second, third)
    return roots
