"""Exact top-k inner products over vectors bucketed by norm.

Vectors are grouped by length into blocks, longest first. For a query, the k-th best score so far
and a block's largest norm give a local cosine threshold. Above 1 the block, and every later one,
is done with. A low threshold prunes by length alone; a high one by coordinate: a vector whose
component along the query's leading coordinate lies outside the range that the threshold leaves
cannot reach it. What is left is multiplied out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUERY_BLOCK = 1024  # queries that are sent to all executors at a time
BLOCK_ROWS = 2048  # vectors of similar norm that share a local threshold
COORDINATE_COSINE = 0.5  # from this local threshold on, coordinates prune better than length
MARGIN = 1e-9  # relative slack of norms and cosines, so that rounding prunes nothing too much

FOUND = "query_id long, vec_id long, score long"


def scaled(vectors: DataFrame, column: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v): components as floor(scale * x), for rows with only finite components."""
    usable = f"exists({column}, x -> x is null or isnan(x) or abs(cast(x as double)) = double('Infinity'))"
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col(column).isNotNull())
        .where(~F.expr(usable))
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.expr(f"transform({column}, x -> floor({scale} * cast(x as double)))").alias("v"),
        )
    )


def matrix(lists: list[list[int]], width: int) -> np.ndarray:
    """Rows of whole numbers as doubles; shorter vectors end in zeros."""
    out = np.zeros((len(lists), width))
    for k, values in enumerate(lists):
        out[k, : len(values)] = values
    return out


class Best:
    """The k best (score, vec_id) of each query so far, ties to the smaller vec_id, each id once."""

    def __init__(self, n_queries: int, k: int) -> None:
        self.k = k
        self.scores = np.full((n_queries, k), -np.inf)
        self.ids = np.full((n_queries, k), np.iinfo(np.int64).max)

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate([self.scores[query], scores])
        ids = np.concatenate([self.ids[query], ids])
        if len(scores) > 4 * self.k:
            level = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            keep = scores >= level
            if len(np.unique(ids[keep])) >= self.k:
                scores, ids = scores[keep], ids[keep]
        order = np.lexsort((ids, -scores))
        first = np.sort(np.unique(ids[order], return_index=True)[1])  # the best of each id
        order = order[first][: self.k]
        self.scores[query], self.ids[query] = -np.inf, np.iinfo(np.int64).max
        self.scores[query, : len(order)], self.ids[query, : len(order)] = scores[order], ids[order]


def search_blocks(
    queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, best: Best
) -> None:
    """Adds the given vectors to the best of each query, pruning whole blocks and single vectors."""
    norms = np.sqrt((rows * rows).sum(axis=1))
    order = np.argsort(-norms, kind="stable")
    rows, ids, norms = rows[order], ids[order], norms[order]
    lengths = np.sqrt((queries * queries).sum(axis=1))
    lead = np.argmax(np.abs(queries), axis=1)
    unit = queries[np.arange(len(queries)), lead] / np.where(lengths > 0, lengths, 1)
    for first in range(0, len(rows), BLOCK_ROWS):
        block, names = rows[first : first + BLOCK_ROWS], ids[first : first + BLOCK_ROWS]
        size = norms[first : first + BLOCK_ROWS]
        floor = best.scores[:, -1]
        reach = lengths * size[0] * (1 + MARGIN)
        open_ = np.flatnonzero(reach >= floor)
        if not len(open_):
            if (floor >= 0).all():
                break
            continue
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where(reach[open_] > 0, floor[open_] / reach[open_], -1)
        by_length = open_[~(local >= COORDINATE_COSINE)]
        if len(by_length):
            scores = queries[by_length] @ block.T
            for row, q in enumerate(by_length):
                wanted = (scores[row] >= best.scores[q, -1]) & (names != query_ids[q])
                if wanted.any():
                    best.add(q, scores[row, wanted], names[wanted])
        for q, cosine in zip(open_[local >= COORDINATE_COSINE], local[local >= COORDINATE_COSINE], strict=True):
            spread = np.sqrt(max(0.0, 1 - unit[q] ** 2) * max(0.0, 1 - cosine**2)) + 1e-6
            low, high = unit[q] * cosine - spread, unit[q] * cosine + spread
            # The largest cosine that is left is 1, so the side of the query itself stays open.
            along = block[:, lead[q]]
            if unit[q] > 0:
                near = along >= low * size
                if unit[q] < cosine:
                    near &= along <= high * size
            else:
                near = along <= high * size
                if -unit[q] < cosine:
                    near &= along >= low * size
            near = np.flatnonzero(near & (lengths[q] * size * (1 + MARGIN) >= best.scores[q, -1]) & (names != query_ids[q]))
            if len(near):
                scores = block[near] @ queries[q]
                wanted = scores >= best.scores[q, -1]
                if wanted.any():
                    best.add(q, scores[wanted], names[near[wanted]])


def top_products(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest integer inner products.

    vectors and queries are (vec_id, v) with whole components; a row isn't a candidate for a query
    of its own id. Ties go to the smaller vec_id; with fewer candidates, all are returned. Where
    lengths differ, missing components are 0. Repeated rows of an id count once, by their best
    score. An empty table gives an empty result. Exact while scores stay below 2**53.

    Vectors are dealt out by norm; the queries come to all executors in blocks of bounded size,
    and each task returns at most k rows per query.
    """
    spark = vectors.sparkSession
    width = vectors.select(F.max(F.size("v")).alias("n")).first().n or 0

    def stage(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query_ids, query_rows = block.value
            best = Best(len(query_ids), k)
            for batch in batches:
                rows = matrix(batch.column("v").to_pylist(), width)
                search_blocks(query_rows, query_ids, rows, batch.column("vec_id").to_numpy(), best)
            at, nth = np.nonzero(np.isfinite(best.scores))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(query_ids[at], pa.int64()),
                    pa.array(best.ids[at, nth], pa.int64()),
                    pa.array(best.scores[at, nth].astype(np.int64), pa.int64()),
                ],
                names=["query_id", "vec_id", "score"],
            )

        return run

    norm = F.expr("aggregate(v, 0D, (a, x) -> a + cast(x as double) * x)")
    dealt = (
        vectors.dropDuplicates(["vec_id", "v"])
        .repartition("vec_id")
        .sortWithinPartitions(norm.desc(), "vec_id")
    )
    n = -(-queries.count() // QUERY_BLOCK) or 1
    found = None
    for b in range(n):
        part = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(n)) == b).dropDuplicates(["vec_id"])
        own = sorted(part.collect())
        ids = np.array([r.vec_id for r in own], np.int64)
        block = spark.sparkContext.broadcast((ids, matrix([r.v for r in own], width)))
        rows = dealt.mapInArrow(stage(block), FOUND)
        found = rows if found is None else found.unionAll(rows)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = best.groupBy("query_id").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id"))), 1, k).alias("top")
    )
    return ranked.select("query_id", F.posexplode("top").alias("at", "hit")).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        "hit.vec_id",
        (-F.col("hit.less")).alias("score"),
    )


def op9(spark, sf_dir: str, vectors: DataFrame | None = None) -> DataFrame:
    """The five best of all vectors for each vector whose id is divisible by 50."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet") if vectors is None else vectors
    rows = scaled(vectors)
    return top_products(rows, rows.where("vec_id % 50 = 0"))


ORACLE = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM p
QUALIFY rank <= 5
"""
