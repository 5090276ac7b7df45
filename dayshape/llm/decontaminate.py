"""Benchmark passages in documents, found by suffix arrays over shards of the documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayshape.llm.common import bytes_of, plain_words
from dayshape.llm.suffixes import narrowed, suffix_array

SHARD_WORDS = 1_000_000  # words of documents in one suffix array
BLOCK_CHARS = 8_000_000  # characters of benchmark texts that are searched for at a time

HITS = "doc_id long, n_words long, starts array<int>, ends array<int>, items array<string>"
FOUND = "item_id string, item_start int, n_matched int, doc_id long, doc_start int"


@dataclass
class Tests:
    """A block of benchmark items as one sequence of word numbers, a 0 behind each item."""

    numbers: dict[bytes, int]
    text: np.ndarray
    item: np.ndarray  # of each position of the sequence
    rest: np.ndarray  # words from each position to the end of its item
    start: np.ndarray  # of each position within its item
    needed: np.ndarray  # length of the window that starts there; 0: none does
    names: list[str]

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], window: int) -> Tests:
        numbers: dict[bytes, int] = {}
        text, item, rest, start, needed, names = [], [], [], [], [], []
        for name, raw in items:
            words = plain_words(raw)
            n, size = len(words), min(window, len(words))
            text += [numbers.setdefault(word, len(numbers) + 1) for word in words] + [0]
            item += [len(names)] * (n + 1)
            rest += range(n, -1, -1)
            start += range(n + 1)
            needed += [size] * (n - size + 1) + [0] * size if n else [0]
            names.append(name)
        whole = [np.array(x, np.int64) for x in (text, item, rest, start, needed)]
        return cls(numbers, *whole, names)


def search(tests: Tests, docs: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Binary-searches every suffix of the tests in the suffix array of a shard.

    Returns the shard's positions and lengths where windows occur with the window's item, then for
    each suffix of the tests the length of its longest match and one position of it, and where
    each document of the shard begins.
    """
    longest = int(tests.rest.max(initial=0))
    begins = np.cumsum([0] + [len(x) + 1 for x in docs])
    stop = np.zeros(1, np.int64)
    text = np.concatenate([part for x in docs for part in (x, stop)] + [np.zeros(longest + 1, np.int64)])
    starts = suffix_array(text, longest)
    suffix = np.flatnonzero(tests.rest)
    low, high = np.zeros(len(suffix), np.int64), np.full(len(suffix), len(starts))
    length, where = np.zeros(len(tests.text), np.int64), np.zeros(len(tests.text), np.int64)
    hits = [(np.zeros(0, np.int64),) * 3]
    for depth in range(longest if len(starts) else 0):
        low, high = narrowed(text, starts, low, high, tests.text[suffix + depth], depth)
        found = low < high
        suffix, low, high = suffix[found], low[found], high[found]
        if not len(suffix):
            break
        length[suffix], where[suffix] = depth + 1, starts[low]
        whole = np.flatnonzero(tests.needed[suffix] == depth + 1)
        if len(whole):
            times = high[whole] - low[whole]
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            places = starts[np.repeat(low[whole], times) + nth]
            hits.append((places, np.full(len(places), depth + 1), np.repeat(tests.item[suffix[whole]], times)))
        go_on = tests.rest[suffix] > depth + 1
        suffix, low, high = suffix[go_on], low[go_on], high[go_on]
    return *(np.concatenate(x) for x in zip(*hits, strict=True)), length, where, begins


def shards(tests: Tests, batch: pa.RecordBatch) -> Iterator[tuple[slice, list[np.ndarray]]]:
    """Runs of rows with about SHARD_WORDS words, each document as word numbers (0: not in a test)."""
    get, first, docs, size = tests.numbers.get, 0, [], 0
    for k, raw in enumerate(bytes_of(batch.column("text"))):
        words = plain_words(raw)
        docs.append(np.fromiter((get(word, 0) for word in words), np.int64, len(words)))
        size += len(words)
        if size >= SHARD_WORDS:
            yield slice(first, k + 1), docs
            first, docs, size = k + 1, [], 0
    if docs:
        yield slice(first, batch.num_rows), docs


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, bytes]]]:
    """The items with an id, in blocks of about BLOCK_CHARS characters."""
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).dropna()
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // BLOCK_CHARS) or 1
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else rows
        yield sorted((name, text.encode()) for name, text in part.collect())


def hits(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """(doc_id, n_words, starts, ends, items): the words of each row that benchmark windows cover.

    Words are lower-cased runs of letters, digits and non-ASCII characters. A window is `window`
    consecutive words of an item, or all words of a shorter one. starts and ends are the covered
    spans of words, apart and in order; items are the ids of items with a window in the text, as
    strings in order. A null or empty text has no words; items without words, text or id have no
    window. Rows are independent, so repeated rows and null ids are kept; an empty table gives an
    empty result.

    The benchmark is searched for in blocks of bounded size, each sent to all executors.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.expr("cast(array() as array<int>)").alias("starts"),
        F.expr("cast(array() as array<int>)").alias("ends"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )

    def stage(tests, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, numbers in shards(tests.value, batch):
                    yield one(tests.value, batch.slice(part.start, part.stop - part.start), numbers, last)

        return run

    todo = list(blocks(benchmark))
    for k, items in enumerate(todo):
        last = k == len(todo) - 1
        schema = HITS if last else HITS.replace("n_words long", "text string")
        rows = rows.mapInArrow(stage(spark.sparkContext.broadcast(Tests.of(items, window)), last), schema)
    return rows


def one(tests: Tests, rows: pa.RecordBatch, numbers: list[np.ndarray], last: bool) -> pa.RecordBatch:
    """The rows of a shard with what this block of tests adds to their spans and items."""
    place, size, item, _, _, begins = search(tests, numbers)
    doc = np.searchsorted(begins, place, side="right") - 1
    change = np.zeros(begins[-1] + 1, np.int64)
    np.add.at(change, place, 1)
    np.add.at(change, place + size, -1)
    for k, (starts, ends) in enumerate(
        zip(rows.column("starts").to_pylist(), rows.column("ends").to_pylist(), strict=True)
    ):  # of earlier blocks
        np.add.at(change, begins[k] + np.array(starts, np.int64), 1)
        np.add.at(change, begins[k] + np.array(ends, np.int64), -1)
    covered = np.concatenate([[0], (np.cumsum(change) > 0).astype(np.int8)])
    edges = np.diff(covered)
    up, down = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    owner = np.searchsorted(begins, up, side="right") - 1
    n = rows.num_rows
    cuts = np.searchsorted(owner, np.arange(n + 1))
    low = begins[owner] if len(owner) else owner
    names = [set(x) for x in rows.column("items").to_pylist()]
    for d, i in np.unique(np.stack([doc, item]), axis=1).T.tolist() if len(doc) else ():
        names[d].add(tests.names[i])
    lists = lambda values: pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, pa.int32()))
    second = pa.array([len(x) for x in numbers], pa.int64()) if last else rows.column("text")
    return pa.RecordBatch.from_arrays(
        [rows.column("doc_id"), second, lists(up - low), lists(down - low), pa.array(map(sorted, names), pa.list_(pa.string()))],
        names=["doc_id", "n_words" if last else "text", "starts", "ends", "items"],
    )


def longest_matches(docs: DataFrame, benchmark: DataFrame, least: int = 5) -> DataFrame:
    """(item_id, item_start, n_matched, doc_id, doc_start): each benchmark suffix's longest match.

    One row per word of an item from which at least `least` words stand verbatim in a document,
    with a place of that match.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def stage(tests):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = tests.value
            for batch in batches:
                for part, numbers in shards(own, batch):
                    _, _, _, length, where, begins = search(own, numbers)
                    at = np.flatnonzero(length >= least)
                    doc = np.searchsorted(begins, where[at], side="right") - 1
                    ids = batch.column("doc_id").slice(part.start, part.stop - part.start)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([own.names[i] for i in own.item[at]], pa.string()),
                            pa.array(own.start[at], pa.int32()),
                            pa.array(length[at], pa.int32()),
                            ids.take(pa.array(doc)),
                            pa.array(where[at] - begins[doc], pa.int32()),
                        ],
                        names=["item_id", "item_start", "n_matched", "doc_id", "doc_start"],
                    )

        return run

    found = None
    for items in blocks(benchmark):
        part = rows.mapInArrow(stage(spark.sparkContext.broadcast(Tests.of(items, 1))), FOUND)
        found = part if found is None else found.unionAll(part)
    best = F.min(F.struct((-F.col("n_matched")).alias("less"), "doc_id", "doc_start")).alias("best")
    return found.groupBy("item_id", "item_start").agg(best).select(
        "item_id", "item_start", (-F.col("best.less")).alias("n_matched"), "best.doc_id", "best.doc_start"
    )


def summary(found: DataFrame) -> DataFrame:
    """Counts and digests of hits()."""
    covered = F.expr("aggregate(zip_with(starts, ends, (a, b) -> b - a), 0L, (a, x) -> a + x)")
    return found.select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("starts") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of docs without a benchmark window, all columns kept; rows without an id stay."""
    hit = hits(docs, benchmark, window).where(F.size("starts") > 0).select("doc_id").distinct()
    return docs.join(hit, "doc_id", "left_anti")


def op2(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """Benchmark passages in all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if docs is None else docs
    return summary(hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))
