"""Near-duplicate documents by min-max hashing of word shingles.

Each permutation of the shingles gives two values of a signature, its minimum and its maximum; the
share of equal values estimates the Jaccard similarity without bias, with half the hashing and,
as the two are negatively correlated, less variance than as many minima. Bands of the signature
give candidates; links are confirmed on the full sets of shingles.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayshape.llm.common import batch_of, bytes_of, dropped, linked, mixed, spaced_words, stored

BAND_VALUES = 6  # values of a signature in one band
MISSED = 1e-6  # chance that a pair right at the threshold shares no band
SLICE_WORDS = 400_000  # words that are hashed at a time
KNOWN_WORDS = 500_000  # words whose hash a worker remembers


class WordHashes(dict):
    """63-bit hashes of words, worked out once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word) >> 1
        return found


HASHES = WordHashes()


def shingle_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles; a text of fewer words is one shingle."""
    words = [spaced_words((text or b"").lower()) for text in texts]
    lengths = np.array([len(x) for x in words])
    flat = np.fromiter((HASHES[w] for x in words for w in x), np.int64, lengths.sum()).view(np.uint64)
    n = len(flat) - size + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(size if n > 0 else 0):
        rolled = mixed(rolled + flat[k : k + n] + np.uint64(k + 1))
    out, at = [], 0
    for length in lengths.tolist():
        if length >= size:
            out.append(np.unique(rolled[at : at + length - size + 1]))
        elif length:
            short = np.zeros(1, np.uint64)
            for k in range(length):
                short = mixed(short + flat[at + k] + np.uint64(k + 1))
            out.append(short)
        else:
            out.append(flat[:0])
        at += length
    return out


def n_bands(threshold: float) -> int:
    count = math.ceil(math.log(MISSED) / math.log(1 - threshold**BAND_VALUES))
    return count + count % 2


def band_keys(sets: list[np.ndarray], bands: int) -> np.ndarray:
    """Keys of the bands of the min-max signatures of non-empty sets, one row per set."""
    permutations = bands * BAND_VALUES // 2
    draw = np.random.default_rng(20)
    times = draw.integers(0, 2**63, permutations, np.uint64) * np.uint64(2) + np.uint64(1)
    flips = draw.integers(0, 2**63, permutations, np.uint64)
    flat = np.concatenate(sets)
    begins = np.cumsum([0] + [len(x) for x in sets[:-1]])
    signature = np.empty((len(sets), 2 * permutations), np.uint64)
    for k in range(permutations):
        shuffled = (flat ^ flips[k]) * times[k]
        signature[:, 2 * k] = np.minimum.reduceat(shuffled, begins)
        signature[:, 2 * k + 1] = np.maximum.reduceat(shuffled, begins)
    keys = np.arange(bands, dtype=np.uint64) * np.ones((len(sets), 1), np.uint64)
    for value in np.moveaxis(signature.reshape(len(sets), bands, BAND_VALUES), 2, 0):
        keys = mixed(keys + value)
    return keys.view(np.int64)


def sliced(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
    """Runs of texts with about SLICE_WORDS words."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text or b"") // 6
        if size >= SLICE_WORDS:
            yield run
            run, size = [], 0
    if run:
        yield run


def by_slice(make) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow: make(ids, sets) for runs of rows with about SLICE_WORDS words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for texts in sliced(bytes_of(batch.column(1))):
                yield make(batch.column(0).slice(first, len(texts)), texts)
                first += len(texts)

    return run


def signatures(docs: DataFrame, shingle: int, bands: int) -> DataFrame:
    """(doc_id, print, n_shingles, digest, keys): size and digest of each row's set, and its bands."""

    def make(ids: pa.StructArray, texts: list[bytes | None]) -> pa.RecordBatch:
        sets = shingle_sets(texts, shingle)
        full = [x for x in sets if len(x)]
        rows = iter(band_keys(full, bands) if full else ())
        return batch_of(
            doc_id=(pa.int64(), ids.field("doc_id")),
            print=(pa.int64(), ids.field("print")),
            n_shingles=(pa.int64(), [len(x) for x in sets]),
            digest=(pa.binary(), [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]),
            keys=(pa.list_(pa.int64()), [next(rows) if len(x) else None for x in sets]),
        )

    return docs.select(F.struct("doc_id", "print").alias("of"), "text").mapInArrow(
        by_slice(make), "doc_id long, print long, n_shingles long, digest binary, keys array<long>"
    )


def sets_of(docs: DataFrame, shingle: int) -> DataFrame:
    """(digest, shingles): the full set of each row (digest, text) as 64-bit hashes."""

    def make(digests: pa.Array, texts: list[bytes | None]) -> pa.RecordBatch:
        found = [x.view(np.int64) for x in shingle_sets(texts, shingle)]
        return batch_of(digest=(pa.binary(), digests), shingles=(pa.list_(pa.int64()), found))

    return docs.select("digest", "text").mapInArrow(by_slice(make), "digest binary, shingles array<long>")


def links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    both = pairs.join(sets.toDF("a", "one"), "a").join(sets.toDF("b", "two"), "b")
    counted = both.select(
        "a", "b", F.size(F.array_intersect("one", "two")).alias("same"), (F.size("one") + F.size("two")).alias("all")
    )
    return counted.where(f"100 * same >= {percent} * (all - same)").select("a", "b")


def prefix_pairs(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): a superset of the linked pairs among rows (rep, size, root) of different roots.

    Every set is ordered by how rare its shingles are among these rows. If two are linked, both have
    as many shingles from their first common one on as the intersection needs: shingles of its
    own, which near copies below the threshold have many of, come first and meet nobody. Sets meet by
    pairs of roots that share such a shingle, so members of one component are never held against
    each other.
    """
    longest = f"size - cast(ceil({percent} * size / 100) as int) + 1"
    own = rows.join(sets.withColumnRenamed("digest", "rep"), "rep")
    each = own.select("rep", F.explode("shingles").alias("shingle"))
    seen = each.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    ranked = (
        each.join(seen, "shingle", "left")
        .groupBy("rep")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "shingle"))).alias("ordered"))
        .join(rows, "rep")
    )
    prefix = ranked.select("rep", "size", "root", F.posexplode(F.expr(f"slice(ordered, 1, {longest})")).alias("at", "item"))
    entries = stored(
        prefix.where("item.n > 1").select(
            F.col("item.shingle").alias("shingle"), "root", "rep", "size", F.expr("size - at").alias("left")
        ),
        "prefixes",
    )

    def enough(left: str, size: str, left2: str, size2: str) -> str:
        return f"{100 + percent} * least({left}, {left2}) >= {percent} * ({size} + {size2})"

    # The best that any member of a root offers at a shingle.
    groups = entries.groupBy("shingle", "root").agg(
        F.max("left").alias("best"), F.min("size").alias("low"), F.max("size").alias("high")
    )
    other = groups.toDF("shingle", "root2", "best2", "low2", "high2")
    met = groups.join(other, "shingle").where("root < root2").where(enough("best", "low", "best2", "low2"))
    met = met.select("shingle", "root", "root2", "best2", "low2", "high2")
    ends = entries.toDF("shingle", "root2", "rep2", "size2", "left2")
    return (
        met.join(entries, ["shingle", "root"])
        .where(enough("left", "size", "best2", "low2"))
        .where(f"100 * high2 >= {percent} * size and 100 * size >= {percent} * low2")
        .join(ends, ["shingle", "root2"])
        .where(enough("left", "size", "left2", "size2"))
        .where(f"100 * least(size, size2) >= {percent} * greatest(size, size2)")
        .select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b"))
        .distinct()
    )


def with_print(docs: DataFrame) -> DataFrame:
    """(doc_id, print, text): print tells rows of one id with different texts apart."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("print"), text.alias("text"))


def judged(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The rows of near_copies() and print, which names the text of a row within its doc_id."""
    bands = n_bands(percent / 100)
    docs = with_print(docs)
    signed = stored(signatures(docs, shingle, bands), "signatures")
    with_set = signed.where("digest is not null and doc_id is not null")
    classes = with_set.groupBy("digest").agg(
        F.min(F.struct("doc_id", "print")).alias("first"), F.first("n_shingles").alias("size"), F.first("keys").alias("keys")
    )
    entries = classes.select(F.explode("keys").alias("key"), F.col("digest").alias("rep"), "size")
    crowded = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(entries.join(crowded, "key"), "buckets")
    # What shares bands with the most others is least edited.
    weights = shared.groupBy("rep").agg(F.sum("n").alias("weight"))
    members = stored(shared.join(weights, "rep").select("key", "rep", "size", "weight").distinct(), "buckets")
    dropped(shared)
    # The full sets of all that have a candidate, read once for all rounds.
    wanted = classes.select("first.*", "digest").join(
        members.select(F.col("rep").alias("digest")).distinct(), "digest", "left_semi"
    )
    texts = docs.join(wanted, ["doc_id", "print"]).groupBy("doc_id", "print", "digest").agg(F.first("text").alias("text"))
    sets = stored(sets_of(texts, shingle), "shingles")
    roots = linked(
        members,
        lambda one, two: f"100 * least({one}, {two}) >= {percent} * greatest({one}, {two})",
        lambda pairs: links(pairs, sets, percent),
        "near-copies",
        lambda rows: prefix_pairs(rows, sets, percent),
    )
    dropped(members, sets)
    ids = classes.select("digest", F.col("first.doc_id").alias("low"))
    grouped = ids.join(roots.withColumnRenamed("id", "digest"), "digest")
    lowest = grouped.groupBy("root").agg(F.min("low").alias("lowest"))
    told = grouped.join(lowest, "root").select("digest", "lowest")
    named = ids.join(told, "digest", "left").select("digest", F.coalesce("lowest", "low").alias("lowest"))
    placed = signed.select("doc_id", "print", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("lowest", "doc_id"))
    return placed.select(
        "doc_id",
        "print",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def near_copies(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per row of docs.

    A row's set holds the distinct runs of `shingle` lower-cased words; two rows are linked if
    100 * intersection >= percent * union. component_id is the smallest doc_id that is reachable.
    A row without words or text has an empty set and is linked with nothing. Rows with equal sets
    are one class from the start, however many there are, and only the class goes on.
    Rows that repeat a doc_id are each judged by their own text. A row without an id is linked with nothing: its
    component_id is null and it is kept. An empty table gives an empty result.

    Classes with an equal band are candidates; linked() says how few of their pairs are compared, and
    prefix_pairs() which are compared last.
    """
    return judged(docs, shingle, percent).drop("print")


def one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that near_copies() keeps; all columns stay, and rows without an id too.

    Of rows that repeat a doc_id with different texts, each stays or goes by its own text.
    """
    gone = judged(docs, shingle, percent).where("not kept").select("doc_id", "print").distinct()
    gone = gone.toDF("gone_id", "gone_print")
    text = docs["text"].cast("string")
    same = (docs["doc_id"].cast("long") == gone["gone_id"]) & (F.xxhash64(text) == gone["gone_print"])
    return docs.join(gone, same, "left_anti")


def op3(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, similarity of 0.85 or more."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if docs is None else docs
    return near_copies(docs, shingle=3, percent=85)
