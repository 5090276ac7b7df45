"""Passages that repeat across documents, found with compressed indexes over shards of them.

Two equal windows of words hold the same anchor: the short word sequence with the smallest hash in
the window. So only runs of windows around an anchor that several documents share can repeat. Spark
reduces equal runs to one with its first document, and the distinct runs of an anchor go to one
shard. A shard indexes them (Burrows-Wheeler transform in a wavelet matrix of packed bits) and
streams them through backward search: after `window` steps the interval of a window is known, and
with it the first document that has it; windows that stand in one place drop out on the way.
Anchors with more than HEAVY_WORDS words of distinct runs don't go to a shard: their runs are cut
into windows, which Spark groups. The first documents are then joined back to the places.
Rows whose words are all those of another are set aside before, however many there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayshape.llm.common import batch_of, by_batch, bytes_of, dropped, mixed, spaced_words, stored
from dayshape.llm.suffixes import suffix_array

ANCHOR_WORDS = 4
ANCHOR_BITS = 48  # of an anchor's hash; another anchor of the same hash only costs time
GROUP_BYTES = 1 << 20  # of texts that are hashed together
ODD = 0x9E3779B97F4A7C15  # base of the hashes of words
SHARD_WORDS = 300_000  # words of distinct runs in one index; the runs of an anchor stay together
HEAVY_WORDS = 30_000  # words of distinct runs of one anchor that may go to a shard


class FmIndex:
    """Backward search over a sequence of symbols from 1 on."""

    def __init__(self, text: np.ndarray) -> None:
        self.starts = np.concatenate([[len(text)], suffix_array(text, len(text))])
        bwt = np.where(self.starts > 0, text[self.starts - 1], 0)
        n_symbols = int(text.max()) + 1
        self.after = np.cumsum(np.bincount(bwt, minlength=n_symbols))
        self.before = np.concatenate([[0], self.after[:-1]])
        self.levels = []
        for bit in range(n_symbols.bit_length() - 1, -1, -1):
            ones = (bwt >> bit & 1).astype(bool)
            padded = np.zeros(-(-(len(ones) + 1) // 64) * 64, bool)
            padded[: len(ones)] = ones
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]).astype(np.uint32)
            self.levels.append((bit, packed, counts, len(ones) - int(ones.sum())))
            bwt = np.concatenate([bwt[~ones], bwt[ones]])
        symbols = np.arange(n_symbols)
        self.origin = self._down(symbols, np.zeros(n_symbols, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the wavelet matrix leads position `at` for a symbol."""
        for bit, packed, counts, zeros in self.levels:
            word = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = counts[word].astype(np.int64) + np.bitwise_count(packed[word] & below)
            at = np.where(symbol >> bit & 1, zeros + ones, at - ones)
        return at

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of each match with one symbol more in front."""
        both = self._down(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        both += np.tile(self.before[symbol] - self.origin[symbol], 2)
        return both[: len(low)], both[len(low) :]


def first_documents(runs: list[list[bytes]], docs: np.ndarray, window: int) -> list[np.ndarray]:
    """For each window of each run the smallest of docs among the runs that hold it."""
    words = [w for run in runs for w in run]
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words), 2)}
    sizes = np.array([len(run) + 1 for run in runs])
    begins = np.cumsum(sizes) - sizes
    text = np.ones(sizes.sum(), np.int64)
    text[np.delete(np.arange(len(text)), begins + sizes - 1)] = [numbers[w] for w in words]
    index = FmIndex(text)
    owner = np.append(np.repeat(docs, sizes), np.iinfo(np.int64).max)
    counts = sizes - window
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.repeat(begins, counts) + nth
    # What stands in one place alone is that run's own and isn't searched any further.
    first, last = np.repeat(docs, counts), text[at + window - 1]
    low, high = index.before[last], index.after[last]
    on = np.arange(len(at))
    for k in range(window - 2, -2, -1):
        several = high - low > 1
        on, low, high = on[several], low[several], high[several]
        if k >= 0:
            low, high = index.step(text[at[on] + k], low, high)
    # Windows of one length have equal or separate intervals.
    lows, which = np.unique(low, return_inverse=True)
    highs = np.zeros(len(lows), np.int64)
    highs[which] = high
    cuts = np.stack([lows, highs], axis=1).ravel()
    least = np.minimum.reduceat(np.append(owner[index.starts], np.iinfo(np.int64).max), cuts)[::2]
    first[on] = least[which]
    return np.split(first, np.cumsum(counts)[:-1])


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as were asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def first(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)]))
                for x in (ODD, pow(ODD, -1, 1 << 64))
            )
        return self.up[:n], self.down[:n]


POWERS = Powers()


def word_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of each word's bytes, from differences of one running sum."""
    up, down = POWERS.first(len(flat))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * up)])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def anchor_runs(texts: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """(text, first, anchor, begin, end) of the runs of neighbouring windows with one anchor, in order.

    texts are words joined by single spaces; first is a run's first window, begin and end are its
    bytes in the text. All texts are hashed as one row of words; the least hash of a window comes
    from those of halves. The lowest bits of a hash are its place, so that a run ends where the
    place changes.
    """
    sizes = np.array([x.count(b" ") + 1 if x else 0 for x in texts])
    counts = np.maximum(sizes - window + 1, 0)
    if not counts.sum():
        return (np.zeros(0, np.int64),) * 5
    flat = np.frombuffer(b" ".join([x for x in texts if x]) + b" ", np.uint8)
    ends = np.flatnonzero(flat == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    words = word_hashes(flat, starts, ends)
    n = len(words) - ANCHOR_WORDS + 1
    rolled = np.zeros(n, np.uint64)
    for k in range(ANCHOR_WORDS):
        rolled = mixed(rolled + words[k : k + n] + np.uint64(k + 1))
    spare = np.uint64(64 - ANCHOR_BITS)
    least = (rolled >> spare << spare) | (np.arange(n, dtype=np.uint64) & ((np.uint64(1) << spare) - np.uint64(1)))
    width, span = window - ANCHOR_WORDS + 1, 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    begins = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = begins[text] + nth
    own = least[at]
    first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (text[1:] != text[:-1])]))
    last = np.concatenate([first[1:], [len(text)]]) - 1
    of = text[first]
    zero = starts[begins[of]]
    begin, end = starts[at[first]] - zero, ends[at[last] + window - 1] - zero
    return of, nth[first], (own[first] >> spare).view(np.int64), begin, end


def in_groups(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Texts, words joined by single spaces, in groups of about GROUP_BYTES; with the number of a group's first."""
    begin, group, size = 0, [], 0
    for text in texts:
        group.append(b" ".join(spaced_words(text)))
        size += len(group[-1])
        if size >= GROUP_BYTES or len(group) == 10_000:
            yield begin, group
            begin, group, size = begin + len(group), [], 0
    if group:
        yield begin, group


def overview(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, n_words, digest, sha, anchors): size and digests of each row, and its anchors."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, digests, shas, counts, found = [], [], [], [], []
        for _, texts in in_groups(bytes_of(batch.column(1))):
            for joined in texts:
                sizes.append(joined.count(b" ") + 1 if joined else 0)
                digests.append(xxhash.xxh3_128_digest(joined))
                shas.append(hashlib.sha256(joined).digest())
            text, _, anchor, *_ = anchor_runs(texts, window)
            own = np.unique(text << ANCHOR_BITS | anchor)
            counts.append(np.bincount(own >> ANCHOR_BITS, minlength=len(texts)))
            found.append(own & ((1 << ANCHOR_BITS) - 1))
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
        anchors = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(shas, pa.binary()),
                anchors,
            ],
            names=["doc_id", "n_words", "digest", "sha", "anchors"],
        )

    return docs.mapInArrow(
        by_batch(make), "doc_id long, n_words long, digest binary, sha binary, anchors array<long>"
    )


def runs_of(docs: DataFrame, window: int, whole: bool = True) -> DataFrame:
    """(doc_id, start, anchor, digest, run) of docs (doc_id, text, shared): runs at shared anchors.

    digest is that of a run; run is its text, or null unless whole.
    """

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, starts, names, digests, runs = [], [], [], [], []
        docs = batch.column(0).to_pylist()
        shared = batch.column(2)
        own = np.repeat(np.arange(len(shared)), shared.value_lengths().fill_null(0).to_numpy())
        own = own << ANCHOR_BITS | shared.flatten().to_numpy()
        for begin, texts in in_groups(bytes_of(batch.column(1))):
            found = anchor_runs(texts, window)
            wanted = np.isin(found[0] + begin << ANCHOR_BITS | found[2], own)
            for k, first, anchor, a, b in zip(*(column[wanted].tolist() for column in found), strict=True):
                ids.append(docs[begin + k])
                starts.append(first)
                names.append(anchor)
                run = texts[k][a:b]
                digests.append(xxhash.xxh3_128_digest(run))
                if whole:
                    runs.append(run)
        return batch_of(
            doc_id=(pa.int64(), ids),
            start=(pa.int32(), starts),
            anchor=(pa.int64(), names),
            digest=(pa.binary(), digests),
            run=(pa.binary(), runs if whole else [None] * len(ids)),
        )

    return docs.mapInArrow(by_batch(make), "doc_id long, start int, anchor long, digest binary, run binary")


def parted(distinct: DataFrame) -> tuple[DataFrame, DataFrame]:
    """distinct (anchor, run, ..) in two: runs of anchors for the shards, and those of heavy ones."""
    size = F.length("run") - F.length(F.translate(F.col("run").cast("string"), " ", "").cast("binary")) + 1
    heavy = distinct.groupBy("anchor").agg(F.sum(size).alias("n")).where(F.col("n") > HEAVY_WORDS).select("anchor")
    return distinct.join(heavy, "anchor", "left_anti"), distinct.join(heavy, "anchor", "left_semi")


def firsts_of_heavy(runs: DataFrame, window: int) -> DataFrame:
    """(digest, last, firsts) of distinct runs, by grouping their windows."""
    own = "split(cast(run as string), ' ')"
    windows = runs.select("digest", "last", "first", F.expr(own).alias("words")).select(
        "digest",
        "last",
        "first",
        F.expr(
            f"posexplode(transform(sequence(1, size(words) - {window - 1}), i -> array_join(slice(words, i, {window}), ' ')))"
        ).alias("nth", "passage"),
    )
    least = windows.groupBy("passage").agg(F.min("first").alias("least"))
    found = windows.select("digest", "last", "nth", "passage").join(least, "passage")
    return found.groupBy("digest", "last").agg(
        F.expr("transform(array_sort(collect_list(struct(nth, least))), x -> x.least)").alias("firsts")
    )


def earlier_windows(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, at) of docs (doc_id, text, shared): the places of windows that an earlier document has."""

    def shard(rows: list[tuple]) -> pa.RecordBatch:
        digests, runs, firsts, lasts = zip(*rows, strict=True)
        found = first_documents([x.split() for x in runs], np.array(firsts, np.int64), window)
        return batch_of(
            digest=(pa.binary(), digests), last=(pa.int64(), lasts), firsts=(pa.list_(pa.int64()), found)
        )

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = [], 0, None
        for batch in batches:
            for anchor, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if anchor != last and size >= SHARD_WORDS:
                    yield shard(rows)
                    rows, size = [], 0
                rows.append(row)
                size += row[1].count(b" ") + 1
                last = anchor
        if rows:
            yield shard(rows)

    distinct = stored(
        runs_of(docs, window)
        .groupBy("anchor", "digest", "run")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")),
        "distinct-runs",
    )
    light, heavy = parted(distinct)
    columns = ["anchor", "digest", "run", "first", "last"]
    dealt = light.select(columns).repartition("anchor").sortWithinPartitions("anchor", "digest")
    firsts = dealt.mapInArrow(stream, "digest binary, last long, firsts array<long>").unionAll(
        firsts_of_heavy(heavy, window)
    )
    # Runs with a window that some document which has them isn't the first to have.
    firsts = stored(firsts.where("array_min(firsts) < last").select("digest", "firsts"), "first-documents")
    dropped(distinct)
    at = "filter(transform(firsts, (f, i) -> if(f < doc_id, start + i, null)), x -> x is not null)"
    places = runs_of(docs, window, whole=False).select("doc_id", "start", "digest")
    return places.join(firsts, "digest").select("doc_id", F.expr(at).alias("at")).where("size(at) > 0")


def repeated_spans(docs: DataFrame, window: int = 13) -> tuple[DataFrame, DataFrame]:
    """An overview of all rows, and (doc_id, text, places): windows that an earlier row has.

    The overview is (doc_id, n_words, digest, sha, copy): copy marks a row whose words are all
    those, in order, of a row with a smaller doc_id; it isn't searched any further. places are the
    first words of the other rows' windows that also start in a row with a smaller doc_id.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    anchored = stored(overview(docs, window), "anchors")
    seen = stored(anchored.drop("anchors"), "overview")
    firsts = seen.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first"))

    def with_copies(rows: DataFrame) -> DataFrame:
        copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
        return rows.join(firsts, "digest", "left").withColumn("copy", copy)

    own = with_copies(anchored).where("doc_id is not null and not copy")
    own = own.select("doc_id", F.explode("anchors").alias("anchor"))
    shared = own.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    wanted = own.join(shared, "anchor", "left_semi").groupBy("doc_id").agg(F.collect_list("anchor").alias("shared"))
    texts = stored(docs.join(wanted, "doc_id").select("doc_id", "text", "shared"), "shared-texts")
    dropped(anchored)
    places = earlier_windows(texts, window).groupBy("doc_id").agg(
        F.flatten(F.collect_list("at")).alias("places")
    )
    found = texts.select("doc_id", "text").join(places, "doc_id")
    return with_copies(seen).select("doc_id", "n_words", "digest", "sha", "copy"), found


def without_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept): one row per row of docs.

    Removes each word that is covered by a window of `window` words whose sequence also starts in
    a row with a smaller doc_id; windows are judged on the input. kept_sha256 is that of the kept
    words, joined by one space; kept holds them where something was removed, else null. A null
    text has no words. Rows of fewer words than a window keep all of them. Rows that repeat a
    doc_id and its text are no smaller than each other and keep the same words; where texts of one
    doc_id differ, the repeats found in either are taken from both. A row without an id keeps all
    of its words and is no one's source. An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    seen, found = repeated_spans(docs, window)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, removed, shas, kept, digests = [], [], [], [], []
        for text, at in zip(bytes_of(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            words = spaced_words(text)
            change = np.zeros(len(words) + window, np.int64)
            at = np.array([x for x in at if x + window <= len(words)], np.int64)
            np.add.at(change, at, 1)
            np.add.at(change, at + window, -1)
            left = np.flatnonzero(np.cumsum(change)[: len(words)] == 0)
            rest = b" ".join([words[k] for k in left])
            sizes.append(len(words))
            removed.append(len(words) - len(left))
            shas.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest)
            digests.append(xxhash.xxh3_128_digest(b" ".join(words)))
        return batch_of(
            id=(pa.int64(), batch.column(0)),
            removed=(pa.int64(), removed),
            kept_sha256=(pa.string(), shas),
            kept=(pa.binary(), kept),
            same=(pa.binary(), digests),
        )

    changed = (
        found.select("doc_id", "text", "places")
        .mapInArrow(by_batch(make), "id long, removed long, kept_sha256 string, kept binary, same binary")
        .dropDuplicates(["id", "same"])
    )
    all_gone = F.col("copy") & (F.col("n_words") >= window)
    nothing = hashlib.sha256(b"").hexdigest()
    joined = seen.join(changed, (F.col("doc_id") == F.col("id")) & (F.col("digest") == F.col("same")) & ~F.col("copy"), "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.when(all_gone, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(all_gone, nothing).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
        F.when(all_gone, F.lit("")).otherwise(F.col("kept").cast("string")).alias("kept"),
    )


def op8(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """Repeated passages of 13 words removed from all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if docs is None else docs
    return without_repeats(docs).drop("kept")
