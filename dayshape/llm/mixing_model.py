"""A language model by online logistic mixing of hashed-context bit predictors.

Words are coded in bits: a Huffman code of the frequent words of the training rows, the end of a
text and an escape; an escaped word is spelled by tables of bytes behind one and three others. For each bit, predictors
hash the place in the code with the previous 0, 1 and 2 words into tables of how often the bit was
0 and 1 in all training rows. Their log odds are mixed with weights that a gate picks by how much
the contexts have been seen; each bit then moves those weights by the gradient of its coding cost,
and a second, adaptive table refines the mixed probability. The coding cost over the bytes of a
text is its bits per byte.

All bits of a code are mixed, and weights and adaptive table go through a whole text; texts are coded
side by side.
"""

from __future__ import annotations

import heapq
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import InitVar, dataclass
from functools import cached_property, reduce
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayshape.llm.common import batch_of, by_batch, bytes_of, mixed, spaced_words, stored
from dayshape.llm.toxicity import crc_mod

FREQUENT = 1 << 17  # words with a code of their own; all others are escaped and spelled
SLOT_BITS = 22  # slots of the table of each hashed context
ORDERS = 2  # hashed contexts: of one word and of two
RANGES = 64  # parts in which the tables are summed
GROUP_TOKENS = 40_000  # tokens whose bits are counted at once
MIXED_TOKENS = 30_000  # tokens whose bits are mixed at once
LANE_TOKENS = 3_000_000  # tokens of texts that are coded side by side
LONG_BYTES = (16_000, 50_000)  # texts above either are coded beside others of that length
LONG_PART = 16_000_000  # bytes of long texts in a part
GATES = 9
SPELL_BITS = 22  # places of the table of bytes behind three
SSE_STEPS = 24
RATE, SSE_RATE = 0.03, 0.02
#: Weights of the contexts of 0, 1 and 2 words at the start of a text.
FIRST_WEIGHTS = np.array([0.45, 0.5, 0.2], np.float32)
PRIOR = 0.4  # added to the counts of 0 and of 1
END, ESCAPE = 0, 1  # symbols; frequent words follow


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, nodes, bits): the path of symbol i is nodes[offsets[i]:offsets[i + 1]] and its bits."""
    n = len(counts)
    heap = [(int(c), i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    above, side, new = np.zeros(2 * n, np.int64), np.zeros(2 * n, np.int8), n
    while len(heap) > 1:
        (one, a), (two, b) = heapq.heappop(heap), heapq.heappop(heap)
        above[a] = above[b] = new
        side[b] = 1
        heapq.heappush(heap, (one + two, new))
        new += 1
    offsets, nodes, bits = array("q", [0]), array("i"), array("b")
    for symbol in range(n):
        path, at = [], symbol
        while at != new - 1:
            path.append((int(above[at]) - n, int(side[at])))
            at = above[at]
        nodes.extend([x for x, _ in reversed(path)])
        bits.extend([x for _, x in reversed(path)])
        offsets.append(len(nodes))
    return np.array(offsets), np.array(nodes, np.int32), np.array(bits, np.int8)


@dataclass
class Code:
    """The frequent words with their counts, and the bits that stand for them."""

    words: list[bytes]
    counts: np.ndarray  # of end, escape and the frequent words, in training tokens

    def __post_init__(self) -> None:
        counts = np.maximum(self.counts, 1)
        offsets, nodes, bits = huffman(counts)
        weight = np.repeat(counts, np.diff(offsets)).astype(float)
        ones = np.bincount(nodes, weight * bits, len(counts))
        zeros = np.bincount(nodes, weight * (1 - bits), len(counts))
        self.node_odds = np.log((ones + PRIOR) / (zeros + PRIOR)).astype(np.float32)
        self.nodes, self.bits, self.offsets, self.lengths = nodes, bits, offsets, np.diff(offsets)
        self.node_hashes = mixed(np.arange(len(counts), dtype=np.uint64))

    @cached_property
    def numbers(self) -> dict[bytes, int]:
        return {word: k + 2 for k, word in enumerate(self.words)}

    def tokens(self, words: list[bytes]) -> np.ndarray:
        get = self.numbers.get
        return np.array([*map(get, words, repeat(ESCAPE)), END], np.int64)

    def spread(self, tokens: np.ndarray, *contexts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of each bit of the tokens: the node, the bit, and the slots of the hashed contexts."""
        begin, sizes = self.offsets[tokens], self.lengths[tokens]
        at = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
        at += np.arange(len(at))
        nodes = self.nodes[at]
        spread = self.node_hashes[nodes]
        slots = []
        for context in contexts:
            slot = np.repeat(context, sizes)
            slot ^= spread
            slot *= np.uint64(0x9E3779B97F4A7C15)
            slot >>= np.uint64(64 - SLOT_BITS)
            slots.append(slot.view(np.int64))
        return sizes, nodes, self.bits[at], *slots


def contexts(tokens: np.ndarray, at: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the token before each place and of the two before, nth being its number in its text."""
    back = np.where(nth > 0, tokens[np.maximum(at - 1, 0)] + 1, 0)
    further = np.where(nth > 1, tokens[np.maximum(at - 2, 0)] + 1, 0)
    one = mixed(back.astype(np.uint64) + np.uint64(1 << 40))
    return one, mixed(one + further.astype(np.uint64))


def packed(part: np.ndarray) -> bytes:
    """The counts (0, 1) of a range of slots: steps between the slots with any, and theirs, by the bytes' rank."""
    at = np.flatnonzero(part[0] | part[1])
    rows = np.stack([np.diff(at, prepend=0), part[0][at], part[1][at]]).astype(np.uint32)
    return zlib.compress(rows.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slots and how often their bits were 0 and 1."""
    by_rank = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, -1)
    steps, zero, one = np.ascontiguousarray(by_rank.T).view(np.uint32).reshape(3, -1)
    return np.cumsum(steps, dtype=np.int64), zero, one


def groups(texts: list[bytes | None], code: Code) -> Iterator[tuple[int, list[list[bytes]], np.ndarray, np.ndarray]]:
    """(first row, words, tokens, where texts begin) of runs of texts with about GROUP_TOKENS tokens."""
    first, words, size = 0, [], 0
    for k, text in enumerate(texts):
        words.append(spaced_words((text or b"").lower()))
        size += len(words[-1]) + 1
        if size >= GROUP_TOKENS or k == len(texts) - 1:
            tokens = [code.tokens(x) for x in words]
            begins = np.cumsum([0] + [len(x) for x in tokens])
            yield first, words, np.concatenate(tokens), begins
            first, words, size = k + 1, [], 0


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n): how often each lower-cased word stands in the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 5000):
                found: Counter[bytes] = Counter()
                for text in bytes_of(batch.column(0).slice(first, 5000)):
                    found.update(spaced_words((text or b"").lower()))
                yield batch_of(word=(pa.binary(), list(found)), n=(pa.int64(), list(found.values())))

    parts = rows.select("text").mapInArrow(count, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def tables(rows: DataFrame, code) -> DataFrame:
    """(range, counts): per range of slots of the tables, how often bits were 0 and 1 there.

    Each task counts its rows into tables of its own and passes on the slots that it met, packed
    by range. They are summed in two steps, so that no task gets the parts of all tasks at once.
    """
    size = ORDERS << SLOT_BITS
    per = size // RANGES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seen = np.zeros(2 * size, np.uint32)  # of each slot, 0 and 1 side by side
        for batch in batches:
            texts = bytes_of(batch.column(0))
            for _, _, tokens, begins in groups(texts, code.value):
                at = np.arange(len(tokens))
                nth = at - np.repeat(begins[:-1], np.diff(begins))
                _, _, bits, *slots = code.value.spread(tokens, *contexts(tokens, at, nth))
                for k, slot in enumerate(slots):
                    np.add.at(seen, (slot + (k << SLOT_BITS)) * 2 + bits, np.uint32(1))
        for k in range(RANGES):
            part = seen.reshape(size, 2)[k * per : (k + 1) * per].T
            if part.any():
                yield batch_of(
                    range=(pa.int32(), [k]),
                    task=(pa.int32(), [TaskContext.get().partitionId()]),
                    counts=(pa.binary(), [packed(part)]),
                )

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros((2, per), np.uint32)
        for raw in pdf.counts:
            at, zero, one = unpacked(raw)
            out[0, at] += zero
            out[1, at] += one
        return pd.DataFrame({"range": [pdf.range.iloc[0]], "task": [pdf.task.iloc[0] // 32], "counts": [packed(out)]})

    schema = "range int, task int, counts binary"
    parts = rows.select("text").mapInArrow(count, schema)
    some = parts.groupBy("range", F.expr("task div 32")).applyInPandas(lambda _, pdf: total(pdf), schema)
    return some.groupBy("range").applyInPandas(lambda _, pdf: total(pdf), schema).select("range", "counts")


def spelled_places(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each byte of the words and their ends: its word, and its places in both spelling tables.

    The first table has bytes behind one byte, the second, hashed, bytes behind three.
    """
    sizes = np.array([len(w) + 4 for w in words])
    flat = np.frombuffer(b"".join([b"\n\n\n" + w + b"\n" for w in words]), np.uint8).astype(np.uint64)
    begins = np.cumsum(sizes) - sizes
    real = np.ones(len(flat), bool)
    for k in range(3):
        real[begins + k] = False
    at = np.flatnonzero(real)
    three = flat[at - 3] << np.uint64(16) | flat[at - 2] << np.uint64(8) | flat[at - 1]
    behind = mixed(three + np.uint64(1)) >> np.uint64(64 - SPELL_BITS + 8)
    place = np.stack([flat[at - 1] << np.uint64(8) | flat[at], behind << np.uint64(8) | flat[at]])
    return np.repeat(np.arange(len(words)), sizes - 3), place.astype(np.int64)


def spelling(counts: DataFrame) -> list[np.ndarray]:
    """Probabilities of a byte behind one, and of a byte behind three, from all distinct words."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, (one, three) = spelled_places(batch.column(0).to_pylist())
        at, n = np.unique(np.concatenate([one, three + (1 << 16)]), return_counts=True)
        return batch_of(place=(pa.int64(), at), n=(pa.int64(), n))

    parts = counts.select("word").mapInArrow(by_batch(make), "place long, n long")
    seen = np.zeros((1 << 16) + (1 << SPELL_BITS), np.float32)
    for place, n in parts.groupBy("place").agg(F.sum("n")).toLocalIterator():  # of a fixed size
        seen[place] = n
    one, three = seen[: 1 << 16].reshape(-1, 256), seen[1 << 16 :].reshape(-1, 256)
    return [(one + 0.05) / (one + 0.05).sum(axis=1, keepdims=True), three]


class Lanes:
    """Weights and adaptive tables of texts that are coded side by side."""

    def __init__(self, n: int) -> None:
        self.weights = np.repeat(FIRST_WEIGHTS, n * GATES)
        self.width = np.float32(16 / SSE_STEPS)
        first = 1 / (1 + np.exp(8 - self.width * (np.arange(SSE_STEPS) + 0.5)))
        self.refined = np.tile(first, n).astype(np.float32)

    def mix(
        self, own: np.ndarray, inputs: list[np.ndarray], gates: np.ndarray, bits: np.ndarray, starts: np.ndarray, sizes: np.ndarray
    ) -> np.ndarray:
        """The log probability of the next bits of each of the lanes `own`, one after the other, all lanes side by side.

        inputs are the predictors' log odds of a 1 for each bit; starts and sizes say which bits are a
        lane's. Longer ones come first.
        """
        one, n_gates = np.float32(1), len(self.weights) // len(inputs)
        # Bits by step, so that a step's are next to each other.
        active = np.searchsorted(-sizes, -np.arange(sizes.max(initial=0)), side="left")
        begins = np.concatenate([[0], np.cumsum(active)])
        lane = np.arange(begins[-1])
        lane -= np.repeat(begins[:-1], active)
        at = starts[lane]
        at += np.repeat(np.arange(len(active)), active)
        all_xs = np.stack([x.take(at) for x in inputs])
        gates = gates.take(at)
        gates += (own * GATES).take(lane)
        all_gates = gates + np.arange(len(inputs))[:, None] * n_gates
        bits, cells = bits[at].astype(np.float32), own * SSE_STEPS
        given = np.empty(len(at), np.float32)  # to the bit that comes
        weights, refined, width = self.weights, self.refined, self.width
        half, rate, sse_rate = np.float32(0.5), np.float32(RATE), np.float32(SSE_RATE)
        low, high, eight = np.float32(-7.99), np.float32(7.99), np.float32(8)
        for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
            gate, bit, xs = all_gates[:, a:b], bits[a:b], all_xs[:, a:b]
            ws = weights.take(gate)
            odds = np.add.reduce(ws * xs, axis=0)
            np.maximum(odds, low, out=odds)
            np.minimum(odds, high, out=odds)
            p = np.negative(odds)
            np.exp(p, out=p)
            p += one
            np.divide(one, p, out=p)
            odds += eight
            odds /= width
            cell = odds.astype(np.int64)
            cell += cells[: b - a]
            q = refined.take(cell)
            np.add(p, q, out=given[a:b])
            np.subtract(bit, p, out=p)
            p *= rate
            ws += xs * p
            weights[gate] = ws
            bit = bit - q
            bit *= sse_rate
            bit += q
            refined[cell] = bit
        given *= half
        given = np.clip(np.where(bits > 0, given, one - given), 1e-5, 1 - 1e-5)
        return np.bincount(lane, np.log(given.astype(np.float64)), len(starts))


def mix(inputs: list[np.ndarray], gates: np.ndarray, bits: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The log probability of each lane's bits from the start of its text, see `Lanes.mix`."""
    return Lanes(len(starts)).mix(np.arange(len(starts)), inputs, gates, bits, starts, sizes)


@dataclass
class Model:
    code: Code
    odds: InitVar[np.ndarray]  # log odds of each slot, in 1/512
    seen: InitVar[np.ndarray]  # 0: never, 1: up to 15 times, 2: more
    spell: list[np.ndarray]

    def __post_init__(self, odds: np.ndarray, seen: np.ndarray) -> None:
        self.slots = odds.astype(np.int32) << 2 | seen.astype(np.int32)  # both, to be looked up at once

    def log_probabilities(self, tokens: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """log10 probability of the tokens of each text; begins has its first token, and the end.

        All texts are coded side by side, about MIXED_TOKENS tokens of them at a time.
        """
        counts = np.diff(begins)
        cost = np.zeros(len(counts))
        order, done = np.argsort(-counts, kind="stable"), 0
        lanes = Lanes(len(counts)) if len(tokens) > MIXED_TOKENS else None
        while len(own := order[: np.count_nonzero(counts > done)]):
            width = max(1, MIXED_TOKENS // len(own)) if lanes else int(counts.max())
            n = np.minimum(counts[own] - done, width)
            begin = np.cumsum(n) - n
            nth = np.arange(done, done + n.sum()) - np.repeat(begin, n)
            at = np.repeat(begins[own], n) + nth
            sizes, nodes, bits, one, two = self.code.spread(tokens[at], *contexts(tokens, at, nth))
            two += 1 << SLOT_BITS
            found = self.slots.take(one), self.slots.take(two)
            inputs = [self.code.node_odds.take(nodes), *((x >> 2).astype(np.float32) * np.float32(1 / 512) for x in found)]
            gates = ((found[0] & 3) * 3 + (found[1] & 3)).astype(np.int64)
            bit_at = np.concatenate([[0], np.cumsum(sizes)])
            starts, lengths = bit_at[begin], bit_at[begin + n] - bit_at[begin]
            longest = np.argsort(-lengths, kind="stable")
            given = (inputs, gates, bits, starts[longest], lengths[longest])
            cost[own[longest]] += lanes.mix(own[longest], *given) if lanes else mix(*given)
            done += width
        return cost / np.log(10)

    def spelled(self, words: list[bytes]) -> np.ndarray:
        """log10 probability of each word's bytes and its end."""
        owner, (one, three) = spelled_places(words)
        single, counts = self.spell
        behind = three >> 8
        p = (counts[behind, three & 255] + 2 * single[one >> 8, one & 255]) / (self.spell_totals[behind] + 2)
        return np.bincount(owner, np.log10(p), len(words))

    @cached_property
    def spell_totals(self) -> np.ndarray:
        return self.spell[1].sum(axis=1)


def trained(rows: DataFrame, counts: DataFrame, n_texts: int, n_words: int) -> Model:
    """The model of the given texts, of which counts are the word counts."""
    spark = rows.sparkSession
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    words, n = [bytes(r.word) for r in top], [r.n for r in top]
    code = Code(words, np.array([n_texts, n_words - sum(n), *n]))
    shared = spark.sparkContext.broadcast(code)
    size = (ORDERS << SLOT_BITS) // RANGES
    odds, seen = np.zeros(ORDERS << SLOT_BITS, np.int16), np.zeros(ORDERS << SLOT_BITS, np.int8)
    for part, raw in tables(rows, shared).toLocalIterator():  # of a fixed total size
        at, zero, one = unpacked(raw)
        at += part * size
        odds[at] = np.round(512 * np.log((one + PRIOR) / (zero + PRIOR)))
        seen[at] = np.where(zero + one > 15, 2, 1)
    return Model(code, odds, seen, spelling(counts))


def mixing_scores(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte).

    One row per row of docs. Tokens are lower-cased words and one end; rows whose crc32(doc_id) mod
    7 is 2 are held out, all others are learned from. base_score is the add-one unigram's, score
    the model's log10 probability of the text; bits_per_byte is score in bits over the bytes of the
    text (null without any). A null or empty text is the end alone. Repeated rows count and are
    scored once each; a row without an id is scored, not learned from. With nothing to learn from,
    counts are 0. An empty table gives an empty result.

    Counts of the FREQUENT words are sent to the tasks; those of other words are joined.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession
    learned = docs.where((crc_mod("doc_id", 7) >= 0) & (crc_mod("doc_id", 7) != 2))
    counts = stored(word_counts(learned), "word-counts")
    n_bytes = F.coalesce(F.octet_length("text").cast("long"), F.lit(0))
    length = sum(((n_bytes > limit).cast("int") for limit in LONG_BYTES), F.lit(0))
    sizes = docs.agg(
        F.count_if((crc_mod("doc_id", 7) >= 0) & (crc_mod("doc_id", 7) != 2)).alias("learned"),
        *(F.coalesce(F.sum(F.when(length == k, n_bytes)), F.lit(0)).alias(f"long_{k}") for k in range(len(LONG_BYTES) + 1)),
    ).first()
    n_texts = sizes.learned
    told = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_train, n_distinct = told.n + n_texts, told.v + (n_texts > 0)
    share = float(np.log10(n_train + n_distinct + 1))
    model = spark.sparkContext.broadcast(trained(learned, counts, n_texts, told.n))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, out, costs, coded = model.value, [], [], []
        rare_words, rare_times, rare_ends = [], [], [0]
        logs = np.log10(own.code.counts + 1.0)
        known = own.code.counts > 0
        texts = bytes_of(batch.column(1))

        def code() -> None:
            begins = np.cumsum([0] + [len(x) for x in coded])
            costs.append(own.log_probabilities(np.concatenate(coded), begins))
            coded.clear()

        for first, words, tokens, begins in groups(texts, own.code):
            coded.extend(np.split(tokens.astype(np.int32), begins[1:-1]))
            frequent = tokens != ESCAPE
            base = np.add.reduceat(np.where(frequent, logs[tokens], 0), begins[:-1])
            n_known = np.add.reduceat((frequent & known[tokens]).astype(np.int64), begins[:-1])
            rare = [Counter([found[i] for i in np.flatnonzero(x == ESCAPE).tolist()]) for found, x in zip(words, coded[-len(words) :], strict=True)]
            new = sorted(set().union(*rare))
            spelled = dict(zip(new, own.spelled(new).tolist(), strict=True)) if new else {}
            for k, found in enumerate(words):
                text, extra = texts[first + k] or b"", sum([n * spelled[w] for w, n in rare[k].items()])
                out.append((len(found) + 1, int(n_known[k]), float(base[k]), extra, len(text), xxhash.xxh3_64_intdigest(text) >> 1))
                rare_words.extend(rare[k])
                rare_times.extend(rare[k].values())
                rare_ends.append(len(rare_words))
            if sum(map(len, coded)) >= LANE_TOKENS:
                code()
        if coded:
            code()
        n, n_known, base, extra, size, row = zip(*out, strict=True)
        rare_items = pa.StructArray.from_arrays(
            [pa.array(rare_words, pa.binary()), pa.array(rare_times, pa.int64())], names=["word", "times"]
        )
        return batch_of(
            doc_id=(pa.int64(), batch.column(0)),
            row=(pa.int64(), row),
            n_tokens=(pa.int64(), n),
            n_known=(pa.int64(), n_known),
            base=(pa.float64(), base),
            score=(pa.float64(), np.concatenate(costs) + np.array(extra, float)),
            n_bytes=(pa.int64(), size),
            rare=(pa.list_(rare_items.type), pa.ListArray.from_arrays(pa.array(rare_ends, pa.int32()), rare_items)),
        )

    # A few long texts beside many short ones would make most steps those of a few lanes.
    dealt = [docs.where(length == 0)]
    for k in range(1, len(LONG_BYTES) + 1):
        dealt.append(docs.where(length == k).repartition(int(sizes[f"long_{k}"] // LONG_PART) + 1))
    parts = [
        rows.mapInArrow(
            by_batch(make),
            "doc_id long, row long, n_tokens long, n_known long, base double, score double, n_bytes long,"
            " rare array<struct<word:binary,times:long>>",
        )
        for rows in dealt
    ]
    scored = stored(reduce(DataFrame.unionAll, parts), "mixing-scores")
    rare = (
        scored.dropDuplicates(["doc_id", "row"])
        .select("doc_id", "row", F.inline("rare"))
        .join(counts, "word")
        .groupBy(F.col("doc_id").alias("id"), F.col("row").alias("r"))
        .agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row") == F.col("r"))
    return scored.drop("rare").join(rare, same, "left").select(
        "doc_id",
        (crc_mod("doc_id", 7) == 2).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * share).alias("base_score"),
        "score",
        F.when(F.col("n_bytes") > 0, -F.col("score") / (F.col("n_bytes") * float(np.log10(2)))).alias("bits_per_byte"),
    )


def op4(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """The mixing model's score of all documents."""
    return mixing_scores(spark.read.parquet(f"{sf_dir}/documents.parquet") if docs is None else docs)
