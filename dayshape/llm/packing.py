"""Best-fit packing of tokenised documents into sequences of a fixed length.

Each task is an online packer with a fixed number of open sequences. A bitset holds which amounts
of free space exist among them: the lowest bit at or above a piece's length is the best fit. When
a piece fits nowhere and all are open, the fullest closes.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayshape.llm.common import batch_of, by_batch

BORDER = "<|startoftext|>"
#: Words of letters that lower-case and compose to one letter each.
LETTERS = re.compile("[a-zA-Zß-öø-ÿÀ-ÖØ-Þ]+").fullmatch
KNOWN_WORDS = 1_000_000  # words whose ids a worker remembers; the memory is emptied when full


class WordIds:
    """Ids of texts under a tokenizer that drops white space and never joins words over it.

    A text's ids are those of its words, one after the other; the library gives each word's ids
    once. Special strings inside texts are handled as the library does it by default.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}
        words = self.library.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(self.library.get_vocab_size(), bool)
        self.ends_word[[i for token, i in words.items() if token.endswith("</w>")]] = True
        self.marks = {mark: self.encoded(mark).tobytes() for mark in ".,"}

    def made(self, words: list[str]) -> list[bytes]:
        """The ids of each word, from one call.

        Words of plain letters are each one piece for the merges, so that the last of their ids
        is one that ends a word; between other words a special string marks the borders.
        """
        simple = [word for word in words if LETTERS(word)]
        marked = [word for word in words if not LETTERS(word) and BORDER not in word]
        out = {w: self.encoded(w).tobytes() for w in words if BORDER in w}
        if simple:
            ids = self.encoded(" ".join(simple))
            raw, ends = ids.tobytes(), (4 * np.flatnonzero(self.ends_word[ids]) + 4).tolist()
            out |= zip(simple, (raw[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True)
        if marked:
            ids = self.encoded(BORDER.join(marked))
            cuts = np.flatnonzero(ids == self.library.token_to_id(BORDER))
            out |= zip(marked, (x[i > 0 :].tobytes() for i, x in enumerate(np.split(ids, cuts))), strict=True)
        return [out[word] for word in words]

    def encoded(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def learn(self, words: set[str]) -> None:
        """Remembers new words; behind plain letters, a full stop or comma is a piece of its own."""
        known = self.known
        stems = {w: w[:-1] for w in words if w[-1] in ".," and LETTERS(w[:-1])}
        new = [w for w in {*(w for w in words if w not in stems), *stems.values()} if w not in known]
        known.update(zip(new, self.made(new), strict=True))
        for word, stem in stems.items():
            known[word] = known[stem] + self.marks[word[-1]]

    def of(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out = []
        for first in range(0, len(texts), 200):
            some = texts[first : first + 200]
            split = [(x or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for x in some]
            if len(self.known) >= KNOWN_WORDS:
                self.known = {"": b""}
            new = {w for w in set().union(*split) if w not in self.known}
            if new:
                self.learn(new)
            out += [b"".join(map(self.known.__getitem__, words)) for words in split]
        return out


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def tokenised(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """(doc_id, ids): little-endian unsigned 32-bit ids of each text, then end_id.

    A null text counts as empty and so is the end id alone.
    """
    end = np.array([end_id], "<u4").tobytes()

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = word_ids(tokenizer).of(batch.column(1).to_pylist())
        return batch_of(doc_id=(pa.int64(), batch.column(0)), ids=(pa.binary(), [x + end for x in found]))

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(by_batch(make), "doc_id long, ids binary")


def pieces(docs: DataFrame, tokenizer: str, length: int, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents cut where they are longer than length."""
    end = np.array([end_id], "<u4").tobytes()

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        texts = word_ids(tokenizer).of(batch.column(1).to_pylist())
        for doc, ids in zip(batch.column(0).to_pylist(), texts, strict=True):
            ids += end
            for k, at in enumerate(range(0, len(ids), 4 * length)):
                part = ids[at : at + 4 * length]
                rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
        doc, k, start, size, crc = zip(*rows, strict=True)
        return batch_of(
            doc_id=(pa.int64(), doc),
            piece=(pa.int32(), k),
            start=(pa.int64(), start),
            length=(pa.int64(), size),
            ids_crc32=(pa.int64(), crc),
        )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(
        by_batch(make), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


class OpenSequences:
    """A fixed number of open sequences, found by their free space."""

    def __init__(self, length: int, most: int) -> None:
        self.length, self.most = length, most
        self.with_free: list[list[int]] = [[] for _ in range(length + 1)]
        self.free_bits = self.n_open = 0
        self.numbers = count()

    def _take(self, free: int) -> int:
        found = self.with_free[free].pop()
        if not self.with_free[free]:
            self.free_bits ^= 1 << free
        self.n_open -= 1
        return found

    def place(self, size: int) -> tuple[int, int]:
        """(sequence, offset) for a piece of 1 to length tokens."""
        fitting = self.free_bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            sequence, free = next(self.numbers), self.length
        left = free - size
        if left:
            if self.n_open == self.most:
                fullest = (self.free_bits & -self.free_bits).bit_length() - 1
                if left <= fullest:  # this one is the fullest, so it closes
                    return sequence, self.length - free
                self._take(fullest)
            self.with_free[left].append(sequence)
            self.free_bits |= 1 << left
            self.n_open += 1
        return sequence, self.length - free


def packed(
    docs: DataFrame,
    tokenizer: str,
    length: int = 2048,
    open_sequences: int = 2048,
    docs_per_task: int = 4_000,
    end_id: int = 0,
) -> DataFrame:
    """Columns of pieces() and (sequence_id, offset): one row for each piece of each document.

    Documents are dealt out by a hash of doc_id and piece to packers of about docs_per_task
    documents each, which bounds a packer's rows and its share of half-filled last sequences. Rows
    come to a packer in the order of length (longest first), doc_id and piece, so a task that runs
    again packs alike. An empty or null text is one piece with the end id; an empty table gives no
    rows; repeated rows are packed once each; a null doc_id is kept.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        bins = OpenSequences(length, open_sequences)
        for batch in batches:
            placed = [bins.place(size) for size in batch.column("length").to_pylist()]
            if placed:
                sequence, offset = zip(*placed, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([first + s for s in sequence], pa.int64()), pa.array(offset, pa.int64())],
                    names=[*batch.schema.names, "sequence_id", "offset"],
                )

    tasks = -(-docs.count() // docs_per_task) or 1
    rows = pieces(docs, tokenizer, length, end_id)
    dealt = rows.repartition(tasks, "doc_id", "piece").sortWithinPartitions(
        F.desc("length"), "doc_id", "piece", "start", "ids_crc32"
    )
    return dealt.mapInArrow(
        pack,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )


def sequences(docs: DataFrame, placed: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed sequences themselves, ids as 32-bit integers."""
    parts = tokenised(docs.dropDuplicates(["doc_id"]), tokenizer, end_id).join(placed, "doc_id")
    part = F.expr("substring(ids, cast(start * 4 + 1 as int), cast(length * 4 as int))")
    return (
        parts.select("sequence_id", "offset", "length", part.alias("part"))
        .groupBy("sequence_id")
        .agg(
            F.sum("length").alias("n_tokens"),
            F.array_sort(F.collect_list(F.struct("offset", "part"))).alias("parts"),
        )
        .select("sequence_id", "n_tokens", F.expr("aggregate(parts, X'', (a, x) -> a || x.part)").alias("ids"))
    )


def op6(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """All documents, packed into sequences of 2048 tokens."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if docs is None else docs
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"))
