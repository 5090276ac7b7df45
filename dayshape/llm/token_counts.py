"""Exact token counts at every prefix of a text, by dynamic programming over its characters.

The pieces of a prefix are the pieces of a shorter prefix and one more piece: the only one that
ends there and stays apart from the piece before it. So count[i] = count[start of that piece] + 1,
and one pass over a text answers every question about budgets and truncation. No piece holds a
space behind another character, so a text falls into chunks (spaces, then what follows) whose
counts add up; the counts of chunks that were met before are looked up.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayshape.llm.common import batch_of, by_batch

SPACE = "▁"  # what the vocabulary writes for a space
KNOWN_CHUNKS = 600_000  # chunks remembered by a worker; the memory is emptied when full
KNOWN_LENGTH = 64  # longer chunks are worked out each time


class PrefixCounter:
    """Counts for one sentencepiece model of merges with byte fallback."""

    def __init__(self, model: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        ids = range(self.library.get_piece_size())
        plain = [
            i
            for i in ids
            if not (
                self.library.is_control(i)
                or self.library.is_unknown(i)
                or self.library.is_byte(i)
                or self.library.is_unused(i)
            )
        ]
        self.rank = {self.library.id_to_piece(i): self.library.get_score(i) for i in plain}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.rank):
            raise ValueError("a piece holds a space behind another character")
        steps = {score: i for i, score in enumerate(sorted(set(self.rank.values()), reverse=True))}
        #: When a piece comes into being: single characters are there from the start.
        self.born = {p: steps[score] if len(p) > 1 else -1 for p, score in self.rank.items()}
        #: Pieces from their last character to their first; a node holds the piece that begins there.
        self.backwards: dict = {}
        for piece in self.rank:
            node = self.backwards
            for char in reversed(piece):
                node = node.setdefault(char, {})
            node[""] = piece
        self.halves: dict[str, tuple[str, str]] = {}
        self.apart: dict[str, dict[str, bool]] = {}
        self.known: dict[str, tuple[int, bytes]] = {}
        self.chunks = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall

    def merged(self, text: str, until: int = 1) -> list[str]:
        """The pieces of a short text: the best adjacent pair merges, down to `until` pieces."""
        parts = list(text)
        while len(parts) > until:
            pairs = [
                (self.born[whole], i)
                for i in range(len(parts) - 1)
                if (whole := parts[i] + parts[i + 1]) in self.born
            ]
            if not pairs:
                break
            at = min(pairs)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def split_of(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge makes a piece; None if merging doesn't lead to it."""
        if piece not in self.halves:
            two = self.merged(piece, until=2)
            self.halves[piece] = tuple(two) if len(two) == 2 else None
        return self.halves[piece]

    def stays(self, before: str, piece: str) -> bool:
        """Whether the two pieces, side by side, stay as they are.

        Goes back in time: of the two pieces at the border, the one that came into being later is
        taken apart again. The border holds unless a pair over it would have merged before that.
        """
        if len(piece) > 1 and self.split_of(piece) is None:
            return False
        if not before:
            return True
        if before[-1] == piece[0] == SPACE:
            return self.merged(before + piece) == [before, piece]
        born = self.born
        limit, left, right = len(born), before, piece
        while True:
            if born.get(left + right, limit) < limit:
                return False
            if len(left) == len(right) == 1:
                return True
            later = born[left] if len(left) > 1 else -2
            if later > (born[right] if len(right) > 1 else -2):
                limit, left = later, self.split_of(left)[1]
            else:  # of equal merges the left one comes first
                limit, right = born[right] + 1, self.split_of(right)[0]

    def worked_out(self, chunk: str) -> list[int]:
        """The number of tokens of each prefix of a chunk, the empty one first."""
        counts, last = [0], [""]
        backwards, apart = self.backwards, self.apart
        for end in range(1, len(chunk) + 1):
            node, start = backwards, end
            while start:
                node = node.get(chunk[start - 1])
                if node is None:
                    break
                start -= 1
                piece = node.get("")
                if piece is None:
                    continue
                before = last[start]
                after = apart.get(before)
                if after is None:
                    after = apart[before] = {}
                fits = after.get(piece)
                if fits is None:
                    fits = after[piece] = self.stays(before, piece)
                if fits:  # no other piece does, so longer ones needn't be looked for
                    counts.append(counts[start] + 1)
                    last.append(piece)
                    break
            if len(counts) == end:  # an unknown character falls back to its bytes
                counts.append(counts[end - 1] + len(chunk[end - 1].encode()))
                last.append(chunk[end - 1])
        return counts

    def steps(self, chunk: str) -> tuple[int, bytes]:
        """A chunk's count, and by how much each of its characters changes it (signed bytes)."""
        if (found := self.known.get(chunk)) is None:
            counts = self.worked_out(chunk)
            found = counts[-1], bytes([(b - a) & 255 for a, b in zip(counts, counts[1:])])
            if len(chunk) <= KNOWN_LENGTH:
                if len(self.known) >= KNOWN_CHUNKS:
                    self.known.clear()
                self.known[chunk] = found
        return found

    def split(self, text: str) -> list[str]:
        return self.chunks(SPACE + text.replace(" ", SPACE)) if text else []


@cache
def counter(model: str) -> PrefixCounter:
    return PrefixCounter(model)


def prefix_counts(docs: DataFrame, model: str, keep_prefixes: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, steps) per row of docs (doc_id, text).

    steps holds, for each character of the text behind a leading space, the signed byte by which
    it changes the count of tokens; sums of its first k + 1 bytes are the counts of prefixes of k
    characters. keep_prefixes=False leaves the column null; the work is the same. A null text
    counts as empty; an empty text has no token. Rows are independent: repeated rows, null ids
    and further columns have no effect.
    """

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = counter(model)
        sizes, totals, kept = [], [], []
        get, steps, split = own.known.get, own.steps, own.split
        for text in batch.column(1).to_pylist():
            parts = split(text or "")
            found = [get(part) or steps(part) for part in parts]
            sizes.append(len((text or "").encode()))
            totals.append(sum([count for count, _ in found]))
            kept.append(b"".join([step for _, step in found]) if keep_prefixes else None)
        return batch_of(
            doc_id=(pa.int64(), batch.column(0)),
            n_bytes=(pa.int64(), sizes),
            n_tokens=(pa.int64(), totals),
            steps=(pa.binary(), kept),
        )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(by_batch(make), "doc_id long, n_bytes long, n_tokens long, steps binary")


def counts_at(steps: bytes) -> np.ndarray:
    """The number of tokens of the prefixes of 0, 1, 2 ... characters."""
    sums = np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)
    return sums if not len(sums) else np.concatenate([[0], sums[1:]])


def truncated(counts: DataFrame, budget: int) -> DataFrame:
    """(doc_id, n_chars, n_kept, tokens_kept): the longest prefix within a budget of tokens.

    counts comes from prefix_counts; no text is encoded again. An empty text keeps 0 characters.
    """

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, kept, tokens = [], [], []
        for steps in batch.column(1).to_pylist():
            at = counts_at(steps or b"")
            last = int(np.flatnonzero(at <= budget)[-1]) if len(at) else 0
            sizes.append(max(0, len(at) - 1))
            kept.append(last)
            tokens.append(int(at[last]) if len(at) else 0)
        return batch_of(
            doc_id=(pa.int64(), batch.column(0)),
            n_chars=(pa.int64(), sizes),
            n_kept=(pa.int64(), kept),
            tokens_kept=(pa.int64(), tokens),
        )

    return counts.select("doc_id", "steps").mapInArrow(
        by_batch(make), "doc_id long, n_chars long, n_kept long, tokens_kept long"
    )


def op10(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """Token counts of all documents under piece_bpe_32k.model."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if docs is None else docs
    counts = prefix_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), False)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))
