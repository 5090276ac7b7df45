"""The language of texts by error-correcting output codes over byte n-grams.

Each language has a codeword of bits; for each bit one linear classifier is trained to tell the
languages with a 1 from those with a 0 by hashed n-grams of a text's letters. A text goes to the
language whose codeword is nearest: bits count by their loss against the codeword, weighted by how
well their classifier did on the training texts, so a few wrong bits are outvoted. The gap to the
next codeword tells how sure that is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayshape.llm.common import batch_of, bytes_of, mixed
from dayshape.llm.toxicity import crc_mod

BUCKETS = 1 << 15
LENGTHS = (1, 2, 3, 4)  # of the n-grams, in bytes
PER_LANGUAGE = 500  # texts of each language that the classifiers are fitted on, at most
MOST_TEXTS = 8000  # of all languages together: what the task of one bit holds
MOST_LANGUAGES = 400
TYPICAL = 3.0  # mean margin of a classifier over its training texts
SHARPNESS = 4.0  # turns gaps of losses into shares
AMBIGUOUS = 0.3  # the gap of mean losses under which a text counts as ambiguous
PIECE = 1 << 20  # bytes whose n-grams are in memory at once

# Lower-cases A-Z; other ASCII characters that are no letters become spaces.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def codewords(languages: int) -> np.ndarray:
    """A row of bits (-1 or 1) for each language; no column is constant and no two are alike or opposite.

    Up to seven languages have all different columns, which puts rows as far apart as can be. For
    more, columns are drawn, and of several drawings the one with the largest least distance stays.
    """
    if languages < 2:
        return np.ones((languages, 0), np.int64)
    if languages <= 7:
        numbers = np.arange(1, 1 << (languages - 1))
        rows = [(numbers >> k) & 1 for k in range(languages - 1)]
        return 1 - 2 * np.array([*rows, np.zeros(len(numbers), np.int64)])
    bits = int(np.ceil(15 * np.log2(languages)))
    best, far = None, -1
    for seed in range(20):
        # Half of the languages have a 1 in a column.
        draw = np.random.default_rng(seed)
        half = np.repeat([-1, 1], [languages // 2, languages - languages // 2])
        code = np.array([draw.permutation(half) for _ in range(bits)]).T
        gaps = bits - code @ code.T
        np.fill_diagonal(gaps, 2 * bits)
        if gaps.min() > far:
            best, far = code, gaps.min()
    return best


def plain_letters(text: bytes) -> np.ndarray:
    """The text's letters in lower case, words parted by one space, with one at each end."""
    return np.frombuffer(b" " + b" ".join(text.translate(LETTERS).split()) + b" ", np.uint8)


def grams(letters: np.ndarray) -> np.ndarray:
    """The buckets of all n-grams."""
    found, key = [], np.zeros(len(letters), np.uint64)
    for n in range(1, max(LENGTHS) + 1):
        if len(letters) < n:
            break
        key = (key[: len(letters) - n + 1] << np.uint64(8)) | letters[n - 1 :]
        if n in LENGTHS:
            found.append(mixed(key + np.uint64(n << 56)) % np.uint64(BUCKETS))
    return np.concatenate(found).astype(np.int32)


def pieces(letters: np.ndarray) -> Iterator[np.ndarray]:
    """A text in parts, each repeating the last letters of the one before, so that every n-gram is in one."""
    for low in range(0, len(letters), PIECE):
        yield letters[max(0, low - max(LENGTHS) + 1) : low + PIECE]


def counted(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text and the share of its n-grams in each."""
    counts = np.zeros(BUCKETS, np.int64)
    for piece in pieces(plain_letters(text)):
        counts += np.bincount(grams(piece), minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found.astype(np.int32), (counts[found] / counts.sum()).astype(np.float32)


def fit_bit(rows: list[np.ndarray], shares: list[np.ndarray], sides: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Weights of the buckets, then the intercept and the classifier's accuracy on these texts.

    Logistic regression by Adagrad over all texts at once; both sides count the same in sum. The mean
    margin of these texts is TYPICAL.
    """
    size = np.array([len(r) for r in rows])
    owner, ids = np.repeat(np.arange(len(rows)), size), np.concatenate(rows)
    x = np.concatenate(shares).astype(np.float64)
    # Buckets are scaled by their spread over texts, so that frequent ones don't decide alone.
    square = np.bincount(ids, x * x, BUCKETS) / len(rows)
    scale = np.where(square > 0, 1 / np.sqrt(square + 1e-9), 0)
    x *= scale[ids]
    balance = np.where(sides > 0, 0.5 / max(1, (sides > 0).sum()), 0.5 / max(1, (sides < 0).sum()))
    weights, power = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-8)
    for _ in range(rounds):
        margin = sides * (np.bincount(owner, weights[ids] * x, len(rows)) + weights[-1])
        slope = -sides * balance / (1 + np.exp(np.clip(margin, -30, 30)))
        step = np.append(np.bincount(ids, slope[owner] * x, BUCKETS), slope.sum())
        step[:-1] += 1e-4 * weights[:-1]
        power += step**2
        weights -= 0.05 * step / np.sqrt(power)
    logit = np.bincount(owner, weights[ids] * x, len(rows)) + weights[-1]
    right = float((balance * (np.sign(logit) == sides)).sum())
    weights[:-1] *= scale
    # In units of its typical margin, no classifier is louder than another.
    weights *= TYPICAL / max(1e-9, np.abs(logit).mean())
    return np.append(weights, right)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    intercepts: np.ndarray
    importance: np.ndarray  # of each bit, 1 in sum

    def margins(self, texts: list[bytes]) -> np.ndarray:
        """Texts x bits: mean weight of the n-grams of each text, and the intercept."""
        out = np.zeros((len(texts), self.code.shape[1]))
        held: list[tuple[int, np.ndarray]] = []
        counts = np.zeros(len(texts))

        def add() -> None:
            found = [grams(piece) for _, piece in held]
            size = np.array([len(x) for x in found])
            sums = np.add.reduceat(self.weights[np.concatenate(found)], np.cumsum(size) - size, axis=0)
            for (i, _), s, n in zip(held, sums, size, strict=True):
                out[i] += s
                counts[i] += n
            held.clear()

        for i, text in enumerate(texts):
            for piece in pieces(plain_letters(text)):
                held.append((i, piece))
                if sum(len(p) for _, p in held[-1:]) >= PIECE // 2 or len(held) >= 64:
                    add()
        if held:
            add()
        return out / counts[:, None] + self.intercepts

    def decode(self, margins: np.ndarray) -> np.ndarray:
        """Texts x languages: the weighted loss of all bits against each codeword."""
        losses = [np.logaddexp(0, -sign * margins) * self.importance for sign in (-1, 1)]
        return losses[0] @ (self.code.T < 0) + losses[1] @ (self.code.T > 0)


def crc(doc_id: str = "doc_id") -> Column:
    return crc_mod(doc_id, 4) == 2


def training_texts(docs: DataFrame, per_language: int) -> DataFrame:
    """(lang, doc_id, text): at most per_language texts of each language, those with the least id hashes.

    Ids are drawn before texts are read; of texts with the same id and language one is taken.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~crc())
    known = known.select(F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = known.where(F.col("text").rlike("\\p{L}"))
    ids = known.select("lang", "doc_id", F.xxhash64("doc_id").alias("h")).distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    drawn = ids.withColumn("place", place).where(F.col("place") <= per_language).select("lang", "doc_id")
    texts = known.join(drawn, ["lang", "doc_id"], "left_semi")
    return texts.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))


def shares_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.list_(pa.int32()), pa.list_(pa.float32())
    for batch in batches:
        for low in range(0, batch.num_rows, 64):
            part = batch.slice(low, 64)
            found = [counted(t) for t in bytes_of(part.column("text"))]
            yield batch_of(
                lang=(pa.string(), part.column("lang").to_pylist()),
                doc_id=(pa.int64(), part.column("doc_id").to_pylist()),
                ids=(kinds[0], [x for x, _ in found]),
                shares=(kinds[1], [x for _, x in found]),
            )


def trained(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """The model of the labelled texts, one task for each bit; None without any.

    The driver gets one weight per bucket and bit. More than MOST_LANGUAGES languages are refused.
    """
    labels = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~crc() & F.col("text").rlike("\\p{L}"))
    found = labels.select(F.col("lang").cast("string")).distinct().limit(MOST_LANGUAGES + 1).collect()
    languages = sorted(row[0] for row in found)
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not languages:
        return None
    code = codewords(len(languages))
    bits = code.shape[1]
    if not bits:
        return Model(languages, code, np.zeros((BUCKETS, 0), np.float32), np.zeros(0), np.zeros(0))
    place = {language: i for i, language in enumerate(languages)}
    sample = training_texts(docs, min(per_language, MOST_TEXTS // len(languages))).mapInArrow(
        shares_of, "lang string, doc_id bigint, ids array<int>, shares array<float>"
    )

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["lang", "doc_id"])
        bit = int(rows["bit"].iloc[0])
        sides = np.array([code[place[x], bit] for x in rows["lang"]])
        return pd.DataFrame({"bit": [bit], "w": [fit_bit(list(rows["ids"]), list(rows["shares"]), sides)]})

    each = sample.withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(bits - 1))))
    made = each.groupBy("bit").applyInPandas(fit, "bit int, w array<double>").orderBy("bit").collect()
    weights = np.array([row["w"] for row in made])
    # A classifier no better than a guess has no say; the best has the most.
    importance = np.maximum(weights[:, -1] - 0.5, 1e-6)
    return Model(
        languages,
        code,
        np.ascontiguousarray(weights[:, :BUCKETS].T.astype(np.float32)),
        weights[:, BUCKETS],
        importance / importance.sum(),
    )


def predictor(model, undetermined: str):
    """For mapInArrow: (doc_id, held_out, text, letters) to (doc_id, held_out, lang_pred, score, ambiguous, runner_up)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model | None = model.value
        for batch in batches:
            texts, letters = bytes_of(batch.column("text")), batch.column("letters").to_pylist()
            n = len(texts)
            first, second = [undetermined] * n, [None] * n
            score, unsure = np.zeros(n), np.ones(n, bool)
            told = [i for i in range(n) if letters[i]]
            if known is not None and told:
                losses = known.decode(known.margins([texts[i] for i in told]))
                order = np.argsort(losses, axis=1, kind="stable")
                rank = np.take_along_axis(losses, order, axis=1)
                share = np.exp(-SHARPNESS * (rank - rank[:, :1]))
                score[told] = share[:, 0] / share.sum(axis=1)
                gap = rank[:, 1] - rank[:, 0] if rank.shape[1] > 1 else np.full(len(told), np.inf)
                unsure[told] = gap < AMBIGUOUS
                for i, o in zip(told, order.tolist(), strict=True):
                    first[i] = known.languages[o[0]]
                    second[i] = known.languages[o[1]] if len(o) > 1 else None
            yield batch_of(
                doc_id=(pa.int64(), batch.column("doc_id")),
                held_out=(pa.bool_(), batch.column("held_out")),
                lang_pred=(pa.string(), first),
                score=(pa.float64(), score),
                ambiguous=(pa.bool_(), unsure),
                runner_up=(pa.string(), second),
            )

    return run


def languages_of(docs: DataFrame, per_language: int = PER_LANGUAGE, undetermined: str = "und") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous, runner_up) for every row of docs.

    Learns from text and lang of rows whose crc32 of the decimal doc_id leaves another remainder by
    4 than 2 (those are held_out), a lang, a doc_id and a letter in the text. Classifiers are fitted
    on at most per_language texts of each language and MOST_TEXTS in all; whole texts count, however long. lang_pred is a
    learned language, or undetermined with score 0 if the text is null or has no letter or nothing
    could be learned. score is the nearest codeword's share of all, 1 with only one language;
    ambiguous tells that the next codeword, of runner_up, is about as near. Rows without doc_id are
    scored, and not held out; repeated rows are scored each; other columns take no part.
    """
    model = docs.sparkSession.sparkContext.broadcast(trained(docs, per_language))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        crc().alias("held_out"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)).alias("letters"),
    )
    kinds = "doc_id bigint, held_out boolean, lang_pred string, score double, ambiguous boolean, runner_up string"
    return rows.mapInArrow(predictor(model, undetermined), kinds)


def op13(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """The language of all documents."""
    return languages_of(spark.read.parquet(f"{sf_dir}/documents.parquet") if docs is None else docs)
