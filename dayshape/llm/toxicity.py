"""Toxicity scores by non-negative learning from positive and unlabelled texts.

Confirmed toxic texts and unlabelled ones train a linear classifier over hashed words and word
beginnings. The risk of calling a text clean is estimated on unlabelled texts, less what the class
prior says the toxic among them add to it; where that difference falls below zero, which a risk
cannot, a step takes the classifier back from fitting the unlabelled texts any further. Several
classifiers are trained side by side on different samples and their logits averaged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayshape.llm.common import bytes_of, plain_words

BUCKETS = 1 << 18
STARTS = (4, 5, 6)  # lengths in bytes of the beginnings that count next to the whole word
KNOWN_WORDS = 400_000
RARE = 10  # texts of a sample
SHRINK = 3


class WordFeatures(dict):
    """Buckets of a word: its own and those of its beginnings."""

    def __missing__(self, word: bytes) -> list[int]:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        parts = [b"=" + word, *(word[:n] for n in STARTS if len(word) > n)]
        found = self[word] = [xxhash.xxh3_64_intdigest(x) % BUCKETS for x in parts]
        return found


FEATURES = WordFeatures()


def features(text: bytes | None) -> np.ndarray:
    """The buckets of a text's distinct words."""
    return np.array([f for word in sorted(set(plain_words(text))) for f in FEATURES[word]], np.int32)


def cut_between(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """The logit from which a text counts as toxic: least non-negative risk of a wrong call.

    Of a stretch of equally good cuts, its middle.
    """
    cuts = np.unique(np.concatenate([positive, unlabelled]))
    cuts = np.concatenate([[cuts[0] - 1], (cuts[1:] + cuts[:-1]) / 2, [cuts[-1] + 1]])
    missed = np.searchsorted(np.sort(positive), cuts) / len(positive)
    called = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    risk = prior * missed + np.maximum(0, called - prior * (1 - missed))
    good = np.flatnonzero(risk <= risk.min() + 1e-12)
    return float((cuts[good[0]] + cuts[good[-1]]) / 2)


def fit(texts: list[bytes], toxic: np.ndarray, prior: float, seed: int, rounds: int = 20) -> np.ndarray:
    """Weights of the buckets and, last, the intercept, by non-negative risk steps (Adagrad).

    toxic marks the confirmed texts; all others count as unlabelled. Buckets of fewer than RARE
    texts take no part, each step draws weights towards 0, and none is below 0: clean words don't
    make up for a toxic one, and long texts don't add up the chance weights of their many words.
    """
    weights = np.zeros(BUCKETS + 1)
    weights[-1] = np.log(prior / (1 - prior))
    positive, unlabelled = np.flatnonzero(toxic), np.flatnonzero(~toxic)
    if not len(positive) or not len(unlabelled):
        return weights
    rows = [features(text) for text in texts]
    texts_with = np.zeros(BUCKETS, np.int64)
    for row in rows:
        texts_with[np.unique(row)] += 1
    rows = [row[texts_with[row] >= RARE] for row in rows]
    power = np.full(BUCKETS + 1, 1.0)
    draw = np.random.default_rng(seed)
    steps = max(1, len(unlabelled) // 200)
    for _ in range(rounds):
        for some_p, some_u in zip(
            np.array_split(draw.permutation(positive), steps),
            np.array_split(draw.permutation(unlabelled), steps),
            strict=True,
        ):
            if not len(some_p):
                some_p = draw.choice(positive, 1)
            picked = [rows[k] for k in (*some_p, *some_u)]
            sizes = np.array([len(x) for x in picked])
            owner, ids = np.repeat(np.arange(len(picked)), sizes), np.concatenate(picked)
            logit = weights[-1] + np.bincount(owner, weights[ids], len(picked))
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            loss = np.logaddexp(0, logit)  # of calling the text clean
            n = len(some_p)
            clean_risk = loss[n:].mean() - prior * loss[:n].mean()
            if clean_risk >= 0:
                slope = np.concatenate([np.full(n, -prior / n), p[n:] / len(some_u)])
            else:  # the estimate can't be lowered any more; only the confirmed texts count
                slope = np.concatenate([-prior * (1 - p[:n]) / n, np.zeros(len(some_u))])
            step = np.bincount(ids, slope[owner], BUCKETS + 1)
            step[-1] = slope.sum()
            step *= len(picked)
            power += step**2
            rate = 0.3 / np.sqrt(power)
            weights -= rate * step
            weights[:-1] = np.maximum(weights[:-1] - SHRINK * rate[:-1], 0)
    logits = np.array([weights[row].sum() for row in rows])
    weights[-1] = -cut_between(logits[positive], logits[unlabelled], prior)
    return weights


def crc_mod(column: str, n: int) -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n, F.lit(-1))


def trained(
    docs: DataFrame,
    labels: DataFrame,
    classifiers: int = 4,
    most_confirmed: int = 2_000,
    most_unlabelled: int = 6_000,
) -> np.ndarray:
    """Mean weights of classifiers, each fitted on its own bounded sample of docs.

    labels is (doc_id, toxic). Rows of docs whose crc32(doc_id) mod 5 is 0 are left to testing.
    A classifier gets about most_confirmed texts with toxic = 1 and most_unlabelled of the other
    texts (all, if fewer). The class prior is the share of toxic = 1 among the labelled, less the
    confirmed texts, which aren't among the unlabelled. Without a confirmed text every score is
    that prior.
    """
    known = labels.where(crc_mod("doc_id", 5) > 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).dropna()
    rows = docs.where(crc_mod("doc_id", 5) > 0).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    told = rows.select("doc_id").join(known, "doc_id").agg(
        F.avg((F.col("toxic") == 1).cast("double")).alias("prior"), F.sum((F.col("toxic") == 1).cast("long")).alias("n")
    )
    share, n_confirmed = told.first()
    n_confirmed, n_all = n_confirmed or 0, rows.count()
    prior = ((share or 0.0) * n_all - n_confirmed) / max(1, n_all - n_confirmed)
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    confirmed = known.where("toxic = 1").select("doc_id")
    ids = rows.select("doc_id").distinct()

    def drawn(part: DataFrame, n: int, most: int, toxic: bool) -> DataFrame:
        chance = min(1.0, most / max(1, n))
        picks = [
            F.when(F.pmod(F.xxhash64("doc_id", F.lit(100 * toxic + k)), F.lit(1_000_003)) < chance * 1_000_003, k)
            for k in range(classifiers)
        ]
        picked = part.select("doc_id", F.explode(F.array_compact(F.array(*picks))).alias("k"))
        return picked.withColumn("toxic", F.lit(toxic))

    # Ids are drawn first, so that only the texts of a bounded number of rows are sent anywhere.
    wanted = drawn(ids.join(confirmed, "doc_id", "left_semi"), n_confirmed, most_confirmed, True).unionAll(
        drawn(ids.join(confirmed, "doc_id", "left_anti"), n_all - n_confirmed, most_unlabelled, False)
    )
    sample = rows.join(F.broadcast(wanted), "doc_id").withColumn("text", F.coalesce("text", F.lit("")))

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["toxic", "doc_id", "text"])
        found = fit([x.encode() for x in pdf.text], pdf.toxic.to_numpy(bool), prior, int(pdf.k.iloc[0]))
        at = np.flatnonzero(found)
        return pd.DataFrame({"bucket": at, "weight": found[at]})

    parts = sample.groupBy("k").applyInPandas(learn, "bucket long, weight double")
    out = np.zeros(BUCKETS + 1)
    mean = parts.groupBy("bucket").agg((F.sum("weight") / classifiers).alias("weight"))
    for bucket, weight in mean.collect():  # at most BUCKETS + 1 rows
        out[bucket] = weight
    if not n_confirmed:
        out[-1] = np.log(prior / (1 - prior))
    return out


class WordLogits(dict):
    def __init__(self, weights: np.ndarray) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        found = self[word] = float(self.weights[FEATURES[word]].sum())
        return found


def toxicity(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per row of docs; bounds as in trained().

    score is the probability of toxic = 1 by all words of the text; predicted is 1 from 0.5 on.
    A null or empty text has the score of no words at all. held_out marks rows that no classifier
    was fitted on. Repeated rows are each scored; a row without an id is never trained on or held
    out; an empty table gives an empty result. lang, source and labels aren't inputs of a score.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    weights = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, **bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_word, intercept = WordLogits(weights.value), weights.value[-1]
        for batch in batches:
            logits = []
            for text in bytes_of(batch.column(1)):
                own = sorted(set(plain_words(text)))
                logits.append(sum([of_word[word] for word in own]))
            score = 1 / (1 + np.exp(-np.clip(np.array(logits, float) + intercept, -40, 40)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    scored = docs.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        (crc_mod("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs not predicted toxic; all columns stay, and rows without an id too."""
    gone = toxicity(docs, labels).where("predicted = 1 and doc_id is not null").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")


def op5(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """Toxicity of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if docs is None else docs
    return toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
