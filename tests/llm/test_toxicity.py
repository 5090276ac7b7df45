import random
import zlib

import numpy as np
from helpers import documents, words

from dayshape.llm.toxicity import cut_between, fit, toxicity, without_toxic


def corpus(seed, n):
    """Toxic texts hold a few words of one stem with ever new endings."""
    rnd = random.Random(seed)
    texts, toxic = [], []
    for _ in range(n):
        own = words(rnd, rnd.randrange(3, 120))
        bad = rnd.random() < 0.2
        for _ in range(rnd.randrange(1, 4) if bad else 0):
            own.insert(rnd.randrange(len(own)), "zzvile" + "".join(words(rnd, 1)))
        texts.append(" ".join(own))
        toxic.append(int(bad))
    return texts, toxic


def labels(spark, toxic, share=0.5):
    rnd = random.Random(8)
    rows = [(i, t) for i, t in enumerate(toxic) if rnd.random() < share]
    return spark.createDataFrame([*rows, (None, 1), (3, None)], "doc_id long, toxic int")


def test_held_out_accuracy(spark):
    texts, toxic = corpus(1, 1500)
    docs = documents(spark, [*texts, None, ""], score="x", toxic="y", k="z")
    got = {r.doc_id: r for r in toxicity(docs, labels(spark, toxic)).collect()}
    assert len(got) == 1502
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    held = [(r.predicted, toxic[i]) for i, r in got.items() if r.held_out and i < 1500]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert got[1500].score == got[1501].score < 0.5


def test_filter_keeps_clean_rows_and_columns(spark):
    texts, toxic = corpus(2, 800)
    docs = documents(spark, texts).unionByName(
        spark.createDataFrame([(None, "zzvileabc")], "doc_id long, text string"), allowMissingColumns=True
    )
    kept = without_toxic(docs, labels(spark, toxic))
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert None in ids
    assert len(ids) - 1 >= 0.97 * toxic.count(0)
    assert sum(toxic[i] for i in ids - {None}) <= 0.1 * sum(toxic)


def test_no_labels_and_empty_table(spark):
    docs = documents(spark, ["a b", "a b", None])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity(docs, none).collect()} == {0}
    assert toxicity(docs.limit(0), none).count() == 0


def test_bounds_of_the_sample(spark):
    texts, toxic = corpus(3, 400)
    few = toxicity(documents(spark, texts), labels(spark, toxic), classifiers=2, most_confirmed=10, most_unlabelled=20)
    assert few.count() == 400


def test_cut_lies_between_separate_groups():
    assert cut_between(np.array([4.0, 6.0]), np.array([0.0, 0.0, 0.0, 5.0]), 0.25) == 2.0
    assert fit([b"a"], np.array([False]), 0.1, 0)[-1] < 0
