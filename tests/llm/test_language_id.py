import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayshape.llm.language_id import (
    AMBIGUOUS,
    PIECE,
    TYPICAL,
    Model,
    codewords,
    counted,
    fit_bit,
    grams,
    languages_of,
    op13,
    plain_letters,
    training_texts,
)

SF = "/root/testdata/sf0.01"
KINDS = "doc_id long, text string, lang string, source string"
SYLLABLES = {
    "aa": ["ba", "do", "ki", "lu"],
    "bb": ["stra", "gne", "vol", "pir"],
    "cc": ["éu", "ñor", "çal", "üm"],
    "dd": ["хо", "ми", "та", "ре"],
    "ee": ["xyz", "qua", "wek", "jot"],
}


def text_of(rnd, lang, n=40):
    return " ".join("".join(rnd.choices(SYLLABLES[lang], k=rnd.randrange(1, 4))) for _ in range(n))


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.mark.parametrize("n", [2, 3, 4, 5, 7, 8, 20, 60])
def test_codewords_are_apart(n):
    code = codewords(n)
    assert set(np.unique(code)) == {-1, 1}
    assert (np.abs(code.sum(axis=0)) < n).all()
    gaps = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
    assert min(gaps) >= (1 if n == 2 else 2 ** (n - 2) if n <= 7 else code.shape[1] // 5)
    assert len(codewords(1)[0]) == 0


def test_margins_are_means_over_all_grams_of_whole_texts():
    rnd = np.random.default_rng(1)
    weights = rnd.normal(size=(1 << 15, 3)).astype(np.float32)
    model = Model(["a", "b", "c"], codewords(3), weights, np.array([0.1, 0.2, 0.3]), np.full(3, 1 / 3))
    texts = [b"a", b"ab, c", "é Ü".encode(), b"word " * (PIECE // 3), b"x" * (2 * PIECE + 3), *[b"abc def"] * 70]
    found = model.margins(texts)
    for text, got in zip(texts, found, strict=True):
        letters = plain_letters(text)
        ids = [grams(letters)] if len(letters) <= PIECE else [counted(text)]
        if len(letters) <= PIECE:
            want = weights[ids[0]].mean(axis=0)
        else:
            want = (weights[ids[0][0]] * ids[0][1][:, None]).sum(axis=0)
        assert np.allclose(got, want + model.intercepts, atol=1e-3)
    once = np.bincount(grams(plain_letters(b"b" * 50)), minlength=1 << 15)
    assert once.sum() == sum(52 - n + 1 for n in (1, 2, 3, 4))


def test_decoding_outvotes_a_wrong_bit():
    code = codewords(4)
    model = Model(list("abcd"), code, np.zeros((1, 7)), np.zeros(7), np.full(7, 1 / 7))
    for k in range(4):
        for wrong in range(7):
            margins = 2.0 * code[k]
            margins[wrong] *= -1
            assert model.decode(margins[None])[0].argmin() == k


def test_a_bit_without_merit_has_no_say():
    code = codewords(3)
    weighted = Model(list("abc"), code, np.zeros((1, 3)), np.zeros(3), np.array([0.5, 0.5, 0.0]))
    margins = np.array([[3.0, 3.0, -50.0]]) * code[0]
    assert weighted.decode(margins)[0].argmin() == 0


def test_fit_tells_sides_apart():
    rnd = random.Random(1)
    texts = [(lang, counted(text_of(rnd, lang).encode())) for lang in ("aa", "bb") for _ in range(50)]
    sides = np.array([1 if lang == "aa" else -1 for lang, _ in texts])
    made = fit_bit([x for _, (x, _) in texts], [s for _, (_, s) in texts], sides)
    assert made[-1] > 0.999
    logits = [(made[:-2][x] * share).sum() + made[-2] for _, (x, share) in texts]
    assert abs(np.abs(logits).mean() - TYPICAL) < 1e-3


def test_held_out_texts_of_five_languages_and_odd_ones(spark):
    rnd = random.Random(2)
    langs = list(SYLLABLES)
    rows = [(i, text_of(rnd, langs[i % 5], rnd.choice([3, 30])), langs[i % 5], "s") for i in range(400)]
    # A third of all rows share an id; unlabelled, null, empty, letterless, long and repeated rows.
    rows += [(9999, text_of(rnd, "aa"), "aa", "s") for _ in range(200)]
    odd = [
        (5000, text_of(rnd, "cc"), None, None), (5001, None, "aa", "s"), (5002, "", "aa", "s"), (5003, "12 %% 7", "bb", "s"),
        (5004, text_of(rnd, "dd", 90_000), None, "s"), (5005, rows[0][1], None, "s"), (5005, rows[0][1], None, "s"),
        (None, text_of(rnd, "ee"), "bb", "s"),
    ]
    docs = spark.createDataFrame(rows + odd, KINDS).withColumns({"letters": F.lit("x"), "score": F.lit(1), "bit": F.lit(2)})
    found = languages_of(docs).collect()
    assert len(found) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in found}
    assert all(r.held_out == (r.doc_id is not None and held_out(r.doc_id)) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    right = [by_id[i].lang_pred == lang for i, _, lang, _ in rows if held_out(i)]
    assert np.mean(right) > 0.97
    assert [by_id[i].lang_pred for i in (5000, 5001, 5002, 5003, 5004, 5005, None)] == ["cc", "und", "und", "und", "dd", "aa", "ee"]
    assert by_id[5001].score == 0 and by_id[5001].ambiguous
    again = {(r.doc_id, r.score) for r in languages_of(docs.repartition(3)).collect() if r.doc_id != 9999}
    assert {k for k, _ in again} == {r.doc_id for r in found if r.doc_id != 9999}
    assert all(abs(by_id[k].score - s) < 1e-9 for k, s in again)


def test_a_mixed_text_is_ambiguous(spark):
    rnd = random.Random(3)
    rows = [(i, text_of(rnd, ["aa", "bb"][i % 2]), ["aa", "bb"][i % 2], "s") for i in range(120)]
    mixed_text = " ".join(a + " " + b for a, b in zip(text_of(rnd, "aa").split(), text_of(rnd, "bb").split(), strict=True))
    clear, mixed_one = (
        languages_of(spark.createDataFrame([*rows, (1000, t, None, "s")], KINDS)).where("doc_id = 1000").first()
        for t in (text_of(rnd, "aa"), mixed_text)
    )
    assert clear.lang_pred == "aa" and not clear.ambiguous
    assert mixed_one.score < clear.score
    assert AMBIGUOUS > 0


def test_one_language_none_and_an_empty_table(spark):
    one = spark.createDataFrame([(i, "ab cd", "xx", "s") for i in range(8)] + [(50, None, "xx", "s")], KINDS)
    got = {(r.lang_pred, r.score, r.ambiguous) for r in languages_of(one).collect()}
    assert got == {("xx", 1.0, False), ("und", 0.0, True)}
    none = one.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in languages_of(none).collect()} == {"und"}
    assert languages_of(one.limit(0)).count() == 0


def test_the_sample_is_bounded_and_leaves_out_held_out_rows(spark):
    docs = spark.createDataFrame([(i, "ab", "xy"[i % 2], "s") for i in range(400)] + [(7, "zz", "y", "s")] * 300, KINDS)
    found = training_texts(docs, 20).collect()
    assert sorted(r.lang for r in found) == ["x"] * 20 + ["y"] * 20
    assert not any(held_out(r.doc_id) for r in found)
    assert len({(r.lang, r.doc_id) for r in found}) == 40


def test_held_out_accuracy_on_the_test_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = op13(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.98
