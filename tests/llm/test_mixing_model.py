import math
import random
import zlib

import numpy as np
from helpers import documents, lower, spaced

from dayshape.llm import mixing_model as m


def language(seed, n):
    """Texts of two vocabularies that don't mix, most words rare."""
    rnd = random.Random(seed)
    pools = [[f"{p}{k}" for k in range(400)] for p in "ab"]
    return [" ".join(rnd.choice(pools[i % 2][: rnd.randrange(1, 400)]) for _ in range(rnd.randrange(1, 80))) for i in range(n)]


def brute(texts):
    counts, n_train = {}, 0
    tokens = [[*spaced(lower(t)), None] for t in texts]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    for own, out in zip(tokens, held, strict=True):
        for token in own if not out else ():
            counts[token] = counts.get(token, 0) + 1
            n_train += 1
    v = len(counts)
    return [
        (i, h, len(own), sum(t in counts for t in own), n_train, sum(math.log10((counts.get(t, 0) + 1) / (n_train + v + 1)) for t in own))
        for i, (own, h) in enumerate(zip(tokens, held, strict=True))
    ]


def test_counts_base_scores_and_gain(spark, monkeypatch):
    texts = [*language(1, 1500), None, "", "  ", "Odd WORDS only here", "a1 " * 3000]
    got = {r.doc_id: r for r in m.mixing_scores(documents(spark, texts, n="x", word="y", rare="z")).collect()}
    assert len(got) == len(texts)
    for i, held, n, known, train, base in brute(texts):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, train)
        assert abs(r.base_score - base) < 1e-6
        assert r.score < 0
    assert got[1500].score == got[1501].score == got[1502].score
    assert got[1500].bits_per_byte is None
    held = [r for r in got.values() if r.held_out and r.doc_id < 1500]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_rare_words_are_joined(spark, monkeypatch):
    monkeypatch.setattr(m, "FREQUENT", 20)
    texts = language(2, 80)
    got = {r.doc_id: r for r in m.mixing_scores(documents(spark, texts)).collect()}
    for i, _, n, known, _, base in brute(texts):
        assert (got[i].n_tokens, got[i].n_known) == (n, known)
        assert abs(got[i].base_score - base) < 1e-6


def test_nothing_to_learn_from_and_empty_table(spark):
    odd = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    got = m.mixing_scores(odd).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens) for r in got) == [(1, 0, 0), (3, 0, 0)]
    assert m.mixing_scores(odd.limit(0)).count() == 0


def test_code_and_spelling_are_probabilities():
    code = m.Code([b"a", b"b", b"c"], np.array([3, 1, 40, 9, 2]))
    sizes = np.diff(code.offsets)
    assert abs(sum(2.0**-sizes) - 1) < 1e-12
    single = np.full((256, 256), 1 / 256)
    model = m.Model(code, np.zeros(0), np.zeros(0), [single, np.zeros((1 << m.SPELL_BITS - 8, 256))])
    assert np.allclose(model.spelled([b"ab", b"c"]), [3 * math.log10(1 / 256), 2 * math.log10(1 / 256)])


def test_a_bit_and_its_opposite_share_all_probability():
    rnd = np.random.default_rng(1)
    inputs = [rnd.normal(size=40).astype(np.float32) for _ in range(3)]
    bits = rnd.integers(0, 2, 40).astype(np.int8)
    other = bits.copy()
    other[-1] ^= 1
    lane = (np.zeros(1, np.int64), np.array([40]))
    less = m.mix([x[:39] for x in inputs], np.zeros(39, np.int64), bits[:39], lane[0], np.array([39]))
    both = [m.mix(inputs, np.zeros(40, np.int64), x, *lane) for x in (bits, other)]
    assert abs(sum(np.exp(x - less)[0] for x in both) - 1) < 1e-5


def test_all_bits_of_a_whole_text_are_mixed_in_one_lane(monkeypatch):
    words = [b"w%d" % k for k in range(40)]
    code = m.Code(words, np.array([1, 1, *(2**k for k in range(40))]))
    assert np.diff(code.offsets).max() > 30  # the rarest words have long codes
    size = m.ORDERS << m.SLOT_BITS
    model = m.Model(code, np.zeros(size, np.int16), np.zeros(size, np.int8), [])
    seen, mix = [], m.mix
    monkeypatch.setattr(m, "mix", lambda *given: seen.append(given[-1]) or mix(*given))
    tokens = np.concatenate([code.tokens(words * 20), code.tokens(words[:1])])
    got = model.log_probabilities(tokens, np.array([0, 801, len(tokens)]))
    bits = np.diff(code.offsets)[tokens]
    assert seen[0].tolist() == [bits[:801].sum(), bits[801:].sum()]
    assert (got < 0).all()


def test_passes_over_all_texts_score_each_as_alone(monkeypatch):
    rnd = np.random.default_rng(4)
    code = m.Code([b"w%d" % k for k in range(40)], rnd.integers(1, 900, 42))
    size = m.ORDERS << m.SLOT_BITS
    model = m.Model(code, rnd.integers(-2000, 2000, size).astype(np.int16), rnd.integers(0, 3, size).astype(np.int8), [])
    texts = [np.append(rnd.integers(1, 42, n), m.END) for n in [*range(25), 300, 0, 7]]
    tokens, begins = np.concatenate(texts), np.cumsum([0] + [len(x) for x in texts])
    alone = [model.log_probabilities(x, np.array([0, len(x)]))[0] for x in texts]
    assert np.allclose(model.log_probabilities(tokens, begins), alone, rtol=1e-9)
    lanes, mixed = [], m.Lanes.mix
    monkeypatch.setattr(m.Lanes, "mix", lambda self, own, *given: lanes.append(len(own)) or mixed(self, own, *given))
    monkeypatch.setattr(m, "MIXED_TOKENS", 60)
    assert np.allclose(model.log_probabilities(tokens, begins), alone, rtol=1e-9)
    # All that go on are coded in one pass, however many there are; the longest ends alone.
    assert lanes[0] == 28 and lanes[-1] == 1 and lanes == sorted(lanes, reverse=True)


def test_long_texts_are_scored_as_before_beside_each_other(spark, monkeypatch):
    texts = language(3, 60)
    whole = {r.doc_id: r for r in m.mixing_scores(documents(spark, texts)).collect()}
    monkeypatch.setattr(m, "LONG_BYTES", (100, 200))
    monkeypatch.setattr(m, "LONG_PART", 2000)
    got = {r.doc_id: r for r in m.mixing_scores(documents(spark, texts)).collect()}
    assert got.keys() == whole.keys()
    for k, r in got.items():
        assert math.isclose(r.score, whole[k].score, rel_tol=1e-9) and r.n_tokens == whole[k].n_tokens


def test_packed_counts_come_back():
    counts = np.zeros((2, 70_000), np.uint32)
    counts[:, [0, 3, 4, 66_000]] = [[1, 0, 300, 5], [0, 2**32 - 1, 70_000, 0]]
    at, zero, one = m.unpacked(m.packed(counts))
    assert at.tolist() == [0, 3, 4, 66_000]
    assert zero.tolist() == [1, 0, 300, 5] and one.tolist() == [0, 2**32 - 1, 70_000, 0]
    assert [len(x) for x in m.unpacked(m.packed(np.zeros((2, 9), np.uint32)))] == [0, 0, 0]
