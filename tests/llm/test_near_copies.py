import random

import numpy as np
import pytest
from helpers import corpus, documents, lower, spaced, words

from dayshape.llm.near_copies import band_keys, near_copies, one_of_each, prefix_pairs, shingle_sets


def brute(texts, size, percent):
    sets = []
    for text in texts:
        found = spaced(lower(text))
        sets.append({tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))} if found else set())
    root = list(range(len(texts)))

    def top(i):
        return i if root[i] == i else top(root[i])

    for i, one in enumerate(sets):
        for j, two in enumerate(sets[:i]):
            same = len(one & two)
            if one and two and 100 * same >= percent * (len(one) + len(two) - same):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [(i, len(s), top(i), top(i) == i) for i, s in enumerate(sets)]


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_same_as_brute_force(spark, rows, size, percent):
    texts = corpus(1, 60, 120)
    got = rows(near_copies(documents(spark, texts, component_id="x", keys="y"), size, percent))
    assert got == sorted(brute(texts, size, percent), key=repr)


def test_chain_of_near_copies_is_one_component(spark, rows):
    rnd = random.Random(4)
    text = words(rnd, 200)
    texts = []
    for i in range(30):  # each differs from the one before by one word; the ends are far apart
        text = [*text]
        text[6 * i] = "changed"
        texts.append(" ".join(text))
    rnd.shuffle(texts)
    assert rows(near_copies(documents(spark, texts), 3, 85)) == sorted(brute(texts, 3, 85), key=repr)


def test_hot_group_nulls_and_repeated_rows(spark):
    copies = documents(spark, ["one two three four five six"] * 300, first=5)
    odd = spark.createDataFrame([(None, "one two three four five six"), (None, None)], "doc_id long, text string")
    docs = copies.unionByName(copies.limit(1)).unionByName(odd, allowMissingColumns=True)
    got = near_copies(docs).collect()
    assert len(got) == 303
    assert sum(r.kept for r in got) == 2 + 2  # both rows of id 5, both without an id
    assert {r.component_id for r in got} == {5, None}
    assert one_of_each(docs).columns == docs.columns
    assert one_of_each(docs).count() == 4


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    rnd = random.Random(9)
    one, two = " ".join(words(rnd, 50)), " ".join(words(rnd, 50))
    docs = spark.createDataFrame([(1, one), (5, one), (5, two), (7, two)], "doc_id long, text string")
    got = {(r.doc_id, r.component_id, r.kept) for r in near_copies(docs, 3, 85).collect()}
    assert got == {(1, 1, True), (5, 1, False), (5, 5, True), (7, 5, False)}
    assert sorted(map(tuple, one_of_each(docs).collect())) == [(1, one), (5, two)]


@pytest.mark.parametrize("changed", [3, 5, 6, 9])
def test_copies_around_the_threshold_in_one_bucket(spark, rows, changed):
    rnd = random.Random(changed)
    text = words(rnd, 150)
    texts = []
    for i in range(60):  # edits at places and of a number of their own
        own = [*text]
        for at in rnd.sample(range(150), changed - i % 3):
            own[at] = f"own{rnd.randrange(40)}"
        texts.append(" ".join(own[: 150 - i % 4]))
    assert rows(near_copies(documents(spark, texts), 3, 85)) == sorted(brute(texts, 3, 85), key=repr)


def test_prefixes_meet_for_every_linked_pair(spark):
    rnd = random.Random(2)
    base = rnd.sample(range(10**6), 60)
    sets = [sorted({*rnd.sample(base, rnd.randrange(40, 61)), *rnd.sample(range(10**6), rnd.randrange(0, 6))}) for _ in range(80)]
    frame = spark.createDataFrame([(bytes([i]), x) for i, x in enumerate(sets)], "digest binary, shingles array<long>")
    open_ = spark.createDataFrame(
        [(bytes([i]), len(x), bytes([i - i % 2])) for i, x in enumerate(sets)], "rep binary, size long, root binary"
    )
    got = {(r.a[0], r.b[0]) for r in prefix_pairs(open_, frame, 85).collect()}
    linked = {
        (i, j)
        for j, y in enumerate(sets)
        for i, x in enumerate(sets[:j])
        if i - i % 2 != j - j % 2 and 100 * len({*x} & {*y}) >= 85 * len({*x} | {*y})
    }
    assert linked and linked <= got


def test_empty_table(spark):
    assert near_copies(documents(spark, ["x"]).limit(0)).count() == 0


def test_signature_estimates_similarity():
    rnd = np.random.default_rng(3)
    both = rnd.integers(0, 2**63, 3000, np.uint64)
    one, two = np.unique(both[:2000]), np.unique(both[1000:])
    keys = band_keys([one, two, one], 30)
    assert (keys[0] == keys[2]).all()
    assert (keys[0] == keys[1]).mean() < 0.1  # similarity of a third: bands of six hardly ever agree


def test_short_texts_are_one_shingle():
    a, b, c, d = shingle_sets([b"a b", b"A  B", b"ab", None], 3)
    assert a.tolist() == b.tolist() != c.tolist()
    assert len(a) == len(c) == 1
    assert len(d) == 0
