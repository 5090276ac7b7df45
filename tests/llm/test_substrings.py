import hashlib
import random

import numpy as np
from helpers import corpus, documents, spaced, words

from dayshape.llm import substrings
from dayshape.llm.substrings import FmIndex, first_documents, without_repeats


def brute(rows, window):
    first = {}
    for doc, text in rows:
        found = spaced(text)
        for i in range(len(found) - window + 1):
            key = tuple(found[i : i + window])
            first[key] = min(doc, first.get(key, doc))
    out = []
    for doc, text in rows:
        found = spaced(text)
        gone = set()
        for i in range(len(found) - window + 1):
            if first[tuple(found[i : i + window])] < doc:
                gone |= set(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(found) if i not in gone)
        out.append((doc, len(found), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_same_as_brute_force(spark, rows):
    texts = corpus(7, 40, 60)
    rnd = random.Random(5)
    loop = " ".join(["a b c"] * 30)
    texts += [loop, loop + " d", " ".join(words(rnd, 100, "ab", 1)), " ".join(words(rnd, 100, "ab", 1))]
    rnd.shuffle(texts)
    got = rows(without_repeats(documents(spark, texts, anchors="x", copy="y")).drop("kept"))
    assert got == brute(list(enumerate(texts)), 13)


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = " ".join(words(random.Random(1), 30))
    docs = spark.createDataFrame([(4, text), (4, text), (7, text + " x"), (None, text), (9, None)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_removed) for r in without_repeats(docs).collect())
    assert got == [(-1, 0), (4, 0), (4, 0), (7, 30), (9, 0)]
    assert without_repeats(docs.limit(0)).count() == 0


def test_backward_search_counts_occurrences():
    rnd = np.random.default_rng(2)
    text = np.append(rnd.integers(2, 6, 300), 1)
    index = FmIndex(text)
    for _ in range(50):
        wanted = rnd.integers(2, 6, 3)
        low, high = np.array([0]), np.array([len(text) + 1])
        for symbol in wanted[::-1]:
            low, high = index.step(np.array([symbol]), low, high)
        assert high[0] - low[0] == sum((text[i : i + 3] == wanted).all() for i in range(len(text) - 2))


def test_first_document_of_each_window():
    runs = [[b"a", b"b", b"c", b"d"], [b"b", b"c", b"d"], [b"x", b"b", b"c", b"d", b"a"]]
    found = first_documents(runs, np.array([5, 3, 9]), 3)
    assert [x.tolist() for x in found] == [[5, 3], [3], [9, 3, 9]]


def test_windows_of_one_place_are_searched_no_further(monkeypatch):
    runs = [[b"%d" % (k % 7) for k in range(40)] + [b"%s%d" % (x, k) for k in range(50)] for x in (b"a", b"b")]
    runs += [[b"c%d" % k for k in range(20)]]
    asked, step = [], FmIndex.step
    monkeypatch.setattr(FmIndex, "step", lambda self, symbol, *ends: asked.append(len(symbol)) or step(self, symbol, *ends))
    found = first_documents(runs, np.array([5, 3, 9]), 13)
    # Of 164 windows, 28 in each of the first two runs hold repeated words alone.
    assert asked == [56] * 12
    assert [x.tolist() for x in found] == [[3] * 28 + [5] * 50, [3] * 78, [9] * 8]
    assert first_documents(runs[2:], np.array([9]), 13)[0].tolist() == [9] * 8


def test_no_shard_gets_a_heavy_anchor(spark, rows, monkeypatch):
    rnd = random.Random(6)
    phrase = words(rnd, 12)
    texts = [" ".join([*words(rnd, 9), *phrase, *words(rnd, 9)]) for _ in range(60)]
    texts += [" ".join(words(rnd, 4) + text.split()[2:] + words(rnd, 4)) for text in texts[:30]]
    monkeypatch.setattr(substrings, "HEAVY_WORDS", 200)
    given, whole = [], substrings.parted

    def parted(distinct):
        light, heavy = whole(distinct)
        given.extend([light.groupBy("anchor").count().agg({"count": "max"}).first()[0] or 0, heavy.count()])
        return light, heavy

    monkeypatch.setattr(substrings, "parted", parted)
    got = rows(without_repeats(documents(spark, texts)).drop("kept"))
    assert got == brute(list(enumerate(texts)), 13)
    assert given[0] * 13 <= 200 and given[1] > 30
