import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import documents, plain, words

from dayshape.llm import lexical_search
from dayshape.llm.lexical_search import Trie, ranked_search


def brute(docs, items, k=10):
    """docs and items are (id, text)."""
    bags = [(i, Counter(plain(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(plain(text))
    out = []
    for item, terms in asked.items():
        if item is None:
            continue
        scores = []
        for i, bag in bags:
            m = 100 - 90 + (90 * sum(bag.values()) * n_docs) // n_terms
            score = 0
            for t in terms & set(bag):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0 and i is not None:
                scores.append((-score, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def searched(spark, rows, docs, items, k=10):
    d = spark.createDataFrame([(*x, "a", "b") for x in docs], "doc_id long, text string, term string, row string")
    q = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, t int")
    return rows(ranked_search(d, q, k))


def test_same_as_brute_force(spark, rows):
    rnd = random.Random(5)
    docs = [(i, " ".join(words(rnd, rnd.randrange(1, 60), "abc"))) for i in range(500)]
    # Copies, near copies, ties, repeated ids and rows, null ids and texts, long texts.
    docs += [(1000 + i, docs[3][1]) for i in range(300)]
    docs += [(2000 + i, docs[4][1] + f" x{i}") for i in range(300)]
    docs += [(5, docs[6][1]), (5, docs[6][1]), (None, docs[7][1]), (7000, None), (7001, ""), (7002, "É İK é aaa"), (7003, "aaa " * 20000)]
    items = [(i, " ".join(words(rnd, rnd.randrange(1, 30), "abc"))) for i in range(40)]
    items += [(0, "AAA bbb"), (None, "aaa"), (90, None), (91, "nothing-like it"), (92, "É!é"), (93, docs[3][1]), (94, docs[4][1])]
    assert searched(spark, rows, docs, items) == brute(docs, items)
    assert searched(spark, rows, docs, items[:5], 3) == brute(docs, items[:5], 3)


def test_several_shards_give_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(lexical_search, "SHARD_ENTRIES", 500)
    rnd = random.Random(6)
    docs = [(i, " ".join(words(rnd, 30, "abcd", 2))) for i in range(300)]
    items = [(i, " ".join(words(rnd, 8, "abcd", 2))) for i in range(12)]
    assert searched(spark, rows, docs, items) == brute(docs, items)


def test_empty_tables(spark, rows):
    assert searched(spark, rows, [], [(1, "a")]) == []
    assert searched(spark, rows, [(1, "a")], []) == []
    assert searched(spark, rows, [(1, None)], [(1, "a")]) == []
    assert ranked_search(documents(spark, ["a"]), spark.createDataFrame([(1, "b")], "item_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_trie_finds_the_best_and_passes_over_most(seed):
    rnd = np.random.default_rng(seed)
    n = 4000
    entries, df = [], Counter()
    for d in range(n):
        found = set((rnd.zipf(1.3, 12) % 3000).tolist()) if d % 3 else {1, 2, 5 + d % 7}
        entries.append((d, -1, int(rnd.integers(10, 500))))
        entries += [(d, t, int(rnd.integers(1, 6))) for t in found]
        df.update(found)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * c + 1))) for t, c in df.items()} | {-1: -1}
    df[-1] = n
    row, t, tf = (np.array(x) for x in zip(*entries, strict=True))
    n_terms = int(tf[t == -1].sum())
    trie = Trie(row, row + 7, t, tf, np.array([df[x] for x in t]), np.array([weight[x] for x in t]), n, n_terms)
    assert sorted(i for span, below in zip(trie.spans, trie.below, strict=True) if not below for i in range(*span)) == list(range(n))

    visits = Counter()
    original = lexical_search.Node.sums
    for query in ([1, 2], [900, 1500, 3], [2999], [5000], [1, 2, 3, 4, 5, 6, 7]):
        bags = {}
        for r, term, count in entries:
            bags.setdefault(r, {})[term] = count
        scores = []
        for d, bag in bags.items():
            m = 10 + (90 * bag[-1] * n) // n_terms
            score = sum(weight[q] * ((10**9 * bag[q]) // (1000 * bag[q] + 8 * m)) for q in query if q in bag)
            scores += [(-score, d + 7)] if score > 0 else []
        lexical_search.Node.sums = lambda self, q: visits.update([len(query)]) or original(self, q)
        try:
            got = trie.search(np.array(query), 10)
        finally:
            lexical_search.Node.sums = original
        assert got == [(-s, i) for s, i in sorted(scores)[:10]]
    assert visits[1] + visits[3] < len(trie.nodes)
