import math
import random

import numpy as np

from dayshape.llm.top_products import Best, scaled, search_blocks, top_products


def brute(rows, queries, k):
    out = []
    for q, v in rows:
        if q in queries:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out, key=repr)


def test_same_as_brute_force(spark, rows):
    rnd = random.Random(3)
    data = [(i, [rnd.gauss(0, 1) * rnd.choice([0.1, 1, 5]) for _ in range(6)]) for i in range(230)]
    data += [(230 + i, data[0][1]) for i in range(40)]  # a hot group of copies, ties by id
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in data]
    odd = [(900, None), (950, [1.0, None]), (951, [float("nan")] * 6), (952, [float("inf")] * 6), (None, [1.0] * 6)]
    table = spark.createDataFrame([*data, *odd], "vec_id long, embedding array<double>").selectExpr("*", "1 as score", "2 as v")
    vectors = scaled(table)
    got = rows(top_products(vectors, vectors.where("vec_id % 50 = 0")))
    assert got == brute(usable, {i for i, _ in usable if i % 50 == 0}, 5)


def test_few_candidates_repeated_rows_and_empty_table(spark, rows):
    two = spark.createDataFrame([(0, [1, 2]), (7, [3, 4]), (7, [3, 4])], "vec_id long, v array<long>")
    assert rows(top_products(two, two.where("vec_id = 0"))) == [(0, 1, 7, 11)]
    assert top_products(two, two.limit(0)).count() == 0
    assert top_products(two.limit(0), two.limit(0)).count() == 0


def test_pruning_changes_nothing():
    rnd = np.random.default_rng(1)
    for n in (3, 40, 3000):
        for sign in (1, -1, 0):
            x = np.floor(rnd.normal(size=(n, 5)) * 50 * rnd.exponential(size=(n, 1)) ** 2)
            x = sign * np.abs(x) if sign else x
            ids = rnd.permutation(n)
            own = np.flatnonzero(ids % 50 == 0)
            best = Best(len(own), 5)
            search_blocks(x[own], ids[own], x, ids, best)
            for k, j in enumerate(own):
                order = np.lexsort((ids, -(x @ x[j])))
                order = order[order != j][:5]
                assert best.ids[k, : len(order)].tolist() == ids[order].tolist()


def test_an_id_with_six_vectors_fills_one_place(spark):
    rows = [(1, [10, k]) for k in range(6)] + [(k, [9 - k, 0]) for k in range(2, 8)]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<long>").coalesce(1)
    queries = spark.createDataFrame([(50, [10, 1])], "vec_id long, v array<long>")
    got = sorted((r["rank"], r.vec_id, r.score) for r in top_products(vectors, queries).collect())
    assert got == [(1, 1, 105), (2, 2, 70), (3, 3, 60), (4, 4, 50), (5, 5, 40)]
    best = Best(1, 2)
    best.add(0, np.arange(20.0), np.array([7] * 19 + [8]))
    best.add(0, np.array([30.0, 29.0]), np.array([7, 7]))
    assert (best.ids.tolist(), best.scores.tolist()) == ([[7, 8]], [[30, 19]])
