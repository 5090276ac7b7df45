import random
import zlib
from hashlib import sha256

import pytest
from helpers import lower
from pyspark.sql import functions as F

from dayshape.llm.manifest import BLOCK, OpenTree, folded, levels_of, manifest, op11

KINDS = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """The root, and for each node its siblings level by level as (before, after) lists."""
    ways = [[] for _ in nodes]
    own = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        made, members = [], []
        for low in range(0, len(nodes), 16):
            run = nodes[low : low + 16]
            for k in range(len(run)):
                for i in own[low + k]:
                    ways[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            made.append(h(*run))
            members.append([i for group in own[low : low + 16] for i in group])
        nodes, own = made, members
    return nodes[0], ways


def brute(rows):
    sources = sorted({r[1] for r in rows}, key=lambda s: b"" if s is None else b"=" + s.encode())
    by_source = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources}
    made = {s: tree([leaf(r) for r in by_source[s]]) for s in sources}
    root, top_ways = tree([made[s][0] for s in sources])
    out = []
    for s, top in zip(sources, top_ways, strict=True):
        for row, way in zip(by_source[s], made[s][1], strict=True):
            steps = way + top
            shown = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                shown = (*row[:4], None if row[4] is None else lower(row[4]))
            up = leaf(shown)
            for before, after in steps:
                up = h(before, up, after)
            proof = h(*(x for step in steps for x in step))
            out.append((row[0], leaf(row), made[s][0], root, proof, up, up == root))
    return sorted(out, key=repr)


def made(spark, rows, rows_of):
    return rows_of(op11(spark, "", spark.createDataFrame(rows, KINDS)))


def test_same_as_brute_force(spark, rows):
    rnd = random.Random(3)
    every = [
        (i, rnd.choice(["a", "é", "", None, "Z", "b" * 3]), rnd.choice(["en", None]), rnd.choice([None, 5]), rnd.choice([None, "", "É x", f"Text {i}", "W" * 9000]))
        for i in range(700)
    ]
    every += [(7, "a", "en", 1, "other"), (7, "a", "en", 1, "other"), (None, "a", None, None, None), (None, "one", None, None, "X")]
    got = made(spark, every, rows)
    assert got == brute(every)
    assert {r[-1] for r in got} == {True, False}


def test_a_source_of_several_blocks_and_many_sources(spark, rows):
    every = [(i, "hot", None, None, "T" if i % 3 else "t") for i in range(2 * BLOCK + 17)]
    every += [(i, f"s{i}", None, None, "x") for i in range(300)]
    assert made(spark, every, rows) == brute(every)


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 31, 32, 33, 255, 256, 257])
def test_open_tree_extends_witnesses_at_every_close(n):
    nodes = [h(str(i)) for i in range(n)]
    grown = OpenTree(True)
    for node in nodes:
        grown.append(node)
    # Before the end, each open run is shorter than 16 and every witness covers what is closed.
    assert all(len(run) < 16 for run in grown.open)
    for level, run in enumerate(grown.open):
        assert all(len(grown.witnesses[i]) == level for _, first, count in run for i in range(first, first + count))
    root, ways = tree(nodes)
    assert grown.finish(levels_of(n)) == root
    assert grown.witnesses == ways


def test_witness_finds_a_change_and_an_empty_table_gives_none(spark):
    docs = spark.createDataFrame([(i, "s", "en", 1, f"t{i}") for i in range(40)], KINDS)
    docs = docs.withColumns({"tree": F.lit(1), "digest": F.lit("x"), "block": F.lit(2), "leaf": F.lit(3), "row": F.lit(4)})
    found = manifest(docs)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "witness"]
    assert found.where(folded(F.col("leaf"), F.col("witness")) != F.col("root")).count() == 0
    assert found.where(folded(F.sha2("leaf", 256), F.col("witness")) == F.col("root")).count() == 0
    assert op11(spark, "", docs.limit(0)).count() == 0
