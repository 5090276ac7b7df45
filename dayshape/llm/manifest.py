"""A Merkle manifest of documents, with a witness for each that leads from its leaf to the root.

Leaves of a source are numbered in order and dealt out in aligned blocks of 4,096. A task appends a
block's nodes to an `OpenTree`, one after the other: runs of 16 close into their parent, and each
close extends the partial witnesses of everything below by the siblings that arrived. A block's root
is one node of the next round, appended in the same way; so are, at last, the roots of the sources.
The rounds go up once for the roots alone. On the way down, each block gets the witness of its root
first and extends its nodes' own by it, so only one block's witnesses are in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayshape.llm.common import batch_of, stored

RUN = 16
LEVELS = 3
BLOCK = RUN**LEVELS
EMIT = 512  # rows at once; each carries some kilobytes of witness

STEPS = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
STEPS_SQL = "array<struct<before: string, after: string>>"

Step = tuple[str, str]


def levels_of(n: int) -> int:
    """How many times n nodes are reduced in runs until one remains."""
    found = 0
    while n > 1:
        n = -(-n // RUN)
        found += 1
    return found


class OpenTree:
    """Nodes appended in order; runs close as they fill up and extend the witnesses below them.

    open[k] holds the nodes of level k whose run isn't complete: digest, first leaf, leaf count.
    witnesses[i] are the steps known so far of the i-th appended node, from below to above.
    """

    def __init__(self, keep_witnesses: bool) -> None:
        self.open: list[list[tuple[str, int, int]]] = [[]]
        self.witnesses: list[list[Step]] = []
        self.keep = keep_witnesses
        self.size = 0

    def append(self, digest: str) -> None:
        self.open[0].append((digest, self.size, 1))
        self.size += 1
        if self.keep:
            self.witnesses.append([])
        level = 0
        while len(self.open[level]) == RUN:
            self.close(level)
            level += 1

    def close(self, level: int) -> None:
        """Make the open run of a level one node of the next."""
        run, self.open[level] = self.open[level], []
        joined = "".join(digest for digest, _, _ in run)
        at = 0
        for digest, first, count in run if self.keep else ():
            step = (joined[:at], joined[at + len(digest) :])
            at += len(digest)
            for witness in self.witnesses[first : first + count]:
                witness.append(step)
        if level + 1 == len(self.open):
            self.open.append([])
        parent = sha256(joined.encode()).hexdigest()
        self.open[level + 1].append((parent, run[0][1], sum(count for _, _, count in run)))

    def finish(self, levels: int) -> str:
        """Close what is open below that many levels, and return the node that remains there."""
        for level in range(levels):
            if self.open[level]:
                self.close(level)
        return self.open[levels][0][0]


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """The digest of a document, as 32 bytes."""
    parts = [field(c) for c in (doc_id, source, lang, n_chars, text)]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and its witness lead to, in hexadecimal."""
    return F.aggregate(witness, leaf, lambda acc, step: F.sha2(F.concat(step["before"], acc, step["after"]), 256))


def siblings(witness: Column) -> Column:
    """The digests of a witness as one text: level by level, left to right."""
    return F.concat_ws("", F.transform(witness, lambda step: F.concat(step["before"], step["after"])))


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """nodes with their rank in the tree by that order, from 0, and the tree's size n.

    Rows are dealt by ranges of (tree, order), so a tree with most of the nodes is spread over many
    tasks; only counts per task and tree are added up.
    """
    keys = ["tree", *order]
    dealt = nodes.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = stored(dealt.withColumn("row", F.monotonically_increasing_id()), "manifest-order")
    part = F.shiftright("row", 33)
    parts = dealt.groupBy("tree", part.alias("part")).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "tree",
        "part",
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(tree).alias("n"),
    )
    parts = stored(parts, "manifest-parts")
    found = dealt.withColumn("part", part).join(parts, ["tree", "part"])
    return found.withColumn("rank", F.col("row") + F.col("shift")).drop("part", "row", "shift")


def placed(nodes: DataFrame) -> DataFrame:
    """nodes with their block and their place in it; the rank is told by both."""
    return nodes.withColumns({"block": F.expr(f"rank div {BLOCK}"), "at": (F.col("rank") % BLOCK).cast("int")}).drop("rank")


def by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "at")


def blocks_in(batches: Iterable[pa.RecordBatch], start: int) -> Iterator[pa.Table]:
    """The rows of each block; one starts wherever `at` is start."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.column("at").to_numpy(zero_copy_only=False)
        edges = [0, *np.flatnonzero(at == start).tolist(), batch.num_rows]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            if low < high:
                if at[low] == start and held:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(low, high - low))
    if held:
        yield pa.Table.from_batches(held)


def grown(rows: pa.Table, keep_witnesses: bool) -> tuple[OpenTree, str]:
    tree = OpenTree(keep_witnesses)
    for digest in rows.column("digest").to_pylist():
        tree.append(digest.hex())
    return tree, tree.finish(min(LEVELS, levels_of(rows.column("n")[0].as_py())))


def roots_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in blocks_in(batches, 0):
        tree, block, n = (rows.column(c)[0].as_py() for c in ("tree", "block", "n"))
        digest = bytes.fromhex(grown(rows, False)[1])
        yield batch_of(tree=(pa.string(), [tree]), digest=(pa.binary(), [digest]), n=(pa.int64(), [-(-n // BLOCK)]), rank=(pa.int64(), [block]))


def witness_steps(payload: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: a block's head row (at -1) has the witness of the block's root; its nodes follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks_in(batches, -1):
            above = [(x["before"], x["after"]) for x in rows.column("above")[0].as_py()]
            subroot, root = rows.column("subroot")[0].as_py(), rows.column("root")[0].as_py()
            rows = rows.slice(1)
            tree, _ = grown(rows, True)
            block = rows.column("block")[0].as_py()
            for low in range(0, rows.num_rows, EMIT):
                part = rows.slice(low, EMIT)
                found = [w + above for w in tree.witnesses[low : low + EMIT]]
                offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
                steps = pa.StructArray.from_arrays(
                    [pa.array([s[k] for w in found for s in w], pa.string()) for k in (0, 1)], ["before", "after"]
                )
                n = part.num_rows
                columns = {
                    "tree": part.column("tree").combine_chunks(),
                    "rank": pa.array(block * BLOCK + low + np.arange(n)),
                    "digest": part.column("digest").combine_chunks(),
                    "witness": pa.ListArray.from_arrays(pa.array(offsets), steps),
                    "subroot": pa.array([subroot] * n, pa.string()),
                    "root": pa.array([root] * n, pa.string()),
                } | {c: part.column(c).combine_chunks() for c in payload}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def rounds(nodes: DataFrame) -> list[DataFrame]:
    """The nodes (tree, digest, n, rank) of each round; in the last, every tree has one."""
    found = [nodes]
    while True:
        most = found[-1].agg(F.max("n")).first()[0]
        if most is None or most == 1:
            return found
        above = by_block(placed(found[-1].select("tree", "digest", "n", "rank")))
        kinds = "tree string, digest binary, n bigint, rank bigint"
        found.append(stored(above.mapInArrow(roots_of_blocks, kinds), "manifest-roots"))


def with_witnesses(levels: list[DataFrame], tops: DataFrame, payload: list[str]) -> DataFrame:
    """The nodes of the first round with (witness, subroot, root).

    tops has, for each tree, the witness of its root, and the subroot and root to state.
    """
    heads = tops.select("tree", F.lit(0).cast("bigint").alias("block"), F.col("witness").alias("above"), "subroot", "root")
    # The last round's only node of a tree is its root, as is a block of one node: no step more.
    for k, nodes in reversed(list(enumerate(levels[:-1] or levels))):
        kept = payload if k == 0 else []
        fields = {f.name: f.dataType for f in nodes.schema.fields}
        rows = placed(nodes.select("tree", "digest", "n", "rank", *kept)).unionByName(
            heads.withColumn("at", F.lit(-1)), allowMissingColumns=True
        )
        kinds = "tree string, rank bigint, digest binary, witness " + STEPS_SQL + ", subroot string, root string"
        kinds += "".join(f", `{c}` {fields[c].simpleString()}" for c in kept)
        done = by_block(rows).mapInArrow(witness_steps(kept), kinds)
        if k == 0:
            return done
        done = stored(done, "manifest-witnesses")
        heads = done.select("tree", F.col("rank").alias("block"), F.col("witness").alias("above"), "subroot", "root")
    raise AssertionError("there is always a first round")


def manifest(docs: DataFrame, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, witness) for every row of docs, and the given extra columns.

    A leaf is the digest of doc_id, source, lang, n_chars and text. The leaves of a source ascend by
    doc_id (a null one first, equal ids by leaf), 16 consecutive ones become a node until one
    remains, the subroot; subroots by source (null first, bytewise) lead to the root likewise.
    witness has, from below to above, the siblings before and after the node on the way to the
    root: `folded(leaf, witness)` is the root. Repeated rows are leaves of their own; null and empty
    values differ; texts of any length are hashed whole. An empty table gives no rows. Other columns
    of docs, whatever their names, take no part.
    """
    extra = dict(extra or {})
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    leaf = leaf_of(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")))
    leaves = docs.select(tree.alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"), leaf.alias("digest"), *(c.alias(k) for k, c in extra.items()))
    leaves = numbered(stored(leaves, "manifest-leaves"), ["doc_id", "digest"])
    levels = rounds(leaves)

    subroots = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    tops = rounds(numbered(subroots, ["of"]))
    root = tops[-1].select(F.lower(F.hex("digest")).alias("root"))
    start = root.select(
        F.lit("").alias("tree"),
        F.expr(f"cast(array() as {STEPS_SQL})").alias("witness"),
        F.lit("").alias("subroot"),
        "root",
    )
    of_source = stored(with_witnesses(tops, start, ["of"]), "manifest-sources").select(
        F.col("of").alias("tree"), "witness", F.lower(F.hex("digest")).alias("subroot"), "root"
    )
    found = with_witnesses(levels, of_source, ["doc_id", *extra])
    return found.select("doc_id", F.lower(F.hex("digest")).alias("leaf"), "subroot", "root", "witness", *extra)


def op11(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """The manifest of all documents, and whether a copy tampered with in places still verifies.

    In the copy, rows whose crc32 of the decimal doc_id is divisible by 5 have A-Z of their text in
    lower case; rows without doc_id stay as they are.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if docs is None else docs
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    altered = F.when(hit, leaf_of(*columns, F.translate("text", upper, lower)))
    found = manifest(docs, {"altered": altered})
    return (
        found.withColumn("shown", F.coalesce(F.lower(F.hex("altered")), "leaf"))
        .withColumn("folded_root", folded(F.col("shown"), F.col("witness")))
        .select(
            "doc_id",
            "leaf",
            "subroot",
            "root",
            F.sha2(siblings(F.col("witness")), 256).alias("proof_sha256"),
            "folded_root",
            (F.col("folded_root") == F.col("root")).alias("verified"),
        )
    )


ORACLE = """
WITH RECURSIVE shown AS (
  SELECT doc_id, source,
    coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS body,
    translate(coalesce(strlen(text) || ':' || text, '-'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
    xor(4294967295, list_reduce(
      list_concat([4294967295::bigint], list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
      lambda state, byte: list_reduce([xor(state, byte), 0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
        lambda x, y: xor(x >> 1, (x & 1) * 3988292384)))) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, sha256(head || body) AS leaf,
    sha256(head || CASE WHEN crc % 5 = 0 THEN lowered ELSE body END) AS given FROM shown
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY tree) AS n FROM leaves
), nodes AS (
  SELECT tree, 0 AS level, place AS idx, leaf AS digest, n FROM placed
  UNION ALL
  SELECT tree, level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (max(n) + 15) // 16
  FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 16
), subroots AS (
  SELECT tree, digest AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, place AS idx, subroot AS digest, n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (max(n) + 15) // 16
  FROM tops WHERE n > 1 GROUP BY level, idx // 16
), steps AS (
  SELECT own.tree, own.idx, own.level,
    coalesce(string_agg(other.digest, '' ORDER BY other.idx) FILTER (other.idx < own.idx), '') AS before,
    coalesce(string_agg(other.digest, '' ORDER BY other.idx) FILTER (other.idx > own.idx), '') AS after
  FROM nodes own JOIN nodes other ON own.tree = other.tree AND own.level = other.level AND own.idx // 16 = other.idx // 16
  WHERE own.n > 1 GROUP BY ALL
), heights AS (SELECT tree, max(level) AS height FROM nodes GROUP BY tree
), top_steps AS (
  SELECT own.idx, own.level,
    coalesce(string_agg(other.digest, '' ORDER BY other.idx) FILTER (other.idx < own.idx), '') AS before,
    coalesce(string_agg(other.digest, '' ORDER BY other.idx) FILTER (other.idx > own.idx), '') AS after
  FROM tops own JOIN tops other ON own.level = other.level AND own.idx // 16 = other.idx // 16
  WHERE own.n > 1 GROUP BY ALL
), ways AS (
  SELECT p.doc_id, p.leaf, p.place, s.level, s.before, s.after
  FROM placed p JOIN steps s ON s.tree = p.tree AND s.idx = p.place // (16 ** s.level)::bigint
  UNION ALL
  SELECT p.doc_id, p.leaf, p.place, h.height + t.level, t.before, t.after
  FROM placed p JOIN heights h USING (tree) JOIN subroots r USING (tree)
    JOIN top_steps t ON t.idx = r.place // (16 ** t.level)::bigint
), folds AS (
  SELECT doc_id, leaf, tree, place, given AS digest, 0 AS level FROM placed
  UNION ALL
  SELECT f.doc_id, f.leaf, f.tree, f.place, sha256(w.before || f.digest || w.after), f.level + 1
  FROM folds f JOIN ways w ON w.doc_id IS NOT DISTINCT FROM f.doc_id AND w.leaf = f.leaf AND w.place = f.place AND w.level = f.level
), proofs AS (
  SELECT doc_id, leaf, place, string_agg(before || after, '' ORDER BY level) AS joined FROM ways GROUP BY ALL
)
SELECT p.doc_id, p.leaf, r.subroot, t.digest AS root, sha256(coalesce(w.joined, '')) AS proof_sha256,
  f.digest AS folded_root, f.digest = t.digest AS verified
FROM placed p JOIN subroots r USING (tree) JOIN (SELECT digest FROM tops WHERE n = 1) t ON true
  JOIN (SELECT doc_id, leaf, place, tree, arg_max(digest, level) AS digest FROM folds GROUP BY ALL) f
    ON f.doc_id IS NOT DISTINCT FROM p.doc_id AND f.leaf = p.leaf AND f.place = p.place AND f.tree = p.tree
  LEFT JOIN proofs w ON w.doc_id IS NOT DISTINCT FROM p.doc_id AND w.leaf = p.leaf AND w.place = p.place
"""
