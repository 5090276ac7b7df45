"""The highest-scoring documents for each query text, by branch and bound over a trie of documents.

Only the queries' terms of a document can score, so each document is restricted to those, ordered by
how many documents hold them: that is its path in a frequent-pattern trie. Documents are dealt out in
shards; a shard's task builds its trie, in which every node knows, for each child, the largest
frequency of each term below it and the smallest length factor m. From these follows the best score
a document below could have. Each query walks the trie depth first, the most promising child
first, and leaves out what can't reach its current last place. Queries pass a shard one after the
other, so neither their number nor that of the shards is held in a task or in the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayshape.llm.common import batch_of, bytes_of, plain_words, stored

# The parts of the score.
WEIGHT_SCALE, TF_SCALE, TF_STEP, M_STEP, M_PART = 1000, 1_000_000_000, 1000, 8, 90

SHARD_ENTRIES = 1 << 19  # terms of documents in a shard: bounds a task's memory (some 250 bytes each)
BUCKET = 128  # documents whose scores are worked out at once
SLICE_BYTES = 4 << 20  # of text, handled at once


def term_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, id, entries) for (row, id, text): the distinct terms with their counts, for texts with a term.

    The first entry, of the empty term, counts all terms with repeats.
    """
    for batch in batches:
        texts = bytes_of(batch.column("text"))
        ends = np.cumsum([len(t or b"") for t in texts]) // SLICE_BYTES
        edges = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(texts)]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            kept, terms, counts, sizes = [], [], [], []
            for i in range(low, high):
                if words := plain_words(texts[i]):
                    found: dict[bytes, int] = {}
                    for word in words:
                        found[word] = found.get(word, 0) + 1
                    kept.append(i)
                    terms.append(b"")
                    terms.extend(found)
                    counts.append(len(words))
                    counts.extend(found.values())
                    sizes.append(1 + len(found))
            if not kept:
                continue
            entries = pa.StructArray.from_arrays(
                [pa.array(terms, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["term", "tf"]
            )
            offsets = pa.array(np.cumsum([0, *sizes]).astype(np.int32))
            columns = [batch.column(c).take(pa.array(kept)) for c in ("row", "id")]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(offsets, entries)], ["row", "id", "entries"])


def entries_of(texts: DataFrame, id_column: str) -> DataFrame:
    """(row, id, term, tf): a row of texts has a number of its own, so repeated ids stay apart."""
    given = texts.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).cast("bigint").alias("id"),
        F.col("text").cast("string").alias("text"),
    )
    found = given.mapInArrow(term_lists, "row bigint, id bigint, entries array<struct<term: string, tf: bigint>>")
    return found.select("row", "id", F.inline("entries"))


class Node:
    """Values of (term, member), by term; members are children or documents."""

    def __init__(self, terms: np.ndarray, members: np.ndarray, values: np.ndarray, size: int) -> None:
        order = np.argsort(terms, kind="stable")
        self.terms, starts = np.unique(terms[order], return_index=True)
        self.ends = np.append(starts, len(terms))
        self.members, self.values, self.size = members[order], values[order], size

    def sums(self, query: np.ndarray) -> np.ndarray:
        """The values of each member, added up over the query's terms."""
        if not len(self.terms):
            return np.zeros(self.size, np.int64)
        at = np.searchsorted(self.terms, query)
        at = at[(at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == query)]
        low, size = self.ends[at], self.ends[at + 1] - self.ends[at]
        picked = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
        # Sums stay below 2**53, where doubles hold every integer.
        return np.bincount(self.members[picked], self.values[picked], self.size).astype(np.int64)


class Trie:
    """Documents of one shard on their paths of terms, the most frequent first."""

    def __init__(self, rows, ids, terms, tfs, dfs, weights, n_docs: int, n_terms: int) -> None:
        """Entries of documents; the one with a negative weight tells a document's term count."""
        whole = weights < 0
        order = np.argsort(rows[whole])
        n = tfs[whole][order]
        self.ids = ids[whole][order]
        self.m = 100 - M_PART + (M_PART * n * n_docs) // n_terms
        rows_in_order = rows[whole][order]
        rows, terms, tfs, dfs, weights = (x[~whole] for x in (rows, terms, tfs, dfs, weights))

        # Local numbers of terms, by how many documents of the whole table hold them.
        self.known, first = np.unique(terms, return_index=True)
        by_df = np.lexsort((self.known, -dfs[first]))
        self.number = np.empty(len(by_df), np.int64)
        self.number[by_df] = np.arange(len(by_df))
        self.weights = weights[first][by_df]
        path = self.number[np.searchsorted(self.known, terms)] if len(terms) else np.zeros(0, np.int64)

        owner = np.searchsorted(rows_in_order, rows)
        order = np.lexsort((path, owner))
        owner, path, tfs = owner[order], path[order], tfs[order]
        bounds = np.searchsorted(owner, np.arange(len(self.ids) + 1))
        keys = path.astype(">u4").tobytes()
        docs = sorted(range(len(self.ids)), key=lambda d: keys[4 * bounds[d] : 4 * bounds[d + 1]])

        # Documents in the order of their paths, so every node of the trie is a stretch of them.
        self.ids, self.m = self.ids[docs], self.m[docs]
        sizes = np.diff(bounds)[docs]
        self.ends = np.concatenate([[0], np.cumsum(sizes)])
        picked = np.repeat(bounds[docs] - self.ends[:-1], sizes) + np.arange(len(path))
        self.path, self.tfs = path[picked], tfs[picked]
        self.owner = np.repeat(np.arange(len(docs)), sizes)
        self.nodes: list[Node] = []
        self.below: list[list[int]] = []  # children of a node; none for a bucket
        self.spans: list[tuple[int, int]] = []
        self.grow()

    def value(self, terms: np.ndarray, tfs: np.ndarray, m) -> np.ndarray:
        return self.weights[terms] * ((TF_SCALE * tfs) // (TF_STEP * tfs + M_STEP * m))

    def grow(self) -> None:
        """Nodes from the root down, each before its children; then their values from below."""
        ahead = [(0, len(self.ids), 0)]
        for low, high, depth in ahead:
            parts = self.children(low, high, depth)
            self.spans.append((low, high))
            self.below.append(list(range(len(ahead), len(ahead) + len(parts))))
            ahead += parts
        known: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
        for at in reversed(range(len(ahead))):
            low, high = self.spans[at]
            if self.below[at]:
                parts = [known.pop(child) for child in self.below[at]]
                terms, tfs = (np.concatenate([part[k] for part in parts]) for k in (0, 1))
                m = np.array([part[2] for part in parts], np.int64)
                member = np.repeat(np.arange(len(parts)), [len(part[0]) for part in parts])
            else:
                span = slice(self.ends[low], self.ends[high])
                terms, tfs, member, m = self.path[span], self.tfs[span], self.owner[span] - low, self.m[low:high]
            self.nodes.append(Node(terms, member, self.value(terms, tfs, m[member]), len(m)))
            known[at] = (*most(terms, tfs), int(m.min()))
        self.nodes.reverse()

    def children(self, low: int, high: int, depth: int) -> list[tuple[int, int, int]]:
        """The parts of documents low to high, which share the first `depth` terms of their paths.

        None if they are few or their paths are all equal; otherwise they differ in the term behind
        those that all share. Small neighbours share a part.
        """
        if high - low <= BUCKET:
            return []
        first, last = (self.path[self.ends[d] : self.ends[d + 1]] for d in (low, high - 1))
        shared = min(len(first), len(last))
        differ = np.flatnonzero(first[depth:shared] != last[depth:shared])
        depth = depth + int(differ[0]) if len(differ) else shared
        if len(first) == len(last) == depth:
            return []
        at = self.ends[low:high] + depth
        following = np.where(at < self.ends[low + 1 : high + 1], self.path[np.minimum(at, len(self.path) - 1)], -1)
        cuts = [0, *(np.flatnonzero(np.diff(following)) + 1).tolist(), high - low]
        parts, start = [], 0
        for left, right in zip(cuts[:-1], cuts[1:], strict=True):
            large = right - left > BUCKET
            if start < left and (large or right - start > BUCKET):
                parts.append((low + start, low + left, depth))
                start = left
            if large:
                parts.append((low + left, low + right, depth))
                start = right
        if start < high - low:
            parts.append((low + start, high, depth))
        return parts

    def search(self, terms: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (score, id) of a query above 0, equal scores by smaller id."""
        at = np.searchsorted(self.known, terms)
        at = at[(at < len(self.known)) & (self.known[np.minimum(at, len(self.known) - 1)] == terms)] if len(self.known) else at[:0]
        query = np.sort(self.number[at])
        best_scores, best_ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = 1
        ahead = [(np.iinfo(np.int64).max, 0)] if len(query) else []
        while ahead:
            bound, at = ahead.pop()
            if bound < least:
                continue
            sums, below = self.nodes[at].sums(query), self.below[at]
            good = np.flatnonzero(sums >= least)
            if below:
                # The most promising child is last, so it is next.
                ahead += [(int(sums[i]), below[i]) for i in good[np.argsort(sums[good], kind="stable")]]
            elif len(good):
                best_scores = np.concatenate([best_scores, sums[good]])
                best_ids = np.concatenate([best_ids, self.ids[self.spans[at][0] + good]])
                kept = np.lexsort((best_ids, -best_scores))[:k]
                best_scores, best_ids = best_scores[kept], best_ids[kept]
                if len(kept) == k:
                    least = max(1, int(best_scores[-1]))  # an equal score may have a smaller id
        return list(zip(best_scores.tolist(), best_ids.tolist(), strict=True))


def most(terms: np.ndarray, tfs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms and the largest frequency of each."""
    if not len(terms):
        return terms, tfs
    order = np.argsort(terms, kind="stable")
    found, starts = np.unique(terms[order], return_index=True)
    return found, np.maximum.reduceat(tfs[order], starts)


COLUMNS = ("row", "id", "t", "tf", "df", "w")


def shard_search(k: int, n_docs: int, n_terms: int):
    """For mapInArrow on rows by turn: a shard's entries have twice its number, its queries one more."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = []
        shard, trie = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            turns = batch.column("turn").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(np.diff(turns)) + 1).tolist(), batch.num_rows]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                if turns[low] // 2 != shard:
                    shard, trie, parts = turns[low] // 2, None, []
                rows = batch.slice(low, high - low)
                if turns[low] % 2 == 0:
                    parts.append([rows.column(c).to_numpy(zero_copy_only=False) for c in COLUMNS])
                    continue
                if parts:
                    trie = Trie(*(np.concatenate(x) for x in zip(*parts, strict=True)), n_docs, n_terms)
                    parts = []
                if trie is None:
                    continue
                found = [
                    (item, doc, score)
                    for item, query in zip(rows.column("id").to_pylist(), rows.column("query").to_pylist(), strict=True)
                    for score, doc in trie.search(np.array(query.split(","), np.int64), k)
                ]
                if found:
                    item, doc, score = zip(*found, strict=True)
                    yield batch_of(item_id=(pa.int64(), item), doc_id=(pa.int64(), doc), score=(pa.int64(), score))

    return run


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents of docs for each item of queries.

    docs has (doc_id, text), queries (item_id, text); other columns take no part. Terms are runs of
    ASCII letters and digits and of all other characters beyond ASCII, A-Z in lower case. Every row
    of docs is a document, repeated ones too; one without a doc_id counts in all statistics but
    can't be listed. Rows of one item_id are one item; a null item_id is none. Null and empty texts
    hold no term; an item without a term that scores has no rows, nor has any if a table is empty.
    Equal scores are ranked by smaller doc_id.
    """
    kinds = "item_id bigint, rank int, doc_id bigint, score bigint"
    items = entries_of(queries.where(F.col("item_id").isNotNull()), "item_id").where("term <> ''")
    items = stored(items.select("id", "term").distinct(), "search-items")
    whole = docs.sparkSession.createDataFrame([("",)], "term string")
    terms = stored(
        items.select("term").distinct().unionAll(whole).withColumn("t", F.monotonically_increasing_id()), "search-terms"
    )
    entries = stored(entries_of(docs, "doc_id").join(terms, "term").select("row", "id", "t", "tf"), "search-entries")
    counts = entries.groupBy("t").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    counts = stored(counts.join(terms, "t"), "search-counts")
    total = counts.where("term = ''").first()
    if total is None:
        return docs.sparkSession.createDataFrame([], kinds)
    n_docs, n_terms = total["df"], total["total"]
    share = F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)
    weight = F.when(F.col("term") == "", -1).otherwise(F.floor(WEIGHT_SCALE * F.log(share)))
    weights = stored(counts.select("t", "term", "df", weight.cast("bigint").alias("w")), "search-weights")

    shards = -(-weights.agg(F.sum("df")).first()[0] // SHARD_ENTRIES)
    parts = entries.join(weights.select("t", "df", "w"), "t").where("id is not null")
    parts = parts.select(F.pmod(F.xxhash64("row"), F.lit(shards)).cast("bigint").alias("shard"), *COLUMNS)
    # As text: Spark measures a batch after every row, which takes long for columns of arrays.
    numbers = F.array_join(F.collect_list(F.col("t").cast("string")), ",")
    asked = items.join(weights.select("term", "t"), "term").groupBy("id").agg(numbers.alias("query"))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))
    asked = asked.select(F.explode(every).alias("shard"), "id", "query")
    # One number to sort by, so that Spark sorts by radix and compares no rows.
    turn = 2 * F.col("shard") + F.col("query").isNotNull().cast("bigint")
    dealt = parts.unionByName(asked, allowMissingColumns=True).withColumn("turn", turn)
    dealt = dealt.repartition("shard").sortWithinPartitions("turn")
    found = dealt.mapInArrow(shard_search(k, n_docs, n_terms), "item_id bigint, doc_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op12(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """The ten highest-scoring documents for each benchmark item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if docs is None else docs
    return ranked_search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _words_of(table: str, id_column: str) -> str:
    pattern = "[0-9A-Za-z\\x{80}-\\x{10FFFF}]+"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return (
        f"SELECT {id_column}, row, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '{pattern}')) AS term "
        f"FROM (SELECT *, row_number() OVER () AS row FROM {table})"
    )


ORACLE = f"""
WITH words AS ({_words_of("documents", "doc_id")}),
entries AS (SELECT row, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
docs AS (SELECT row, sum(tf)::bigint AS n FROM entries GROUP BY row),
total AS (SELECT count(*)::bigint AS big_n, sum(n)::bigint AS big_l FROM docs),
weights AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::double / (2 * count(*) + 1)::double))::bigint AS w
  FROM entries, total GROUP BY term, big_n
),
items AS (SELECT DISTINCT item_id, term FROM ({_words_of("benchmark", "item_id")}) WHERE item_id IS NOT NULL),
scored AS (
  SELECT item_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * big_n) // big_l)))))::bigint AS score
  FROM items JOIN entries USING (term) JOIN weights USING (term) JOIN docs USING (row), total
  GROUP BY item_id, row, doc_id
)
SELECT item_id, rank::int AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE score > 0 AND doc_id IS NOT NULL
) WHERE rank <= 10
"""
