"""Ranked lexical search of many queries at once, sharing their common parts.

*Sharing.*  A document's score for an item is a sum over the item's terms, so the sum over a set of terms that
several items share is computed once.  Terms that stand in exactly the same items form one shared set (a leaf).
Then the pair of nodes that most items have in common is merged into a new node, again and again (``share_plan``):
the nodes form a DAG whose sinks are the items.

*Evaluation.*  Each task reads its documents once.  Per block of documents the leaves' accumulators are filled from the
term counts, every inner node is the sum of two nodes before it, and an item is the sum of the nodes left in
it.  A task keeps the best ``k`` documents per item; these meet in two steps (salted, then per item).

Items come in blocks of bounded size, read from a table one block at a time; terms are told by 64-bit hashes.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corvid.llm import text_np as tn
from corvid.llm.common import ship_package, stored

TOP = 10
BLOCK_TERMS = 1 << 16    # distinct terms of the items of a block, summed over its items
BLOCK_DOCS = 1024        # documents whose accumulators are held at once, fewer where the DAG is large:
BLOCK_SUMS = 1 << 22     # accumulators held at once
MINED_TERMS = 96         # an item is mined for shared pairs in runs of this many leaves
SALTS = 32
_N, _L = -1, -2          # places of the two totals among the document frequencies


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, raw, off in tn.slices(batch.column(1)):
            h, _, _, counts = tn.words(raw, off, tn.ALNUM)
            of = np.repeat(np.arange(lo, hi), counts)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), pa.array(h.view(np.int64))],
                                             ["item_id", "term"])


class SharePlan:
    """The sharing DAG of a block of items.

    ``terms`` (sorted hashes) and the ``leaf`` of each; ``merges`` lists (a, b): node ``leaves + i`` is their sum;
    ``parts[item]`` are the nodes whose sum is the item's score.
    """

    def __init__(self, items: list[list[int]]):
        holders: dict[int, list[int]] = defaultdict(list)
        for i, terms in enumerate(items):
            for t in sorted(set(terms)):
                holders[t].append(i)
        self.items = len(items)
        self.terms = np.array(sorted(holders), dtype=np.int64).view(np.uint64)
        self.terms.sort()
        leaves: dict[tuple[int, ...], int] = {}
        self.leaf = np.array([leaves.setdefault(tuple(holders[int(t)]), len(leaves))
                              for t in self.terms.view(np.int64)], dtype=np.int64)
        self.leaves = len(leaves)
        self._mine([list(s) for s in leaves])

    def _mine(self, item_lists: list[list[int]]) -> None:
        """Merge the pair of nodes that most runs hold, until no pair is held twice."""
        order = sorted(range(len(item_lists)), key=lambda n: (-len(item_lists[n]), n))
        whole: list[list[int]] = [[] for _ in range(self.items)]
        for node in order:
            for i in item_lists[node]:
                whole[i].append(node)
        runs: list[set[int]] = []
        owner: list[int] = []
        for i, nodes in enumerate(whole):
            for at in range(0, len(nodes), MINED_TERMS):
                runs.append(set(nodes[at:at + MINED_TERMS]))
                owner.append(i)
        held: dict[tuple[int, int], set[int]] = defaultdict(set)
        for r, nodes in enumerate(runs):
            shared = sorted(n for n in nodes if len(item_lists[n]) > 1)
            for j, a in enumerate(shared):
                for b in shared[j + 1:]:
                    held[a, b].add(r)
        queue = [(-len(rs), pair) for pair, rs in held.items() if len(rs) > 1]
        heapq.heapify(queue)
        self.merges: list[tuple[int, int]] = []
        while queue:
            count, pair = heapq.heappop(queue)
            rs = held.get(pair, set())
            if len(rs) != -count:
                if len(rs) > 1:
                    heapq.heappush(queue, (-len(rs), pair))
                continue
            a, b = pair
            new = self.leaves + len(self.merges)
            self.merges.append(pair)
            fresh: Counter = Counter()
            for r in list(rs):
                nodes = runs[r]
                nodes -= {a, b}
                for x in nodes:
                    held[min(a, x), max(a, x)].discard(r)
                    held[min(b, x), max(b, x)].discard(r)
                    held[x, new].add(r)
                    fresh[x, new] += 1
                nodes.add(new)
            del held[pair]
            for p, n in fresh.items():
                if n > 1:
                    heapq.heappush(queue, (-n, p))
        self.parts: list[list[int]] = [[] for _ in range(self.items)]
        for r, nodes in enumerate(runs):
            self.parts[owner[r]] += sorted(nodes)

    def node_counts(self) -> tuple[int, int, int]:
        """(terms summed without sharing, nodes added with it, leaves)."""
        size = np.bincount(self.leaf, minlength=self.leaves)
        weight = list(size)
        for a, b in self.merges:
            weight.append(weight[a] + weight[b])
        return (int(sum(weight[n] for p in self.parts for n in p)),
                len(self.terms) + len(self.merges) + sum(map(len, self.parts)), self.leaves)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the hashes that are terms, their term numbers)."""
        if not len(self.terms):
            z = np.zeros(0, dtype=np.int64)
            return z, z
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        hit = np.flatnonzero(self.terms[at] == hashes)
        return hit, at[hit]


def _term_counts(plan: SharePlan, h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, occurrences) of the plan's terms, by document."""
    hit, term = plan.find(h)
    doc = np.repeat(np.arange(len(counts)), counts)[hit]
    key, tf = np.unique(doc * np.int64(max(len(plan.terms), 1)) + term, return_counts=True)
    return key // max(len(plan.terms), 1), key % max(len(plan.terms), 1), tf


def _frequency_batches(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Per task: documents holding each term, documents with any term, terms in all."""
    plan = shared.value
    df = np.zeros(len(plan.terms), dtype=np.int64)
    total = np.zeros(2, dtype=np.int64)
    for batch in batches:
        for _, _, raw, off in tn.slices(batch.column(0)):
            h, _, _, counts = tn.words(raw, off, tn.ALNUM)
            total += (int((counts > 0).sum()), len(h))
            df += np.bincount(_term_counts(plan, h, counts)[1], minlength=len(df))
    held = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate((held, [_N, _L])).astype(np.int32)), pa.array(np.concatenate((df[held], total)))],
        ["place", "c"])


def _length_part(counts: np.ndarray, docs: int, words: int) -> np.ndarray:
    """m = 100 - 90 + (90 * n * N) div L, exact also where the product is beyond a long."""
    if not len(counts) or int(counts.max()) * 90 * docs < 2 ** 63:
        return 10 + (90 * counts * docs) // words
    return np.array([10 + 90 * int(n) * docs // words for n in counts], dtype=np.int64)


class _Best:
    """The best ``k`` (score, id) of every item so far; equal scores by ascending id, no id last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.floor = np.ones(items, dtype=np.int64)  # scores below cannot enter
        self.rows: list[np.ndarray] = [np.zeros((0, 3), dtype=np.int64) for _ in range(items)]

    def offer(self, scores: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        """``scores``: items x documents."""
        item, doc = np.nonzero(scores >= self.floor[:, None])
        cut = np.searchsorted(item, np.arange(len(self.rows) + 1))
        for i in np.flatnonzero(np.diff(cut)):
            d = doc[cut[i]:cut[i + 1]]
            new = np.stack((-scores[i, d], none[d], ids[d]), axis=1)
            rows = np.concatenate((self.rows[i], new))
            rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))[:self.k]]
            self.rows[i] = rows
            if len(rows) == self.k:
                self.floor[i] = -rows[-1, 0]


def _score_batches(batches: Iterator[pa.RecordBatch], shared, weights: np.ndarray, docs: int, words: int, k: int
                   ) -> Iterator[pa.RecordBatch]:
    plan = shared.value
    best = _Best(plan.items, k)
    nodes_held = plan.leaves + len(plan.merges)
    width = max(16, min(BLOCK_DOCS, BLOCK_SUMS // max(nodes_held, 1)))
    acc = np.zeros((nodes_held, width), dtype=np.int64)
    scores = np.zeros((plan.items, width), dtype=np.int64)
    for batch in batches:
        id_col = batch.column(0)
        none = np.asarray(id_col.is_null()).astype(np.int64)
        ids = id_col.fill_null(0).to_numpy()
        for lo, hi, raw, off in tn.slices(batch.column(1)):
            h, _, _, counts = tn.words(raw, off, tn.ALNUM)
            doc, term, tf = _term_counts(plan, h, counts)
            m = _length_part(counts, docs, words)
            value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
            for at in range(0, hi - lo, width):
                size = min(width, hi - lo - at)
                s, e = np.searchsorted(doc, (at, at + size))
                acc[:plan.leaves] = 0
                np.add.at(acc, (plan.leaf[term[s:e]], doc[s:e] - at), value[s:e])
                for i, (a, b) in enumerate(plan.merges):
                    np.add(acc[a], acc[b], out=acc[plan.leaves + i])
                for i, nodes in enumerate(plan.parts):
                    np.sum(acc[nodes], axis=0, out=scores[i])
                best.offer(scores[:, :size], ids[lo + at:lo + at + size], none[lo + at:lo + at + size])
    item = np.repeat(np.arange(plan.items, dtype=np.int32), [len(r) for r in best.rows])
    rows = np.concatenate(best.rows) if best.rows else np.zeros((0, 3), dtype=np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(rows[:, 2], mask=rows[:, 1] > 0), pa.array(-rows[:, 0])],
                                     ["item", "doc_id", "score"])


def _item_blocks(items: DataFrame, block_terms: int) -> Iterator[tuple[list, list[list[int]]]]:
    """(ids, terms) of blocks of items; one block at a time is on the driver."""
    ids, terms, size = [], [], 0
    for row in items.toLocalIterator():
        if ids and size + len(row.terms) > block_terms:
            yield ids, terms
            ids, terms, size = [], [], 0
        ids.append(row.item_id)
        terms.append(list(row.terms))
        size += len(row.terms)
    if ids:
        yield ids, terms


def _ranked(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``k`` best documents of every item: ``item_id, rank, doc_id, score`` (scores above 0 only).

    Terms are words of letters, digits and non-ASCII characters, A-Z lower-cased, of whole texts.  The score sums
    ``w * (10^9 tf div (1000 tf + 8 m))`` over the item's distinct terms, with ``w = floor(1000 ln((2N+2)/(2df+1)))`` and
    ``m = 10 + (90 n N) div L`` (N documents with any term, L their terms, n those of the document), in whole numbers.
    Equal scores rank by ascending id, a null id last.  Null, empty and wordless texts hold no terms: such a
    document is never found and such an item finds nothing.  Rows of ``items`` that repeat an id (null included) are
    one item with the terms of all.  Rows of ``docs`` that repeat an id are documents of their own.  Empty tables give
    an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    id_type = items.schema[item_col].dataType
    terms = (items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
             .mapInArrow(_term_batches, StructType([StructField("item_id", id_type), StructField("term", LongType())])))
    queries = stored(terms.groupBy("item_id").agg(F.collect_set("term").alias("terms")), "search-items")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = None
    for ids, block in _item_blocks(queries, block_terms):
        plan = SharePlan(block)
        shared = spark.sparkContext.broadcast(plan)
        counted = rows.select("text").mapInArrow(lambda it, s=shared: _frequency_batches(it, s), "place int, c long")
        found = {r.place: r.c for r in counted.groupBy("place").agg(F.sum("c").alias("c")).collect()}
        n, total = found.get(_N, 0), found.get(_L, 0)
        df = np.array([found.get(i, 0) for i in range(len(plan.terms))], dtype=np.int64)
        weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)
        best = rows.mapInArrow(
            lambda it, s=shared, w=weights, n=n, t=max(total, 1): _score_batches(it, s, w, n, t, k),
            "item int, doc_id long, score long")
        best = best.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
        best = _ranked(_ranked(best, ["item", "_salt"], k).drop("rank"), ["item"], k)
        names = spark.createDataFrame(list(enumerate(ids)), StructType([StructField("item", LongType()),
                                                                       StructField("item_id", id_type)]))
        # one row per item of the block, bounded like the block
        done = stored(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "search-block")
        shared.destroy()
        out = done if out is None else out.unionByName(done)
    if out is None:
        return spark.createDataFrame([], StructType([StructField("item_id", id_type)])).selectExpr(
            "item_id", "CAST(NULL AS INT) AS rank", "CAST(NULL AS BIGINT) AS doc_id", "CAST(NULL AS BIGINT) AS score")
    return out
