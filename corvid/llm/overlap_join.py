"""N-gram Jaccard join by T-occurrence search (DivideSkip) on inverted lists.

A document is the set of its distinct word shingles; documents with equal sets are one class.  Two classes of
sizes ``n`` and ``m`` are linked at ``p`` percent if and only if they share ``ceil(p (n + m) / (100 + p))`` shingles, so
a partner of a class occurs in at least ``T = ceil(p n / 100)`` of its inverted lists.

1. *Possible classes.*  Of the ``n - T + r`` shingles of lowest hash a class shares at least ``r`` with any partner.
   Those are counted first (a slice of texts sends a shingle it holds twice only once), and classes with
   fewer than ``r`` lists of two or more leave.
2. *Lists.*  For the others all lists are counted.  Shingles with a list of their own only are dropped, classes with
   fewer than ``T`` lists left leave, the rest order their shingles by list length.
3. *Blocks.*  Classes are range-partitioned by their lowest shared hash (near copies mostly meet) and cut into blocks
   of bounded size.  A block builds its inverted lists once and searches each of its classes:
   the ``L = T / (mu ln M + 1)`` longest lists (``M`` the longest) are set aside, the short ones are merged with a
   heap that skips whatever cannot occur ``T - L`` times, and the long ones are probed for the candidates by binary
   search.  Found classes leave the lists: a spanning forest of links comes out, never all pairs.
4. *Visits.*  A class visits an earlier block if at least ``T - L`` of its short lists have a posting there of another
   component.  One class of each block's component goes first; the others only where components still
   differ, so a large group of near copies costs no visits per copy.  Visits to a block are dealt out in parts.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm import text_np as tn
from corvid.llm.common import release, ship_package, shuffle_partitions, stored
from corvid.llm.components import connected_components
from corvid.plans.joins import broadcast_if_small

SHINGLE, PERCENT = 5, 80
MU = 0.01                    # weight of a probe against a heap step in the choice of long lists
SPARE = 0.15                 # r as a share of n
BLOCK_SHINGLES = 1 << 18     # shingles of a block, and of the visits of a part
PIECE_SHINGLES = 1 << 18     # shingles turned to rows at once
_SALTS = (0x6A09E667F3BCC908, 0x3C6EF372FE94F82B)


# -- sets ------------------------------------------------------------------------------

def _set_prints(sets: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums over differently mixed shingles tell a set."""
    out = []
    for salt in _SALTS:
        c = np.concatenate((np.zeros(1, dtype=tn.U), np.cumsum(tn.mix(sets ^ tn.U(salt)))))
        out.append(tn.mix(c[ends] - c[ends - sizes] + sizes.astype(tn.U)).view(np.int64))
    return out


def _shingle_sets(column: pa.Array, shingle: int):
    for lo, hi, raw, off in tn.slices(column):
        h, _, _, counts = tn.words(raw, off, tn.NOT_BLANK)
        sets, sizes = tn.word_shingles(h, counts, shingle)
        yield lo, hi, sets, np.cumsum(sizes), sizes


def _print_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, sets, ends, sizes in _shingle_sets(batch.column(2), shingle):
            h1, h2 = _set_prints(sets, ends, sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(sizes), pa.array(h1),
                 pa.array(h2)], ["id", "th", "n", "h1", "h2"])


def _own_sets(batch: pa.RecordBatch, shingle: int):
    """(cids, sets, ends, sizes) of the rows (cid, h1, h2, text) whose text is the class's, each class once a slice."""
    cid, h1, h2 = (batch.column(i).to_numpy() for i in range(3))
    for lo, hi, sets, ends, sizes in _shingle_sets(batch.column(3), shingle):
        p1, p2 = _set_prints(sets, ends, sizes)
        own = np.flatnonzero((p1 == h1[lo:hi]) & (p2 == h2[lo:hi]))
        own = own[np.unique(cid[lo:hi][own], return_index=True)[1]]
        mask = np.zeros(hi - lo, dtype=bool)
        mask[own] = True
        kept = np.flatnonzero(mask)
        yield (cid[lo:hi][kept], sets[np.repeat(mask, sizes)], np.cumsum(sizes[kept]), sizes[kept])


def least_common(n, percent: int):
    """T: how many shingles any partner of a set of ``n`` shares with it."""
    return -(-percent * n // 100)


def _lowest_batches(batches: Iterator[pa.RecordBatch], shingle: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Postings (hash, cid, known) of each class's lowest shingles.

    ``known`` > 0: that many of the class's shingles occur in another class of the slice; such a shingle is sent once
    (cid -1).
    """
    for batch in batches:
        for cid, sets, ends, sizes in _some(_own_sets(batch, shingle)):
            prefix = np.minimum(sizes, sizes - least_common(sizes, percent) + spare(sizes))
            of = np.repeat(np.arange(len(sizes)), prefix)
            at = np.arange(len(of)) - np.repeat(np.cumsum(prefix) - prefix, prefix) + np.repeat(ends - sizes, prefix)
            h = sets[at]
            order = np.argsort(h, kind="stable")
            h, of = h[order], of[order]
            first = np.concatenate(([True], h[1:] != h[:-1]))
            run = np.add.reduceat(np.ones(len(h), dtype=np.int64), np.flatnonzero(first))
            shared = np.repeat(run, run) > 1
            known = np.bincount(of[shared], minlength=len(sizes))
            with_known = np.flatnonzero(known)
            single, once = ~shared, shared & first
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((h[single], h[once], tn.mix(cid[with_known].view(np.uint64)))).view(np.int64)),
                 pa.array(np.concatenate((cid[of[single]], np.full(once.sum(), -1), cid[with_known]))),
                 pa.array(np.concatenate((np.zeros(single.sum() + once.sum(), dtype=np.int32),
                                          known[with_known].astype(np.int32))))], ["hash", "cid", "known"])


def _some(sets):
    return (s for s in sets if len(s[0]) and len(s[1]))


def spare(n):
    """r: lists of two or more that a class needs among its lowest shingles."""
    return np.maximum(1, np.floor(SPARE * np.asarray(n))).astype(np.int64)


def _shared_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From postings sorted by hash: (cid, lists of two or more).  Holds one batch and the run that ends it.

    A class of repeated rows may be counted more than once: it is only kept more easily.
    """
    held_h, held_c = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def lists(h, c):
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        run = np.diff(np.append(first, len(h)))
        low, high = np.minimum.reduceat(c, first), np.maximum.reduceat(c, first)
        many = np.repeat(low != high, run) & (c >= 0)  # another class beside it
        return np.unique(c[many], return_counts=True)

    def out(cid, n):
        return pa.RecordBatch.from_arrays([pa.array(cid), pa.array(n.astype(np.int32))], ["cid", "n"])

    for batch in batches:
        h, c, known = (batch.column(i).to_numpy() for i in range(3))
        told = known > 0
        if told.any():
            yield out(c[told], known[told])
        h, c = np.concatenate((held_h, h[~told])), np.concatenate((held_c, c[~told]))
        if not len(h):
            continue
        last = np.searchsorted(h, h[-1])
        if last:
            yield out(*lists(h[:last], c[:last]))
        held_h, held_c = h[last:], c[last:]
        if len(held_h) > 4096:  # a long list: its first and last class stand for those told already
            cid, n = lists(held_h, held_c)
            yield out(cid, n)
            held_h, held_c = held_h[:1], np.array([-1])
    if len(held_h):
        yield out(*lists(held_h, held_c))


def _posting_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for cid, sets, _, sizes in _some(_own_sets(batch, shingle)):
            yield pa.RecordBatch.from_arrays([pa.array(sets.view(np.int64)), pa.array(np.repeat(cid, sizes))],
                                             ["hash", "cid"])


def _packed_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """From rows (cid, n, df, hash) by (cid, df, hash): classes with enough lists, shingles by list length.

    Rows that repeat a document's id and text repeat its postings; each counts once here.
    """
    for t, starts in tn.whole_groups(batches, ["cid"]):
        n, cid, h, df = (t[c].to_numpy() for c in ("n", "cid", "hash", "df"))
        fresh = np.concatenate(([True], (h[1:] != h[:-1]) | (cid[1:] != cid[:-1])))
        size = np.add.reduceat(fresh, starts, dtype=np.int64)
        live = size >= least_common(n[starts], percent)
        mask = fresh & np.repeat(live, np.diff(np.append(starts, len(cid))))
        h, df = h[mask], df[mask]
        ends = np.cumsum(size[live])
        if not len(ends):
            continue
        yield pa.RecordBatch.from_arrays(
            [pa.array(cid[starts][live]), pa.array(n[starts][live]),
             pa.array(np.minimum.reduceat(h.view(np.uint64), ends - size[live]).view(np.int64)),
             pa.array(df[ends - 1]), tn.binary_column(h.view(np.uint64), ends)],
            ["cid", "n", "anchor", "longest", "members"])


# -- T-occurrence search ---------------------------------------------------------------

def long_lists(t: int, longest: int) -> int:
    """How many of the longest lists to set aside (fewer than ``t``)."""
    return max(0, min(t - 1, int(t / (MU * math.log(max(longest, 2)) + 1))))


def divide_skip(docs: list[int], lists: list[tuple[int, int]], t: int) -> list[tuple[int, int]]:
    """Documents in at least ``t`` of the sorted ``lists`` (ranges of ``docs``), with how many they are in."""
    lists.sort(key=lambda r: r[1] - r[0])
    if len(lists) < t or t < 1:
        return []
    aside = min(long_lists(t, lists[-1][1] - lists[-1][0]), len(lists))
    cut = len(lists) - aside
    short, long = lists[:cut], lists[cut:]
    need = t - aside
    place = [s for s, _ in short]
    heap = [(docs[s], i) for i, (s, _) in enumerate(short)]
    heapq.heapify(heap)
    found = []
    while len(heap) >= need:
        top = heap[0][0]
        popped = []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= need:
            count, left = len(popped), len(long)
            for s, e in long:
                if count + left < t:
                    break
                left -= 1
                k = bisect_left(docs, top, s, e)
                count += k < e and docs[k] == top
            if count >= t:
                found.append((top, count))
            for i in popped:
                place[i] += 1
                if place[i] < short[i][1]:
                    heapq.heappush(heap, (docs[place[i]], i))
            continue
        while heap and len(popped) < need - 1:  # whatever is below the next top cannot occur often enough
            popped.append(heapq.heappop(heap)[1])
        if not heap:
            break
        top = heap[0][0]
        for i in popped:
            place[i] = bisect_left(docs, top, place[i], short[i][1])
            if place[i] < short[i][1]:
                heapq.heappush(heap, (docs[place[i]], i))
    return found


class _Lists:
    """Inverted lists over the sets of a block."""

    def __init__(self, values: np.ndarray, off: np.ndarray, n: np.ndarray, percent: int):
        self.values, self.off, self.percent = values, off, percent
        self.n = n.tolist()
        self.vocab, code = np.unique(values, return_inverse=True)
        self.code = code.astype(np.int64)
        doc = np.repeat(np.arange(len(n)), np.diff(off))
        order = np.argsort(self.code, kind="stable")
        self._doc, self._of = doc[order], self.code[order]
        self._lists()

    def _lists(self) -> None:
        self.docs = self._doc.tolist()
        self.start = np.searchsorted(self._of, np.arange(len(self.vocab) + 1)).tolist()

    def drop(self, alive: np.ndarray) -> None:
        keep = alive[self._doc]
        self._doc, self._of = self._doc[keep], self._of[keep]
        self._lists()

    def own(self, i: int) -> list[int]:
        return self.code[self.off[i]:self.off[i + 1]].tolist()

    def codes(self, values: np.ndarray) -> list[int]:
        at = np.minimum(np.searchsorted(self.vocab, values), max(len(self.vocab) - 1, 0))
        return at[self.vocab[at] == values].tolist() if len(self.vocab) else []

    def search(self, codes: list[int], n: int) -> list[int]:
        """Documents of the lists that are linked to a set of ``n`` shingles, ``codes`` those that have a list."""
        start = self.start
        lists = [(start[c], start[c + 1]) for c in codes if start[c] < start[c + 1]]
        p = self.percent
        return [d for d, count in divide_skip(self.docs, lists, least_common(n, p))
                if (100 + p) * count >= p * (n + self.n[d])]


def _forest(lists: _Lists) -> np.ndarray:
    """The component of every set of the block (its first member), through links inside the block."""
    size = len(lists.n)
    root = np.arange(size)
    alive = np.ones(size, dtype=bool)
    dead, left = 0, size
    for i in range(size):
        if not alive[i]:
            continue
        queue = [i]
        alive[i] = False
        dead, left = dead + 1, left - 1
        while queue:
            j = queue.pop()
            for k in lists.search(lists.own(j), lists.n[j]):
                if alive[k]:
                    alive[k] = False
                    root[k] = i
                    dead, left = dead + 1, left - 1
                    queue.append(k)
            if dead > max(16, left // 8):
                lists.drop(alive)
                dead = 0
    return root


def _position_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows gain the partition they are in and the shingles before them in its order."""
    from pyspark import TaskContext
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = before + tn.binary_values(batch.column(batch.schema.get_field_index("members")), np.uint64)[1]
        before = int(ends[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(batch.num_rows, part, dtype=np.int64)), pa.array(ends[:-1]), pa.array(ends[1:])],
            [*batch.schema.names, "range", "at", "end"])


def _block_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Classes by block: each gains the label of its component within the block."""
    for t, starts in tn.whole_groups(batches, ["block"]):
        cid, n = t["cid"].to_numpy(), t["n"].to_numpy()
        values, off = tn.binary_values(t["members"], np.uint64)
        label = np.empty(len(cid), dtype=np.int64)
        for s, e in zip(starts, np.append(starts[1:], len(cid))):
            lists = _Lists(values[off[s]:off[e]], off[s:e + 1] - off[s], n[s:e], percent)
            label[s:e] = cid[s:e][_forest(lists)]
        yield from t.append_column("label", pa.array(label)).to_batches()


def _visit_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Per (block, part): search the visitors in the block's lists; one link per visitor and component found."""
    for t, starts in tn.whole_groups(batches, ["block", "part"]):
        cid, label, n = (t[c].to_numpy() for c in ("cid", "label", "n"))
        visitor = t["visitor"].to_numpy()
        values, off = tn.binary_values(t["members"], np.uint64)
        a, b = [], []
        for s, e in zip(starts, np.append(starts[1:], len(cid))):
            m = s + int(np.searchsorted(visitor[s:e], 1))
            if m in (s, e):
                continue
            lists = _Lists(values[off[s]:off[m]], off[s:m + 1] - off[s], n[s:m], percent)
            for v in range(m, e):
                hits = lists.search(lists.codes(values[off[v]:off[v + 1]]), int(n[v]))
                for other in {int(label[s + d]): int(cid[s + d]) for d in hits if label[s + d] != label[v]}.values():
                    a.append(int(cid[v]))
                    b.append(other)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _pieces(members: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, shingles, offsets) in pieces of bounded size."""
    values, off = tn.binary_values(members, np.int64)
    lo, rows = 0, len(off) - 1
    while lo < rows:
        hi = min(rows, max(lo + 1, int(np.searchsorted(off, off[lo] + PIECE_SHINGLES, side="right")) - 1))
        yield lo, hi, values[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def _place_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where lists have postings: (hash, block, lowest and highest label), each once a piece."""
    for batch in batches:
        if not batch.num_rows:
            continue
        for lo, hi, values, off in _pieces(batch.column(2)):
            block, label = (np.repeat(batch.column(i).to_numpy()[lo:hi], np.diff(off)) for i in (0, 1))
            order = np.lexsort((block, values))
            h, block, label = values[order], block[order], label[order]
            first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (block[1:] != block[:-1]))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[first]), pa.array(block[first]), pa.array(np.minimum.reduceat(label, first)),
                 pa.array(np.maximum.reduceat(label, first))], ["hash", "block", "low", "high"])


def _short_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """A class's short lists (hash, cid, home, own, need)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        n, longest = batch.column(3).to_numpy(), batch.column(4).to_numpy()
        t = least_common(n, percent)
        aside = np.array([long_lists(int(x), int(y)) for x, y in zip(t, longest)], dtype=np.int64)
        for lo, hi, values, off in _pieces(batch.column(5)):
            size = np.diff(off) - aside[lo:hi]
            of = np.repeat(np.arange(hi - lo), size)
            at = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(off[:-1], size)
            cols = [batch.column(i).to_numpy()[lo:hi][of] for i in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(values[at]), *map(pa.array, cols), pa.array((t - aside)[lo:hi][of])],
                                             ["hash", "cid", "home", "own", "need"])


# -- operator --------------------------------------------------------------------------

def _joined(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Inner join; ``right`` is broadcast if its size allows, else both sides are shuffled."""
    small = broadcast_if_small(right)
    return left.join(small if small is not None else right, on)


def _class_texts(base: DataFrame, classes: DataFrame) -> DataFrame:
    """(cid, h1, h2, text) of each class's chosen row; rows that repeat id and text come along."""
    chosen = classes.select("cid", "h1", "h2", F.col("min_id").alias("_id"), F.col("rep_th").alias("_th"))
    on = F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))
    return _joined(base, chosen, on).select("cid", "h1", "h2", "text")


def _visits(placed: DataFrame, visitors: Column, percent: int, block_shingles: int) -> DataFrame:
    """Links between the classes that ``visitors`` picks and classes of other labels in earlier blocks."""
    n = shuffle_partitions(placed.sparkSession)
    places = stored(placed.select("block", "label", "members")
                    .mapInArrow(_place_batches, "hash long, block long, low long, high long")
                    .groupBy("hash", "block").agg(F.min("low").alias("low"), F.max("high").alias("high")), "join-places")
    short = (placed.filter(visitors).select("cid", "block", "label", "n", "longest", "members")
             .mapInArrow(lambda it: _short_batches(it, percent), "hash long, cid long, home long, own long, need long"))
    other = (F.col("low") != F.col("own")) | (F.col("high") != F.col("own"))
    met = short.join(places, "hash").filter((F.col("block") < F.col("home")) & other)
    visits = stored(met.groupBy("cid", "block").agg(F.count(F.lit(1)).alias("c"), F.first("need").alias("need"))
                    .filter("c >= need").select("cid", F.col("block").alias("to")), "join-visits")
    release(places)
    rows = placed.select("cid", "label", "n", "members")
    guests = visits.join(rows.withColumn("size", F.octet_length("members") / 8), "cid")
    parts = (guests.groupBy("to").agg(F.sum("size").alias("s"))
             .select("to", F.ceil(F.col("s") / block_shingles).cast("long").alias("parts")))
    parts = stored(parts, "join-parts")
    of_part = F.pmod(F.xxhash64("cid"), F.col("parts"))
    guests = guests.join(parts, "to").select(F.col("to").alias("block"), of_part.alias("part"), "cid", "label", "n",
                                             "members", F.lit(1).alias("visitor"))
    hosts = (_joined(placed.select("block", "cid", "label", "n", "members"), parts.withColumnRenamed("to", "block"), "block")
             .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
             .select("block", "part", "cid", "label", "n", "members", F.lit(0).alias("visitor")))
    met = hosts.unionByName(guests).repartition(n, "block", "part").sortWithinPartitions("block", "part", "visitor", "cid")
    links = stored(met.mapInArrow(lambda it: _visit_batches(it, percent), "a long, b long"), "join-links")
    release(visits)
    release(parts)
    return links


def linked_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                     shingle: int = SHINGLE, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Components of documents linked by ``100 * |A & B| >= percent * |A | B|`` over word shingles.

    One row per input row: ``doc_id, n_shingles, component_id``; ``component_id`` is the smallest id that links reach.
    Texts without words (null, empty, blank) have an empty set and are linked with nothing: their component is
    their own id.  Repeated rows have equal sets and share a component.  Null ids take part in links but never name
    a component that has another id.  An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    parallel = shuffle_partitions(spark)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("th"),
                       F.col(text_col).alias("text"))
    rows = stored(base.mapInArrow(lambda it: _print_batches(it, shingle), "id long, th long, n long, h1 long, h2 long"),
                  "join-rows")
    # of equal sets one row is read again: the smallest id (null only without another), then text hash
    chosen = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th"))
    classes = stored(rows.filter("n > 0").groupBy("h1", "h2").agg(chosen.alias("c"), F.max("n").alias("n"))
                     .select(F.monotonically_increasing_id().alias("cid"), "h1", "h2", "n",
                             F.col("c.id").alias("min_id"), F.col("c.th").alias("rep_th")), "join-classes")

    lowest = _class_texts(base, classes).mapInArrow(lambda it: _lowest_batches(it, shingle, percent),
                                                    "hash long, cid long, known int")
    counted = (lowest.repartition(parallel, "hash").sortWithinPartitions("hash")
               .mapInArrow(_shared_batches, "cid long, n int").groupBy("cid").agg(F.sum("n").alias("lists")))
    needed = F.greatest(F.lit(1), F.floor(F.lit(SPARE) * F.col("n")))
    possible = stored(classes.join(counted, "cid").filter(F.col("lists") >= needed).drop("lists"), "join-possible")

    postings = stored(_class_texts(base, possible).mapInArrow(lambda it: _posting_batches(it, shingle),
                                                              "hash long, cid long"), "join-postings")
    lengths = stored(postings.groupBy("hash").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "join-lengths")
    # the postings are read afresh, so a frequent shingle's rows can be split by an adaptive skew join
    weighted = postings.join(lengths, "hash")
    weighted = _joined(weighted, possible.select("cid", "n"), "cid").select("cid", "n", "df", "hash")
    live = stored(weighted.repartition(parallel, "cid").sortWithinPartitions("cid", "df", "hash")
                  .mapInArrow(lambda it: _packed_batches(it, percent),
                              "cid long, n long, anchor long, longest long, members binary"), "join-live")
    for spent in (postings, lengths, possible):
        release(spent)
    ranged = stored(live.repartitionByRange(parallel, "anchor", "cid").sortWithinPartitions("anchor", "cid")
                    .mapInArrow(_position_batches, "cid long, n long, anchor long, longest long, members binary, "
                                "range long, at long, end long"), "join-ranged")
    release(live)
    # one row a partition; blocks follow the shingles before them, whatever the number of partitions
    ranges = ranged.groupBy("range").agg(F.max("end").alias("size"))
    earlier = F.coalesce(F.sum("size").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select("range", earlier.alias("before"))
    block = F.floor((F.col("before") + F.col("at")) / F.lit(block_shingles)).cast("long")
    placed = stored(ranged.join(F.broadcast(ranges), "range")
                    .select("cid", "n", "longest", "members", block.alias("block"), "anchor")
                    .repartition(parallel, "block").sortWithinPartitions("block", "anchor", "cid").drop("anchor")
                    .mapInArrow(lambda it: _block_batches(it, percent),
                                "cid long, n long, longest long, members binary, block long, label long"), "join-placed")
    release(ranged)

    first = _visits(placed, F.col("cid") == F.col("label"), percent, block_shingles)
    # links name members; within a block members hang on their component's first member
    inside = placed.filter("cid <> label").select(F.col("cid").alias("a"), F.col("label").alias("b"))
    known = connected_components(inside.unionByName(first))
    relabelled = stored(placed.withColumnRenamed("label", "_was").join(
        known.select(F.col("node").alias("cid"), "label"), "cid", "left")
        .select("cid", "n", "longest", "members", "block", F.coalesce("label", "_was").alias("label")), "join-relabelled")
    second = _visits(relabelled, F.lit(True), percent, block_shingles)
    spine = known.filter("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))
    found = connected_components(spine.unionByName(second))

    named = found.join(classes.select("cid", "min_id"), F.col("node") == F.col("cid"))
    names = named.groupBy("label").agg(F.min("min_id").alias("component_id"))
    of_class = classes.select("cid", "h1", "h2", "min_id").join(
        named.select("cid", "label").join(names, "label").select("cid", "component_id"), "cid", "left").select(
        "h1", "h2", F.coalesce("component_id", "min_id").alias("component_id"))
    out = rows.select("id", "n", "h1", "h2").join(of_class, ["h1", "h2"], "left")
    for spent in (first, second, placed, relabelled):
        release(spent)
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
