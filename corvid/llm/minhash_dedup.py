"""MinHash near-dedup by a multi-index Hamming join.

1. *Signatures.*  Per document the set of its distinct 5-word shingles and ``K``
   minhashes, each cut to ``b`` bits (a symbol).  Documents with equal sets form
   one class; from here on work is per class, so copies cost nothing.
2. *Multi-index.*  The K symbols are split into ``m`` chunks of ``r``.  If two
   signatures differ in at most ``m * (e + 1) - 1`` symbols, some chunk differs in
   at most ``e`` (pigeonhole).  For every chunk each choice of ``e`` erased symbols
   is enumerated; the others make an index key.  All pairs within that signature
   distance share a key.  With K=32, m=8, r=4, e=1: 32 keys, distance 15 of 32;
   at a similarity of 0.75 a pair misses every key with probability 2e-5.
3. *Coarse components.*  Within a key's bucket signatures are compared (distance at
   most ``max_distance``, far beyond what 0.75 can give) and only a spanning forest
   of the close ones is emitted, never all pairs.  Buckets above ``block`` entries
   are dealt out as pairs of blocks, so no task holds more than two blocks.
4. *Verification.*  The full shingle sets of each coarse component meet once, again
   in pairs of bounded blocks; exact intersections decide, and a spanning forest of
   the confirmed links goes to the final components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm import text_np as tn
from corvid.llm.common import ship_package, shuffle_partitions, stored
from corvid.llm.components import connected_components
from corvid.plans.joins import broadcast_if_small

SHINGLE = 5
SYMBOLS, CHUNKS, ERRORS, BITS = 32, 8, 1, 16
MAX_DISTANCE = 20  # of 32; a pair at 0.75 exceeds it with probability 2e-6
BLOCK = 1024
SET_BLOCK, SET_BLOCK_SHINGLES = 512, 1 << 20

_rng = np.random.default_rng(20240607)
_XOR = _rng.integers(0, 2 ** 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = _rng.integers(0, 2 ** 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _fingerprints(sets: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over differently mixed members identify a set."""
    out = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        c = np.concatenate((np.zeros(1, dtype=tn.U), np.cumsum(tn.mix(sets ^ tn.U(salt)))))
        out.append(tn.mix(c[ends] - c[ends - sizes] + sizes.astype(tn.U)).view(np.int64))
    return out[0], out[1]


def _minhash(sets: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    sig = np.zeros((len(sizes), SYMBOLS), dtype=np.uint16)
    full = np.flatnonzero(sizes)
    if len(full):
        begins = (ends - sizes)[full]
        for k in range(SYMBOLS):
            low = np.minimum.reduceat((sets ^ _XOR[k]) * _MUL[k], begins)
            sig[full, k] = (tn.mix(low) & tn.U((1 << BITS) - 1)).astype(np.uint16)
    return sig


def _signature_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for lo, hi, raw, off in tn.slices(batch.column(1)):
            h, _, _, counts = tn.words(raw, off, tn.NOT_BLANK)
            sets, sizes = tn.word_shingles(h, counts, shingle)
            ends = np.cumsum(sizes)
            h1, h2 = _fingerprints(sets, ends, sizes)
            sig = _minhash(sets, ends, sizes)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), pa.array(sizes), pa.array(h1), pa.array(h2),
                 tn.binary_column(sig.reshape(-1), np.arange(1, len(sizes) + 1) * SYMBOLS)],
                ["id", "n", "h1", "h2", "sig"])


def _set_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, raw, off in tn.slices(batch.column(0)):
            h, _, _, counts = tn.words(raw, off, tn.NOT_BLANK)
            sets, sizes = tn.word_shingles(h, counts, shingle)
            ends = np.cumsum(sizes)
            h1, h2 = _fingerprints(sets, ends, sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1), pa.array(h2), tn.binary_column(sets, ends)], ["h1", "h2", "members"])


def index_keys(sig: np.ndarray) -> np.ndarray:
    """All index keys of signatures (rows of SYMBOLS): one column per (chunk, erased symbols)."""
    r = SYMBOLS // CHUNKS
    cols = []
    for c in range(CHUNKS):
        part = sig[:, c * r:(c + 1) * r].astype(np.uint64)
        for erased in combinations(range(r), ERRORS):
            key = np.full(len(sig), len(cols), dtype=np.uint64)
            for j in range(r):
                if j not in erased:
                    key = (key << tn.U(BITS)) | part[:, j]
            cols.append(key)
    return np.stack(cols, axis=1).view(np.int64)


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        cid = batch.column(0).to_numpy()
        keys = index_keys(tn.binary_values(batch.column(1), np.uint16)[0].reshape(-1, SYMBOLS))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(cid, keys.shape[1])), pa.array(keys.reshape(-1))],
                                         ["cid", "key"])


def _forest(n: int, near) -> list[tuple[int, int]]:
    """Spanning forest of the graph on 0..n-1 whose edges ``near(i, rest)`` tells (a mask over ``rest``)."""
    left = np.arange(n)
    links: list[tuple[int, int]] = []
    while len(left) > 1:
        queue = [left[0]]
        left = left[1:]
        while queue and len(left):
            i = queue.pop()
            hit = near(i, left)
            found = left[hit]
            links += [(i, j) for j in found]
            queue += list(found)
            left = left[~hit]
    return links


def _close_batches(batches: Iterator[pa.RecordBatch], max_distance: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that connect, within each bucket, all classes whose signatures are close."""
    small = 6
    for t, starts in tn.whole_groups(batches, ["key", "lo", "hi"]):
        cid = t["cid"].to_numpy()
        sig = tn.binary_values(t["sig"], np.uint16)[0].reshape(-1, SYMBOLS)
        bounds = np.append(starts, len(cid))
        size = np.diff(bounds)
        a, b = [], []
        tiny = np.repeat(size <= small, size)
        group = np.repeat(np.arange(len(size)), size)
        for k in range(1, small):
            i = np.flatnonzero((group[:-k] == group[k:]) & tiny[k:]) if len(cid) > k else np.zeros(0, dtype=int)
            i = i[(sig[i] != sig[i + k]).sum(axis=1) <= max_distance]
            a.append(cid[i])
            b.append(cid[i + k])
        for g in np.flatnonzero(size > small):
            s, c = sig[bounds[g]:bounds[g + 1]], cid[bounds[g]:bounds[g + 1]]
            links = _forest(len(c), lambda i, rest, s=s: (s[rest] != s[i]).sum(axis=1) <= max_distance)
            if links:
                x, y = np.array(links).T
                a.append(c[x])
                b.append(c[y])
        a, b = np.concatenate(a), np.concatenate(b)
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _confirmed_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links that connect, within each group of full sets, all pairs of at least ``percent`` similarity."""
    for t, starts in tn.whole_groups(batches, ["label", "lo", "hi"]):
        cid = t["cid"].to_numpy()
        values, off = tn.binary_values(t["members"], np.uint64)
        a, b = [], []
        for s, e in zip(starts, np.append(starts[1:], len(cid))):
            if e - s < 2:
                continue
            begin = off[s:e] - off[s]
            length = np.diff(off[s:e + 1])
            uniq, code = np.unique(values[off[s]:off[e]], return_inverse=True)
            flag = np.zeros(len(uniq), dtype=np.int32)

            def near(i, rest):
                own = code[begin[i]:begin[i] + length[i]]
                flag[own] = 1
                if len(rest) * 4 < e - s:
                    inter = np.array([flag[code[begin[j]:begin[j] + length[j]]].sum() for j in rest])
                else:
                    inter = np.add.reduceat(flag[code], begin)[rest]
                flag[own] = 0
                return 100 * inter >= percent * (length[i] + length[rest] - inter)

            links = _forest(e - s, near)
            if links:
                x, y = np.array(links).T
                a.append(cid[s:e][x])
                b.append(cid[s:e][y])
        if a:
            a, b = np.concatenate(a), np.concatenate(b)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _in_blocks(rows: DataFrame, blocks, group: list[str]) -> DataFrame:
    """Deal each group out as pairs of blocks: rows gain ``lo, hi``; any two rows of a group meet in some pair."""
    mine = F.pmod(F.xxhash64("cid"), F.col("_blocks")).cast("int")
    return (rows.withColumn("_blocks", blocks.cast("int")).withColumn("_mine", mine)
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
            .withColumn("lo", F.least("_mine", "_other")).withColumn("hi", F.greatest("_mine", "_other"))
            .drop("_blocks", "_mine", "_other"))


def _dealt(rows: DataFrame, keys: list[str]) -> DataFrame:
    n = shuffle_partitions(rows.sparkSession)
    return rows.repartition(n, *keys).sortWithinPartitions(*keys)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75,
                    shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Components of documents linked by ``100 * |A & B| >= percent * |A | B|`` over word shingles.

    Returns one row per input row: ``doc_id, n_shingles, component_id, kept``.
    ``component_id`` is the smallest id reachable, ``kept`` marks the row(s) carrying it.
    Texts without words (null, empty, blank) have an empty set and are linked with
    nothing: their component is their own id.  Repeated rows have equal sets and share a
    component.  Null ids take part in links but never name a component that has another
    id; a component of null ids only is named null and its rows are kept.  An empty
    table gives an empty result; other columns of ``docs`` are not read.
    """
    ship_package(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = stored(base.mapInArrow(lambda it: _signature_batches(it, shingle),
                                  "id long, n long, h1 long, h2 long, sig binary"), "signatures")
    classes = stored(rows.filter("n > 0").groupBy("h1", "h2")
                     .agg(F.min("id").alias("min_id"), F.max("n").alias("n"), F.first("sig").alias("sig"))
                     .withColumn("cid", F.monotonically_increasing_id()), "classes")

    keys = classes.select("cid", "sig").mapInArrow(_key_batches, "cid long, key long")
    buckets = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    entries = _in_blocks(keys.join(buckets, "key"), F.ceil(F.col("size") / F.lit(BLOCK)), ["key"])
    entries = entries.select("key", "lo", "hi", "cid").join(classes.select("cid", "sig"), "cid")
    close = _dealt(entries, ["key", "lo", "hi"]).mapInArrow(
        lambda it: _close_batches(it, max_distance), "a long, b long")
    coarse = connected_components(close)

    members = stored(coarse.join(classes.drop("sig"), F.col("node") == F.col("cid")).drop("node"), "members")
    sizes = members.groupBy("label").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"))
    want = members.select(F.col("min_id").alias("_want")).distinct()
    small = broadcast_if_small(want)
    texts = base.join(small if small is not None else want, F.col("id").eqNullSafe(F.col("_want")), "left_semi")
    sets = texts.select("text").mapInArrow(lambda it: _set_batches(it, shingle),
                                           "h1 long, h2 long, members binary")
    full = members.select("cid", "label", "h1", "h2").join(sets, ["h1", "h2"]).join(sizes, "label")
    blocks = F.ceil(F.greatest(F.col("size") / F.lit(SET_BLOCK), F.col("shingles") / F.lit(SET_BLOCK_SHINGLES)))
    full = _in_blocks(full.select("cid", "label", "members", "size", "shingles"), blocks, ["label"])
    links = _dealt(full.select("label", "lo", "hi", "cid", "members"), ["label", "lo", "hi"]).mapInArrow(
        lambda it: _confirmed_batches(it, percent), "a long, b long")
    found = connected_components(links)

    named = found.join(classes.select("cid", "min_id"), F.col("node") == F.col("cid"))
    names = named.groupBy("label").agg(F.min("min_id").alias("component_id"))
    of_class = classes.select("cid", "h1", "h2", "min_id").join(
        named.select("cid", "label").join(names, "label").select("cid", "component_id"), "cid", "left").select(
        "h1", "h2", F.coalesce("component_id", "min_id").alias("component_id"))
    out = rows.select("id", "n", "h1", "h2").join(of_class, ["h1", "h2"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
