"""Benchmark decontamination with a distributed positional inverted index.

*Index.*  The corpus is cut into shards of whole documents (a few MB of text).  For
each shard and term one row holds the ascending word positions of the term; a
document's words follow the previous document's after a gap, so no phrase spans two
documents.  One more row per document says where it lies.  The index is a table:
lost executors re-read it, and it can serve several benchmarks.  ``vocabulary``
leaves out the postings of terms that no benchmark item has.

*Search.*  Benchmark windows are matched shard by shard.  Within a shard each
window's terms are ordered by posting-list length.  The rarest term's positions,
minus its offset in the window, are the candidate starts; they are intersected with
the next rarest term's list, adjusted by its offset, and so on.  With a ``slop`` a
term may also stand up to that many words off its place: a window all of whose
terms do is a proximity match.

The benchmark is the stated query set: it is sent to the tasks in blocks of at most
``block_words`` words, each block against every shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm import text_np as tn
from corvid.llm.common import release, ship_package, shuffle_partitions, stored

WINDOW = 13
SLOP = 2
GAP = 64  # positions between documents; more than a window and its slop
BLOCK_WORDS = 1_000_000
MAX_VOCABULARY = 1_000_000

INDEX_SCHEMA = ("shard long, term long, positions binary, ordinal int, doc_id long, n_words long, base long")


def _index_batches(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    seen = None
    if vocabulary is not None:
        seen = np.zeros(1 << 20, dtype=bool)
        seen[vocabulary & tn.U((1 << 20) - 1)] = True
    part, count = TaskContext.get().partitionId(), 0
    for batch in batches:
        ids = batch.column(0)
        for lo, hi, raw, off in tn.slices(batch.column(1)):
            shard = (part << 32) | count
            count += 1
            h, _, _, counts = tn.words(raw, off, tn.ALNUM)
            first = np.cumsum(counts) - counts
            base = first + np.arange(len(counts)) * GAP
            pos = np.arange(len(h)) + np.repeat(np.arange(len(counts)) * GAP, counts)
            if vocabulary is not None:
                keep = np.flatnonzero(seen[h & tn.U((1 << 20) - 1)])
                h, pos = h[keep], pos[keep]
                at = np.searchsorted(vocabulary, h)
                at[at == len(vocabulary)] = 0
                keep = np.flatnonzero(vocabulary[at] == h) if len(vocabulary) else keep[:0]
                code, pos, terms = at[keep], pos[keep], vocabulary
            else:
                terms, code = np.unique(h, return_inverse=True)
            key = np.sort((code.astype(np.uint64) << tn.U(32)) | pos.astype(np.uint64))
            code, pos = (key >> tn.U(32)).astype(np.int64), key.astype(np.uint32)
            last = np.flatnonzero(np.append(code[1:] != code[:-1], True)) if len(code) else np.zeros(0, dtype=np.int64)
            n, d = len(last), hi - lo
            none_n, none_d = np.ones(n, dtype=bool), np.ones(d, dtype=bool)
            if n:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, shard)), pa.array(terms[code[last]].view(np.int64)),
                    tn.binary_column(pos, last + 1), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
                    ["shard", "term", "positions", "ordinal", "doc_id", "n_words", "base"])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(d, shard)), pa.nulls(d, pa.int64()), pa.nulls(d, pa.binary()),
                pa.array(np.arange(d, dtype=np.int32)), ids.slice(lo, d), pa.array(counts), pa.array(base)],
                ["shard", "term", "positions", "ordinal", "doc_id", "n_words", "base"])


def build_index(docs: DataFrame, vocabulary: np.ndarray | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The stored positional index of ``docs`` (see the module).  Null texts have no words."""
    ship_package(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stored(base.mapInArrow(lambda it: _index_batches(it, vocabulary), INDEX_SCHEMA), "postings")


def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, raw, off in tn.slices(batch.column(1)):
            h, _, _, counts = tn.words(raw, off, tn.ALNUM)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(counts), tn.binary_column(h, np.cumsum(counts))],
                ["item_id", "n", "terms"])


class _Windows:
    """The windows of a block of items: ``terms`` of all items one after another, as codes into ``vocabulary``."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        self.item_ids = [i for i, _ in items]
        terms = [t for _, t in items]
        self.vocabulary, codes = np.unique(np.concatenate(terms), return_inverse=True)
        start, item, length = [], [], []
        at = 0
        for k, t in enumerate(terms):
            w = min(window, len(t))
            s = at + np.arange(len(t) - w + 1)
            start.append(s)
            item.append(np.full(len(s), k))
            length.append(np.full(len(s), w))
            at += len(t)
        self.start, self.item, self.length = map(np.concatenate, (start, item, length))
        # terms of each window; short windows repeat their last term, which changes nothing
        step = np.minimum(np.arange(window)[None, :], self.length[:, None] - 1)
        self.offset = step
        self.term = codes[self.start[:, None] + step]


def _find(w: _Windows, term: np.ndarray, values: np.ndarray, ends: np.ndarray, slop: int):
    """Matches in one shard: (window, start position, exact) arrays."""
    at = np.searchsorted(w.vocabulary, term)
    at[at == len(w.vocabulary)] = 0
    known = w.vocabulary[at] == term
    n = np.diff(np.concatenate(([0], ends)))
    size = np.zeros(len(w.vocabulary), dtype=np.int64)
    size[at[known]] = n[known]
    code = np.repeat(np.where(known, at, len(w.vocabulary)), n)
    key = (code.astype(np.int64) << 32) | values.astype(np.int64)
    key = np.sort(key)  # by term, then position
    first = np.searchsorted(key, np.arange(len(w.vocabulary)) << 32)
    window = np.flatnonzero((size[w.term] > 0).all(axis=1))
    order = np.argsort(size[w.term[window]], axis=1, kind="stable")
    term_of = np.take_along_axis(w.term[window], order, axis=1)
    off_of = np.take_along_axis(w.offset[window], order, axis=1)
    many = size[term_of[:, 0]] if len(window) else np.zeros(0, dtype=np.int64)
    row = np.repeat(np.arange(len(window)), many)
    within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    start = (key[np.repeat(first[term_of[:, 0]], many) + within] & 0xFFFFFFFF) - off_of[row, 0]
    exact = np.ones(len(row), dtype=bool)
    for j in range(1, w.term.shape[1]):
        if not len(row):
            break
        base = (term_of[row, j].astype(np.int64) << 32)
        place = start + off_of[row, j]
        low = np.searchsorted(key, base + np.maximum(place - slop, 0))
        found = key[np.minimum(low, len(key) - 1)]
        ok = (low < len(key)) & (found <= base + place + slop) & (found >= base) & (place + slop >= 0)
        if slop:
            hit = np.searchsorted(key, base + np.maximum(place, 0))
            exact &= (hit < len(key)) & (key[np.minimum(hit, len(key) - 1)] == base + place) & (place >= 0)
        row, start, exact = row[ok], start[ok], exact[ok]
    exact &= start >= 0
    return window[row], start, exact


def _match_batches(batches: Iterator[pa.RecordBatch], w: _Windows, slop: int) -> Iterator[pa.RecordBatch]:
    names = np.array(w.item_ids, dtype=object)
    for t, starts in tn.whole_groups(batches, ["shard"]):
        shards = t["shard"].to_numpy()
        for s, e in zip(starts, np.append(starts[1:], len(shards))):
            part = t.slice(s, e - s)
            is_doc = part["term"].is_null().to_numpy()
            docs, posts = part.filter(pa.array(is_doc)), part.filter(pa.array(~is_doc))
            if not posts.num_rows:
                continue
            docs = docs.sort_by("ordinal")
            values, off = tn.binary_values(posts["positions"], np.uint32)
            window, start, exact = _find(w, posts["term"].to_numpy().view(np.uint64), values, off[1:], slop)
            if not len(window):
                continue
            base, n = docs["base"].to_numpy(), docs["n_words"].to_numpy()
            doc = np.searchsorted(base, np.maximum(start, 0), side="right") - 1
            # a proximity match may begin before the first word found; keep it inside its document
            lo = np.clip(start - base[doc], 0, n[doc])
            hi = np.clip(start - base[doc] + w.length[window], 0, n[doc])
            # windows of one occurrence follow each other: merge them into runs
            item, shift = w.item[window], start - w.start[window]
            o = np.lexsort((lo, exact, shift, item, doc))
            doc, item, shift, exact, lo, hi = (x[o] for x in (doc, item, shift, exact, lo, hi))
            new = np.ones(len(doc), dtype=bool)
            new[1:] = ((doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (shift[1:] != shift[:-1])
                       | (exact[1:] != exact[:-1]) | (lo[1:] > lo[:-1] + 1))
            at = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(at), shards[s])), pa.array(doc[at].astype(np.int32)),
                pa.array(names[item[at]], type=pa.string()),
                pa.array(np.where(exact[at], "phrase", "proximity"), type=pa.string()),
                pa.array(lo[at]), pa.array(np.maximum.reduceat(hi, at))],
                ["shard", "ordinal", "item_id", "kind", "start", "end"])


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    ship_package(benchmark.sparkSession)
    return benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(text_col).alias("text")).mapInArrow(
        _item_batches, "item_id string, n long, terms binary").filter("n > 0 AND item_id IS NOT NULL")


def find_matches(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP,
                 item_col: str = "item_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Matched runs of benchmark windows: ``shard, ordinal, item_id, kind, start, end`` (words of the document,
    end exclusive).

    ``kind`` is ``phrase`` (every word in its place) or ``proximity`` (each of a window's
    words within ``slop`` of its place, not all in place).  An item of fewer than
    ``window`` words is one window; items without words or id match nothing.
    """
    if window + 2 * slop >= GAP:
        raise ValueError(f"window + 2 * slop must stay below {GAP}")
    spark = index.sparkSession
    items = _items(benchmark, item_col, text_col)
    total = items.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-int(total) // block_words))
    out, shared = None, []
    for k in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect()
        block = [(r["item_id"], np.frombuffer(bytes(r["terms"]), dtype=np.uint64)) for r in rows]
        if not block:
            continue
        w = _Windows(block, window)
        sent = spark.sparkContext.broadcast(w)
        shared.append(sent)
        n = shuffle_partitions(spark)
        found = index.repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(
            lambda it, sent=sent: _match_batches(it, sent.value, slop),
            "shard long, ordinal int, item_id string, kind string, start long, end long")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], "shard long, ordinal int, item_id string, kind string, start long, end long")
    out = stored(out, "matches")
    for sent in shared:
        sent.destroy()
    return out


def vocabulary_of(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
                  limit: int = MAX_VOCABULARY) -> np.ndarray | None:
    """Sorted distinct term hashes of the benchmark, or None (index every term) if there are more than ``limit``."""
    terms = (_items(benchmark, item_col, text_col).select("terms").mapInArrow(_term_batches, "term long").distinct())
    if terms.count() > limit:
        return None
    return np.sort(np.array([r[0] for r in terms.collect()], dtype=np.int64).view(np.uint64))


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.unique(tn.binary_values(batch.column(0), np.int64)[0])
        yield pa.RecordBatch.from_arrays([pa.array(values)], ["term"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """Per document how much of it is benchmark text.

    Returns one row per input row: ``doc_id, n_words, n_hit`` (words inside any phrase
    match), ``n_items, items`` (sorted ids, as strings, of items with a phrase match),
    ``n_near_items`` (items with a proximity match only) and ``contaminated``
    (``n_hit > 0`` and at least a twentieth of the words).  Null and empty texts
    have no words and are clean.  Repeated rows are reported one by one; a null id is kept as
    null.  Empty tables and empty benchmarks give clean documents; other columns are
    not read.
    """
    index = build_index(docs, vocabulary_of(benchmark, item_col), id_col, text_col)
    found = find_matches(index, benchmark, window, slop, item_col)
    key = ["shard", "ordinal"]
    listing = stored(index.filter("term IS NULL").select(*key, "doc_id", "n_words"), "listing")
    release(index)
    phrase = found.filter("kind = 'phrase'")
    hits = (phrase.withColumn("word", F.explode(F.sequence("start", F.col("end") - 1)))
            .select(*key, "word").distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("n_hit")))
    items = found.groupBy(*key, "item_id").agg(F.max(F.col("kind") == "phrase").alias("exact")).groupBy(*key).agg(
        F.sort_array(F.collect_list(F.when(F.col("exact"), F.col("item_id")))).alias("items"),
        F.sum(F.when(F.col("exact"), 0).otherwise(1)).alias("near"))
    out = listing.join(hits, key, "left").join(items, key, "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
                      listed.alias("items"), F.coalesce("near", F.lit(0)).cast("long").alias("n_near_items"),
                      ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"))
