"""Language-model scoring with a hierarchical Pitman-Yor model.

*Model.*  Tokens are lower-cased words and an end per text.  A token's restaurant is its
context, the token before it (the text's start is a context of its own).  The parent of a
context is its class (its ending, hashed to ``CLASSES`` classes), and all classes share one
parent, the unigram restaurant, whose own base is uniform over the known types and one
unknown type.  A context that was never seen backs off to its class.

*Seating.*  A Gibbs sweep takes the customers of each dish out of a restaurant and seats
them again one by one: the next customer opens a table with weight
``(theta + d * tables) * parent probability`` against ``customers - d * own tables``.  Each new
table sends a customer to the parent, which is reseated after its children.  After
``BURN_IN`` sweeps, the predictive probabilities of ``SAMPLES`` sweeps are averaged.  Beyond 16 customers
of a dish, runs of an eighth of those already seated are drawn at once (binomially).

*Distribution.*  Text is cut into blocks.  A block sends each of its distinct (word,
context) pairs once, with its training count, to the word's shard.  A shard holds all customers of
its words, in every restaurant, so seating is local.  The totals of the contexts (customers
and tables) are summed in shards of their own, by context, and go back to the shards that ask
for them; the totals per class come to the driver (a fixed number of sums).  Shards answer
each block with the counts and probabilities of its pairs.  Seeds derive from the shard, so a
lost task is repeated exactly.  Without contexts (``fit`` on counts per class) the customers of
the classes are the tokens themselves.

*On disk.*  A message names each of its words once, with its contexts (their classes in the low bits).
Messages are stored by wave of shards; a wave goes to its shards, one shard a task, and is deleted once its
records are stored.  A record has the distinct pairs of a shard, its contexts as places in the list of the
shard's contexts, and each message's pairs as steps between their places in the record, so that keys
move once.  The answers are made and stored wave by wave as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm import text_np as tn
from corvid.llm.common import crc_mod, release, ship_package, shuffle_partitions, stored, stored_by

CLASS_BITS = 5
CLASSES = 1 << CLASS_BITS  # the last one is the start of a text
START = CLASSES - 1
ENDING = 2  # bytes of the token before that make its class (the parent of its restaurant)
BLOCK_BYTES = 8 << 20
BURN_IN, SAMPLES = 2, 4
THETA, THETA_ROOT = 1.0, 1.0
_CLASS = tn.U(CLASSES - 1)
END = tn.mix(np.array([0xE17D], dtype=np.uint64))[0]
# class of a token by its last two (lower-cased) bytes
_CLASS_OF = (tn.mix(np.arange(1 << 16, dtype=np.uint64) + tn.U(1)) % tn.U(START)).astype(np.uint8)
_TRIVIAL = 16  # customers seated one by one
_STEP = 65535
START_CONTEXT = tn.U(START)  # no word hash: those have empty class bits
WAVES = 4  # parts of the shards that are shuffled one after another
LISTING, RECORD = -1, -3  # wave of the listings of blocks; block of a record


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hash (class bits empty) and own class of all tokens of the texts, ends included, and tokens per text."""
    h, start, end, counts = tn.words(raw, offsets, tn.NOT_BLANK)
    size = counts + 1
    at = np.cumsum(size)
    total = int(at[-1]) if len(at) else 0
    is_end = np.zeros(total, dtype=bool)
    is_end[at - 1] = True
    low = tn.LOWER[raw]
    own = np.zeros(total, dtype=np.uint8)
    own[~is_end] = _CLASS_OF[low[np.maximum(end - ENDING, start)].astype(np.uint16) << 8 | low[end - 1]]
    words = np.empty(total, dtype=np.uint64)
    words[~is_end] = h
    words[is_end] = END
    return words & ~_CLASS, own, size


def _pairs_of(words: np.ndarray, own: np.ndarray, size: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (word, token before) pairs: keys (word with the class in its low bits), contexts, pair of each token.

    A context is the whole word hash of the token before; the start of a text has its own.
    """
    types, word = np.unique(words, return_inverse=True)
    before = np.empty(len(word), dtype=np.int64)
    before[1:] = word[:-1]
    before[np.cumsum(size) - size] = len(types)
    pair, code = np.unique(word * (len(types) + 1) + before, return_inverse=True)
    cls = np.full(len(types) + 1, START, dtype=np.uint64)
    cls[word] = own
    place = pair % (len(types) + 1)
    return types[pair // (len(types) + 1)] | cls[place], np.append(types, START_CONTEXT)[place], code


def _deltas(index: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """16-bit steps of the ascending indices of each text (65535 carries on), and steps per text."""
    first = np.cumsum(size) - size
    step = np.diff(index, prepend=0)
    step[first] = index[first]
    more = step // _STEP
    out = np.full(int(more.sum()) + len(step), _STEP, dtype=np.uint16)
    last = np.cumsum(more + 1) - 1
    out[last] = step % _STEP
    return out, np.add.reduceat(more + 1, first) if len(first) else first


def _indices(steps: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inverse of ``_deltas``: (indices, text of each)."""
    first = np.cumsum(counts) - counts
    c = np.cumsum(steps, dtype=np.int64)
    base = np.where(first > 0, c[first - 1], 0)
    text = np.repeat(np.arange(len(counts)), counts)
    keep = steps != _STEP
    return (c - np.repeat(base, counts))[keep], text[keep]


_SCHEMA = "shard int, block long, keys binary, counts binary, doc_ids binary, held_out binary, known_ids binary, contexts binary"
_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")]


def _block_batches(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Per block a message for each shard, and (shard -1) the block's own listing of its texts."""
    part, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        doc_ids = batch.column(0)
        known = doc_ids.is_valid().to_numpy(zero_copy_only=False)
        values = doc_ids.fill_null(0).to_numpy()
        held = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for lo, hi, raw, off in tn.slices(batch.column(2), BLOCK_BYTES):
            block = part << 32 | number
            number += 1
            words, own, size = tokens(raw, off)
            train = np.repeat(~held[lo:hi], size)
            uniq, contexts, code = _pairs_of(words, own, size)
            count = np.bincount(code[train], minlength=len(uniq))
            del words, own, train
            # order by shard, then word and context; a text's listing names pairs by their place in this order
            shard = (tn.mix(uniq & ~_CLASS) % tn.U(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            place = np.empty(len(order), dtype=np.int64)
            place[order] = np.arange(len(order))
            text = np.repeat(np.arange(hi - lo), size)
            width = len(uniq) + 1
            index = text * width + place[code]
            del text, code
            index.sort()
            index %= width
            steps, n_steps = _deltas(index, size)
            ends = np.cumsum(np.bincount(shard, minlength=shards))
            sent = np.flatnonzero(np.bincount(shard, minlength=shards))
            keys_column = tn.binary_column(uniq[order], ends[sent])
            counts_column = tn.binary_column(count[order].astype(np.uint32), ends[sent])
            n = len(sent)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sent.astype(np.int32)), pa.array(np.full(n, block)), keys_column, counts_column,
                 *(pa.nulls(n, pa.binary()) for _ in range(3)), tn.binary_column(contexts[order], ends[sent])], _NAMES)
            one = [np.ascontiguousarray(x).tobytes() for x in (
                steps, n_steps.astype(np.int64), values[lo:hi].astype(np.int64), held[lo:hi], known[lo:hi])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1], type=pa.int32()), pa.array([block]), *(pa.array([x], type=pa.binary()) for x in one),
                 pa.nulls(1, pa.binary())], _NAMES)


def _runs(keys: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of the keys of each row (rows end at ``off[1:]``), once each: words, pairs per word, rows' ends in words."""
    new = _new(keys >> tn.U(CLASS_BITS))
    new[off[:-1][off[:-1] < off[1:]]] = True
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(keys))).astype(np.uint32)
    return keys[first] & ~_CLASS, sizes, np.searchsorted(first, off[1:])


def _bare(contexts: np.ndarray) -> np.ndarray:
    """Contexts without their class; the start of a text is the only one of its class."""
    return np.where(contexts & _CLASS == START_CONTEXT, START_CONTEXT, contexts & ~_CLASS)


_PACKED = f"{_SCHEMA}, sizes binary, wave int"


def _packed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Messages with each word once and classes in the contexts, and the wave of their shard; listings as they are."""
    names = [x.split()[0] for x in _PACKED.split(", ")]
    for batch in batches:
        columns = dict(zip(_NAMES, batch.columns))
        shard = columns["shard"].to_numpy()
        n = len(shard)
        if n and shard[0] >= 0:
            keys, off = tn.binary_values(columns["keys"], np.uint64)
            contexts, _ = tn.binary_values(columns["contexts"], np.uint64)
            words, sizes, ends = _runs(keys, off)
            columns |= {"keys": tn.binary_column(words, ends), "sizes": tn.binary_column(sizes, ends),
                        "contexts": tn.binary_column(contexts | (keys & _CLASS), off[1:]),
                        "wave": pa.array((shard % WAVES).astype(np.int32))}
        else:
            columns |= {"sizes": pa.nulls(n, pa.binary()), "wave": pa.array(np.full(n, LISTING, dtype=np.int32))}
        yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)


def _plain_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Inverse of ``_packed_batches`` for messages: a key and a context for each pair."""
    for batch in batches:
        words, _ = tn.binary_values(batch["keys"], np.uint64)
        sizes, _ = tn.binary_values(batch["sizes"], np.uint32)
        contexts, off = tn.binary_values(batch["contexts"], np.uint64)
        keys = np.repeat(words, sizes) | (contexts & _CLASS)
        yield pa.RecordBatch.from_arrays(
            [batch["shard"], batch["block"], tn.binary_column(keys, off[1:]), batch["counts"],
             tn.binary_column(_bare(contexts), off[1:])], ["shard", "block", "keys", "counts", "contexts"])


def _merged(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(Word, class) keys of a shard's messages with their training counts, seen ones only."""
    keys, _ = tn.binary_values(t["keys"], np.uint64)
    counts, _ = tn.binary_values(t["counts"], np.uint32)
    uniq, code = np.unique(keys, return_inverse=True)
    n = np.bincount(code, weights=counts, minlength=len(uniq)).astype(np.int64)
    return uniq[n > 0], n[n > 0]


def _merged_pairs(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of a shard's messages: keys, contexts, training counts (0 too), and the pair of each entry."""
    keys, _ = tn.binary_values(t["keys"], np.uint64)
    contexts, _ = tn.binary_values(t["contexts"], np.uint64)
    counts, _ = tn.binary_values(t["counts"], np.uint32)
    order = np.lexsort((contexts, keys))
    keys, contexts = keys[order], contexts[order]
    new = _new(keys) | _new(contexts)
    first = np.flatnonzero(new)
    code = np.empty(len(order), dtype=np.int64)
    code[order] = np.cumsum(new) - 1
    n = np.add.reduceat(counts[order].astype(np.int64), first) if len(first) else first
    return keys[first], contexts[first], n, code


def _new(x: np.ndarray) -> np.ndarray:
    """True where a value differs from the one before."""
    return np.append(True, x[1:] != x[:-1]) if len(x) else np.zeros(0, dtype=bool)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first) if len(first) else values


_COUNTS = "shard int, block long, keys binary, counts binary, contexts binary, asked binary"


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a shard: its trained pairs, and all contexts of its pairs (held-out texts ask for theirs too)."""
    for t, starts in tn.whole_groups(batches, ["shard"]):
        shard = t["shard"].to_numpy()
        for s, e in zip(starts, np.append(starts[1:], len(shard))):
            keys, contexts, n, _ = _merged_pairs(t.slice(s, e - s))
            seen = n > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(shard[s])], type=pa.int32()), pa.array([0], type=pa.int64()),
                 *(pa.array([x.tobytes()], type=pa.binary())
                   for x in (keys[seen], n[seen], contexts[seen], np.unique(contexts)))],
                [x.split()[0] for x in _COUNTS.split(", ")])


_RECORDS = "shard int, block long, keys binary, sizes binary, counts binary, contexts binary, at binary, steps binary"


def _record_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's record (all its pairs, those of held-out texts too), and for each message the steps to its pairs."""
    names = [x.split()[0] for x in _RECORDS.split(", ")]
    for t, starts in tn.whole_groups(_plain_batches(batches), ["shard"]):
        shard = t["shard"].to_numpy()
        for s, e in zip(starts, np.append(starts[1:], len(shard))):
            part = t.slice(s, e - s)
            off = tn.binary_values(part["keys"], np.uint64)[1]
            keys, contexts, n, code = _merged_pairs(part)
            asked, at = np.unique(contexts, return_inverse=True)
            asked[at] |= keys & _CLASS
            words, sizes, _ = _runs(keys, np.array([0, len(keys)]))
            one = [pa.array([x.tobytes()], type=pa.binary()) for x in (words, sizes, n, asked, at.astype(np.uint32))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(shard[s])], type=pa.int32()), pa.array([RECORD], type=pa.int64()), *one,
                 pa.nulls(1, pa.binary())], names)
            size = np.diff(off)
            place = np.repeat(np.arange(e - s), size) * len(keys) + code
            place.sort()
            steps, n_steps = _deltas(place % max(len(keys), 1), size)
            yield pa.RecordBatch.from_arrays(
                [part["shard"].combine_chunks(), part["block"].combine_chunks(),
                 *(pa.nulls(e - s, pa.binary()) for _ in range(5)), tn.binary_column(steps, np.cumsum(n_steps))], names)


def _of_record(own: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, contexts and training counts of the pairs of a record (one row), and its distinct contexts."""
    words, sizes, n, asked, at = (tn.binary_values(own[c], kind)[0] for c, kind in (
        ("keys", np.uint64), ("sizes", np.uint32), ("counts", np.int64), ("contexts", np.uint64), ("at", np.uint32)))
    contexts = asked[at]
    return np.repeat(words, sizes) | (contexts & _CLASS), _bare(contexts), n, _bare(asked)


def _message_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's messages again, from its record and their steps, after the totals of its contexts.

    A pair's training count, summed over the messages, is in the first that has it.
    """
    for t, starts in tn.whole_groups(batches, ["shard"]):
        number = t["shard"].to_numpy()
        for s, e in zip(starts, np.append(starts[1:], len(number))):
            part = t.slice(s, e - s).combine_chunks()
            keys, contexts, n, _ = _of_record(part.filter(pc.equal(part["block"], RECORD)))
            known = part.filter(pc.and_(pc.less(part["block"], 0), pc.greater(part["block"], RECORD)))
            part = part.filter(pc.greater_equal(part["block"], 0)).combine_chunks()
            steps, off = tn.binary_values(part["steps"], np.uint16)
            place, message = _indices(steps, np.diff(off))
            # in a message the contexts of a word ascend, whatever their class; the start of a text comes last
            x = contexts[place]
            x = np.where(x == START_CONTEXT, ~tn.U(0), x)
            place = place[np.lexsort((x, keys[place] >> tn.U(CLASS_BITS), message))]
            ends = np.cumsum(np.bincount(message, minlength=part.num_rows))
            _, first = np.unique(place, return_index=True)
            count = np.zeros(len(place), dtype=np.uint32)
            count[first] = n
            columns = ["shard", "block", "keys", "counts", "contexts"]
            messages = pa.table([part["shard"], part["block"], tn.binary_column(keys[place], ends),
                                 tn.binary_column(count, ends), tn.binary_column(contexts[place], ends)], columns)
            yield from pa.concat_tables([known.select(columns), messages]).combine_chunks().to_batches()


_CONTEXTS = "shard int, block long, keys binary, contexts binary"


def _context_batches(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Sums of the contexts' (customers, tables) over the word shards, sent to all shards that ask."""
    for t, starts in tn.whole_groups(batches, ["to"]):
        to = t["to"].to_numpy()
        for s, e in zip(starts, np.append(starts[1:], len(to))):
            part = t.slice(s, e - s).combine_chunks()
            contexts, off = tn.binary_values(part["contexts"], np.uint64)
            values, _ = tn.binary_values(part["sums"], np.float64)
            uniq, code = np.unique(contexts, return_inverse=True)
            total = np.stack([np.bincount(code, weights=v, minlength=len(uniq)) for v in values.reshape(-1, 2).T], 1)
            yield pa.RecordBatch.from_arrays(
                [part["shard"].combine_chunks(), pa.array(np.full(e - s, block, dtype=np.int64)),
                 tn.binary_column(total[code].ravel(), 2 * off[1:]), part["contexts"].combine_chunks()],
                [x.split()[0] for x in _CONTEXTS.split(", ")])


def _of_contexts(t: pa.Table, block: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Customers and tables of the wanted contexts from the answers (rows of number ``block``) to a shard."""
    t = t.filter(pc.equal(t["block"], block))
    contexts, _ = tn.binary_values(t["contexts"], np.uint64)
    values, _ = tn.binary_values(t["keys"], np.float64)
    order = np.argsort(contexts)
    at = order[np.searchsorted(contexts, wanted, sorter=order)]
    values = values.reshape(-1, 2)[at]
    return values[:, 0], values[:, 1]


def _seat(n: np.ndarray, weight: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of ``n`` customers of one dish each, seated one after another; ``weight`` opens a table."""
    t = np.minimum(n, 1)
    left = np.flatnonzero(n > 1)
    k = 1
    while len(left):
        run = 1 if k < _TRIVIAL else k // 8
        p = weight[left] / (weight[left] + k - d * t[left])
        if run == 1:
            t[left] += rng.random(len(left)) < p
        else:
            t[left] += rng.binomial(np.minimum(run, n[left] - k), p.clip(0, 1))
        k += run
        left = left[n[left] > k]
    return t


class _Shard:
    """Customers of a shard's words in all restaurants; with ``contexts``, a key has an entry for each of them."""

    def __init__(self, shard: int, keys: np.ndarray, n: np.ndarray, contexts: np.ndarray | None = None):
        self.shard, self.n, self.contexts = shard, n, contexts
        new = _new(keys)
        self.key_first = np.flatnonzero(new)
        self.key_of = np.cumsum(new) - 1  # key of each pair
        self.keys = keys[self.key_first]
        self.cls = (self.keys & _CLASS).astype(np.int64)
        word = self.keys >> tn.U(CLASS_BITS)
        new = _new(word)
        self.first = np.flatnonzero(new)
        self.words = word[self.first]
        self.of = np.cumsum(new) - 1  # word of each key
        self.count = _sums(_sums(n, self.key_first), self.first)
        # customers of the classes before any sweep: a table in each context
        self.start = n if contexts is None else _sums(np.ones_like(n), self.key_first)

    def sweeps(self, m: dict, tables: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, ...]]:
        """After each Gibbs sweep: tables of each pair, customers and tables of each key, and of each word in the root.

        ``tables`` are those of each pair's context.
        """
        rng = np.random.default_rng([m["seed"], self.shard])
        t, up = self.n, self.start
        own = np.minimum(up, 1)
        over = _sums(own, self.first)
        top = np.minimum(over, 1)
        root = (THETA_ROOT + m["d_root"] * m["root_tables"]) / (m["types"] + 1)
        for _ in range(BURN_IN + SAMPLES):
            parent = (over - m["d_root"] * top + root) / (THETA_ROOT + m["root_customers"])
            weight = (THETA + m["d"] * m["tables"][self.cls]) * parent[self.of]
            if self.contexts is not None:
                p = (up - m["d"] * own + weight) / (THETA + m["customers"][self.cls])
                t = _seat(self.n, (THETA + m["d_pair"] * tables) * p[self.key_of], m["d_pair"], rng)
                up = _sums(t, self.key_first)
            own = _seat(up, weight, m["d"], rng)
            over = _sums(own, self.first)
            top = _seat(over, np.full(len(over), root), m["d_root"], rng)
            yield t, up, own, over, top


_TOTALS = "name string, sample int, by_class array<double>, to int, shard int, contexts binary, sums binary"


def _total_batches(batches: Iterator[pa.RecordBatch], m: dict | None, shards: int) -> Iterator[pa.RecordBatch]:
    """Sums over a task's shards, a row for each name and sample (single values as class 0), and a shard's sums by context."""
    summed: dict[tuple[str, int], np.ndarray] = {}
    columns = [x.split()[0] for x in _TOTALS.split(", ")]

    def add(name: str, sample: int, by_class) -> None:
        v = np.atleast_1d(by_class)
        summed.setdefault((name, sample), np.zeros(CLASSES))[:len(v)] += v

    def by_class(s: _Shard, v: np.ndarray) -> np.ndarray:
        return np.bincount(s.cls, weights=v, minlength=CLASSES)

    for t, starts in tn.whole_groups(batches, ["shard"]):
        number = t["shard"].to_numpy()
        for lo, hi in zip(starts, np.append(starts[1:], len(number))):
            part = t.slice(lo, hi - lo)
            own = part.slice(part.num_rows - 1)  # after the answers of the contexts
            if "at" in own.column_names:
                keys, contexts, n, asked = _of_record(own)
                keys, contexts, n = keys[n > 0], contexts[n > 0], n[n > 0]
            else:
                keys, n = (tn.binary_values(own[c], kind)[0] for c, kind in (("keys", np.uint64), ("counts", np.int64)))
                contexts, asked = (tn.binary_values(own[c], np.uint64)[0] if c in own.column_names else None
                                   for c in ("contexts", "asked"))
            s = _Shard(int(number[lo]), keys, n, contexts)
            if m is None:
                over = _sums(np.ones_like(s.start), s.first)
                add("tokens", 0, n.sum())
                add("customers", 0, by_class(s, s.start))
                add("tables", 0, np.bincount(s.cls, minlength=CLASSES))
                add("types", 0, len(s.words))
                for name, x in (("pair", n), ("class", s.start), ("root", over)):
                    add(f"{name}_once", 0, (x == 1).sum())
                    add(f"{name}_twice", 0, (x == 2).sum())
                seated = np.ones(len(n))
            else:
                seated = np.zeros(len(n))
                opened = None if contexts is None else _of_contexts(part, -1, contexts)[1]
                for k, (tables, up, own_tables, over, top) in enumerate(s.sweeps(m, opened)):
                    add("customers", k, by_class(s, up))
                    add("tables", k, by_class(s, own_tables))
                    add("root_customers", k, over.sum())
                    add("root_tables", k, top.sum())
                    if k >= BURN_IN:
                        seated += tables / SAMPLES
            if contexts is None:
                continue
            at = np.searchsorted(asked, contexts)
            sums = np.stack([np.bincount(at, weights=w, minlength=len(asked)) for w in (n, seated)], 1)
            to = (tn.mix(asked) % tn.U(shards)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            ends = np.cumsum(np.bincount(to, minlength=shards))
            sent = np.flatnonzero(np.bincount(to, minlength=shards))
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(sent), pa.string()), pa.nulls(len(sent), pa.int32()),
                 pa.nulls(len(sent), pa.list_(pa.float64())), pa.array(sent.astype(np.int32)),
                 pa.array(np.full(len(sent), number[lo], dtype=np.int32)), tn.binary_column(asked[order], ends[sent]),
                 tn.binary_column(sums[order].ravel(), 2 * ends[sent])], columns)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in summed], type=pa.string()), pa.array([k for _, k in summed], type=pa.int32()),
         pa.array([v.tolist() for v in summed.values()], type=pa.list_(pa.float64())),
         *(pa.nulls(len(summed), pa.int32()) for _ in range(2)), *(pa.nulls(len(summed), pa.binary()) for _ in range(2))],
        columns)


def _totals(counts: DataFrame, m: dict | None, known: DataFrame | None, block: int
            ) -> tuple[dict[tuple[str, int], np.ndarray], DataFrame | None]:
    """Sums for the driver, and (if there are contexts) the stored totals of contexts by asking shard."""
    shards = shuffle_partitions(counts.sparkSession)
    by_context = "contexts" in counts.columns
    if known is not None:
        counts = (counts.unionByName(known.withColumn("block", F.lit(-1).cast("long")), allowMissingColumns=True)
                  .repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "block"))
    found = counts.mapInArrow(lambda it: _total_batches(it, m, shards), _TOTALS)
    if by_context:
        found = stored(found, "totals", compression="zstd", **{"parquet.enable.dictionary": "false"})
    rows = (found.filter("name IS NOT NULL").groupBy("name", "sample")
            .agg(F.array(*[F.sum(F.get("by_class", F.lit(c))) for c in range(CLASSES)]).alias("by_class"))
            .collect())  # a fixed number of sums
    out = {(r["name"], r["sample"]): np.array(r["by_class"]) for r in rows}
    if not by_context:
        return out, None
    sums = stored(found.filter("name IS NULL").select("to", "shard", "contexts", "sums")
                  .repartitionById(shards, F.col("to")).sortWithinPartitions("to")
                  .mapInArrow(lambda it: _context_batches(it, block), _CONTEXTS), "contexts", compression="zstd",
                  **{"parquet.enable.dictionary": "false"})
    release(found)
    return out, sums


def fit(counts: DataFrame, seed: int = 11) -> dict:
    """Totals, discounts and the totals of every sweep; ``contexts``: the stored totals of contexts, if there are any."""
    first, opened = _totals(counts, None, None, -1)

    def one(name: str) -> float:
        return float(first.get((name, 0), np.zeros(CLASSES))[0])

    def discount(name: str) -> float:
        once, twice = one(f"{name}_once"), one(f"{name}_twice")
        return min(max(once / max(once + 2 * twice, 1), 0.1), 0.95)

    tables = first.get(("tables", 0), np.zeros(CLASSES))
    m = {"seed": seed, "types": one("types"), "customers": first.get(("customers", 0), np.zeros(CLASSES)),
         "tokens": one("tokens"), "d_pair": discount("pair"), "d": discount("class"), "d_root": discount("root"),
         "tables": tables, "root_customers": float(tables.sum()), "root_tables": one("types")}
    settled, seated = _totals(counts, m, opened, -2)  # the sums that the sweeps settle at ...
    if opened is not None:
        release(opened)
    last = BURN_IN + SAMPLES - 1
    if ("tables", last) in settled:
        m |= {"customers": settled["customers", last], "tables": settled["tables", last],
              "root_customers": float(settled["root_customers", last][0]),
              "root_tables": float(settled["root_tables", last][0])}
    sweeps, final = _totals(counts, m, seated, -1)  # ... are what the final sweeps are seated with
    return m | {"sweeps": sweeps, "contexts": (seated, final)}


def _answer_batches(batches: Iterator[pa.RecordBatch], m: dict) -> Iterator[pa.RecordBatch]:
    """For each message the training count of every pair's word and the pair's log10 probability.

    Before a shard's messages come the totals of its contexts: those its sweeps are seated with
    (block -2), and the means over the sampled sweeps (block -1).  Messages without
    contexts are answered for the classes.
    """
    sums = m["sweeps"]
    for t, starts in tn.whole_groups(batches, ["shard"]):
        shard = t["shard"].to_numpy()
        for s, e in zip(starts, np.append(starts[1:], len(shard))):
            part = t.slice(s, e - s).combine_chunks()
            if "contexts" in part.column_names:
                known, part = part, part.filter(pc.greater_equal(part["block"], 0)).combine_chunks()
                uniq, contexts, trained, code = _merged_pairs(part)
                off = tn.binary_values(part["keys"], np.uint64)[1]
                seen = trained > 0
                model = _Shard(int(shard[s]), uniq[seen], trained[seen], contexts[seen])
                customers, opened = _of_contexts(known, -1, contexts)
                sweeps = model.sweeps(m, _of_contexts(known, -2, contexts[seen])[1])
                del known
            else:
                asked, off = tn.binary_values(part["keys"], np.uint64)
                uniq, code = np.unique(asked, return_inverse=True)
                contexts = None
                model = _Shard(int(shard[s]), *_merged(part))
                sweeps = model.sweeps(m)
            cls = (uniq & _CLASS).astype(np.int64)
            word = uniq >> tn.U(CLASS_BITS)

            def found(table, wanted):
                at = np.searchsorted(table, wanted)
                at[at == len(table)] = 0
                return at, (table[at] == wanted if len(table) else np.zeros(len(wanted), dtype=bool))

            key, has_key = found(model.keys, uniq)
            place, has_word = found(model.words, word)

            def take(values, at, has):
                return np.where(has, values[at], 0) if len(values) else np.zeros(len(at), dtype=np.int64)

            count = take(model.count, place, has_word)
            mean = np.zeros(len(uniq))
            for k, (tables, up, own, over, top) in enumerate(sweeps):
                if k < BURN_IN:
                    continue
                root = (THETA_ROOT + m["d_root"] * sums["root_tables", k][0]) / (m["types"] + 1)
                parent = ((take(over, place, has_word) - m["d_root"] * take(top, place, has_word) + root)
                          / (THETA_ROOT + sums["root_customers", k][0]))
                p = ((take(up, key, has_key) - m["d"] * take(own, key, has_key)
                      + (THETA + m["d"] * sums["tables", k][cls]) * parent) / (THETA + sums["customers", k][cls]))
                if contexts is not None:
                    p = (THETA + m["d_pair"] * opened) * p
                    p[seen] += model.n - m["d_pair"] * tables
                    p /= THETA + customers
                mean += p
            logp = np.log10(mean / SAMPLES).astype(np.float32)
            ends = off[1:]
            nulls = [pa.nulls(part.num_rows, pa.binary()) for _ in range(4)]
            yield pa.RecordBatch.from_arrays(
                [part["shard"].combine_chunks(), part["block"].combine_chunks(),
                 tn.binary_column(logp[code], ends), tn.binary_column(count[code], ends), *nulls], _NAMES)


def _text_batches(batches: Iterator[pa.RecordBatch], m: dict) -> Iterator[pa.RecordBatch]:
    """Scores of a block's texts from its listing (shard -1, sorted first) and the shards' answers."""
    total = m["tokens"] + m["types"] + 1
    for t, starts in tn.whole_groups(batches, ["block"]):
        shard = t["shard"].to_numpy()
        for s, e in zip(starts, np.append(starts[1:], len(shard))):
            own, answers = t.slice(s, 1), t.slice(s + 1, e - s - 1)
            steps, size, ids, held, known = (
                np.frombuffer(own[c][0].as_py(), dtype=kind)
                for c, kind in zip(_NAMES[2:], (np.uint16, np.int64, np.int64, bool, bool)))
            index, text = _indices(steps, size)
            logp, _ = tn.binary_values(answers["keys"], np.float32)
            count, _ = tn.binary_values(answers["counts"], np.int64)
            base = np.log10((count + 1) / total)
            n = len(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=~known), pa.array(held),
                 pa.array(np.bincount(text, minlength=n).astype(np.int64)),
                 pa.array(np.bincount(text, weights=count[index] > 0, minlength=n).astype(np.int64)),
                 pa.array(np.full(n, int(m["tokens"]))),
                 pa.array(np.bincount(text, weights=base[index], minlength=n)),
                 pa.array(np.bincount(text, weights=logp[index].astype(np.float64), minlength=n))],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def language_model_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7,
                          held_fold: int = 2, seed: int = 11) -> DataFrame:
    """Log10 probability of every whole text under the model learnt from the other folds.

    Returns per input row ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score`` (``base_score``: add-one unigrams).  Perplexity is ``10 ** (-score / n_tokens)``.
    Rows whose crc32(id) mod ``folds`` is ``held_fold`` are held out; a null id is not.  Null and
    empty texts are one end token.  Repeated rows train and score like any others.  Without
    training rows every token is of the unknown type.  An empty table gives an empty
    result; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shards = shuffle_partitions(spark)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).select(
        "doc_id", F.coalesce(crc_mod("doc_id", folds) == held_fold, F.lit(False)).alias("held_out"), "text")
    options = {"compression": "zstd", "parquet.enable.dictionary": "false"}
    blocks = stored_by(base.mapInArrow(lambda it: _packed_batches(_block_batches(it, shards)), _PACKED), "blocks", "wave",
                       [LISTING, *range(WAVES)], **options)

    def in_shards(rows: DataFrame) -> DataFrame:
        """One shard of a wave a task."""
        return rows.repartitionById(max(-(-shards // WAVES), 1), F.floor(F.col("shard") / WAVES).cast("int")
                                    ).sortWithinPartitions("shard", "block")

    records = []
    for wave in range(WAVES):
        messages = blocks[wave].select("shard", "block", "keys", "sizes", "counts", "contexts")
        records.append(stored(in_shards(messages).mapInArrow(_record_batches, _RECORDS), "records", **options))
        release(blocks[wave])
    counts = reduce(DataFrame.unionByName, records).filter(F.col("block") == RECORD).drop("steps")
    fitted = fit(counts.withColumn("block", F.lit(0).cast("long")), seed)
    seated, final = fitted.pop("contexts")
    model = spark.sparkContext.broadcast(fitted)
    answers = []
    for wave in range(WAVES):
        asked = records[wave]
        for totals in (seated, final):
            asked = asked.unionByName(totals.filter(F.col("shard") % WAVES == wave), allowMissingColumns=True)
        answers.append(stored(in_shards(asked).mapInArrow(lambda it: _answer_batches(_message_batches(it), model.value),
                                                          _SCHEMA), "answers", **options))
        release(records[wave])
    for totals in (seated, final):
        release(totals)
    return (reduce(DataFrame.unionByName, [blocks[LISTING].select(*_NAMES), *answers])
            .repartition(shards, "block").sortWithinPartitions("block", "shard")
            .mapInArrow(lambda it: _text_batches(it, model.value),
                        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                        "base_score double, score double"))
