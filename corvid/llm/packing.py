"""Best-fit packing of tokenised documents by minimum bin slack.

1. Documents are tokenised in parallel and cut into pieces of at most ``capacity``
   tokens; the pieces (ids' checksum and length, no text) are written to a table.
2. Their lengths are counted.  A histogram of at most ``capacity`` numbers is all the
   packing needs to know, whatever the size of the corpus.
3. Minimum bin slack on the histogram: a bin starts with the largest piece left; a
   bitset subset-sum over the available lengths (each as often as it is left, largest
   first) finds the fullest feasible filling; the pieces are removed.  The same
   filling is taken as many times as its lengths allow, so each step uses up a length
   and there are at most about ``capacity`` different bins.
4. Pieces are numbered within their length in parallel (salted, so a length that a
   third of all pieces have is numbered by many tasks) and read their place off
   the plan.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm import text_np as tn
from corvid.llm.common import ship_package, shuffle_partitions, stored

CAPACITY = 2048
END_ID = 0
CACHE_PARTS = 1 << 17  # per task process; the cache is emptied when full
SLICE = 1 << 19  # bytes of texts that are tokenised at a time: encodings take many times the text
SEGMENT = 1 << 19  # bytes of one text that are split at a time

# Texts of these characters only (and without "<|", which may begin a special token) need no normalising but case;
# the tokenizer's pattern then cuts them into these parts, which go straight to its BPE model, each distinct one once.
_PLAIN = re.compile("[\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\s0-9{_LETTERS}]+", re.ASCII)


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level BPE: itself, or the next unused one from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class _Encoder:
    """Texts -> packed little-endian 32-bit ids, in one task process, with a bounded cache of parts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.parts: dict[str, bytes] = {}
        self.letters = _byte_letters()

    def _learn(self, part: str) -> bytes:
        shown = part if part.isascii() else "".join([self.letters[b] for b in part.encode()])
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        cut = [_PARTS.findall(t.lower()) if "<|" not in t and _PLAIN.fullmatch(t) else None for t in texts]
        new = set().union(*(c for c in cut if c is not None)) - self.parts.keys()
        if len(self.parts) + len(new) > CACHE_PARTS:
            self.parts.clear()
            new = set().union(*(c for c in cut if c is not None))
        for part in new:
            self.parts[part] = self._learn(part)
        rest = [t for t, c in zip(texts, cut) if c is None]
        done = iter(self.tok.encode_batch_fast(rest, add_special_tokens=False) if rest else [])
        get = self.parts.__getitem__
        out = [b"".join(map(get, c)) if c is not None else array("I", next(done).ids).tobytes() for c in cut]
        if len(self.parts) > CACHE_PARTS:  # one slice had more parts than the cache may keep
            self.parts.clear()
        return out


_loaded: dict[str, _Encoder] = {}


def text_ids(path: str, texts: list[str]) -> list[bytes]:
    """Packed ids of texts, as the tokenizer file at ``path`` gives them."""
    if path not in _loaded:
        _loaded[path] = _Encoder(path)
    return _loaded[path].ids(texts)


def _segments(text: bytes) -> Iterator[bytes]:
    """Cut a long text between words."""
    at = 0
    while len(text) - at > SEGMENT:
        end = at + SEGMENT
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def _piece_batches(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int
                   ) -> Iterator[pa.RecordBatch]:
    end = array("I", [end_id]).tobytes()
    width = capacity * 4
    for batch in batches:
        ids = batch.column(0)
        for lo, hi, raw, off in tn.slices(batch.column(1), SLICE):
            row, piece, length, crc = [], [], [], []
            texts = [raw[off[i]:off[i + 1]].tobytes() for i in range(hi - lo)]
            found = text_ids(path, [t.decode("utf-8", "replace") for t in texts]) if hi - lo > 1 else None
            for i in range(hi - lo):
                buf, k = b"", 0
                for part in ([found[i]] if found else _segments(texts[i])):
                    buf += part if found else text_ids(path, [part.decode("utf-8", "replace")])[0]
                    full = max(0, (len(buf) - 1) // width)  # the last id seen so far may end the last piece
                    for j in range(full):
                        row.append(lo + i)
                        piece.append(k)
                        length.append(capacity)
                        crc.append(zlib.crc32(buf[j * width:(j + 1) * width]))
                        k += 1
                    buf = buf[full * width:]
                buf += end
                for j in range(0, len(buf), width):
                    part = buf[j:j + width]
                    row.append(lo + i)
                    piece.append(k)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    k += 1
            n = np.array(piece, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(row)), pa.array(n), pa.array(n.astype(np.int64) * capacity),
                 pa.array(length, type=pa.int64()), pa.array(crc, type=pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of the tokenised documents: ``doc_id, piece, start, length, ids_crc32``."""
    ship_package(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInArrow(lambda it: _piece_batches(it, tokenizer, capacity, end_id),
                           "doc_id long, piece int, start long, length long, ids_crc32 long")


def fullest(slack: int, available: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The fullest multiset of ``(length, count)`` with sum at most ``slack``, by a bitset subset-sum."""
    mask = (1 << (slack + 1)) - 1
    goal = 1 << slack
    reach, steps = 1, []
    for length, count in available:
        if length > slack:
            continue
        steps.append((length, count, reach))
        base = reach
        for j in range(1, min(count, slack // length) + 1):
            grown = reach | (base << (length * j) & mask)
            if grown == reach:
                break
            reach = grown
        if reach & goal:
            break
    rest = reach.bit_length() - 1
    chosen = []
    for length, count, before in reversed(steps):
        used = 0
        while not before >> rest & 1:
            rest -= length
            used += 1
        if used:
            chosen.append((length, used))
    return chosen


def minimum_bin_slack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """Bins as ``([(length, uses), ...], copies)`` covering exactly the pieces counted in ``counts``."""
    left = {k: v for k, v in counts.items() if v > 0}
    bins = []
    while left:
        top = max(left)
        uses = {top: 1}
        available = [(k, v - (k == top)) for k, v in sorted(left.items(), reverse=True) if v - (k == top) > 0]
        for length, used in fullest(capacity - top, available):
            uses[length] = uses.get(length, 0) + used
        copies = min(left[k] // u for k, u in uses.items())
        for k, u in uses.items():
            left[k] -= u * copies
            if not left[k]:
                del left[k]
        bins.append((sorted(uses.items(), reverse=True), copies))
    return bins


def _place_batches(batches: Iterator[pa.RecordBatch], plan: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        length = batch.column("length").to_numpy()
        rank = batch.column("rank").to_numpy()
        at = np.searchsorted(plan["key"], (length << 44) | rank, side="right") - 1
        t = rank - plan["first"][at]
        uses = plan["uses"][at]
        cols = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
        yield pa.RecordBatch.from_arrays(
            [*cols, pa.array(plan["sequence"][at] + t // uses), pa.array(plan["offset"][at] + t % uses * length)],
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def _plan(bins: list) -> dict[str, np.ndarray]:
    """Ranges of ranks per length, with the first sequence and the offset they go to."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, copies in bins:
        offset = 0
        for length, uses in pattern:
            first = taken.get(length, 0)
            rows.append((length << 44 | first, first, uses, sequence, offset))
            taken[length] = first + uses * copies
            offset += length * uses
        sequence += copies
    rows.sort()
    cols = np.array(rows or [(0, 0, 1, 0, 0)], dtype=np.int64).T
    return dict(zip(("key", "first", "uses", "sequence", "offset"), cols))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns one row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset``.  A document is its ids and then ``end_id``; null and empty texts are the
    end id alone.  Documents longer than ``capacity`` are cut into full pieces and a last
    one.  Repeated rows and null ids are packed like any others.  An empty table gives
    an empty result; other columns are not read.
    """
    pieces = stored(token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces")
    counts = {r["length"]: r["n"] for r in
              pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    plan = _plan(minimum_bin_slack(counts, capacity))

    salts = max(32, shuffle_partitions(docs.sparkSession))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (salted.withColumn("_row", F.row_number().over(own))
              .join(offsets, ["length", "_salt"])  # as the windows are partitioned: the pieces do not move again
              .withColumn("rank", (F.col("_before") + F.col("_row") - 1).cast("long")))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        lambda it: _place_batches(it, plan),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
