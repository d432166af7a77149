"""Quality classifier: nearest-neighbour voting in a latent semantic space.

*Terms.*  Hashed words (lower-cased, a part of the space) and word shapes (capitals,
digits, trailing marks, length class, repetition of the word before; the other
part), counted over the whole text, dampened, weighted by the inverse document
frequency over *all* documents, and normalised per part.

*Space.*  A truncated SVD of the labelled sample (at most ``sample`` rows, picked by
a hash of the id) gives ``dims`` latent directions.  Its size is fixed by the
parameters, so the directions and the labelled vectors are safe to broadcast.

*Vote.*  Every document's vector is multiplied with all labelled vectors, block by
block, exactly; the ``k`` most similar (with ties) vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm import text_np as tn
from corvid.llm.common import crc_mod, ship_package

WORD_TERMS, SHAPE_TERMS = 3072, 1024
TERMS = WORD_TERMS + SHAPE_TERMS
SAMPLE, DIMS, NEIGHBOURS = 4096, 64, 25
THRESHOLD = 0.3
SHAPE_WEIGHT = 2.0
BLOCK_DOCS = 256

_UPPER = np.zeros(256, dtype=np.int32)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256, dtype=np.int32)
_DIGIT[48:58] = 1
_MARK = np.ones(256, dtype=bool)
_MARK[48:58] = _MARK[65:91] = _MARK[97:123] = _MARK[128:] = False


def _within(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    c = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return c[end] - c[start]


def term_counts(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, count) of the texts of a slice, by document."""
    h, start, end, counts = tn.words(raw, offsets, tn.NOT_BLANK)
    doc = np.repeat(np.arange(len(counts)), counts)
    if not len(h):
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    size = end - start
    upper, digit = _within(_UPPER[raw], start, end), _within(_DIGIT[raw], start, end)
    marks = _within(_MARK[raw], start, end)
    last = raw[end - 1].astype(np.int64)
    before = raw[np.maximum(end - 2, start)].astype(np.int64)
    last = np.where(_MARK[last], last, 0)
    before = np.where(_MARK[before], before, 0)
    case = np.where(upper == 0, 0, np.where(upper == 1, 1, np.where(upper + marks >= size, 2, 3)))
    again = np.zeros(len(h), dtype=np.int64)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    shape = (((last * 256 + before) * 4 + case) * 2 + (digit > 0)) * 2 + again
    shape = shape * 8 + np.minimum(np.log2(size + 1).astype(np.int64), 7)
    shape = (tn.mix(shape.astype(np.uint64) + tn.U(1)) % tn.U(SHAPE_TERMS)).astype(np.int64) + WORD_TERMS
    word = (h % tn.U(WORD_TERMS)).astype(np.int64)
    cells = len(counts) * TERMS
    both = np.concatenate((doc * TERMS + word, doc * TERMS + shape))
    if cells <= 1 << 22:
        table = np.bincount(both, minlength=cells)
        at = np.flatnonzero(table)
        n = table[at]
    else:
        at, n = np.unique(both, return_counts=True)
    return at // TERMS, at % TERMS, n


def weighted(doc: np.ndarray, term: np.ndarray, n: np.ndarray, docs: int, idf: np.ndarray) -> np.ndarray:
    """Dense rows of weighted terms, each part of the space at unit length (shapes times ``SHAPE_WEIGHT``)."""
    x = np.zeros((docs, TERMS), dtype=np.float32)
    x[doc, term] = (1 + np.log(n)) * idf[term]
    for lo, hi, weight in ((0, WORD_TERMS, 1.0), (WORD_TERMS, TERMS, SHAPE_WEIGHT)):
        norm = np.sqrt((x[:, lo:hi] ** 2).sum(axis=1, keepdims=True))
        x[:, lo:hi] *= weight / np.where(norm > 0, norm, 1)
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x ** 2).sum(axis=1, keepdims=True))
    return (x / np.where(norm > 0, norm, 1)).astype(np.float32)


def latent_directions(x: np.ndarray, dims: int, seed: int = 7) -> np.ndarray:
    """Leading right singular vectors (terms x dims) by a randomised range finder."""
    dims = min(dims, *x.shape)
    rng = np.random.default_rng(seed)
    q = rng.standard_normal((x.shape[0], dims + 16)).astype(np.float32)
    q = x.T @ q
    for _ in range(4):
        q, _ = np.linalg.qr(q)
        q = x.T @ (x @ q)
    q, _ = np.linalg.qr(q)
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ vt[:dims].T).astype(np.float32)


def _frequency_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, docs = np.zeros(TERMS, dtype=np.int64), 0
    for batch in batches:
        for lo, hi, raw, off in tn.slices(batch.column(0), tn.SLICE_BYTES // 2):
            df += np.bincount(term_counts(raw, off)[1], minlength=TERMS)
            docs += hi - lo
    yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(TERMS), -1)), pa.array(np.append(df, docs))],
                                     ["term", "df"])


def _sample_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, raw, off in tn.slices(batch.column(2), tn.SLICE_BYTES // 2):
            doc, term, n = term_counts(raw, off)
            ends = np.cumsum(np.bincount(doc, minlength=hi - lo))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                 tn.binary_column(term.astype(np.int32), ends), tn.binary_column(n.astype(np.int32), ends)],
                ["doc_id", "label", "terms", "counts"])


def vote(z: np.ndarray, vectors: np.ndarray, labels: np.ndarray, k: int, prior: float) -> np.ndarray:
    """Similarity-weighted share of label 1 among the ``k`` nearest (and ties); ``prior`` where nothing is similar."""
    if not len(vectors):
        return np.full(len(z), prior)
    sim = z @ vectors.T
    k = min(k, len(vectors))
    kth = np.partition(sim, len(vectors) - k, axis=1)[:, len(vectors) - k:len(vectors) - k + 1]
    w = np.where(sim >= kth, np.maximum(sim, 0), 0).astype(np.float64)
    total = w.sum(axis=1)
    return np.where(total > 0, (w @ labels) / np.where(total > 0, total, 1), prior).clip(0, 1)


def _score_batches(batches: Iterator[pa.RecordBatch], model: dict, k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, raw, off in tn.slices(batch.column(1), tn.SLICE_BYTES // 2):
            doc, term, n = term_counts(raw, off)
            cut = np.searchsorted(doc, np.arange(0, hi - lo + BLOCK_DOCS, BLOCK_DOCS))
            score = np.empty(hi - lo)
            for j, at in enumerate(range(0, hi - lo, BLOCK_DOCS)):
                size = min(BLOCK_DOCS, hi - lo - at)
                s = slice(cut[j], cut[j + 1])
                z = _unit(weighted(doc[s] - at, term[s], n[s], size, model["idf"]) @ model["directions"])
                score[at:at + size] = vote(z, model["vectors"], model["labels"], k, model["prior"])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(score)],
                                             ["doc_id", "score"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample: int = SAMPLE, dims: int = DIMS) -> dict:
    """Learn from at most ``sample`` labelled documents whose crc32(id) mod 5 is not 0.

    Rows without id or label are left out; a document labelled more than once takes the
    majority.  Document frequencies are counted over all of ``docs``.
    """
    ship_package(docs.sparkSession)
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y"))
             .filter("doc_id IS NOT NULL AND y IS NOT NULL").filter(crc_mod("doc_id", 5) != 0)
             .groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = (texts.join(F.broadcast(known), "doc_id")  # at most ``sample`` rows
            .select("doc_id", "label", "text").dropDuplicates(["doc_id"])
            .mapInArrow(_sample_batches, "doc_id long, label int, terms binary, counts binary"))
    found = sorted(rows.collect(), key=lambda r: r["doc_id"])
    df = np.zeros(TERMS + 1, dtype=np.int64)
    for r in texts.select("text").mapInArrow(_frequency_batches, "term long, df long").groupBy("term").agg(
            F.sum("df").alias("df")).collect():  # TERMS + 1 rows
        df[r["term"]] = r["df"]
    idf = np.log((1 + df[-1]) / (1 + df[:-1])).astype(np.float32)
    y = np.array([r["label"] for r in found], dtype=np.float64)
    if not found:
        return {"idf": idf, "directions": np.zeros((TERMS, 1), dtype=np.float32),
                "vectors": np.zeros((0, 1), dtype=np.float32), "labels": y, "prior": 0.5}
    doc = np.repeat(np.arange(len(found)), [len(r["terms"]) // 4 for r in found])
    term = np.frombuffer(b"".join(bytes(r["terms"]) for r in found), dtype=np.int32)
    n = np.frombuffer(b"".join(bytes(r["counts"]) for r in found), dtype=np.int32)
    x = weighted(doc, term, n, len(found), idf)
    directions = latent_directions(x, dims)
    return {"idf": idf, "directions": directions, "vectors": _unit(x @ directions), "labels": y,
            "prior": float(y.mean())}


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", sample: int = SAMPLE, dims: int = DIMS, k: int = NEIGHBOURS,
                   threshold: float = THRESHOLD) -> DataFrame:
    """Score every whole text: ``doc_id, held_out, score, predicted`` per input row.

    ``held_out`` marks ids whose crc32 mod 5 is 0 (false for a null id); their labels are
    never learnt.  Null and empty texts, and texts similar to no labelled one, score the
    share of label 1 in the sample (0.5 without any labelled row).  Repeated rows get
    equal scores.  ``result.shared`` is the broadcast model, to be destroyed once the result is
    stored (else it stays for the session).  An empty table gives an empty result; other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col, sample, dims))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = base.mapInArrow(lambda it: _score_batches(it, model.value, k), "doc_id long, score double")
    out = scored.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= F.lit(threshold)).cast("int").alias("predicted"))
    out.shared = model
    return out
