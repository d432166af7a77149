"""Toxicity: cumulative-link ordinal regression on sparse text features.

``P(grade <= j | x) = sigmoid(theta_j - w . x)``: one weight per feature is shared by all
grades, and the thresholds ``theta_0 < theta_1 < ...`` cut the common scale.  Features are the
distinct words of the whole text and their leading letters (inflected forms share them),
hashed.  The model is fitted on a bounded sample of
labelled documents (``sample`` rows picked by a hash of the id, crc32(id) mod 5 not 0)
with an L1 penalty, so only telling words keep a weight, and scores every document with
its expected severity, the sum over grades of ``P(grade > j)``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm import text_np as tn
from corvid.llm.common import crc_mod, ship_package

BITS = 20
FEATURES = 1 << BITS
STEMS = (4, 5, 6)  # leading bytes of longer words that are features too
SAMPLE = 8192
PENALTY = 1.5
MIN_DOCS = 3
ROUNDS, RATE = 300, 0.1


def word_features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed words and word stems per text: (features, features per text)."""
    h, start, end, counts = tn.words(raw, offsets, tn.ALNUM)
    doc = np.repeat(np.arange(len(counts)), counts).astype(np.uint64)
    keys = [doc << tn.U(BITS) | (h & tn.U(FEATURES - 1))]
    low = tn.LOWER[raw]
    for size in STEMS:
        longer = np.flatnonzero(end - start > size)
        stem = tn.mix(tn.span_hashes(low, start[longer], start[longer] + size) + tn.U(size))
        keys.append(doc[longer] << tn.U(BITS) | (stem & tn.U(FEATURES - 1)))
    key = np.sort(np.concatenate(keys))
    if len(key):
        key = key[np.append(True, key[1:] != key[:-1])]
    return ((key & tn.U(FEATURES - 1)).astype(np.int32),
            np.bincount((key >> tn.U(BITS)).astype(np.int64), minlength=len(counts)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _dot(w: np.ndarray, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of the weights of each text's features."""
    out = np.zeros(len(counts))
    full = np.flatnonzero(counts)
    if len(full):
        out[full] = np.add.reduceat(w.astype(np.float32)[features], (np.cumsum(counts) - counts)[full])
    return out


def fit_ordinal(features: np.ndarray, counts: np.ndarray, grade: np.ndarray, grades: int, size: int,
                penalty: float = PENALTY, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights (``size``) and the ``grades - 1`` ascending thresholds, by proximal steps with
    averaged, scaled gradients and a falling rate."""
    w = np.zeros(size)
    below = np.array([(grade <= j).mean() for j in range(grades - 1)]).clip(1e-3, 1 - 1e-3)
    theta = np.maximum.accumulate(np.log(below / (1 - below)) + 1e-3 * np.arange(grades - 1))
    mean_w, mean_t, sq_w, sq_t = np.zeros(size), np.zeros(grades - 1), np.zeros(size), np.zeros(grades - 1)
    for k in range(1, rounds + 1):
        rate = RATE * (1 - (k - 1) / rounds)
        z = _dot(w, features, counts)
        cut = np.concatenate(([-np.inf], theta, [np.inf]))
        hi, lo = _sigmoid(cut[grade + 1] - z), _sigmoid(cut[grade] - z)
        p = np.maximum(hi - lo, 1e-12)
        dhi, dlo = hi * (1 - hi) / p, lo * (1 - lo) / p
        g = dhi - dlo  # of the negative log likelihood by z
        gw = np.bincount(features, weights=np.repeat(g, counts), minlength=size)
        gt = np.array([dlo[grade == j + 1].sum() - dhi[grade == j].sum() for j in range(grades - 1)])
        mean_w, sq_w = 0.9 * mean_w + 0.1 * gw, 0.99 * sq_w + 0.01 * gw ** 2
        mean_t, sq_t = 0.9 * mean_t + 0.1 * gt, 0.99 * sq_t + 0.01 * gt ** 2
        step = rate / (np.sqrt(sq_w / (1 - 0.99 ** k)) + 1e-8)
        w = w - step * mean_w / (1 - 0.9 ** k)
        w = np.sign(w) * np.maximum(np.abs(w) - step * penalty, 0)
        theta = theta - rate / (np.sqrt(sq_t / (1 - 0.99 ** k)) + 1e-8) * mean_t / (1 - 0.9 ** k)
        theta = np.maximum.accumulate(theta) + 1e-6 * np.arange(grades - 1)
    return w, theta


def _sample_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, raw, off in tn.slices(batch.column(2)):
            features, counts = word_features(raw, off)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                 tn.binary_column(features, np.cumsum(counts))], ["doc_id", "grade", "features"])


def fit(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text",
        sample: int = SAMPLE) -> dict:
    """Fit on at most ``sample`` labelled documents; grades are the label's whole numbers from 0."""
    ship_package(docs.sparkSession)
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("grade"))
             .filter("doc_id IS NOT NULL AND grade >= 0").filter(crc_mod("doc_id", 5) != 0)
             .groupBy("doc_id").agg(F.max("grade").alias("grade"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .join(F.broadcast(known), "doc_id")  # at most ``sample`` rows
            .select("doc_id", "grade", "text").dropDuplicates(["doc_id"])
            .mapInArrow(_sample_batches, "doc_id long, grade int, features binary"))
    found = sorted(rows.collect(), key=lambda r: r["doc_id"])
    grade = np.array([r["grade"] for r in found], dtype=np.int64)
    grades = int(grade.max()) + 1 if len(grade) else 1
    if grades < 2:
        return {"features": np.zeros(0, dtype=np.int32), "weights": np.zeros(0), "theta": np.zeros(0)}
    counts = np.array([len(r["features"]) // 4 for r in found])
    features = np.frombuffer(b"".join(bytes(r["features"]) for r in found), dtype=np.int32)
    common = np.flatnonzero(np.bincount(features, minlength=FEATURES) >= MIN_DOCS)
    place = np.full(FEATURES, -1, dtype=np.int32)
    place[common] = np.arange(len(common))
    code = place[features]
    known_counts = np.diff(np.concatenate(([0], np.cumsum(code >= 0)))[np.concatenate(([0], np.cumsum(counts)))])
    del features, found, rows
    w, theta = fit_ordinal(code[code >= 0], known_counts, grade, grades, len(common))
    kept = np.flatnonzero(w)
    return {"features": common[kept].astype(np.int32), "weights": w[kept], "theta": theta}


def _score_batches(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    weights = np.zeros(FEATURES)
    weights[model["features"]] = model["weights"]
    theta = model["theta"]
    for batch in batches:
        for lo, hi, raw, off in tn.slices(batch.column(1)):
            z = _dot(weights, *word_features(raw, off))
            above = _sigmoid(z[:, None] - theta[None, :])  # P(grade > j)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(above.sum(axis=1)),
                 pa.array((above >= 0.5).sum(axis=1).astype(np.int32))], ["doc_id", "severity", "predicted"])


def severity_scores(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
                    text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """Score every whole text: ``doc_id, held_out, severity, predicted`` per input row.

    ``severity`` is the expected grade, ``predicted`` the median grade.  Null and empty texts
    get the severity of a text without telling words.  Labels without id or grade are left
    out, a document with several labels takes the highest; without two different grades every
    severity is 0.  Repeated rows get equal scores; ``held_out`` (crc32(id) mod 5 is 0) is false
    for a null id.  An empty table gives an empty result; other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, label_col, id_col, text_col, sample))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = base.mapInArrow(lambda it: _score_batches(it, model.value), "doc_id long, severity double, predicted int")
    return scored.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                         "severity", "predicted")
