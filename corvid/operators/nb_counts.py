"""Naive Bayes from additive counts.

The multinomial model needs only, per class, the number of rows and the sum of every feature.  ``nb_counts`` reduces
a batch to these (a table that can be stored per day and added up with ``merge_counts``), ``nb_model`` turns the sum
into the closed form and ``nb_score`` applies it.  However rows are split into batches, the model is that of
one fit over all of them, and old rows are never read again.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

# Workers need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PLACE = -1      # place of a class's row count among its sums
MAX_WEIGHTS = 1 << 24  # classes x features of a model that may be sent to all tasks


def nb_counts(df: DataFrame, label: str = "label", features: str = "pixels") -> DataFrame:
    """``(label, place, total)``: per class the sum of each feature, and at place -1 its number of rows.

    Partial sums are formed in each task.  Rows without a label or features are left out; a null feature adds
    nothing; a negative one raises, as the model is one of counts.
    """
    value = F.when(F.col("_v") < 0, F.raise_error(F.lit("naive Bayes needs non-negative features"))).otherwise(F.col("_v"))
    rows = df.filter(F.col(label).isNotNull() & F.col(features).isNotNull()).select(F.col(label).alias("label"),
                                                                                    F.col(features).alias("_f"))
    # the row itself is one more feature
    long = rows.select("label", F.posexplode(F.concat(F.array(F.lit(1.0)), "_f")).alias("_p", "_v"))
    return (long.groupBy("label", (F.col("_p") + F.lit(ROWS_PLACE)).alias("place"))
            .agg(F.sum(value).alias("total")))


def merge_counts(tables: DataFrame | Sequence[DataFrame]) -> DataFrame:
    """Add the counts of disjoint batches (one frame holding many, or several)."""
    if not isinstance(tables, DataFrame):
        tables = reduce(DataFrame.unionByName, tables)
    return tables.groupBy("label", "place").agg(F.sum("total").alias("total"))


def nb_model(counts: DataFrame, smoothing: float = 1.0) -> DataFrame:
    """``(label, place, weight)``: log prior at place -1, else the log probability of the feature in the class."""
    lam = F.lit(float(smoothing))
    counts = merge_counts(counts)
    is_rows = F.col("place") == ROWS_PLACE
    per_class = counts.groupBy("label").agg(F.sum(F.when(is_rows, F.col("total"))).alias("_rows"),
                                            F.sum(F.when(~is_rows, F.col("total"))).alias("_sum"),
                                            F.count(F.when(~is_rows, 1)).alias("_features"))
    # one row per class
    whole = per_class.agg(F.sum("_rows").alias("_all"), F.count(F.lit(1)).alias("_classes"), F.max("_features").alias("_width"))
    per_class = per_class.join(F.broadcast(whole.withColumn("_one", F.lit(1))), F.lit(1) == F.col("_one"))
    prior = F.log(F.col("_rows") + lam) - F.log(F.col("_all") + F.col("_classes") * lam)
    theta = F.log(F.col("total") + lam) - F.log(F.col("_sum") + F.col("_width") * lam)
    return counts.join(F.broadcast(per_class.withColumnRenamed("label", "_label")), F.col("label") == F.col("_label")).select(
        "label", "place", F.when(is_rows, prior).otherwise(theta).alias("weight"))


def nb_score(df: DataFrame, model: DataFrame, features: str = "pixels", out: str = "prediction") -> DataFrame:
    """``df`` with the most probable label (as double; the smallest label on a tie, null where features are missing).

    The model, classes x features of numbers, is checked against ``MAX_WEIGHTS`` and sent to the tasks.
    """
    size = model.count()
    if size > MAX_WEIGHTS:
        raise ValueError(f"a model of {size} weights is too large to send to every task (at most {MAX_WEIGHTS})")
    rows = model.orderBy("label", "place").collect()
    labels = sorted({r.label for r in rows})
    width = max((r.place for r in rows), default=-1) + 1
    prior, theta = np.zeros(len(labels)), np.zeros((len(labels), width))
    at = {label: i for i, label in enumerate(labels)}
    for r in rows:
        if r.place == ROWS_PLACE:
            prior[at[r.label]] = r.weight
        else:
            theta[at[r.label], r.place] = r.weight
    shared = df.sparkSession.sparkContext.broadcast((np.array(labels, dtype=float), prior, theta))
    place = df.columns.index(features)
    schema = StructType([*df.schema.fields, StructField(out, DoubleType())])

    def score(batches):
        names, p, t = shared.value
        for batch in batches:
            column = batch.column(place)
            sizes = np.asarray(column.value_lengths().fill_null(-1))
            whole = np.flatnonzero(sizes == t.shape[1]) if len(names) else np.zeros(0, dtype=int)
            x = column.take(pa.array(whole)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(whole), t.shape[1])
            best = np.full(batch.num_rows, np.nan)
            if len(whole):
                best[whole] = names[(np.nan_to_num(x) @ t.T + p).argmax(axis=1)]
            answer = pa.array(best, mask=np.isnan(best))
            yield pa.RecordBatch.from_arrays([*batch.columns, answer], [*batch.schema.names, out])

    return df.mapInArrow(score, schema)
