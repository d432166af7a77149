"""Column profiles that can be added up: one stored row per column and batch.

``summarize`` reduces a batch (a day, a file, a partition) to one row per column with exact counts and bounds and two
mergeable sketches of bounded size: HyperLogLog of the distinct text and KLL of the numeric values.  ``merge`` adds any
number of summaries, in any grouping and order, and ``read`` turns the sum into a profile: a new day costs a pass
over that day, never over the history.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators.profile import _col, _parsed, _unpivot_one_row

# Stated sizes: HLL of 2^12 buckets (standard error 1.6 %), KLL with k=400 (rank error under 1 % at 99 %).
DISTINCT_LG_K = 12
QUANTILE_K = 400
QUANTILES = (0.25, 0.5, 0.75)

_FIELDS = ("non_empty", "n_bad", "n_values", "min", "max", "total", "distinct_sketch", "quantile_sketch")


def summarize(df: DataFrame, columns: Sequence[str] | None = None, lg_k: int = DISTINCT_LG_K,
              k: int = QUANTILE_K) -> DataFrame:
    """One row per column, in one aggregate: ``col_name``, exact ``non_empty, n_bad, n_values, min, max, total`` and
    the sketches.  Text semantics as in ``profile``: a null counts as the empty text among the distinct values, a
    non-empty value that is no number as bad; NaN is a number but stands in no quantile.
    """
    cols = list(columns or df.columns)
    aggs = []
    for i, c in enumerate(cols):
        v, ne, bad = _parsed(df, c)
        text = F.coalesce(_col(c).cast("string"), F.lit(""))
        ordered = F.when(~F.isnan(v), v)
        aggs += [a.alias(f"_{i}_{f}") for f, a in zip(_FIELDS, (
            F.count_if(ne), F.count_if(bad), F.count(v), F.min(v), F.max(v), F.sum(v), F.hll_sketch_agg(text, F.lit(lg_k)),
            F.kll_sketch_agg_double(ordered, F.lit(k))))]
    return _unpivot_one_row(df.agg(*aggs), cols, _FIELDS)


def merge(summaries: DataFrame | Sequence[DataFrame]) -> DataFrame:
    """Add summaries of disjoint batches (one frame holding many, or several): one row per column again."""
    if not isinstance(summaries, DataFrame):
        summaries = reduce(DataFrame.unionByName, summaries)
    return summaries.groupBy("col_name").agg(
        F.sum("non_empty").alias("non_empty"), F.sum("n_bad").alias("n_bad"), F.sum("n_values").alias("n_values"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.sum("total").alias("total"),
        F.hll_union_agg("distinct_sketch", F.lit(True)).alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))


def read(summary: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """The profile a summary stands for: ``col_name, non_empty, n_bad, n_distinct, min, max, avg, quantiles``.

    ``n_distinct`` and ``quantiles`` (an array) are estimates; the rest is exact.  Numbers are null for a column
    that is not numeric (no value, or one that does not parse).
    """
    numeric = (F.col("non_empty") > 0) & (F.col("n_bad") == 0)
    # a column of NaN only has an empty sketch
    ranked = F.kll_sketch_get_n_double("quantile_sketch") > 0
    points = F.array(*[F.lit(float(q)) for q in quantiles])
    return summary.select(
        "col_name", "non_empty", "n_bad", F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"),
        F.when(numeric, F.col("min")).alias("min"), F.when(numeric, F.col("max")).alias("max"),
        F.when(numeric, F.try_divide("total", "n_values")).alias("avg"),
        F.when(numeric & ranked, F.kll_sketch_get_quantile_double("quantile_sketch", points)).alias("quantiles"))
