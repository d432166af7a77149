"""Registered profile queries: the whole ``lineitem`` table with text semantics."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.operators import profile, profile_sketch
from corvid.plans.registry import register
from corvid.plans.standins import table

PROFILE_TABLE = "lineitem"
PROFILE_COLUMNS = ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice "
                   "l_discount l_tax l_returnflag l_linestatus l_shipdate").split()


def _text(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


def _nonempty(c: str) -> str:
    return f"({_text(c)} IS NOT NULL AND {_text(c)} <> '')"


def _numeric_sql() -> str:
    parts = []
    for c in PROFILE_COLUMNS:
        v = f"TRY_CAST({_text(c)} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS col_name, min({v}) AS min, max({v}) AS max, round(avg({v}), 6) AS avg "
            f"FROM {PROFILE_TABLE} HAVING count(CASE WHEN {_nonempty(c)} THEN 1 END) > 0 "
            f"AND count(CASE WHEN {_nonempty(c)} AND {v} IS NULL THEN 1 END) = 0")
    return "\nUNION ALL\n".join(parts)


def _counts_sql() -> str:
    parts = []
    for c in PROFILE_COLUMNS:
        parts.append(
            f"SELECT '{c}' AS col_name, count(CASE WHEN {_nonempty(c)} THEN 1 END) AS non_empty, "
            f"count(DISTINCT coalesce({_text(c)}, '')) AS n_distinct, "
            f"count(CASE WHEN {_nonempty(c)} AND TRY_CAST({_text(c)} AS DOUBLE) IS NULL THEN 1 END) AS n_bad "
            f"FROM {PROFILE_TABLE}")
    return "\nUNION ALL\n".join(parts)


@register("profile_numeric", sql=_numeric_sql())
def profile_numeric(spark, sf_dir):
    """P10+A3-A5: min / max / avg of the columns whose every value (as text) parses as a number."""
    df = table(spark, sf_dir, PROFILE_TABLE).select(*PROFILE_COLUMNS)
    out = profile.profile_numeric(df)
    return out.select("col_name", "min", "max", F.round("avg", 6).alias("avg"))


@register("profile_counts", sql=_counts_sql())
def profile_counts(spark, sf_dir):
    """A6+A7: non-empty and exact textual distinct counts of every column."""
    df = table(spark, sf_dir, PROFILE_TABLE).select(*PROFILE_COLUMNS)
    return profile.profile_counts(df)


ORDERS_COLUMNS = ("o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority").split()


def _full_sql(table_name: str, columns) -> str:
    parts = []
    for c in columns:
        v = f"TRY_CAST({_text(c)} AS DOUBLE)"
        ne = _nonempty(c)
        parts.append(
            f"SELECT '{c}' AS col_name, count(CASE WHEN {ne} THEN 1 END) AS non_empty, "
            f"count(DISTINCT coalesce({_text(c)}, '')) AS n_distinct, "
            f"count(CASE WHEN {ne} AND {v} IS NULL THEN 1 END) AS n_bad, "
            f"CASE WHEN count(CASE WHEN {ne} THEN 1 END) > 0 AND count(CASE WHEN {ne} AND {v} IS NULL THEN 1 END) = 0 "
            f"THEN min({v}) END AS min, "
            f"CASE WHEN count(CASE WHEN {ne} THEN 1 END) > 0 AND count(CASE WHEN {ne} AND {v} IS NULL THEN 1 END) = 0 "
            f"THEN max({v}) END AS max, "
            f"CASE WHEN count(CASE WHEN {ne} THEN 1 END) > 0 AND count(CASE WHEN {ne} AND {v} IS NULL THEN 1 END) = 0 "
            f"THEN round(avg({v}), 6) END AS avg "
            f"FROM {table_name}")
    return "\nUNION ALL\n".join(parts)


@register("profile_orders", sql=_full_sql("orders", ORDERS_COLUMNS))
def profile_orders(spark, sf_dir):
    """A3-A7 on a second table: the combined profile (counts and numeric stats) of ``orders``."""
    df = table(spark, sf_dir, "orders").select(*ORDERS_COLUMNS)
    out = profile.profile(df)
    return out.select("col_name", "non_empty", "n_distinct", "n_bad", "min", "max",
                      F.round("avg", 6).alias("avg"))


# Lineitem in three batches by ship date, each summarised on its own.
SKETCH_CUTS = ("1996-01-01 00:00:00", "1998-01-01 00:00:00")
# Stated errors of the sketches that the query holds its estimates to.
DISTINCT_ERROR, RANK_ERROR = 0.06, 0.02


def _sketch_sql() -> str:
    parts = []
    for c in PROFILE_COLUMNS:
        v = f"TRY_CAST({_text(c)} AS DOUBLE)"
        bad = f"count(CASE WHEN {_nonempty(c)} AND {v} IS NULL THEN 1 END)"
        ok = f"count(CASE WHEN {_nonempty(c)} THEN 1 END) > 0 AND {bad} = 0"
        parts.append(
            f"SELECT '{c}' AS col_name, count(CASE WHEN {_nonempty(c)} THEN 1 END) AS non_empty, {bad} AS n_bad, "
            f"CASE WHEN {ok} THEN min({v}) END AS min, CASE WHEN {ok} THEN max({v}) END AS max, "
            f"CASE WHEN {ok} THEN round(avg({v}), 4) END AS avg, true AS distinct_close, "
            f"CASE WHEN {ok} THEN true END AS median_close FROM {PROFILE_TABLE}")
    return "\nUNION ALL\n".join(parts)


@register("profile_merged", sql=_sketch_sql())
def profile_merged(spark, sf_dir):
    """A3-A7 added up: the profile of three batches from their stored summaries alone.

    Counts, bounds and averages are exact; the flags say whether the estimates keep the stated errors against an
    exact distinct count and the exact rank of the estimated median.
    """
    df = table(spark, sf_dir, PROFILE_TABLE).select(*PROFILE_COLUMNS)
    first, second = (F.col("l_shipdate") < F.lit(cut).cast("timestamp_ntz") for cut in SKETCH_CUTS)
    late = F.coalesce(~second, F.lit(True))  # rows without a date come with the last batch
    batches = [df.filter(first), df.filter(~first & second), df.filter(late)]
    merged = profile_sketch.read(profile_sketch.merge([profile_sketch.summarize(b) for b in batches]), [0.5])
    exact = profile.profile_counts(df).select("col_name", F.col("n_distinct").alias("_exact"))
    out = merged.join(F.broadcast(exact), "col_name")  # one row per column
    medians = F.broadcast(out.select("col_name", F.col("quantiles")[0].alias("_median")))
    values = df.select(*[F.col(c).cast("string").alias(c) for c in PROFILE_COLUMNS]).unpivot(
        [], PROFILE_COLUMNS, "col_name", "_text")
    number = F.expr("try_cast(_text AS double)")
    ranks = (values.join(medians, "col_name").filter(F.col("_median").isNotNull())
             .groupBy("col_name").agg((F.count_if(number < F.col("_median")) / F.count(number)).alias("_below"),
                                      (F.count_if(number <= F.col("_median")) / F.count(number)).alias("_upto")))
    out = out.join(F.broadcast(ranks), "col_name", "left")
    close = (F.col("_below") <= 0.5 + RANK_ERROR) & (F.col("_upto") >= 0.5 - RANK_ERROR)
    return out.select("col_name", "non_empty", "n_bad", "min", "max", F.round("avg", 4).alias("avg"),
                      (F.abs(F.col("n_distinct") - F.col("_exact")) <= F.lit(DISTINCT_ERROR) * F.col("_exact")).alias("distinct_close"),
                      close.alias("median_close"))
