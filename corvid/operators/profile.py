"""Column profile of any DataFrame: min / max / avg / non-empty / distinct.

Two passes whatever the column count (the reference looped over the rows five
times per column):

* the wide pass: one aggregate (partial + final, a single row shuffled per task) over
  every column gives min, max, avg, non-empty and unparseable counts (and, with
  ``approx``, HyperLogLog++ distinct counts); the one-row result is unpivoted;
* the distinct pass: each column is read once more, unpivoted to ``(column, value)`` in
  groups of at most ``GROUP_COLUMNS`` columns of one key type and deduplicated map-side before the
  shuffle, which is spread over all distinct values.

Text semantics (the reference reads CSV as text): a value is *empty* when null
or ``''``; distinct counts are textual (``'1'`` and ``'1.0'`` differ, the empty
value counts once); a column is numeric when it has a non-empty value and every
non-empty value parses as a double.  Unparseable values are counted (``n_bad``)
instead of aborting.  NaN follows Spark: ``min`` skips it, ``max`` returns it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, ByteType, DateType, DoubleType, IntegerType,
                               LongType, NumericType, ShortType, TimestampNTZType, TimestampType)

from corvid.functions.text import parse_double


def _col(name: str):
    """A column by its exact name (CSV headers may hold dots, spaces, backticks)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _type(df: DataFrame, name: str):
    return next(f.dataType for f in df.schema.fields if f.name == name)


def as_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Every column cast to string: the table as a CSV reader would give it."""
    cols = list(columns or df.columns)
    return df.select(*[_col(c).cast("string").alias(c) for c in cols])


# Types whose text always parses back to the same double as a direct cast
# (integers and doubles print exactly; float does not: '0.1' != (double) 0.1f).
_EXACT_NUMERIC = (ByteType, ShortType, IntegerType, LongType, DoubleType)
# Types whose text never parses as a number ('1995-01-02 00:00:00', 'true', ...).
_NEVER_NUMERIC = (DateType, TimestampType, TimestampNTZType, BooleanType, BinaryType)


def _parsed(df: DataFrame, c: str):
    """``(value as double or null, text is non-empty, text is non-empty and unparseable)``.

    The same as casting the column to text and parsing it back, without the
    round trip where the type decides the answer.
    """
    t = _type(df, c)
    col = _col(c)
    if isinstance(t, _EXACT_NUMERIC):
        return col.cast("double"), col.isNotNull(), F.lit(False)
    if isinstance(t, _NEVER_NUMERIC):
        return F.lit(None).cast("double"), col.isNotNull(), col.isNotNull()
    text = col.cast("string")
    v = parse_double(text)
    ne = text.isNotNull() & (text != F.lit(""))
    return v, ne, ne & v.isNull()


def _unpivot_one_row(row_df: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn the one-row wide aggregate (aliases ``_<i>_<field>``) into one row per column."""
    structs = [F.struct(F.lit(c).alias("col_name"),
                        *[F.col(f"_{i}_{f}").alias(f) for f in fields]) for i, c in enumerate(columns)]
    return row_df.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


GROUP_COLUMNS = 16
_FIELDS = ("min", "max", "avg", "ne", "bad")


def _wide(df: DataFrame, cols: Sequence[str], rsd: float | None = None) -> DataFrame:
    """One row per column: ``col_name, min, max, avg, ne, bad`` (and ``approx`` with ``rsd``), in one aggregate."""
    aggs = []
    for i, c in enumerate(cols):
        v, ne, bad = _parsed(df, c)
        aggs += [F.min(v).alias(f"_{i}_min"), F.max(v).alias(f"_{i}_max"), F.avg(v).alias(f"_{i}_avg"),
                 F.count_if(ne).alias(f"_{i}_ne"), F.count_if(bad).alias(f"_{i}_bad")]
        if rsd is not None:
            text = F.coalesce(_col(c).cast("string"), F.lit(""))
            aggs.append(F.approx_count_distinct(text, rsd).alias(f"_{i}_approx"))
    fields = [*_FIELDS, "approx"] if rsd is not None else _FIELDS
    return _unpivot_one_row(df.agg(*aggs), cols, fields)


def profile_numeric(df: DataFrame, columns: Sequence[str] | None = None,
                    typed: bool = False) -> DataFrame:
    """``(col_name, min, max, avg)`` for the numeric columns of ``df``.

    ``typed=False`` (default) gives every column text semantics (numeric when
    every non-empty value parses); ``typed=True`` takes numeric columns by
    their Spark type.
    """
    cols = list(columns or df.columns)
    if typed:
        cols = [c for c in cols if isinstance(_type(df, c), NumericType)]
        if not cols:
            return df.sparkSession.createDataFrame([], "col_name string, min double, max double, avg double")
        aggs = []
        for i, c in enumerate(cols):
            v = _col(c).cast("double")
            aggs += [F.min(v).alias(f"_{i}_min"), F.max(v).alias(f"_{i}_max"),
                     F.avg(v).alias(f"_{i}_avg"), F.count(v).alias(f"_{i}_n")]
        long = _unpivot_one_row(df.agg(*aggs), cols, ["min", "max", "avg", "n"])
        return long.filter(F.col("n") > 0).select("col_name", "min", "max", "avg")
    return _numeric_of(_wide(df, cols))


def _numeric_of(wide: DataFrame) -> DataFrame:
    return (wide.filter((F.col("ne") > 0) & (F.col("bad") == 0))
            .select("col_name", "min", "max", "avg"))


def _distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(col_name, n_distinct)``: exact counts of each column's distinct text.

    Integers and doubles are compared as numbers (cheaper than formatting them):
    their text is unique per value, except that ``-0.0`` and ``0.0`` print
    differently while comparing equal, so a negative zero is told by its bits.  NaN
    prints as one text and Spark groups all NaNs as one.  Other types use their text.
    A null is the empty text (of its own: no number prints as it).
    """
    groups: dict[str, list[tuple[str, object]]] = {"long": [], "double": [], "string": []}
    for c in cols:
        t, v = _type(df, c), _col(c)
        if isinstance(t, (ByteType, ShortType, IntegerType, LongType)):
            groups["long"].append((c, v.cast("long")))
        elif isinstance(t, DoubleType):
            groups["double"].append((c, v))
        else:
            groups["string"].append((c, F.coalesce(v.cast("string"), F.lit(""))))
    out = None
    for kind, members in groups.items():
        for at in range(0, len(members), GROUP_COLUMNS):
            part = members[at:at + GROUP_COLUMNS]
            long = df.select(*[v.alias(f"_{i}") for i, (_, v) in enumerate(part)]).unpivot(
                [], [f"_{i}" for i in range(len(part))], "_pos", "_v")
            key = [F.col("_v")]
            if kind == "double":
                key.append((F.col("_v") == F.lit(0.0)) & F.col("_v").cast("string").startswith("-"))
            values = long.select("_pos", *[k.alias(f"_k{i}") for i, k in enumerate(key)]).distinct()
            names = F.array(*[F.lit(c) for c, _ in part])
            counts = values.groupBy("_pos").agg(F.count(F.lit(1)).alias("n_distinct")).select(
                F.get(names, F.substring("_pos", 2, 10).cast("int")).alias("col_name"), "n_distinct")
            out = counts if out is None else out.unionByName(counts)
    return out


def _counted(df: DataFrame, cols: Sequence[str], approx: bool, rsd: float) -> DataFrame:
    """``_wide`` with ``n_distinct``."""
    wide = _wide(df, cols, rsd if approx else None)
    if approx:
        return wide.withColumnRenamed("approx", "n_distinct")
    # one row per column of df on either side
    return wide.join(F.broadcast(_distinct_counts(df, cols)), "col_name", "left").withColumn(
        "n_distinct", F.coalesce("n_distinct", F.lit(0)))


def profile_counts(df: DataFrame, columns: Sequence[str] | None = None,
                   approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """``(col_name, non_empty, n_distinct, n_bad)`` for every column (text semantics).

    ``n_bad`` counts non-empty values that do not parse as a double.
    """
    cols = list(columns or df.columns)
    return _counted(df, cols, approx, rsd).select(
        "col_name", F.col("ne").alias("non_empty"), F.col("n_distinct").cast("long"), F.col("bad").alias("n_bad"))


def profile(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """Both profiles side by side: ``(col_name, non_empty, n_distinct, n_bad, min, max, avg)``."""
    cols = list(columns or df.columns)
    numeric = (F.col("ne") > 0) & (F.col("bad") == 0)
    return _counted(df, cols, approx, rsd).select(
        "col_name", F.col("ne").alias("non_empty"), F.col("n_distinct").cast("long"), F.col("bad").alias("n_bad"),
        *[F.when(numeric, F.col(c)).alias(c) for c in ("min", "max", "avg")])
