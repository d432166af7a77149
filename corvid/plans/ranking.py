"""Row numbers within groups that stay distributed whatever the size of a group.

``row_number().over(Window.partitionBy(key).orderBy(...))`` sends every row of a
key to one task.  Here every input goes the same way:

1. Spark's range partitioning on the full tuple (keys, order columns) cuts the table into ordered ranges: a hot key,
   equal scores and text orders are cut like anything else; only rows equal in the whole tuple stay together;
2. the rows are written once to the checkpoint folder with the number of their range, and reread, so every pass and
   every re-run after a lost executor sees the same ranges;
3. rows are numbered within (key, range), and the row count of the key's earlier
   ranges is added: at most one row per key and range.

Spark's sample decides how even the ranges are, never the result.  The number of ranges follows the shuffle
partitions; small neighbouring ranges are merged by the adaptive planner, which keeps their order.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvid.session import ensure_checkpoint_dir


def _ranged(df: DataFrame, cols: list[str], ranges: int | None) -> DataFrame:
    """``df`` with ``_range``, the number of its range in the order of ``cols``, stored."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ranking-{uuid.uuid4().hex}"
    cut = df.repartitionByRange(ranges, *cols) if ranges else df.repartitionByRange(*cols)
    cut = cut.withColumn("_range", F.spark_partition_id())
    cut.write.parquet(path)
    return spark.read.schema(cut.schema).parquet(path)


def row_number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "rank",
                      ranges: int | None = None) -> DataFrame:
    """Append ``out`` = 1-based position of each row within its ``keys`` group.

    ``order`` lists column names of any orderable types, ascending (nulls first, as in a
    window); it must make rows unique within a group (add a tie-breaker) for the
    numbering to be deterministic.  ``ranges`` (default: the session's shuffle
    partitions, merged where they are small) is how many ranges the whole table is cut into.
    """
    keys, order = list(keys), list(order)
    ranged = _ranged(df, [*keys, *order], ranges)
    # Repartition on (keys, range) explicitly: a partitioning by the keys alone would
    # otherwise be reused and number a hot key in one task.
    place = [*[F.col(k) for k in keys], F.col("_range")]
    spread = ranged.repartition(ranges, *place) if ranges else ranged.repartition(*place)
    local = spread.withColumn("_lrn", F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*order)))
    counts = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_r"),
                            F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    same = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):  # a null key is a group of its own, as in a window
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return (local.join(offsets, same)
            .withColumn(out, (F.col("_off") + F.col("_lrn")).cast("long"))
            .select(*df.columns, out))
