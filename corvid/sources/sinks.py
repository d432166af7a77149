"""Table writers for keyed sets and sorted sets.

A keyed set or sorted set is stored as parquet clustered by key: rows are
range-partitioned on ``(key, member)`` and sorted within files, so row-group
statistics let a key lookup skip most of the data, and a key that holds a third
of all rows is spread over several files instead of one task.

Updates are appended: each batch of a stream writes its own folder
``stream=<id>/epoch=<n>`` and nothing else, so a replayed batch replaces only itself and
another stream never touches it.  Readers merge at read (newest or summed score per
key); ``compact`` folds the folders of finished streams into one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_keyed_table(df: DataFrame, path: str, keys: Sequence[str], members: Sequence[str] = (),
                      dedupe: bool = True, num_files: int | None = None, mode: str = "overwrite") -> None:
    """Write ``df`` clustered by ``keys`` (then ``members``); ``dedupe`` makes set semantics.

    ``mode='overwrite'`` replaces this path only (the reference's flush of its
    own store, never anything else).
    """
    cols = [*keys, *members]
    n = num_files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *cols)
    if dedupe:  # the range partitioning already clusters (keys, members): no second shuffle
        ranged = ranged.dropDuplicates(cols)
    ranged.sortWithinPartitions(*cols).write.mode(mode).parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str] = ("year",),
                      cluster_by: Sequence[str] = (), num_files: int | None = None,
                      mode: str = "overwrite") -> None:
    """Write ``df`` as ``<col>=<value>/`` directories (e.g. one per year).

    Readers filtering on the partition columns then skip whole directories
    (Spark's partition pruning).  Rows are range-partitioned on the partition
    and cluster columns first, so a value holding a third of the rows is
    written by many tasks, and files are sorted by ``cluster_by`` for row-group
    skipping on those columns.
    """
    cols = [*partition_by, *cluster_by]
    n = num_files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
     .write.mode(mode).partitionBy(*partition_by).parquet(path))


def append_delta(updates: DataFrame, base: str, stream: str, epoch: int, keys: Sequence[str], score: str,
                 combine: str = "max") -> str:
    """Write one batch's ``(keys..., score)`` rows under ``base``, reduced to a row per key; idempotent."""
    folder = f"{base.rstrip('/')}/stream={stream}/epoch={int(epoch)}"
    reduced = updates.groupBy(*keys).agg(_combiner(combine)(score).alias(score))
    reduced.write.mode("overwrite").parquet(folder)
    return folder


def read_merged(spark: SparkSession, base: str, keys: Sequence[str], score: str, combine: str = "max") -> DataFrame:
    """The table under ``base``: all batches of all streams, merged per key (one shuffle)."""
    rows = spark.read.option("basePath", base).parquet(f"{base.rstrip('/')}/stream=*/epoch=*")
    return rows.groupBy(*keys).agg(_combiner(combine)(score).alias(score))


def compact(spark: SparkSession, base: str, out: str, keys: Sequence[str], score: str,
            combine: str = "max") -> DataFrame:
    """Write the merged table to a new ``out`` as one batch, clustered by key.

    Streams may go on appending to ``out`` afterwards; ``base`` is left as it is.  Run it while no stream
    writes to ``base``.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"{out.rstrip('/')}/stream=compacted/epoch=0"
    (read_merged(spark, base, keys, score, combine).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
     .write.mode("overwrite").parquet(folder))
    return read_merged(spark, out, keys, score, combine)


def _combiner(combine: str):
    if combine not in ("max", "sum"):
        raise ValueError("combine must be 'max' or 'sum'")
    return F.max if combine == "max" else F.sum
