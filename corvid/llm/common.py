"""Small shared helpers of the training-data operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.session import ensure_checkpoint_dir

# Deleted / separating white space of the contracts: space and \x09-\x0D (fixed values).
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver imported it from (once per application)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # The driver's file server hands this archive to the executors, so it stays until the driver ends.
    folder = tempfile.mkdtemp(prefix="corvid-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "corvid.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for parent, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(parent, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def _written(df: DataFrame, name: str, by: list[str], options: dict[str, str]) -> str:
    """Write ``df`` in the session's shared checkpoint folder, in folders ``by`` columns; its path."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        writer = df.write.options(**options)
        (writer.partitionBy(*by) if by else writer).parquet(path)
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)
    return path


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as a table in the session's shared checkpoint folder and read it back.

    Cuts the lineage: later stages and lost executors re-read the table instead of
    recomputing it, and every reader sees the same rows.  The shuffle files of its making are deleted
    when it is written (else they stay until the driver's garbage collection).
    """
    path = _written(df, name, [], options)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def stored_by(df: DataFrame, name: str, by: str, values: list[int], **options: str) -> dict[int, DataFrame]:
    """``stored``, as one table (without the column ``by``) for each of the ``values`` of ``by``; released one by one."""
    spark = df.sparkSession
    path = _written(df, name, [by], options)
    schema = df.drop(by).schema
    out = {}
    for value in values:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{by}={value}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)  # a value without rows has none
        out[value] = spark.read.schema(schema).parquet(f"{path}/{by}={value}")
        out[value].scratch_path = f"{path}/{by}={value}"
    return out


def release(df: DataFrame) -> None:
    """Delete a large ``stored`` table once everything that reads it has itself been stored."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def without_blanks(text: Column) -> Column:
    """``text`` without any character of ``[\\x20\\x09-\\x0D]`` (byte-wise replaces, no regex)."""
    for ch in BLANKS:
        text = F.replace(text, F.lit(ch), F.lit(""))
    return text


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(id_col: str, m: int) -> Column:
    """crc32 of the id as text, modulo ``m`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string")) % F.lit(m)
