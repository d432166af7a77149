"""CSV readers for the reference's inputs.

All readers take an explicit schema (no ``inferSchema``: inference is an extra
pass over the data) and keep values as text unless types are given, since the
reference compares and parses text.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corvid.plans.joins import broadcast_if_small

# Fixed values of the weather files: positional column names (the files have no
# header) and the years of the per-year file family, 1975 to 2015 inclusive.
WEATHER_OBS_COLUMNS = ("STATION", "WBAN", "MONTH", "DAY", "TEMP")
WEATHER_STATION_COLUMNS = ("STATION", "WBAN", "LAT", "LON")
FIRST_YEAR, LAST_YEAR = 1975, 2015


def _text_schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


def _reader(spark: SparkSession, multi_line: bool):
    """Quotes as spreadsheet programs and pandas write them: doubled inside a quoted field.

    ``multi_line`` also reads line breaks inside quotes.  A file is then one task, so
    large inputs should come as many files.
    """
    return (spark.read.option("quote", '"').option("escape", '"')
            .option("multiLine", str(multi_line).lower()))


def read_headerless_csv(spark: SparkSession, path: str | list[str], names: Sequence[str],
                        multi_line: bool = False) -> DataFrame:
    """Headerless CSV with positional column names, all text (``csv(path).toDF(names*)``).

    Short rows are padded with nulls, extra fields dropped (PERMISSIVE mode).
    """
    return _reader(spark, multi_line).schema(_text_schema(names)).option("header", "false").csv(path)


_YEAR_FILE = re.compile(r"(\d{4})(?:\.[A-Za-z]+)*")


def _files_in_years(spark: SparkSession, path: str, first_year: int | None, last_year: int | None) -> list[str]:
    """Paths of the ``<year>.<extension>`` files under ``path`` (dir or glob) within the years.

    Only names are listed (through the Hadoop FileSystem, as Spark's own file
    index does), so files outside the range are never opened.  Hidden files (``_`` or
    ``.`` first) and names without a digit (a ``stations.csv`` beside them) are no year
    files; a name with digits that is not exactly a year raises.
    """
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    statuses = fs.globStatus(hpath) or []
    files = []
    for st in statuses:
        for f in (fs.listStatus(st.getPath()) if st.isDirectory() else [st]):
            name = f.getPath().getName()
            if f.isDirectory() or name[0] in "_." or not any(ch.isdigit() for ch in name):
                continue
            m = _YEAR_FILE.fullmatch(name)
            if not m:
                raise ValueError(f"{f.getPath().toString()}: the name of a year file must be <year>.<extension>")
            if (first_year is None or first_year <= int(m.group(1))) and \
                    (last_year is None or int(m.group(1)) <= last_year):
                files.append(f.getPath().toString())
    return sorted(files)


def read_year_files(spark: SparkSession, path: str, names: Sequence[str] = WEATHER_OBS_COLUMNS,
                    first_year: int | None = None, last_year: int | None = None,
                    year_col: str = "year") -> DataFrame:
    """One table over a family of per-year files (``<dir>/1986.csv`` ...).

    ``path`` is a directory or glob; the year is the file's name.  All years are read
    unless ``first_year`` / ``last_year`` are given; files outside them are pruned from
    the listing before the scan.  (Data laid out as ``year=YYYY/`` directories needs
    none of this: Spark's partition discovery and pruning apply.)
    """
    files = _files_in_years(spark, path, first_year, last_year)
    if not files:
        return spark.createDataFrame([], _text_schema(names).add(year_col, "int"))
    df = read_headerless_csv(spark, files, names)
    year = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d{4})", 1).cast("int")
    return df.withColumn(year_col, year)


def read_header_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with a header row; every column text (the reference's string grid)."""
    header = _reader(spark, multi_line).option("header", "true").csv(path).columns
    return _reader(spark, multi_line).schema(_text_schema(header)).option("header", "true").csv(path)


def read_indexed_csv(spark: SparkSession, path: str, types: Mapping[str, str] | None = None,
                     multi_line: bool = True, position_col: str | None = None) -> DataFrame:
    """Header CSV whose first column is a row index written by pandas: dropped by position.

    The index header cell is empty, so Spark names it ``_c0``; it is removed by
    position whatever its name.  ``types`` casts named columns (``try_cast``,
    bad values become null).  ``position_col`` keeps the order the index stands for: the
    row's place over all files, by file path and then index (a bigint; null where the
    index is not a number), whatever partitions the rows are read in.
    """
    df = read_header_csv(spark, path, multi_line)
    index = df.columns[0]
    rest = df.columns[1:]
    if position_col:
        rows = df.select("*", F.col("_metadata.file_path").alias("_file"),
                         F.col(f"`{index}`").try_cast("bigint").alias("_at"))
        # one row per file: the place where it begins
        sizes = rows.groupBy("_file").agg((F.coalesce(F.max("_at"), F.lit(-1)) + 1).alias("_size"))
        before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
        begins = sizes.select("_file", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_begin"))
        small = broadcast_if_small(begins)
        df = rows.join(small if small is not None else begins, "_file").withColumn(
            position_col, F.col("_begin") + F.col("_at")).select(*[f"`{c}`" for c in rest], position_col)
    else:
        df = df.drop(index)
    for name, t in (types or {}).items():
        df = df.withColumn(name, F.col(name).try_cast(t))
    return df
