"""Registered queries of the readers and writers, over files written from the given tables.

Each query first writes its files with Spark, in the formats the readers expect, to a new folder beside
the session's checkpoints, and returns what the library reads from them.  The folder stays, as the
returned rows still read it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.operators import feed
from corvid.plans.q_feed import _CTES
from corvid.plans.registry import register
from corvid.plans.standins import (EDGES_SQL, OBSERVATIONS_SQL, STATIONS_SQL, follow_edges, table, tweets,
                                   weather_observations, weather_stations)
from corvid.session import ensure_checkpoint_dir
from corvid.sources.csv import (WEATHER_OBS_COLUMNS, WEATHER_STATION_COLUMNS, read_header_csv, read_headerless_csv,
                                read_indexed_csv, read_year_files)
from corvid.sources.images import list_files
from corvid.sources.sinks import write_keyed_table

# Years that the year-file query reads; files of other years are not opened.
YEARS_READ = (1993, 1996)
# Folders over which the year files are spread, so that a year is not one task.
YEAR_SHARDS = 4


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/files-{name}-{uuid.uuid4().hex}"


def _write_csv(df: DataFrame, path: str, header: bool) -> str:
    """CSV as pandas writes it: quotes doubled inside a quoted field."""
    df.write.option("quote", '"').option("escape", '"').option("header", str(header).lower()).csv(path)
    return path


def _write_year_files(spark: SparkSession, sf_dir: str) -> str:
    """``shard=<k>/<year>.csv`` files of the observations, headerless, columns in the fixed order."""
    base = _folder(spark, "years")
    rows = weather_observations(spark, sf_dir)
    (rows.select(*[name.lower() for name in WEATHER_OBS_COLUMNS], "year",
                 (F.col("station").cast("int") % YEAR_SHARDS).alias("shard"))
     .repartition("shard", "year").write.partitionBy("shard", "year").csv(base))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for st in fs.globStatus(path(f"{base}/shard=*/year=*/part-*")):
        year = st.getPath().getParent()
        if not fs.rename(st.getPath(), path(year.getParent(), f"{year.getName()[len('year='):]}.csv")):
            raise RuntimeError(f"{st.getPath().toString()} could not be renamed")
        fs.delete(year, True)
    return base


@register("csv_headerless", sql=f"""SELECT station, wban, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon
    FROM ({STATIONS_SQL})""")
def csv_headerless(spark, sf_dir):
    """Headerless CSV with positional names; empty fields are null."""
    path = _write_csv(weather_stations(spark, sf_dir), _folder(spark, "stations"), header=False)
    df = read_headerless_csv(spark, path, WEATHER_STATION_COLUMNS)
    return df.select(F.col("STATION").alias("station"), F.col("WBAN").alias("wban"),
                     F.col("LAT").try_cast("double").alias("lat"), F.col("LON").try_cast("double").alias("lon"))


@register("csv_years", sql=f"""SELECT station, wban, month, day, temp, year FROM ({OBSERVATIONS_SQL})
    WHERE year BETWEEN {YEARS_READ[0]} AND {YEARS_READ[1]}""")
def csv_years(spark, sf_dir):
    """A family of per-year files, the year from the file's name, other years pruned from the listing."""
    df = read_year_files(spark, f"{_write_year_files(spark, sf_dir)}/shard=*", first_year=YEARS_READ[0],
                         last_year=YEARS_READ[1])
    return df.select(*[F.col(name).alias(name.lower()) for name in WEATHER_OBS_COLUMNS], "year")


@register("csv_header", sql="""SELECT CAST(event_id AS VARCHAR) AS event_id, event_type || ',' || props AS tag,
    props, value FROM events""")
def csv_header(spark, sf_dir):
    """Header CSV, all columns text; fields hold commas and quotes."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.concat_ws(",", "event_type", "props").alias("tag"), "props", "value")
    df = read_header_csv(spark, _write_csv(rows, _folder(spark, "events"), header=True))
    return df.withColumn("value", F.col("value").try_cast("double"))


@register("csv_lines", sql="SELECT doc_id, text FROM documents WHERE text <> ''")
def csv_lines(spark, sf_dir):
    """S3: fields with line breaks inside quotes; an empty field is null, so such rows are left out on both sides."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").filter("text <> ''")
    df = read_header_csv(spark, _write_csv(rows, _folder(spark, "texts"), header=True), multi_line=True)
    return df.withColumn("doc_id", F.col("doc_id").try_cast("bigint"))


@register("csv_indexed", sql=f"SELECT user_id, follows_id FROM ({EDGES_SQL})")
def csv_indexed(spark, sf_dir):
    """Header CSV whose first column is a row index without a name: dropped by position, the rest typed."""
    edges = follow_edges(spark, sf_dir)
    rows = edges.select(F.monotonically_increasing_id().alias(""), "user_id", "follows_id")
    return read_indexed_csv(spark, _write_csv(rows, _folder(spark, "edges"), header=True),
                            {"user_id": "bigint", "follows_id": "bigint"})


@register("file_listing", sql=f"""SELECT DISTINCT 'shard=' || (CAST(station AS INTEGER) % {YEAR_SHARDS}) || '/'
    || year || '.csv' AS file FROM ({OBSERVATIONS_SQL})""")
def file_listing(spark, sf_dir):
    """Paths of all files under a folder, contents not read."""
    base = _write_year_files(spark, sf_dir)
    files = list_files(spark, base, glob="*.csv", recursive=True)
    return files.select(F.concat_ws("/", F.slice(F.split("path", "/"), -2, 2)).alias("file"))


@register("set_write", sql="SELECT DISTINCT user_id, event_type FROM events")
def set_write(spark, sf_dir):
    """K1/F8: keyed-set write from rows with repeats, done twice; the second write leaves the same set."""
    path = _folder(spark, "sets")
    rows = table(spark, sf_dir, "events").select("user_id", "event_type")
    for _ in range(2):
        write_keyed_table(rows, path, ["user_id"], ["event_type"])
    return spark.read.parquet(path)


@register("union_store", sql=_CTES + """SELECT reader AS user_id, tweet_text,
    sum(CAST(score AS DECIMAL(38,0))) AS score FROM fan GROUP BY reader, tweet_text""")
def union_store(spark, sf_dir):
    """K3/K4: every reader's union written over an older table at the same path; nothing of that one stays."""
    path = _folder(spark, "unions")
    tw, edges = tweets(spark, sf_dir), follow_edges(spark, sf_dir)
    for rows in (feed.posts_by_author(tw), feed.timeline_pull(tw, edges)):
        write_keyed_table(rows, path, ["user_id"], ["tweet_text"], dedupe=False)
    return spark.read.parquet(path)
