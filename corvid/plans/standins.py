"""Stand-in inputs built from the driver's parquet tables.

The reference reads weather CSVs, follower/tweet CSVs and image folders that do
not ship with it.  These functions give rows in the schemas the operators expect,
derived from the test tables so that the work grows with them.  They do none of
the operators' work: every recipe is a per-row projection (edges also take the
distinct users and the largest user id), mirrored one-to-one by the SQL
fragments below for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.functions.time import epoch_micros


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _str(c):
    return c.cast("string")


# -- weather --------------------------------------------------------------------

def weather_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``supplier`` -> stations(station, wban, lat, lon), all strings as read from CSV."""
    s = F.col("s_suppkey")
    lat = F.when(s % 13 == 0, F.lit(None).cast("double")).otherwise(
        F.lit(28.388382) + ((s * 8) % 21 - 10).cast("double") * F.lit(0.15))
    lon = F.lit(-80.603498) + ((s * 11) % 17 - 8).cast("double") * F.lit(0.15)
    return table(spark, sf_dir, "supplier").select(
        _str(s).alias("station"),
        _str(F.nullif(s % 5, F.lit(0))).alias("wban"),
        _str(lat).alias("lat"),
        _str(lon).alias("lon"))


def weather_observations(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    """``lineitem`` -> observations(station, wban, year, month, day, temp).

    ``year`` reads one year only, as choosing one year's file does (a range on the raw date
    column, so it reaches the scan).

    ``year`` plays the part of the year in the file name (an int partition column);
    the other columns are strings as read from CSV.
    """
    k = F.col("l_suppkey")
    d = F.col("l_shipdate")
    rows = table(spark, sf_dir, "lineitem")
    if year is not None:
        first, after = (F.lit(f"{y}-01-01 00:00:00").cast("timestamp_ntz") for y in (year, year + 1))
        rows = rows.filter((d >= first) & (d < after))
    return rows.select(
        _str(k).alias("station"),
        _str(F.nullif(k % 5, F.lit(0))).alias("wban"),
        F.year(d).alias("year"),
        _str(F.month(d)).alias("month"),
        _str(F.dayofmonth(d)).alias("day"),
        _str(F.col("l_quantity")).alias("temp"))


STATIONS_SQL = """
  SELECT CAST(s_suppkey AS VARCHAR) AS station,
         CAST(NULLIF(s_suppkey % 5, 0) AS VARCHAR) AS wban,
         CAST(CASE WHEN s_suppkey % 13 = 0 THEN NULL
                   ELSE 28.388382e0 + CAST((s_suppkey * 8) % 21 - 10 AS DOUBLE) * 0.15e0 END AS VARCHAR) AS lat,
         CAST(-80.603498e0 + CAST((s_suppkey * 11) % 17 - 8 AS DOUBLE) * 0.15e0 AS VARCHAR) AS lon
  FROM supplier"""

OBSERVATIONS_SQL = """
  SELECT CAST(l_suppkey AS VARCHAR) AS station,
         CAST(NULLIF(l_suppkey % 5, 0) AS VARCHAR) AS wban,
         CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(month(l_shipdate) AS VARCHAR) AS month,
         CAST(day(l_shipdate) AS VARCHAR) AS day,
         CAST(l_quantity AS VARCHAR) AS temp
  FROM lineitem"""


def target_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` -> targets(target_id, lat, lon) around the stations and up to 4 degrees beyond them."""
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        c.alias("target_id"),
        (F.lit(28.388382) + ((c * 5) % 41 - 20).cast("double") * F.lit(0.2)).alias("lat"),
        (F.lit(-80.603498) + ((c * 7) % 37 - 18).cast("double") * F.lit(0.2)).alias("lon"))


TARGETS_SQL = """
  SELECT c_custkey AS target_id,
         28.388382e0 + CAST((c_custkey * 5) % 41 - 20 AS DOUBLE) * 0.2e0 AS lat,
         -80.603498e0 + CAST((c_custkey * 7) % 37 - 18 AS DOUBLE) * 0.2e0 AS lon
  FROM customer"""


# -- social feed ----------------------------------------------------------------

FOLLOWS_PER_USER = 3


def follow_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` -> edges(user_id, follows_id): user u follows (7u + k) mod (max+1), k=1..3."""
    ev = table(spark, sf_dir, "events")
    users = ev.select("user_id").distinct()
    modulus = ev.select((F.max("user_id") + 1).alias("m")).scalar()
    ks = F.explode(F.sequence(F.lit(1), F.lit(FOLLOWS_PER_USER))).alias("k")
    return (users.select("user_id", ks)
            .select("user_id", ((F.col("user_id") * 7 + F.col("k")) % modulus).alias("follows_id"))
            .distinct())


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` -> tweets(user_id, tweet_text, score, ts): text = event type, score = ts in µs."""
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.col("event_type").alias("tweet_text"),
        epoch_micros(F.col("ts")).alias("score"),
        "ts")


EDGES_SQL = """
  SELECT DISTINCT u.user_id, (u.user_id * 7 + k.k) % (SELECT max(user_id) + 1 FROM events) AS follows_id
  FROM (SELECT DISTINCT user_id FROM events) u, (SELECT unnest(range(1, 4)) AS k) k"""

TWEETS_SQL = """
  SELECT user_id, event_type AS tweet_text, epoch_us(ts) AS score FROM events"""


# -- images ---------------------------------------------------------------------

IMAGE_SIDE = 8


def gray_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` -> 8-bit gray images(image_id, height, width, pixels array<double>).

    Each 64-float embedding is read as an 8x8 row-major image and quantised to
    0..255 by ``least(255, greatest(0, floor((x + 1) * 127.5)))``.
    """
    q = lambda x: F.least(F.lit(255.0), F.greatest(F.lit(0.0), F.floor((x.cast("double") + 1.0) * 127.5).cast("double")))
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("image_id"),
        F.lit(IMAGE_SIDE).alias("height"), F.lit(IMAGE_SIDE).alias("width"),
        F.transform("embedding", q).alias("pixels"))


def colour_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` -> colour images(image_id, height, width, channels, pixels), B, G, R interleaved.

    With ``v`` the quantised gray value: B = v, G = 255 - v, R = floor(v / 2).
    """
    return gray_images(spark, sf_dir).withColumn("channels", F.lit(3)).withColumn(
        "pixels", F.flatten(F.transform("pixels", lambda v: F.array(v, F.lit(255.0) - v, F.floor(v / 2).cast("double")))))


def feature_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` -> (image_id, label, pixels): label = class >= 5, pixels = x + 1 (>= 0)."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("image_id"),
        F.when(F.col("label") >= 5, F.lit(1)).otherwise(F.lit(0)).alias("label"),
        F.lit(IMAGE_SIDE).alias("height"), F.lit(IMAGE_SIDE).alias("width"),
        F.transform("embedding", lambda x: x.cast("double") + 1.0).alias("pixels"))


GRAY_PIXELS_SQL = """
  SELECT vec_id AS image_id, CAST(i - 1 AS INTEGER) AS idx,
         CAST((i - 1) // 8 AS INTEGER) AS r, CAST((i - 1) % 8 AS INTEGER) AS c,
         least(255.0, greatest(0.0, floor((CAST(embedding[i] AS DOUBLE) + 1.0) * 127.5))) AS v
  FROM embeddings, range(1, 65) t(i)"""


COLOUR_PIXELS_SQL = f"""
  SELECT p.image_id, p.idx, p.r, p.c, ch.ch,
         CASE ch.ch WHEN 0 THEN p.v WHEN 1 THEN 255.0 - p.v ELSE floor(p.v / 2) END AS v
  FROM ({GRAY_PIXELS_SQL}) p, (SELECT unnest(range(0, 3)) AS ch) ch"""


def raw_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` -> float images(image_id, height, width, pixels): values as stored."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("image_id"),
        F.lit(IMAGE_SIDE).alias("height"), F.lit(IMAGE_SIDE).alias("width"),
        F.transform("embedding", lambda x: x.cast("double")).alias("pixels"))


RAW_PIXELS_SQL = """
  SELECT vec_id AS image_id, CAST(i - 1 AS INTEGER) AS idx,
         CAST((i - 1) // 8 AS INTEGER) AS r, CAST((i - 1) % 8 AS INTEGER) AS c,
         CAST(embedding[i] AS DOUBLE) AS v
  FROM embeddings, range(1, 65) t(i)"""


def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` -> decoded image files(image_id, path, height, width, pixels).

    As in an image folder, the class is only in the file name
    (``images/dog.<id>.bmp`` for class >= 5, ``images/cat.<id>.bmp`` otherwise);
    pixels are ``x + 1`` (non-negative, as multinomial naive Bayes needs).
    """
    word = F.when(F.col("label") >= 5, F.lit("dog")).otherwise(F.lit("cat"))
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("image_id"),
        F.concat(F.lit("images/"), word, F.lit("."), F.col("vec_id").cast("string"), F.lit(".bmp")).alias("path"),
        F.lit(IMAGE_SIDE).alias("height"), F.lit(IMAGE_SIDE).alias("width"),
        F.transform("embedding", lambda x: x.cast("double") + 1.0).alias("pixels"))


FEATURE_ROWS_SQL = """
  SELECT vec_id AS image_id, CAST(CASE WHEN label >= 5 THEN 1 ELSE 0 END AS INTEGER) AS label,
         CAST(i - 1 AS INTEGER) AS i, CAST((i - 1) // 8 AS INTEGER) AS r, CAST((i - 1) % 8 AS INTEGER) AS c,
         CAST(embedding[i] AS DOUBLE) + 1.0 AS v
  FROM embeddings, range(1, 65) t(i)"""
