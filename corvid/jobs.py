"""The reference's four workflows as jobs over their own file formats.

Each job reads the files with ``corvid.sources``, runs the operators and returns
DataFrames; ``python -m corvid <job> ...`` runs one and shows the result.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.operators import feed, geo, ml, profile
from corvid.sources.csv import (FIRST_YEAR, LAST_YEAR, WEATHER_STATION_COLUMNS, read_header_csv,
                                read_headerless_csv, read_indexed_csv, read_year_files)
from corvid.sources.images import read_images
from corvid.sources.sinks import write_keyed_table


def weather(spark: SparkSession, readings: str, stations: str, lat: float = geo.CAPE_LAT,
            lon: float = geo.CAPE_LON, radius_km: float = geo.RADIUS_KM, month: int = geo.DAY_MONTH,
            day: int = geo.DAY_OF_MONTH, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR,
            readings_format: str = "csv", drop_null_readings: bool = False) -> DataFrame:
    """IDW estimate of the day's temperature at a point, one row per year.

    ``readings``: directory or glob of headerless ``<year>.csv`` files
    (STATION, WBAN, MONTH, DAY, TEMP), or a parquet table partitioned by
    ``year`` (see ``sources.sinks.write_partitioned``; the year range is then a
    partition filter); ``stations``: headerless CSV (STATION, WBAN, LAT, LON).
    """
    if readings_format == "parquet":
        obs = spark.read.parquet(readings).filter(F.col("year").between(first_year, last_year))
    else:
        obs = read_year_files(spark, readings, first_year=first_year, last_year=last_year)
    st = read_headerless_csv(spark, stations, WEATHER_STATION_COLUMNS)
    out = geo.idw_for_day(st, obs, lat, lon, radius_km, month, day, drop_null_obs=drop_null_readings)
    return out.orderBy("year")


def column_profile(spark: SparkSession, path: str, approx: bool = False) -> DataFrame:
    """Min / max / avg (numeric columns), non-empty and distinct counts of a header CSV.

    ``approx=True`` counts distinct values with HyperLogLog++ (shuffles sketches,
    not values), for very large files.
    """
    df = read_header_csv(spark, path)
    return profile.profile(df, approx=approx).orderBy("col_name")


def feed_tables(spark: SparkSession, followers_csv: str, tweets_csv: str) -> dict[str, DataFrame]:
    """Edges, posts, push timelines from ``followers.csv`` and ``tweets.csv``.

    The tweet files carry no time; tweets are posted now, in file order: a
    tweet's score is the job's start time in microseconds plus its position (file,
    then row index), so a later copy of the same text is the newer one and summed
    scores sort after single ones, as with clock times.  The order does not depend on
    how the files are split into tasks.
    """
    edges = read_indexed_csv(spark, followers_csv, {"user_id": "bigint", "follows_id": "bigint"})
    tw = read_indexed_csv(spark, tweets_csv, {"user_id": "bigint"}, position_col="_position")
    posted_at = int(time.time() * 1_000_000)  # one literal: every action sees the same scores
    tw = tw.withColumn("score", F.lit(posted_at) + F.coalesce("_position", F.lit(0))).drop("_position")
    return {"edges": edges, "tweets": tw, "posts": feed.posts_by_author(tw),
            "timelines": feed.timeline_push(tw, edges)}


def feed_read(spark: SparkSession, followers_csv: str, tweets_csv: str, user_id: int,
              out_dir: str | None = None) -> dict[str, DataFrame]:
    """One user's timeline both ways (precomputed push, union-on-read pull).

    With ``out_dir`` the follower sets, posts, pushed timelines and the
    materialised unions (pull for every reader) are also written as
    key-clustered tables (``followers``, ``following``, ``posts``,
    ``timelines``, ``unions``); each write replaces only its own folder.
    """
    t = feed_tables(spark, followers_csv, tweets_csv)
    if out_dir:
        base = out_dir.rstrip("/")
        write_keyed_table(feed.follower_sets(t["edges"]), f"{base}/followers", ["user_id"], ["follower_id"])
        write_keyed_table(feed.following_sets(t["edges"]), f"{base}/following", ["user_id"], ["followee_id"])
        write_keyed_table(t["posts"], f"{base}/posts", ["user_id"], ["tweet_text"], dedupe=False)
        write_keyed_table(t["timelines"], f"{base}/timelines", ["user_id"], ["tweet_text"], dedupe=False)
        write_keyed_table(feed.timeline_pull(t["tweets"], t["edges"]), f"{base}/unions", ["user_id"],
                          ["tweet_text"], dedupe=False)
        # answer from the tables just written: their key clustering lets a lookup skip most of the data
        of = {name: spark.read.parquet(f"{base}/{name}") for name in ("followers", "following", "timelines", "unions")}
        mine = {name: df.filter(F.col("user_id") == user_id) for name, df in of.items()}
        return {"push": feed.read_timeline(of["timelines"], user_id),
                "pull": feed.read_timeline(of["unions"], user_id),
                "followers": mine["followers"].select("follower_id"),
                "followees": mine["following"].select("followee_id")}
    pull = feed.timeline_pull(t["tweets"], t["edges"], reader=user_id)
    return {"push": feed.read_timeline(t["timelines"], user_id),
            "pull": feed.read_timeline(pull, user_id),
            "followers": feed.followers_of(t["edges"], user_id),
            "followees": feed.followees_of(t["edges"], user_id)}


def classify_images(spark: SparkSession, folder: str, featurizer: str = "raw", classifier: str = "nb",
                    size: int = ml.DEFAULT_SIDE, train_percent: int = ml.TRAIN_PERCENT) -> dict[str, DataFrame]:
    """Label from file name, featurize, train on the split, score the rest.

    Returns ``predictions`` (path, label, prediction; null for a file that does not decode),
    ``accuracy`` (with the number of unscored rows) and ``unreadable`` (paths, of either side).
    """
    # bytes stay bytes until the featurizer: decode, edges and resize are one step
    imgs = read_images(spark, folder, decode=False).withColumn("image_id", F.xxhash64("path"))
    imgs = ml.with_split(imgs, train_percent=train_percent)
    stages = ml.build_stages(featurizer, classifier, size=size, path_col="path", input_col="data")
    pred = ml.fit_and_predict(stages, imgs.filter("is_train"), imgs.filter("NOT is_train"))
    unreadable = imgs.filter((F.col("height") <= 0) | (F.length("data") == 0)).select("path")
    return {"predictions": pred.select("path", "label", "prediction"), "accuracy": ml.accuracy(pred),
            "unreadable": unreadable}
