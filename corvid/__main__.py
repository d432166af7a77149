"""``python -m corvid <job> ...``: run one of the reference workflows and show it."""

from __future__ import annotations

import argparse
import sys

from corvid import jobs


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="corvid")
    sub = p.add_subparsers(dest="job", required=True)
    w = sub.add_parser("weather", help="IDW estimate per year")
    w.add_argument("--readings", required=True, help="dir or glob of <year>.csv files")
    w.add_argument("--stations", required=True)
    w.add_argument("--lat", type=float, default=jobs.geo.CAPE_LAT)
    w.add_argument("--lon", type=float, default=jobs.geo.CAPE_LON)
    w.add_argument("--radius-km", type=float, default=jobs.geo.RADIUS_KM)
    w.add_argument("--month", type=int, default=jobs.geo.DAY_MONTH)
    w.add_argument("--day", type=int, default=jobs.geo.DAY_OF_MONTH)
    w.add_argument("--first-year", type=int, default=jobs.FIRST_YEAR)
    w.add_argument("--last-year", type=int, default=jobs.LAST_YEAR)
    w.add_argument("--readings-format", default="csv", choices=["csv", "parquet"])
    w.add_argument("--drop-null-readings", action="store_true",
                   help="drop readings without a temperature (default: their weight still counts)")
    pr = sub.add_parser("profile", help="column profile of header CSV files")
    pr.add_argument("paths", nargs="+")
    pr.add_argument("--approx", action="store_true", help="approximate distinct counts (HyperLogLog++)")
    f = sub.add_parser("feed", help="one user's timeline, push and pull")
    f.add_argument("--followers", required=True)
    f.add_argument("--tweets", required=True)
    f.add_argument("--user", type=int, required=True)
    f.add_argument("--out", help="write key-clustered tables, and the answers, here")
    im = sub.add_parser("images", help="train and score an image classifier")
    im.add_argument("folder")
    im.add_argument("--featurizer", default="raw", choices=sorted(jobs.ml.FEATURIZERS))
    im.add_argument("--classifier", default="nb", choices=["nb", "svc", "mlp"])
    im.add_argument("--size", type=int, default=jobs.ml.DEFAULT_SIDE)
    for job in (w, pr, im):
        job.add_argument("--out", help="write the whole result here (parquet)")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    a = p.parse_args(argv)

    from pyspark.sql import SparkSession
    builder = SparkSession.builder.appName(f"corvid-{a.job}")
    if a.master:
        builder = builder.master(a.master)
    spark = builder.getOrCreate()

    def emit(df, name: str = "", rows: int = 200) -> None:
        """Show the first rows; with ``--out`` write the whole result, each result to its own folder."""
        if a.out:
            path = "/".join(x for x in (a.out.rstrip("/"), name) if x)
            df.write.mode("overwrite").parquet(path)
            df = spark.read.parquet(path)
        shown = df.take(rows + 1)
        df.show(rows, truncate=False)
        if len(shown) > rows:
            print(f"(the first {rows} rows" + (")" if a.out else "; --out writes all)"))

    if a.job == "weather":
        emit(jobs.weather(spark, a.readings, a.stations, a.lat, a.lon, a.radius_km, a.month, a.day,
                          a.first_year, a.last_year, a.readings_format, a.drop_null_readings))
    elif a.job == "profile":
        for i, path in enumerate(a.paths):
            print(f"Statistics for {path}")
            emit(jobs.column_profile(spark, path, a.approx), str(i) if len(a.paths) > 1 else "", 1000)
    elif a.job == "feed":
        out = jobs.feed_read(spark, a.followers, a.tweets, a.user, a.out)
        for name in ("push", "pull"):
            print(f"{name} timeline of user {a.user}")
            emit(out[name], f"answers/{name}", 1000)
    else:
        out = jobs.classify_images(spark, a.folder, a.featurizer, a.classifier, a.size)
        for name in ("predictions", "accuracy", "unreadable"):
            emit(out[name], name, 20)
    return 0


if __name__ == "__main__":
    sys.exit(main())
