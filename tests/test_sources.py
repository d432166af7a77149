import os
import struct

import numpy as np

from corvid.functions.text import basename, label_from_text, strip_scheme
from corvid.operators import geo
from corvid.sources import csv as csvsrc
from corvid.sources.images import list_files, read_images
from corvid.sources.sinks import append_delta, compact, read_merged, write_keyed_table


def write_bmp(path, rgb):
    """24-bit BMP, rows bottom-up, each row padded to 4 bytes."""
    h, w, _ = rgb.shape
    row = (w * 3 + 3) & ~3
    data = b"".join(bytes(rgb[r, :, ::-1].astype(np.uint8).ravel()) + b"\0" * (row - w * 3)
                    for r in range(h - 1, -1, -1))
    header = struct.pack("<2sIHHI", b"BM", 54 + len(data), 0, 0, 54)
    info = struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(data), 2835, 2835, 0, 0)
    with open(path, "wb") as f:
        f.write(header + info + data)


def test_headerless_and_year_family(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "weather")
    os.makedirs(d)
    for year, rows in {1974: ["1,2,1,28,99"], 1986: ["1,,01,28,30.5", ",93,1,28,31"], 1990: ["7,1,1,28,40"]}.items():
        with open(os.path.join(d, f"{year}.csv"), "w") as f:
            f.write("\n".join(rows) + "\n")
    with open(os.path.join(d, "stations.csv"), "w") as f:
        f.write("1,0,28.4,-80.6\n0,93,28.5,-80.6\n7,1,,-80.6\n")
    obs = csvsrc.read_year_files(spark, os.path.join(d, "[0-9]*.csv"))
    assert sorted(r.year for r in obs.select("year").distinct().collect()) == [1974, 1986, 1990]
    obs = csvsrc.read_year_files(spark, d, first_year=csvsrc.FIRST_YEAR, last_year=csvsrc.LAST_YEAR)
    assert sorted(r.year for r in obs.select("year").distinct().collect()) == [1986, 1990]
    st = csvsrc.read_headerless_csv(spark, os.path.join(d, "stations.csv"), csvsrc.WEATHER_STATION_COLUMNS)
    assert st.columns == ["STATION", "WBAN", "LAT", "LON"] and dict(st.dtypes)["LAT"] == "string"
    out = {r.year: r for r in geo.idw_for_day(st, obs).collect()}
    assert set(out) == {1986}  # station 7 has no latitude
    assert out[1986].n == 2


def test_indexed_csv_drops_first_column(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "followers.csv")
    with open(p, "w") as f:
        f.write(",user_id,follows_id\n0,1,2\n1,3,2\n")
    df = csvsrc.read_indexed_csv(spark, p, {"user_id": "bigint", "follows_id": "bigint"})
    assert df.columns == ["user_id", "follows_id"]
    assert sorted(tuple(r) for r in df.collect()) == [(1, 2), (3, 2)]


def test_list_files_and_images(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "1k")
    os.makedirs(d)
    rng = np.random.default_rng(3)
    dog = rng.integers(0, 256, (5, 7, 3))
    write_bmp(os.path.join(d, "dog.1.bmp"), dog)
    write_bmp(os.path.join(d, "cat.1.bmp"), rng.integers(0, 256, (4, 4, 3)))
    files = list_files(spark, d)
    paths = sorted(r.path for r in files.collect())
    assert len(paths) == 2 and not any(p.startswith("file:") for p in paths)
    assert "ReadSchema: struct<path:string>" in files._jdf.queryExecution().executedPlan().toString()
    imgs = {os.path.basename(r.path): r for r in read_images(spark, d, gray=False).collect()}
    r = imgs["dog.1.bmp"]
    assert (r.height, r.width, r.channels) == (5, 7, 3)
    assert np.array_equal(np.array(r.pixels).reshape(5, 7, 3), dog[..., ::-1])  # B, G, R
    g = {os.path.basename(x.path): x for x in read_images(spark, d).collect()}["dog.1.bmp"]
    want = dog[..., 2] * 0.114 + dog[..., 1] * 0.587 + dog[..., 0] * 0.299
    assert np.allclose(np.array(g.pixels).reshape(5, 7), want)
    for gray in (True, False):
        a = {r.path: tuple(r) for r in read_images(spark, d, gray=gray, engine="numpy").collect()}
        b = {r.path: tuple(r) for r in read_images(spark, d, gray=gray, engine="native").collect()}
        assert a == b


def test_label_from_text_short_and_null(spark):
    df = spark.createDataFrame([("/data/1k/dog.12.jpg",), ("/x",), (None,), ("file:/a/cat.1.jpg",)], "p string")
    got = [r.l for r in df.select(label_from_text(basename("p"), 1, 3, "dog").alias("l")).collect()]
    assert got == [1, 0, 0, 0]
    assert [r.s for r in df.select(strip_scheme("p").alias("s")).collect()][3] == "/a/cat.1.jpg"
    short = df.select(label_from_text("p", 47, 3, "dog").alias("l")).collect()
    assert [r.l for r in short] == [0, 0, 0, 0]


def test_keyed_table_and_versions(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 5), (2, "b", 1)], "user_id long, tweet_text string, score long")
    write_keyed_table(df, os.path.join(tmpdir_path, "sets"), ["user_id"], ["tweet_text"])
    assert spark.read.parquet(os.path.join(tmpdir_path, "sets")).count() == 2
    base, keys = os.path.join(tmpdir_path, "tl"), ["user_id", "tweet_text"]
    append_delta(df, base, "s1", 0, keys, "score")
    upd = spark.createDataFrame([(1, "a", 9), (3, "c", 2)], "user_id long, tweet_text string, score long")
    append_delta(upd, base, "s1", 1, keys, "score")
    read = lambda b=base: {(r.user_id, r.tweet_text): r.score for r in read_merged(spark, b, keys, "score").collect()}
    assert read() == {(1, "a"): 9, (2, "b"): 1, (3, "c"): 2}
    append_delta(upd, base, "s1", 1, keys, "score")  # a replay changes nothing
    assert read() == {(1, "a"): 9, (2, "b"): 1, (3, "c"): 2}
    # another stream starts at epoch 0 again: nothing of the first is lost
    more = spark.createDataFrame([(1, "a", 4), (4, "d", 3)], "user_id long, tweet_text string, score long")
    append_delta(more, base, "s2", 0, keys, "score")
    want = {(1, "a"): 9, (2, "b"): 1, (3, "c"): 2, (4, "d"): 3}
    assert read() == want
    out = os.path.join(tmpdir_path, "tl2")
    compact(spark, base, out, keys, "score")
    assert read(out) == want
    append_delta(more.selectExpr("user_id", "tweet_text", "score + 100 AS score"), out, "s3", 0, keys, "score")
    assert read(out) == want | {(1, "a"): 104, (4, "d"): 103}


def test_partitioned_writer_splits_a_hot_partition(spark, tmpdir_path):
    from pyspark.sql import functions as F

    from corvid.sources.sinks import write_partitioned
    # year 2000 holds most rows: it must be written by several tasks (files)
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 10 < 8, F.lit(2000)).otherwise(F.lit(1990) + F.col("id") % 5).alias("year"),
        (F.col("id") % 997).cast("string").alias("station"), F.col("id").alias("v"))
    path = os.path.join(tmpdir_path, "parts")
    write_partitioned(df, path, ["year"], ["station"], num_files=8)
    hot = [f for f in os.listdir(os.path.join(path, "year=2000")) if f.endswith(".parquet")]
    assert len(hot) >= 4
    back = spark.read.parquet(path)
    assert back.count() == 20000 and back.filter("year = 2000").count() == 16000


def test_csv_reads_what_pandas_writes(spark, tmpdir_path):
    import pandas as pd

    from corvid.sources.csv import read_indexed_csv
    rows = pd.DataFrame({"user_id": [1, 2, 3, 4], "tweet_text": ['he said "hi", ok', "two\nlines", "a,b", 'x "y"\n"z"']})
    rows.to_csv(os.path.join(tmpdir_path, "t.csv"))
    got = read_indexed_csv(spark, os.path.join(tmpdir_path, "t.csv"), {"user_id": "bigint"})
    assert [(r.user_id, r.tweet_text) for r in got.orderBy("user_id").collect()] == list(rows.itertuples(index=False, name=None))


def test_positions_follow_files_and_index_not_partitions(spark, tmpdir_path):
    import pandas as pd

    from corvid.sources.csv import read_indexed_csv
    d = os.path.join(tmpdir_path, "tweets")
    os.makedirs(d)
    for f in range(3):
        pd.DataFrame({"user_id": [f] * 500, "tweet_text": [f"{f}-{i}" for i in range(500)]}).to_csv(os.path.join(d, f"{f}.csv"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        rows = read_indexed_csv(spark, d, multi_line=False, position_col="at").collect()
        assert {r.tweet_text: r["at"] for r in rows} == {f"{f}-{i}": 500 * f + i for f in range(3) for i in range(500)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_year_files_all_years_and_strict_names(spark, tmpdir_path):
    import pytest

    from corvid.sources.csv import read_year_files
    d = os.path.join(tmpdir_path, "years")
    os.makedirs(d)
    for name in ("1986.csv", "2016.csv"):
        with open(os.path.join(d, name), "w") as f:
            f.write("1,2,01,28,5\n")
    assert sorted(r.year for r in read_year_files(spark, d).collect()) == [1986, 2016]
    assert [r.year for r in read_year_files(spark, d, last_year=2015).collect()] == [1986]
    with open(os.path.join(d, "st0123_1990.csv"), "w") as f:
        f.write("1,2,01,28,5\n")
    with pytest.raises(ValueError, match="st0123_1990"):
        read_year_files(spark, d)


def test_undecodable_images_stay_with_null_pixels(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "dog.bad.bmp"), "wb") as f:
        f.write(b"not an image")
    for engine in ("numpy", "native"):
        rows = read_images(spark, tmpdir_path, engine=engine).collect()
        assert len(rows) == 1 and rows[0].pixels is None
