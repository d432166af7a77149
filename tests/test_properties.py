"""Property tests: random small inputs, invariants that must hold."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from corvid.operators import feed, geo, imaging
from corvid.plans.ranking import row_number_within

SETTINGS = settings(max_examples=8, deadline=None)

edges_st = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), min_size=1, max_size=25)
tweets_st = st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["a", "b", "c", "d"]),
                               st.integers(1_700_000_000_000_000, 1_700_000_000_999_999)),
                     min_size=1, max_size=40)


@SETTINGS
@given(edges_st, tweets_st)
def test_push_equals_pull_with_max(spark, edges, tweets):
    e = spark.createDataFrame(edges, "user_id long, follows_id long")
    t = spark.createDataFrame(tweets, "user_id long, tweet_text string, score long")
    push = feed.timeline_push(t, e)
    pull = feed.timeline_pull(t, e, combine="max")
    assert push.exceptAll(pull).count() == 0 and pull.exceptAll(push).count() == 0
    # summed scores are never below the newest one
    summed = feed.timeline_pull(t, e).withColumnRenamed("score", "s")
    joined = summed.join(push, ["user_id", "tweet_text"])
    assert joined.filter(F.col("s") < F.col("score")).count() == 0


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50), st.integers(0, 10**6)),
                min_size=1, max_size=120, unique_by=lambda r: (r[0], r[2])),
       st.integers(1, 20))
def test_ranking_equals_window(spark, rows, bound):
    df = spark.createDataFrame(rows, "k long, score long, member long")
    got = row_number_within(df, ["k"], ["score", "member"], ranges=bound)
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy("score", "member"))
                         .cast("long"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@SETTINGS
@given(st.lists(st.tuples(st.floats(-0.8, 0.8), st.floats(-0.8, 0.8), st.integers(-20, 110)),
                min_size=1, max_size=12))
def test_idw_between_min_and_max(spark, pts):
    stations = [(str(i), "1", str(geo.CAPE_LAT + dlat), str(geo.CAPE_LON + dlon))
                for i, (dlat, dlon, _) in enumerate(pts)]
    obs = [(str(i), "1", "1", "28", str(t), 2000) for i, (_, _, t) in enumerate(pts)]
    st_df = spark.createDataFrame(stations, "station string, wban string, lat string, lon string")
    ob_df = spark.createDataFrame(obs, "station string, wban string, month string, day string, "
                                       "temp string, year int")
    r = geo.idw_for_day(st_df, ob_df, by=()).first()
    near = geo.within_radius(geo.clean_stations(st_df)).select("station").collect()
    temps = [pts[int(x.station)][2] for x in near]
    if not temps:
        assert r.est is None and r.n == 0
    else:
        assert min(temps) - 1e-9 <= r.est <= max(temps) + 1e-9 and r.n == len(temps)


@SETTINGS
@given(st.integers(1, 9), st.integers(1, 9), st.integers(0, 2**31 - 1))
def test_dilate_ge_input_and_engines_agree(spark, h, w, seed):
    a = np.random.default_rng(seed).integers(0, 256, (h, w)).astype(float)
    df = spark.createDataFrame([(0, h, w, [float(x) for x in a.ravel()])],
                               "image_id long, height int, width int, pixels array<double>")
    nat = np.array(imaging.dilate(df, engine="native").first().pixels)
    num = np.array(imaging.dilate(df, engine="numpy").first().pixels)
    assert (nat >= a.ravel()).all() and np.array_equal(nat, num)
    for op in (imaging.sobel, imaging.laplace, imaging.canny):
        assert op(df, engine="native").first().pixels == op(df, engine="numpy").first().pixels


@SETTINGS
@given(st.floats(-89.5, 89.5), st.floats(-180.0, 180.0), st.floats(1.0, 3000.0),
       st.lists(st.tuples(st.floats(-1.0, 1.0), st.floats(-1.0, 1.0)), min_size=5, max_size=40))
def test_bounding_box_never_drops_a_station_in_range(spark, lat0, lon0, radius, offsets):
    from corvid.functions.geo import haversine_km
    scale = radius / 111.0 * 1.2  # points spread around the circle's edge
    pts = [(str(i), "1", max(-90.0, min(90.0, lat0 + dy * scale)), lon0 + dx * scale * 2)
           for i, (dy, dx) in enumerate(offsets)]
    df = spark.createDataFrame(pts, "station string, wban string, lat double, lon double")
    got = {r.station for r in geo.within_radius(df, lat0, lon0, radius).collect()}
    want = {r.station for r in df.filter(haversine_km("lat", "lon", lat0, lon0) <= radius).collect()}
    assert got == want


cell_st = st.one_of(st.none(), st.sampled_from(["", "1", "1.0", "01", "2.5", "-0.0", "0.0", "x", "NaN", " 3 "]))


@SETTINGS
@given(st.lists(st.tuples(cell_st, cell_st, cell_st), min_size=1, max_size=30))
def test_profile_matches_python(spark, rows):
    import math

    from corvid.operators import profile
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = {r.col_name: (r.non_empty, r.n_distinct, r.n_bad) for r in profile.profile_counts(df).collect()}
    nums = {r.col_name: (r.min, r.max) for r in profile.profile_numeric(df).collect()}
    for i, name in enumerate("abc"):
        vals = [r[i] for r in rows]
        nonempty = [v for v in vals if v not in (None, "")]
        parsed = [float(v) for v in nonempty if v.strip() not in ("x",)]  # python float == Spark here
        assert got[name] == (len(nonempty), len({v if v is not None else "" for v in vals}),
                             len(nonempty) - len(parsed))
        if nonempty and len(parsed) == len(nonempty):
            finite = [p for p in parsed if not math.isnan(p)]
            lo = min(finite) if finite else float("nan")
            hi = float("nan") if any(math.isnan(p) for p in parsed) else max(parsed)
            mn, mx = nums[name]
            assert (mn == lo or (math.isnan(mn) and math.isnan(lo))) and \
                   (mx == hi or (math.isnan(mx) and math.isnan(hi)))
        else:
            assert name not in nums


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="dogcat/.é1", max_size=12)), min_size=1, max_size=30),
       st.integers(1, 8), st.integers(0, 4), st.sampled_from(["dog", "d", "", "cat/"]))
def test_label_from_text_matches_python_slicing(spark, texts, start, length, word):
    from corvid.functions.text import label_from_text
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.l for r in df.select(label_from_text("t", start, length, word).alias("l")).collect()]
    want = [int(t is not None and t[start - 1:start - 1 + length] == word) for t in texts]
    assert got == want


@SETTINGS
@given(st.lists(st.text(alphabet="ab/:file.x", max_size=16), min_size=1, max_size=20),
       st.lists(st.datetimes(min_value=__import__("datetime").datetime(1970, 1, 1),
                             max_value=__import__("datetime").datetime(2100, 1, 1)), min_size=1, max_size=10))
def test_small_helpers_match_python(spark, paths, stamps):
    import datetime

    from corvid.functions.text import basename, strip_scheme
    from corvid.functions.time import epoch_micros
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    rows = df.select(basename("p").alias("b"), strip_scheme("p").alias("s")).collect()
    assert [r.b for r in rows] == [p.split("/")[-1] for p in paths]
    assert [r.s for r in rows] == [p.replace("file:", "") for p in paths]
    ts = spark.createDataFrame([(t,) for t in stamps], "t timestamp_ntz")
    got = [r.u for r in ts.select(epoch_micros("t").alias("u")).collect()]
    epoch = datetime.datetime(1970, 1, 1)
    assert got == [(t - epoch) // datetime.timedelta(microseconds=1) for t in stamps]
