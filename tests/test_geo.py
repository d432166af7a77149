import math

import pytest
from pyspark.sql import functions as F

from corvid.functions.geo import haversine_km
from corvid.operators import geo

STATION_COLS = "station string, wban string, lat string, lon string"
OBS_COLS = "station string, wban string, month string, day string, temp string, year int"


def test_haversine_zero_and_symmetric(spark):
    df = spark.createDataFrame([(10.0, 20.0, -33.0, 151.0)], "a double, b double, c double, d double")
    r = df.select(haversine_km("a", "b", "a", "b").alias("z"),
                  haversine_km("a", "b", "c", "d").alias("x"),
                  haversine_km("c", "d", "a", "b").alias("y")).first()
    assert r.z == 0.0
    assert r.x == pytest.approx(r.y, rel=1e-12)
    assert 14000 < r.x < 16000


def test_day_filter_and_null_key_fill_micro_fixture(spark):
    # ('1',null,'01','28','30.5'), (null,'93','1','28','31'), ('0','93','1','28','x')
    obs = spark.createDataFrame([("1", None, "01", "28", "30.5", 1986), (None, "93", "1", "28", "31", 1986),
                                 ("0", "93", "1", "28", "x", 1986), ("1", None, "2", "28", "1", 1986)], OBS_COLS)
    day = geo.observations_on_day(obs)
    assert day.count() == 3  # '01' means January
    filled = geo.fill_null_keys(day).orderBy("temp").collect()
    assert [(r.station, r.wban) for r in filled] == [("1", "0"), ("0", "93"), ("0", "93")]


def test_within_radius_inclusive_and_bbox(spark):
    st = spark.createDataFrame([("a", "1", "28.388382", "-80.603498"), ("b", "1", "29.3", "-80.6"),
                                ("c", "1", "40.0", "-80.6"), ("d", "1", "bad", "1"), ("e", "1", None, "1")],
                               STATION_COLS)
    near = geo.within_radius(geo.clean_stations(st)).orderBy("station").collect()
    assert [r.station for r in near] == ["a"]
    # 100 km radius: b is 101 km north -> out; a 99 km point -> in
    lat_99 = 28.388382 + math.degrees(99.0 / 6371.0)
    st2 = spark.createDataFrame([("x", "1", str(lat_99), "-80.603498")], STATION_COLS)
    assert geo.within_radius(geo.clean_stations(st2)).count() == 1


def test_bbox_across_antimeridian(spark):
    st = spark.createDataFrame([("w", "1", "0.0", "179.9"), ("e", "1", "0.0", "-179.9"), ("f", "1", "0.0", "170.0")],
                               STATION_COLS)
    near = geo.within_radius(geo.clean_stations(st), lat0=0.0, lon0=180.0, radius_km=100.0)
    assert sorted(r.station for r in near.collect()) == ["e", "w"]


def _fixture(spark):
    st = spark.createDataFrame([("1", None, "28.388382", "-80.603498"),   # distance 0
                                ("2", "5", "28.5", "-80.603498"),          # ~12 km
                                ("3", "5", "28.6", "-80.603498")], STATION_COLS)
    obs = spark.createDataFrame([("1", None, "1", "28", "10", 2000), ("2", "5", "1", "28", "20", 2000),
                                 ("2", "5", "1", "28", "20", 2001), ("3", "5", "1", "28", None, 2001),
                                 ("2", "5", "1", "28", "40", 2002), ("3", "5", "1", "28", "10", 2002)], OBS_COLS)
    return st, obs


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_idw_semantics(spark, broadcast_rows):
    st, obs = _fixture(spark)
    out = {r.year: r for r in geo.idw_for_day(st, obs, broadcast_rows=broadcast_rows).collect()}
    # The station on the point wins alone
    assert out[2000].est == 10.0 and out[2000].n == 2
    # Null temp keeps its weight in the denominator -> biased low
    d2 = geo.with_distance(geo.clean_stations(st)).filter("station = '2'").first().dist_km
    d3 = geo.with_distance(geo.clean_stations(st)).filter("station = '3'").first().dist_km
    w2, w3 = d2 ** -2, d3 ** -2
    assert out[2001].est == pytest.approx(20 * w2 / (w2 + w3))
    assert out[2002].est == pytest.approx((40 * w2 + 10 * w3) / (w2 + w3))
    dropped = {r.year: r for r in geo.idw_for_day(st, obs, drop_null_obs=True,
                                                  broadcast_rows=broadcast_rows).collect()}
    assert dropped[2001].est == pytest.approx(20.0)


def test_idw_between_min_and_max(spark):
    st, obs = _fixture(spark)
    r = geo.idw_for_day(st, obs.filter("year = 2002"), by=()).first()
    assert 10.0 <= r.est <= 40.0


def test_no_station_in_range_gives_null_row(spark):
    st = spark.createDataFrame([("9", "1", "60.0", "10.0")], STATION_COLS)
    obs = spark.createDataFrame([("9", "1", "1", "28", "5", 2000)], OBS_COLS)
    r = geo.idw_for_day(st, obs, by=()).collect()
    assert len(r) == 1 and r[0].est is None and r[0].n == 0
    assert geo.idw_for_day(st, obs).count() == 0


def test_string_keys_are_textual(spark):
    st = spark.createDataFrame([("007", "1", "28.5", "-80.6")], STATION_COLS)
    obs = spark.createDataFrame([("7", "1", "1", "28", "5", 2000)], OBS_COLS)
    assert geo.idw_for_day(st, obs).count() == 0


def test_plan_broadcasts_and_single_job(spark):
    from corvid.plans.registry import all_queries
    from corvid.plans.explain import final_plan
    plan = final_plan(all_queries()["idw_yearly"].build(spark, "/root/testdata/sf0.001"))
    assert "BroadcastHashJoin" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_broadcast_bound_in_rows_and_bytes(spark):
    from corvid.plans.joins import broadcast_if_small, estimated_row_bytes
    df = spark.range(0, 100).selectExpr("id", "cast(id as string) as s")
    assert estimated_row_bytes(df) == 8 + 20
    assert broadcast_if_small(df, max_rows=100) is not None
    assert broadcast_if_small(df, max_rows=99) is None
    assert broadcast_if_small(df, max_bytes=28 * 100) is not None
    assert broadcast_if_small(df, max_bytes=28 * 99) is None


def test_broadcast_check_beyond_the_probe(spark):
    import corvid.plans.joins as joins
    df = spark.range(0, 300)
    old = joins.PROBE_ROWS
    try:
        joins.PROBE_ROWS = 50  # force the distributed count tier
        assert joins.broadcast_if_small(df, max_rows=300) is not None
        assert joins.broadcast_if_small(df, max_rows=299) is None
    finally:
        joins.PROBE_ROWS = old
