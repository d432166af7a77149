import math
import struct

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corvid.functions.text import parse_double
from corvid.functions.time import epoch_micros

ALPHABET = "0123456789+-.eExXpPdDfFlL aAbBnNiIfFtTyY_\t\n  ١,"


def _same(a, b):
    if a is None or b is None:
        return a is None and b is None
    if math.isnan(a) or math.isnan(b):
        return math.isnan(a) and math.isnan(b)
    return struct.pack(">d", a) == struct.pack(">d", b)  # also tells -0.0 from 0.0


FIXED = ["1", " 1 ", "1.", ".5", "1e5", "1.5E-3d", "2f", "0x1p3", "0X1.8P1", "NaN", "nan", "-Infinity",
         "inf", "+inf", "-INF", "infinity", "+NaN", "", "x", "1995-01-02 00:00:00", "1,5", "--1", "1e", "e5",
         "\t7\n", "1_000", "0x", "0x1", "N", "F", "1d", "1D", ".", "+", "-0.0", "-0", " -0 ", "1e400",
         "9007199254740993", "99999999999999999999", "1.5", "-5"]


def _check(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = df.select("v", F.col("v").try_cast("double").alias("a"), parse_double("v").alias("b")).collect()
    bad = [(r.v, r.a, r.b) for r in rows if not _same(r.a, r.b)]
    assert not bad, bad


def test_parse_double_fixed_cases(spark):
    _check(spark, FIXED)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=12), min_size=50, max_size=200))
def test_parse_double_equals_try_cast(spark, values):
    _check(spark, values)


def test_epoch_micros_ignores_session_zone(spark):
    df = spark.createDataFrame([("2024-01-15 00:00:00",)], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("t"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        got = []
        for tz in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got.append(df.select(epoch_micros("t").alias("u")).first().u)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [1705276800000000] * 3


def test_parse_double_on_typed_columns(spark):
    from corvid.operators import geo
    df = spark.createDataFrame([(1, 28, 3.5), (2, 28, None)], "month int, day int, temp double")
    rows = df.select(parse_double("month").alias("m"), parse_double("temp").alias("t")).collect()
    assert [(r.m, r.t) for r in rows] == [(1.0, 3.5), (2.0, None)]
    assert geo.observations_on_day(df).count() == 1
