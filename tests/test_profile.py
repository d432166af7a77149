import math

from pyspark.sql import functions as F

from corvid.operators import profile
from corvid.sources.csv import read_header_csv


def _csv(tmpdir_path):
    path = f"{tmpdir_path}/grid.csv"
    with open(path, "w") as f:
        f.write("a,b,c,d\n")
        f.write("1,x,,1\n")
        f.write("1.0,y,NaN,2\n")
        f.write("3,,2,bad\n")
        f.write("1,x\n")  # short row: c and d missing
    return path


def test_counts_text_semantics(spark, tmpdir_path):
    df = read_header_csv(spark, _csv(tmpdir_path))
    got = {r.col_name: (r.non_empty, r.n_distinct, r.n_bad) for r in profile.profile_counts(df).collect()}
    assert got["a"] == (4, 3, 0)        # '1' and '1.0' are different text
    assert got["b"] == (3, 3, 3)        # x, y and the empty value
    assert got["c"] == (2, 3, 0)        # '' / null count as one empty value
    assert got["d"] == (3, 4, 1)


def test_numeric_detection_and_nan(spark, tmpdir_path):
    df = read_header_csv(spark, _csv(tmpdir_path))
    got = {r.col_name: r for r in profile.profile_numeric(df).collect()}
    assert set(got) == {"a", "c"}       # d has a bad value, b is text
    assert (got["a"].min, got["a"].max) == (1.0, 3.0)
    assert math.isclose(got["a"].avg, 1.5)
    assert got["c"].min == 2.0 and math.isnan(got["c"].max)  # Spark: max returns NaN


def test_typed_mode(spark):
    df = spark.createDataFrame([(1, 2.5, "x"), (3, None, "y")], "i int, d double, s string")
    got = {r.col_name: r for r in profile.profile_numeric(df, typed=True).collect()}
    assert set(got) == {"i", "d"}
    assert got["i"].avg == 2.0 and got["d"].max == 2.5


def test_approx_counts_close(spark):
    df = spark.range(0, 5000).selectExpr("cast(id % 1000 as string) as k")
    exact = profile.profile_counts(df).first().n_distinct
    approx = profile.profile_counts(df, approx=True).first().n_distinct
    assert exact == 1000 and abs(approx - 1000) < 150


def test_distinct_at_most_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    n = df.count()
    assert all(r.n_distinct <= n for r in profile.profile_counts(df).collect())


def test_distinct_is_textual_for_doubles_and_ints(spark):
    df = spark.createDataFrame([(0.0, 1), (-0.0, 1), (float("nan"), None), (float("nan"), 2), (None, 2)],
                               "d double, i int")
    got = {r.col_name: r for r in profile.profile_counts(df).collect()}
    texts = {r.d for r in df.select(F.coalesce(F.col("d").cast("string"), F.lit("")).alias("d")).collect()}
    assert got["d"].n_distinct == len(texts) == 4   # '0.0', '-0.0', 'NaN', ''
    assert got["i"].n_distinct == 3                 # '1', '2', ''
    assert got["d"].non_empty == 4 and got["i"].non_empty == 4


def test_awkward_column_names(spark, tmpdir_path):
    path = f"{tmpdir_path}/odd.csv"
    with open(path, "w") as f:
        f.write("a.b,x y,`q`\n1,2,z\n3,,w\n")
    df = read_header_csv(spark, path)
    counts = {r.col_name: (r.non_empty, r.n_distinct) for r in profile.profile_counts(df).collect()}
    assert counts == {"a.b": (2, 2), "x y": (1, 2), "`q`": (2, 2)}
    nums = {r.col_name: (r.min, r.max) for r in profile.profile_numeric(df).collect()}
    assert nums == {"a.b": (1.0, 3.0), "x y": (2.0, 2.0)}
