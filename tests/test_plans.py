"""Plan properties that matter at scale, read from the physical plans."""

import pytest

from corvid.operators import feed
from corvid.plans.explain import final_plan
from corvid.plans.registry import all_queries
from corvid.plans.standins import follow_edges, tweets

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "PythonUDF", "FlatMapGroupsInPandas")


def plan_of(df):
    """The final (AQE) physical plan: this DataFrame's own plan is executed first."""
    return final_plan(df)


def test_idw_broadcasts_stations_and_never_shuffles_readings(spark):
    df = all_queries()["idw_yearly"].build(spark, SF)
    plan = plan_of(df)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # readings: scan -> filter -> join -> partial aggregate, the only exchanges
    # are the broadcast and the aggregate's (year) shuffle
    assert plan.count("Exchange hashpartitioning") == 1
    lineitem_scan = [ln for ln in plan.splitlines() if "lineitem.parquet" in ln][0]
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in lineitem_scan


@pytest.mark.parametrize("name", ["idw_yearly", "timeline_push", "timeline_pull", "timeline_ordered",
                                  "profile_numeric", "profile_counts", "followers_packed", "img_resize",
                                  "img_scale"])
def test_no_python_in_plan(spark, name):
    plan = plan_of(all_queries()[name].build(spark, SF))
    assert not any(node in plan for node in PYTHON_NODES), name


@pytest.mark.parametrize("op", ["sobel", "laplace", "convolve", "dilate", "canny"])
def test_image_engines_plans(spark, op):
    from corvid.functions.image import SOBEL_X
    from corvid.operators import imaging
    from corvid.plans.standins import gray_images
    fn = getattr(imaging, op)
    args = (SOBEL_X,) if op == "convolve" else ()
    native = plan_of(imaging.to_long(fn(gray_images(spark, SF), *args, engine="native")))
    numpy_ = plan_of(imaging.to_long(fn(gray_images(spark, SF), *args, engine="numpy")))
    # native: JVM only (Canny: its hysteresis loop is the one Python step)
    assert native.count("MapInPandas") == (1 if op == "canny" else 0)
    assert not any(n in native for n in PYTHON_NODES if n != "MapInPandas")
    # numpy: one Arrow-batched step, no per-row Python UDF
    assert numpy_.count("MapInPandas") == 1 and "BatchEvalPython" not in numpy_


def test_pull_for_one_reader_filters_edges_before_join(spark):
    df = feed.timeline_pull(tweets(spark, SF), follow_edges(spark, SF), reader=7)
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    join_at = opt.index("Join Inner")
    assert "(user_id#" in opt[join_at:] and "= 7)" in opt[join_at:]


def test_profile_counts_spreads_distinct_over_values(spark):
    plan = plan_of(all_queries()["profile_counts"].build(spark, SF))
    # exact distinct: deduplicated on (column, value), then counted per column
    assert any("hashpartitioning(_pos" in ln and ", _k0#" in ln for ln in plan.splitlines())
    # each column is read once by the wide pass and once by its type's distinct pass
    scans = [ln for ln in plan.splitlines() if "lineitem.parquet" in ln]
    assert len(scans) == 4 and sum(ln.count("l_orderkey") for ln in scans) <= 4


def test_day_and_year_filters_reach_a_stored_scan(spark, tmp_path):
    from corvid.operators import geo
    from corvid.plans.standins import weather_observations
    from corvid.sources.sinks import write_partitioned
    path = str(tmp_path / "obs")
    write_partitioned(geo.typed_observations(weather_observations(spark, SF)), path, ["year"], ["month", "day"])
    day = geo.observations_on_day(spark.read.parquet(path).filter("year = 1996"))
    plan = plan_of(day)
    assert "EqualTo(month,1)" in plan and "EqualTo(day,28)" in plan and "PartitionFilters: [isnotnull(year" in plan
    text = geo.observations_on_day(weather_observations(spark, SF).filter("year = 1996"))
    assert day.count() == text.count() > 0
    scan = plan_of(all_queries()["idw_point"].build(spark, SF))
    assert "GreaterThanOrEqual(l_shipdate" in scan and "LessThan(l_shipdate" in scan


def test_celebrity_author_join_is_split_by_aqe(spark):
    """A user followed by a third of all users: AQE splits that join partition."""
    from pyspark.sql import functions as F
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        edges = spark.range(0, 30000).select(
            (F.col("id") + 1).alias("user_id"),
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("follows_id"))
        tw = spark.range(0, 3000).select((F.col("id") % 998).alias("user_id"),
                                         (F.col("id") % 50).cast("string").alias("tweet_text"),
                                         F.col("id").alias("score"))
        plan = plan_of(feed.timeline_push(tw, edges))
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_packed_sets_shuffle_on_key_and_chunk(spark):
    """A hot key's chunks must be built by several tasks, not the join's key partition."""
    from pyspark.sql import functions as F
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sets = spark.range(0, 30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("user_id"),
            F.col("id").alias("follower_id"))
        plan = plan_of(feed.pack_sets(sets, "user_id", "follower_id", width=1000))
        assert any("hashpartitioning(user_id" in ln and "chunk" in ln for ln in plan.splitlines())
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_ranking_shuffles_on_key_and_bucket(spark):
    """An input partitioned by the key alone must not put a hot key in one window task."""
    from corvid.plans.ranking import row_number_within
    rows = [(0 if i % 3 == 0 else i % 50, i % 997, i) for i in range(30000)]
    df = spark.createDataFrame(rows, "k long, score long, member long").repartition(8, "k")
    plan = plan_of(row_number_within(df, ["k"], ["score", "member"], ranges=8))
    assert any("hashpartitioning(k" in ln and "_range" in ln for ln in plan.splitlines())


def test_ranking_plan_does_not_grow_with_the_ranges(spark):
    """No boundary is sampled to the driver or written into the plan."""
    from corvid.plans.ranking import row_number_within
    df = spark.range(0, 5000).selectExpr("id % 7 AS k", "id % 100 AS score", "id AS member")
    few, many = (len(row_number_within(df, ["k"], ["score", "member"], ranges=n)._jdf.queryExecution().toString())
                 for n in (4, 200))
    assert abs(few - many) < 200
