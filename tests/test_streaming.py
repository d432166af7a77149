import os

import pytest
from pyspark.sql import functions as F

from corvid.operators import feed
from corvid.plans.standins import follow_edges, tweets
from corvid.sources.sinks import read_merged
from corvid.streaming import start_timeline_writer, timeline_stream

SF = "/root/testdata/sf0.001"


def _tweet_files(spark, d):
    tw = tweets(spark, SF)
    tw.repartition(4, "user_id").write.mode("overwrite").parquet(d)
    return tw


def test_stream_writer_equals_batch_push(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "tweets")
    tw = _tweet_files(spark, src)
    edges = follow_edges(spark, SF)
    stream = spark.readStream.schema(tw.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = start_timeline_writer(stream, edges, os.path.join(tmpdir_path, "timeline"),
                              checkpoint=os.path.join(tmpdir_path, "ckpt"), trigger={"availableNow": True})
    q.awaitTermination(300)
    got = read_merged(spark, os.path.join(tmpdir_path, "timeline"), ["user_id", "tweet_text"], "score")
    want = feed.timeline_push(tw, edges)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_stateful_timeline_stream(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "tweets")
    tw = _tweet_files(spark, src)
    edges = follow_edges(spark, SF)
    stream = spark.readStream.schema(tw.schema).option("maxFilesPerTrigger", 2).parquet(src)
    q = (timeline_stream(stream, edges).writeStream.outputMode("complete").format("memory")
         .queryName("tl_state").option("checkpointLocation", os.path.join(tmpdir_path, "ck2")).start())
    q.processAllAvailable()
    q.stop()
    got = spark.table("tl_state")
    want = feed.timeline_push(tw, edges)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_second_stream_with_a_new_checkpoint_adds_to_the_table(spark, tmpdir_path):
    edges = spark.createDataFrame([(1, 9), (2, 9)], "user_id long, follows_id long")
    schema = "user_id long, tweet_text string, score long"
    table = os.path.join(tmpdir_path, "timeline")
    for name, rows in (("one", [(9, "a", 5), (9, "b", 6)]), ("two", [(9, "b", 4), (9, "c", 7)])):
        src = os.path.join(tmpdir_path, name)
        spark.createDataFrame(rows, schema).repartition(2).write.parquet(src)
        q = start_timeline_writer(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src), edges, table,
                                  checkpoint=os.path.join(tmpdir_path, "ck-" + name), trigger={"availableNow": True})
        q.awaitTermination(120)
    got = {(r.user_id, r.tweet_text): r.score for r in
           read_merged(spark, table, ["user_id", "tweet_text"], "score").collect()}
    assert got == {(u, t): s for u in (1, 2) for t, s in (("a", 5), ("b", 6), ("c", 7))}


def test_writer_restarted_with_defaults_goes_on(spark, tmpdir_path):
    """The default checkpoint belongs to the table and the name: a second start reads only new files."""
    edges = spark.createDataFrame([(1, 9)], "user_id long, follows_id long")
    schema = "user_id long, tweet_text string, score long"
    src, table = os.path.join(tmpdir_path, "src"), os.path.join(tmpdir_path, "timeline")

    def run(name):
        q = start_timeline_writer(spark.readStream.schema(schema).parquet(src), edges, table, query_name=name,
                                  trigger={"availableNow": True})
        q.awaitTermination(120)
        return q

    spark.createDataFrame([(9, "a", 5)], schema).write.parquet(src)
    first = run("posts")
    spark.createDataFrame([(9, "a", 7), (9, "b", 1)], schema).write.mode("append").parquet(src)
    second = run("posts")
    assert first.id == second.id and second.lastProgress["numInputRows"] == 2
    other = run("others")  # another name is another writer with a checkpoint of its own
    assert other.id != first.id and other.lastProgress["numInputRows"] == 3
    got = {(r.user_id, r.tweet_text): r.score for r in read_merged(spark, table, ["user_id", "tweet_text"], "score").collect()}
    assert got == {(1, "a"): 7, (1, "b"): 1}
    with pytest.raises(ValueError):
        start_timeline_writer(spark.readStream.schema(schema).parquet(src), edges, table)
