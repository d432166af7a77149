"""Posting tweets as a stream: fan-out on write, incrementally.

The reference posts a file of tweets in a loop and pushes each one onto its
author's followers' timelines.  Here the tweets are a streaming source:

* ``timeline_stream``: stream-static join with the follow edges, then one
  stateful aggregate (newest score per reader and text) kept in the state
  store; ``outputMode('update')`` emits the changed timeline rows each batch.
* ``start_timeline_writer``: ``foreachBatch`` turns each micro-batch into timeline
  updates (batch operators, so posts are first reduced per author) and appends
  them under (stream, epoch).  A replayed epoch rewrites its own folder only; a stream with
  a new checkpoint is a new stream and adds to what others wrote.  Cost follows the
  batch, not the table; readers merge (``sources.sinks.read_merged``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corvid.operators import feed
from corvid.sources.sinks import append_delta


def timeline_stream(tweet_stream: DataFrame, edges: DataFrame) -> DataFrame:
    """Streaming ``(user_id, tweet_text, score)`` timeline rows, newest score per text."""
    e = edges.select(F.col(feed.USER).alias("_reader"), F.col(feed.FOLLOWS).alias("_author")).distinct()
    fan = tweet_stream.select(F.col(feed.USER).alias("_author"), feed.TEXT, feed.SCORE).join(e, "_author")
    return (fan.groupBy(F.col("_reader").alias(feed.USER), feed.TEXT)
            .agg(F.max(feed.SCORE).alias(feed.SCORE)))


def start_timeline_writer(tweet_stream: DataFrame, edges: DataFrame, table_path: str,
                          checkpoint: str | None = None, trigger: dict | None = None,
                          query_name: str | None = None) -> StreamingQuery:
    """Run the push write path as a stream into the table at ``table_path``.

    ``checkpoint`` defaults to a folder of the writer's own beside the table, ``<table_path>/_checkpoints/<query_name>``:
    the same writer started again, by another application too, goes on where it stopped.  A writer with neither a
    name nor a checkpoint cannot be told from another one and is refused.  ``trigger`` is passed to
    ``writeStream.trigger`` (e.g. ``{'availableNow': True}``).
    """
    if checkpoint is None:
        if not query_name:
            raise ValueError("name the writer (query_name) or its checkpoint folder")
        checkpoint = f"{table_path.rstrip('/')}/_checkpoints/{query_name}"

    def append(batch: DataFrame, epoch_id: int) -> None:
        # the query's id lives in its checkpoint: the same after a restart, another for a new checkpoint
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        append_delta(feed.timeline_push(batch, edges), table_path, stream, int(epoch_id), [feed.USER, feed.TEXT],
                     feed.SCORE, "max")

    writer = tweet_stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
