"""Registered feed queries (edges and tweets derived from ``events``)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corvid.operators import feed
from corvid.plans.ranking import row_number_within
from corvid.plans.registry import register
from corvid.plans.standins import EDGES_SQL, TWEETS_SQL, follow_edges, tweets
from corvid.session import delete_folder, ensure_checkpoint_dir
from corvid.sources.sinks import read_merged
from corvid.streaming import start_timeline_writer

# The user whose followers / followees are looked up.
LOOKUP_USER = 7
# Tweets before this instant form the stored timeline; the rest arrive as an update.
UPSERT_CUTOFF = "2024-01-15 00:00:00"
# Files (so batches) of each of the two streams.
STREAM_BATCHES = 3

_CTES = f"""
WITH edges AS ({EDGES_SQL}),
tw AS ({TWEETS_SQL}),
posts AS (SELECT user_id, tweet_text, max(score) AS score FROM tw GROUP BY user_id, tweet_text),
fan AS (SELECT e.user_id AS reader, p.tweet_text, p.score
        FROM posts p JOIN (SELECT DISTINCT user_id, follows_id FROM edges) e ON p.user_id = e.follows_id),
push AS (SELECT reader AS user_id, tweet_text, max(score) AS score FROM fan GROUP BY reader, tweet_text)
"""


def _inputs(spark, sf_dir):
    return tweets(spark, sf_dir), follow_edges(spark, sf_dir)


@register("followers_sets", sql=_CTES + """SELECT DISTINCT follows_id AS user_id,
    user_id AS follower_id FROM edges""")
def followers_sets(spark, sf_dir):
    """Set of followers per user, one row per (user, follower)."""
    return feed.follower_sets(follow_edges(spark, sf_dir))


@register("following_sets", sql=_CTES + """SELECT DISTINCT user_id, follows_id AS followee_id
    FROM edges""")
def following_sets(spark, sf_dir):
    """Set of followees per user, one row per (user, followee)."""
    return feed.following_sets(follow_edges(spark, sf_dir))


PACK_WIDTH = 4


@register("followers_packed", sql=_CTES + f"""SELECT follows_id AS user_id,
    CAST(user_id // {PACK_WIDTH} AS BIGINT) AS chunk, list_sort(list(DISTINCT user_id)) AS members
    FROM edges GROUP BY follows_id, user_id // {PACK_WIDTH}""")
def followers_packed(spark, sf_dir):
    """A8 as arrays: sorted follower arrays per user, each of at most a fixed number of members."""
    return feed.pack_sets(feed.follower_sets(follow_edges(spark, sf_dir)), "user_id", "follower_id", PACK_WIDTH)


@register("followers_of", sql=_CTES + f"""SELECT DISTINCT user_id AS follower_id FROM edges
    WHERE follows_id = {LOOKUP_USER}""")
def followers_of(spark, sf_dir):
    """Followers of one user (key lookup)."""
    return feed.followers_of(follow_edges(spark, sf_dir), LOOKUP_USER)


@register("followees_of", sql=_CTES + f"""SELECT DISTINCT follows_id AS followee_id FROM edges
    WHERE user_id = {LOOKUP_USER}""")
def followees_of(spark, sf_dir):
    """Users one user follows (key lookup)."""
    return feed.followees_of(follow_edges(spark, sf_dir), LOOKUP_USER)


@register("posts_by_author", sql=_CTES + "SELECT user_id, tweet_text, score FROM posts")
def posts_by_author(spark, sf_dir):
    """A10: each author's sorted set of posts, newest score per text."""
    return feed.posts_by_author(tweets(spark, sf_dir))


@register("timeline_push", sql=_CTES + "SELECT user_id, tweet_text, score FROM push")
def timeline_push(spark, sf_dir):
    """J2+A10: fan-out on write, every follower's timeline, newest score per text."""
    tw, edges = _inputs(spark, sf_dir)
    return feed.timeline_push(tw, edges)


@register("timeline_pull", sql=_CTES + """SELECT reader AS user_id, tweet_text,
    sum(CAST(score AS DECIMAL(38,0))) AS score FROM fan GROUP BY reader, tweet_text""")
def timeline_pull(spark, sf_dir):
    """J3+A11+U1: union on read for every reader, equal texts' scores summed."""
    tw, edges = _inputs(spark, sf_dir)
    return feed.timeline_pull(tw, edges, combine="sum")


@register("timeline_ordered", sql=_CTES + """SELECT user_id, tweet_text, score,
    row_number() OVER (PARTITION BY user_id ORDER BY score, tweet_text) AS rank FROM push""")
def timeline_ordered(spark, sf_dir):
    """O1: read order of every pushed timeline (rank by score, ties by text)."""
    tw, edges = _inputs(spark, sf_dir)
    return feed.timeline_ordered(feed.timeline_push(tw, edges))


@register("feed_upsert", sql=_CTES + "SELECT user_id, tweet_text, score FROM push")
def feed_upsert(spark, sf_dir):
    """K2: stored timeline (tweets before a cutoff) upserted with the later tweets' fan-out."""
    tw, edges = _inputs(spark, sf_dir)
    cutoff = F.lit(UPSERT_CUTOFF).cast("timestamp_ntz")  # on the raw column: pushed into the scan
    earlier = F.col("ts") < cutoff
    stored = feed.timeline_push(tw.filter(earlier), edges)
    # everything else is the update, tweets without a time included
    updates = feed.timeline_push(tw.filter(~earlier | F.col("ts").isNull()), edges)
    return feed.upsert_sorted_set(stored, updates)


@register("timeline_read_push", sql=_CTES + f"""SELECT tweet_text, score,
    row_number() OVER (ORDER BY score, tweet_text) AS pos FROM push WHERE user_id = {LOOKUP_USER}""")
def timeline_read_push(spark, sf_dir):
    """O1+P8: one user's precomputed timeline in read order (position by score, then text)."""
    tw, edges = _inputs(spark, sf_dir)
    one = feed.timeline_of(feed.timeline_push(tw, edges), LOOKUP_USER)
    return feed.timeline_ordered(one, out="pos").select("tweet_text", "score", "pos")


@register("timeline_read_pull", sql=_CTES + f"""SELECT tweet_text,
    sum(CAST(score AS DECIMAL(38,0))) AS score,
    row_number() OVER (ORDER BY sum(CAST(score AS DECIMAL(38,0))), tweet_text) AS pos
    FROM fan WHERE reader = {LOOKUP_USER} GROUP BY tweet_text""")
def timeline_read_pull(spark, sf_dir):
    """J3+O1: one user's timeline merged on read (only that user's edges are joined), in read order."""
    tw, edges = _inputs(spark, sf_dir)
    one = feed.timeline_pull(tw, edges, reader=LOOKUP_USER)
    return feed.timeline_ordered(one, out="pos").select("tweet_text", "score", "pos")


@register("timeline_ordered_text", sql=_CTES + """SELECT user_id, tweet_text, score,
    row_number() OVER (PARTITION BY user_id ORDER BY tweet_text) AS rank FROM push""")
def timeline_ordered_text(spark, sf_dir):
    """O1 by member: every pushed timeline ranked by its texts."""
    tw, edges = _inputs(spark, sf_dir)
    return row_number_within(feed.timeline_push(tw, edges), [feed.USER], [feed.TEXT])


# Authors with this many followers (by the sketch) are merged on read.
HEAVY_FOLLOWERS = 4
ENDS = 3


@register("timeline_split", sql=_CTES + "SELECT user_id, tweet_text, score FROM push")
def timeline_split(spark, sf_dir):
    """J2+J3+U1: posts of authors with few followers pushed, those of the others merged on read; equals the push form."""
    tw, edges = _inputs(spark, sf_dir)
    heavy = feed.heavy_authors(edges, HEAVY_FOLLOWERS)
    return feed.split_read(feed.split_push(tw, edges, heavy), tw, edges, heavy)


@register("timeline_first", sql=_CTES + f"""SELECT * FROM (SELECT user_id, tweet_text, score,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY score, tweet_text) AS INTEGER) AS rank FROM push)
    WHERE rank <= {ENDS}""")
def timeline_first(spark, sf_dir):
    """O1 with bounds: the first three entries of every pushed timeline."""
    tw, edges = _inputs(spark, sf_dir)
    return feed.timeline_ends(feed.timeline_push(tw, edges), ENDS)


@register("timeline_last", sql=_CTES + f"""SELECT * FROM (SELECT user_id, tweet_text, score,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, tweet_text DESC) AS INTEGER) AS rank FROM push)
    WHERE rank <= {ENDS}""")
def timeline_last(spark, sf_dir):
    """O1 with bounds: the last three entries of every pushed timeline, newest first."""
    tw, edges = _inputs(spark, sf_dir)
    return feed.timeline_ends(feed.timeline_push(tw, edges), ENDS, newest=True)


@register("timeline_stream_push", sql=_CTES + "SELECT user_id, tweet_text, score FROM push")
def timeline_stream_push(spark, sf_dir):
    """J2/K2 as Structured Streaming: two streams with checkpoints of their own, each of several
    batches, push the tweets into one table; the result merges what they appended.

    The earlier tweets are the first stream's source, the others (and those without a
    time) the second's; both are written as several files, one batch each.
    """
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corvid-stream-{uuid.uuid4().hex}"
    tw, edges = _inputs(spark, sf_dir)
    earlier = F.col("ts") < F.lit(UPSERT_CUTOFF).cast("timestamp_ntz")
    for name, part in (("first", tw.filter(earlier)), ("second", tw.filter(~earlier | F.col("ts").isNull()))):
        part.repartition(STREAM_BATCHES, "user_id").write.parquet(f"{base}/source-{name}")
        source = (spark.readStream.schema(tw.schema).option("maxFilesPerTrigger", 1)
                  .parquet(f"{base}/source-{name}"))
        query = start_timeline_writer(source, edges, f"{base}/timeline", checkpoint=f"{base}/checkpoint-{name}",
                                      trigger={"availableNow": True})
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        for spent in (f"{base}/source-{name}", f"{base}/checkpoint-{name}"):  # only the table is read below
            delete_folder(spark, spent)
    return read_merged(spark, f"{base}/timeline", [feed.USER, feed.TEXT], feed.SCORE)
