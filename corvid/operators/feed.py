"""Social feed workload as tables: follow edges, posts, timelines.

A keyed set (``followers:<id>``) becomes a deduplicated edge table; a keyed
sorted set (``timeline:<id>``) becomes ``(user_id, tweet_text, score)`` unique
on ``(user_id, tweet_text)``.  Inputs:

* edges  ``(user_id, follows_id)``: ``user_id`` follows ``follows_id``
* tweets ``(user_id, tweet_text, score)``: ``score`` = post time in microseconds

Fan-out on write (push) and union on read (pull) are the same join of posts
to edges on the author; they differ in the aggregate over equal texts.  Posts
are reduced to one row per (author, text) *before* the join, so the join
input does not grow with repeated posts.  A celebrity author (a third of all
edges) is one skewed join key: with AQE on (the default) a skewed sort-merge
join partition is split, and the aggregates after the join are partial
(map-side) aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvid.plans.joins import broadcast_if_small
from corvid.plans.ranking import row_number_within

USER, FOLLOWS, TEXT, SCORE = "user_id", "follows_id", "tweet_text", "score"

# Sorted-set scores can be summed across authors (union on read).  Microsecond
# stamps near 1.7e15 overflow BIGINT after ~5,400 equal texts, so sums are exact
# DECIMAL(38, 0).
SUM_TYPE = "decimal(38,0)"

# Longest array of a packed set.
PACK_WIDTH = 1 << 16


def follower_sets(edges: DataFrame) -> DataFrame:
    """Followers of every user, one row per member: ``(user_id, follower_id)``.

    Users without followers have no row; every user id present is kept (no id
    range is assumed).
    """
    return (edges.select(F.col(FOLLOWS).alias(USER), F.col(USER).alias("follower_id"))
            .filter(F.col(USER).isNotNull() & F.col("follower_id").isNotNull())
            .distinct())


def following_sets(edges: DataFrame) -> DataFrame:
    """Users each user follows, one row per member: ``(user_id, followee_id)``."""
    return (edges.select(F.col(USER), F.col(FOLLOWS).alias("followee_id"))
            .filter(F.col(USER).isNotNull() & F.col("followee_id").isNotNull())
            .distinct())


def pack_sets(sets: DataFrame, key: str, member: str, width: int = PACK_WIDTH) -> DataFrame:
    """Pack a long-form set into sorted arrays: ``(key, chunk, members array)``.

    A chunk holds the members of one range of ``width`` ids (``floor(member / width)``), so no array is longer than
    ``width`` however large a set grows, a member's chunk never changes, and the chunks of a hot key are built by
    as many tasks.  Chunks in order give the sorted set.
    """
    first = F.col(member) - F.pmod(F.col(member), F.lit(width))  # whole numbers: exact for every long
    return (sets.withColumn("_first", first.cast("long")).withColumn("chunk", F.expr(f"_first div {int(width)}"))
            .groupBy(key, "chunk")
            .agg(F.sort_array(F.collect_list(member)).alias("members")))


def followers_of(edges: DataFrame, user_id: int) -> DataFrame:
    """Followers of one user: ``(follower_id)``."""
    return (edges.filter(F.col(FOLLOWS) == F.lit(user_id))
            .select(F.col(USER).alias("follower_id")).distinct())


def followees_of(edges: DataFrame, user_id: int) -> DataFrame:
    """Users one user follows: ``(followee_id)``."""
    return (edges.filter(F.col(USER) == F.lit(user_id))
            .select(F.col(FOLLOWS).alias("followee_id")).distinct())


def posts_by_author(tweets: DataFrame) -> DataFrame:
    """Each author's sorted set of posts: newest score per (author, text)."""
    return tweets.groupBy(USER, TEXT).agg(F.max(SCORE).alias(SCORE))


def _fan(posts: DataFrame, edges: DataFrame) -> DataFrame:
    """(reader, text, author score) for every post of every followee of every reader."""
    e = edges.select(F.col(USER).alias("_reader"), F.col(FOLLOWS).alias("_author")).distinct()
    p = posts.select(F.col(USER).alias("_author"), TEXT, SCORE)
    return p.join(e, "_author")


def timeline_push(tweets: DataFrame, edges: DataFrame) -> DataFrame:
    """Fan-out on write: every tweet lands on each follower's timeline.

    Equal texts on one timeline keep the newest score (``zadd`` overwrites).
    Result ``(user_id, tweet_text, score)``, user_id = the timeline's owner.
    """
    return (_fan(posts_by_author(tweets), edges)
            .groupBy(F.col("_reader").alias(USER), TEXT)
            .agg(F.max(SCORE).alias(SCORE)))


def timeline_pull(tweets: DataFrame, edges: DataFrame, reader: int | None = None,
                  combine: str = "sum") -> DataFrame:
    """Union on read: the posts of the users a reader follows, merged by text.

    ``combine='sum'`` is the sorted-set union default: the scores of equal texts
    from different authors add up (as DECIMAL(38,0)), so such a text sorts last.
    ``combine='max'`` keeps the newest and then equals ``timeline_push``.
    ``reader`` restricts to one reader; the filter is applied to the edges
    before the join.
    """
    if combine not in ("sum", "max"):
        raise ValueError("combine must be 'sum' or 'max'")
    if reader is not None:
        edges = edges.filter(F.col(USER) == F.lit(reader))
    fan = _fan(posts_by_author(tweets), edges)
    agg = (F.sum(F.col(SCORE).cast(SUM_TYPE)) if combine == "sum" else F.max(SCORE)).alias(SCORE)
    return fan.groupBy(F.col("_reader").alias(USER), TEXT).agg(agg)


def timeline_ordered(timeline: DataFrame, key: str = USER, score: str = SCORE,
                     member: str = TEXT, out: str = "rank") -> DataFrame:
    """Read order of every timeline: rank 1.. by ascending score, ties by member bytes.

    Uses ``row_number_within`` so that a user with a huge timeline is numbered
    by several tasks, not one.
    """
    return row_number_within(timeline, [key], [score, member], out=out)


def heavy_authors(edges: DataFrame, min_followers: int, most: int = 1000, tracked: int = 10_000) -> DataFrame:
    """Authors that a frequent-items sketch gives at least ``min_followers`` followers: ``(user_id)``.

    ``approx_top_k`` keeps ``tracked`` counters a task and merges them: one row of at most ``most`` authors, whatever
    the number of edges.  The sketch decides only which way an author's posts take, never a result, so its
    error costs speed at most; ``most`` bounds the pull path, authors beyond it are pushed.
    """
    top = edges.filter(F.col(FOLLOWS).isNotNull()).agg(
        F.expr(f"approx_top_k({FOLLOWS}, {int(most)}, {int(tracked)})").alias("_top"))
    return (top.select(F.explode("_top").alias("_t")).filter(F.col("_t.count") >= min_followers)
            .select(F.col("_t.item").alias(USER)))


def split_push(tweets: DataFrame, edges: DataFrame, heavy: DataFrame) -> DataFrame:
    """The stored part of a split feed: timelines from the posts of all authors but the ``heavy`` ones.

    ``heavy`` is a small list (see ``heavy_authors``); both anti joins are map-side, so neither the posts nor the
    edges of a heavy author reach the fan-out's shuffle.
    """
    light = F.broadcast(heavy.select(F.col(USER).alias("_heavy")))  # at most ``most`` rows
    return timeline_push(tweets.join(light, F.col(USER) == F.col("_heavy"), "left_anti"),
                         edges.join(light, F.col(FOLLOWS) == F.col("_heavy"), "left_anti"))


def split_read(stored: DataFrame, tweets: DataFrame, edges: DataFrame, heavy: DataFrame,
               reader: int | None = None) -> DataFrame:
    """Read a split feed: the stored timelines and, merged on read, the posts of the ``heavy`` authors.

    Equal texts keep the newest score, so the result equals ``timeline_push`` whoever is heavy.  The heavy authors'
    posts, one row per (author, text), are broadcast to their edges if a size check allows; else the join is a
    shuffle join that adaptive execution splits.  ``reader`` restricts both parts before the join.
    """
    few = F.broadcast(heavy.select(F.col(USER).alias("_heavy")))
    if reader is not None:
        stored, edges = timeline_of(stored, reader), edges.filter(F.col(USER) == F.lit(reader))
    posts = posts_by_author(tweets.join(few, F.col(USER) == F.col("_heavy"), "left_semi")).select(
        F.col(USER).alias("_author"), TEXT, SCORE)
    small = broadcast_if_small(posts)
    follows = (edges.join(few, F.col(FOLLOWS) == F.col("_heavy"), "left_semi")
               .select(F.col(USER).alias("_reader"), F.col(FOLLOWS).alias("_author")))
    pulled = follows.join(small if small is not None else posts, "_author").select(F.col("_reader").alias(USER), TEXT, SCORE)
    return (stored.select(USER, TEXT, SCORE).unionByName(pulled)
            .groupBy(USER, TEXT).agg(F.max(SCORE).alias(SCORE)))


def timeline_ends(timeline: DataFrame, n: int, newest: bool = False, key: str = USER, score: str = SCORE,
                  member: str = TEXT, out: str = "rank") -> DataFrame:
    """The first ``n`` entries of every timeline in read order, or with ``newest`` the last ``n`` in reverse order.

    ``rank`` 1.. counts from that end (``zrange(key, 0, n - 1)`` and ``zrevrange``).  The limit is pushed below the
    shuffle (window group limit): a task sends at most ``n`` rows a timeline, so a hot timeline is no hot partition.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    by = [F.col(score), F.col(member)]
    order = Window.partitionBy(key).orderBy(*[c.desc() for c in by] if newest else by)
    return timeline.withColumn(out, F.row_number().over(order)).filter(F.col(out) <= n)


def timeline_of(timeline: DataFrame, user_id: int, key: str = USER) -> DataFrame:
    """One user's timeline rows (unordered)."""
    return timeline.filter(F.col(key) == F.lit(user_id))


def read_timeline(timeline: DataFrame, user_id: int, key: str = USER,
                  score: str = SCORE, member: str = TEXT) -> DataFrame:
    """One user's timeline in read order (the ``zrange(key, 0, -1)`` view)."""
    return timeline_of(timeline, user_id, key).orderBy(score, member)


def upsert_sorted_set(existing: DataFrame, updates: DataFrame,
                      keys: Sequence[str] = (USER, TEXT), score: str = SCORE,
                      combine: str = "max") -> DataFrame:
    """Merge new ``(keys..., score)`` rows into a sorted-set table.

    ``max``: the newest write of a member wins (``zadd``); ``sum``: scores add
    (``zincrby``).  Both sides are unioned and re-aggregated with a partial
    aggregate, so the update costs one shuffle of the two inputs.
    """
    if combine not in ("max", "sum"):
        raise ValueError("combine must be 'max' or 'sum'")
    keys = list(keys)
    both = existing.select(*keys, score).unionByName(updates.select(*keys, score))
    fn = F.max if combine == "max" else F.sum
    return both.groupBy(*keys).agg(fn(score).alias(score))
