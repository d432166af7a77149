import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corvid.operators import feed
from corvid.plans.ranking import row_number_within

EDGES = "user_id long, follows_id long"
TWEETS = "user_id long, tweet_text string, score long"


def _edges(spark):
    # users 1..4, user 4 is the maximum id, user 2 has no followers
    return spark.createDataFrame([(1, 3), (2, 1), (2, 4), (3, 4), (4, 1), (4, 3), (4, 3)], EDGES)


def test_sets_include_max_user_and_skip_users_without_followers(spark):
    e = _edges(spark)
    followers = {}
    for r in feed.follower_sets(e).collect():
        followers.setdefault(r.user_id, []).append(r.follower_id)
    assert {k: sorted(v) for k, v in followers.items()} == {1: [2, 4], 3: [1, 4], 4: [2, 3]}
    assert 2 not in followers  # no followers -> no row
    following = {}
    for r in feed.following_sets(e).collect():
        following.setdefault(r.user_id, []).append(r.followee_id)
    assert sorted(following[4]) == [1, 3]  # max user kept, duplicate edge deduped


def test_lookups(spark):
    e = _edges(spark)
    assert sorted(r.follower_id for r in feed.followers_of(e, 4).collect()) == [2, 3]
    assert sorted(r.followee_id for r in feed.followees_of(e, 4).collect()) == [1, 3]
    assert feed.followers_of(e, 99).count() == 0


def test_push_pull_semantics(spark):
    e = spark.createDataFrame([(10, 1), (10, 2), (11, 1)], EDGES)
    # two authors post the same text; author 1 posts it twice
    tw = spark.createDataFrame([(1, "hi", 100), (1, "hi", 300), (2, "hi", 200), (2, "yo", 50)], TWEETS)
    push = {(r.user_id, r.tweet_text): r.score for r in feed.timeline_push(tw, e).collect()}
    assert push == {(10, "hi"): 300, (10, "yo"): 50, (11, "hi"): 300}
    pull = {(r.user_id, r.tweet_text): int(r.score) for r in feed.timeline_pull(tw, e).collect()}
    assert pull == {(10, "hi"): 500, (10, "yo"): 50, (11, "hi"): 300}
    pull_max = {(r.user_id, r.tweet_text): r.score for r in feed.timeline_pull(tw, e, combine="max").collect()}
    assert pull_max == push
    one = feed.timeline_pull(tw, e, reader=11).collect()
    assert [(r.user_id, r.tweet_text) for r in one] == [(11, "hi")]


def test_pull_sum_is_decimal(spark):
    e = spark.createDataFrame([(10, 1), (10, 2)], EDGES)
    big = 1_700_000_000_000_000
    tw = spark.createDataFrame([(1, "x", big), (2, "x", big)], TWEETS)
    r = feed.timeline_pull(tw, e).first()
    assert dict(feed.timeline_pull(tw, e).dtypes)["score"] == "decimal(38,0)"
    assert int(r.score) == 2 * big


def test_ordered_timeline_matches_window_on_a_hot_user(spark):
    rows = [(1, f"t{i:05d}", (i * 7919) % 1000) for i in range(3000)]  # one hot user
    rows += [(u, f"t{i}", i) for u in range(2, 40) for i in range(5)]
    tl = spark.createDataFrame(rows, TWEETS)
    w = Window.partitionBy("user_id").orderBy("score", "tweet_text")
    want = tl.withColumn("rank", F.row_number().over(w).cast("long"))
    for ranges in (1, 7, 40):
        got = row_number_within(tl, ["user_id"], ["score", "tweet_text"], ranges=ranges)
        assert got.count() == want.count()
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_ranking_of_texts_ties_and_nulls_matches_a_window(spark):
    """Text order (10 before 9), all scores equal, null keys and scores, a key with a third of the rows."""
    rows = [(1 if i % 3 == 0 else (None if i % 50 == 1 else i % 11), str(i), 5 if i % 7 else None) for i in range(2000)]
    tl = spark.createDataFrame(rows, TWEETS)
    for order in (["tweet_text"], ["score", "tweet_text"]):
        w = Window.partitionBy("user_id").orderBy(*order)
        want = tl.withColumn("rank", F.row_number().over(w).cast("long"))
        got = row_number_within(tl, ["user_id"], order, ranges=16)
        assert got.exceptAll(want).count() == 0 and got.count() == 2000


def test_ranking_spreads_tied_rows(spark):
    """40,000 rows of one key with one score: their ranges are numbered by several tasks."""
    tl = spark.range(40_000).selectExpr("1L AS user_id", "cast(id AS string) AS tweet_text", "7L AS score")
    got = row_number_within(tl, ["user_id"], ["score", "tweet_text"], ranges=16)
    from corvid.plans.ranking import _ranged
    sizes = [r["count"] for r in _ranged(tl, ["user_id", "score", "tweet_text"], 16).groupBy("_range").count().collect()]
    assert len(sizes) >= 14 and max(sizes) < 8_000
    assert got.agg(F.max("rank"), F.countDistinct("rank")).first() == (40_000, 40_000)


def test_upsert_keeps_newest(spark):
    old = spark.createDataFrame([(1, "a", 5), (1, "b", 9)], TWEETS)
    new = spark.createDataFrame([(1, "a", 7), (1, "b", 3), (2, "c", 1)], TWEETS)
    out = {(r.user_id, r.tweet_text): r.score for r in feed.upsert_sorted_set(old, new).collect()}
    assert out == {(1, "a"): 7, (1, "b"): 9, (2, "c"): 1}


def test_pack_sets_chunks_by_member_range(spark):
    big = 2 ** 62 + 5
    rows = [(1, i) for i in range(250)] + [(2, 7), (2, -1), (2, big), (2, big + 1)]
    sets = spark.createDataFrame(rows, "user_id long, follower_id long")
    packed = feed.pack_sets(sets, "user_id", "follower_id", width=100).collect()
    hot = sorted((r.chunk, r.members) for r in packed if r.user_id == 1)
    assert hot == [(0, list(range(100))), (1, list(range(100, 200))), (2, list(range(200, 250)))]
    assert all(len(r.members) <= 100 for r in packed)
    assert sorted((r.chunk, r.members) for r in packed if r.user_id == 2) == [
        (-1, [-1]), (0, [7]), (big // 100, [big, big + 1])]


def _hot_feed(spark):
    """One author followed by a third of all edges, posting much; texts shared between authors."""
    edges = [(u, 0) for u in range(300)] + [(u, 1 + (u * k) % 120) for u in range(300) for k in (3, 7)]
    tw = [(0, f"t{i % 40}", i) for i in range(100)] + [(1 + i % 120, f"t{i % 55}", 1000 - i) for i in range(400)] + [(None, "n", 1)]
    return spark.createDataFrame(tw, TWEETS), spark.createDataFrame(edges + [(5, None), (None, 5)], EDGES)


def test_heavy_authors_by_sketch(spark):
    _, edges = _hot_feed(spark)
    assert [r.user_id for r in feed.heavy_authors(edges, 200).collect()] == [0]
    assert feed.heavy_authors(edges, 10 ** 6).count() == 0
    assert feed.heavy_authors(edges, 1, most=7).count() == 7
    assert feed.heavy_authors(edges.limit(0), 1).count() == 0


def test_split_feed_equals_push_whoever_is_heavy(spark):
    tw, edges = _hot_feed(spark)
    want = sorted(map(tuple, feed.timeline_push(tw, edges).collect()), key=str)
    ids = lambda xs: spark.createDataFrame([(x,) for x in xs], "user_id long")
    for heavy in (ids([]), ids([0]), ids([0, 3, 9, 500]), feed.heavy_authors(edges, 200), feed.heavy_authors(edges, 1)):
        stored = feed.split_push(tw, edges, heavy)
        assert sorted(map(tuple, feed.split_read(stored, tw, edges, heavy).collect()), key=str) == want
    one = feed.split_read(feed.split_push(tw, edges, ids([0])), tw, edges, ids([0]), reader=7).collect()
    assert sorted(map(tuple, one), key=str) == [w for w in want if w[0] == 7]


def test_a_heavy_author_is_not_in_the_stored_part(spark):
    tw, edges = _hot_feed(spark)
    heavy = feed.heavy_authors(edges, 200)
    only_hot = tw.filter("user_id = 0")
    assert feed.split_push(only_hot, edges, heavy).count() == 0
    plan = feed.split_push(tw, edges, heavy)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 2  # both sides lose the heavy author before the fan-out join


@pytest.mark.parametrize("newest", [False, True])
def test_timeline_ends(spark, newest):
    rows = [(0 if i % 3 == 0 else i % 20, f"m{i:03}", i // 4) for i in range(600)] + [(None, "x", 1), (5, None, None)]
    tl = spark.createDataFrame(rows, TWEETS)
    got = feed.timeline_ends(tl, 4, newest)
    by = [F.desc("score"), F.desc("tweet_text")] if newest else [F.asc("score"), F.asc("tweet_text")]
    want = tl.withColumn("rank", F.row_number().over(Window.partitionBy("user_id").orderBy(*by))).collect()
    key = lambda r: (r.user_id is None, r.user_id or 0, r["rank"])
    assert sorted(got.collect(), key=key) == sorted((r for r in want if r["rank"] <= 4), key=key)
    with pytest.raises(ValueError):
        feed.timeline_ends(tl, 0)


def test_timeline_ends_are_limited_before_the_shuffle(spark):
    rows = spark.range(0, 20000).selectExpr("id % 3 AS user_id", "cast(id AS string) AS tweet_text", "id AS score")
    lines = feed.timeline_ends(rows, 5)._jdf.queryExecution().executedPlan().toString().splitlines()
    limits = [i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln]
    shuffle = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning(user_id" in ln]
    assert len(limits) == 2 and limits[0] < shuffle[0] < limits[1]  # final above, partial below the exchange


def test_read_timeline_order(spark):
    tl = spark.createDataFrame([(1, "b", 5), (1, "a", 5), (1, "c", 1), (2, "z", 0)], TWEETS)
    assert [r.tweet_text for r in feed.read_timeline(tl, 1).collect()] == ["c", "a", "b"]


def test_upsert_sum_adds_scores(spark):
    old = spark.createDataFrame([(1, "a", 5), (1, "b", 9)], TWEETS)
    new = spark.createDataFrame([(1, "a", 7), (2, "c", 1)], TWEETS)
    out = {(r.user_id, r.tweet_text): r.score for r in feed.upsert_sorted_set(old, new, combine="sum").collect()}
    assert out == {(1, "a"): 12, (1, "b"): 9, (2, "c"): 1}
    import pytest
    with pytest.raises(ValueError):
        feed.timeline_pull(old, spark.createDataFrame([(1, 1)], EDGES), combine="avg")
    with pytest.raises(ValueError):
        feed.upsert_sorted_set(old, new, combine="avg")
