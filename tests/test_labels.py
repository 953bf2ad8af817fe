import datetime as dt

from pyspark.sql import functions as F

from postpulse.operators import labels
from postpulse.operators.joins import (
    dedupe_first,
    join_by_size,
    most_frequent,
    pair_first_posts,
    pair_posts,
    top_k,
)
from postpulse.sources import price_range, unpivot_prices


def day(n):
    return dt.date(2015, 1, n)


def test_engagement_levels(spark):
    values = [0.0, 0.5, 2.0, 2.5, 3.0, 11.0, 11.1, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select(labels.interaction_level(F.col("x")).alias("l")).collect()
    assert [r["l"] for r in rows] == ["none", "low", "low", "medium", "medium", "medium", "high", "0"]


def test_sentiment_edges(spark):
    df = spark.createDataFrame([(v,) for v in (-0.5, -0.49, 0.5, None)], "polarity double")
    rows = labels.add_sentiment(df).collect()
    assert [r["sentiment"] for r in rows] == ["negative", "neutral", "positive", "0"]


def test_price_change_keeps_unmatched_rows(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 0.0), (3, -1.0), (4, None)], "id int, price_diff double")
    rows = {r["id"]: r["price_change"] for r in labels.label_price_change(df).collect()}
    assert rows == {1: "increase", 3: "decrease", 4: "0"}


def test_price_diff_looks_at_the_shared_calendar(spark):
    prices = spark.createDataFrame(
        [
            (day(1), "A", 1.0), (day(3), "A", 5.0), (day(4), "A", 7.0),
            (day(1), "B", 1.0), (day(2), "B", 2.0), (day(3), "B", 4.0), (day(4), "B", None),
        ],
        "date date, ticker_symbol string, adj_close double",
    )
    rows = {(r[0].day, r[1]): r[2] for r in labels.price_diffs(prices).collect()}
    # A has no price on day 2, so none on days 1 and 3; B none on day 4.
    assert rows == {(2, "A"): 4.0, (2, "B"): 3.0}


def test_posts_off_the_calendar_go_and_unknown_tickers_stay(spark):
    prices = spark.createDataFrame(
        [(day(1), "A", 1.0), (day(2), "A", 2.0), (day(3), "A", 4.0)],
        "date date, ticker_symbol string, adj_close double",
    )
    posts = spark.createDataFrame(
        [(1, day(2), "A"), (2, day(2), "Z"), (3, day(9), "A")],
        "tweet_id long, date date, ticker_symbol string",
    )
    kept = labels.keep_trading_days(posts, prices)
    rows = {r["tweet_id"]: r["price_diff"] for r in labels.add_price_diff(kept, prices).collect()}
    assert rows == {1: 3.0, 2: None}


def test_post_date_is_the_utc_day(spark):
    df = spark.createDataFrame([(1420070399,), (1420070400,)], "post_date long")
    rows = labels.add_post_date(df).collect()
    assert [r["date"] for r in rows] == [dt.date(2014, 12, 31), dt.date(2015, 1, 1)]


def test_engagement_weights_skip_silent_posts_and_zero_means(spark):
    schema = "comment_num long, retweet_num long, like_num long"
    df = spark.createDataFrame([(0, 0, 0), (2, 0, 4), (0, 0, 2)], schema)
    row = labels.engagement_weights(df).first()
    assert (row["comment_mean"], row["retweet_mean"], row["like_mean"]) == (1.0, 0.0, 3.0)
    assert (row["likes_to_comments"], row["likes_to_retweets"]) == (3.0, None)
    assert {r["interaction_level"] for r in labels.add_interaction_level(df).collect()} == {"0"}


def test_missing_rows_are_counted_and_dropped(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan"))], "id int, x double")
    assert tuple(labels.missing_counts(df).first()) == (3, 1)
    assert [r["id"] for r in labels.drop_missing(df).collect()] == [1]


def test_price_range_is_half_open_and_unpivot_skips_gaps(spark):
    wide = spark.createDataFrame(
        [(day(1), 1.0, None), (day(2), 2.0, 5.0)], "date date, A double, B double"
    )
    long = unpivot_prices(wide, ["A", "B"])
    assert long.count() == 3
    assert price_range(long, "2015-01-01", "2015-01-02", ["A"]).count() == 1


POSTS = "tweet_id long, body string"
PAIRS = "tweet_id long, ticker_symbol string"


def test_dedupe_keeps_the_first_pair_of_a_body(spark):
    posts = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, None), (5, None)], POSTS)
    pairs = spark.createDataFrame([(1, "B"), (1, "A"), (2, "A"), (3, "C"), (5, "A")], PAIRS)
    want = {(1, "A"), (3, "C"), (5, "A")}
    joined = pair_posts(posts, pairs)
    assert joined.count() == 5
    first = dedupe_first(joined, ["body"], ["tweet_id", "ticker_symbol"])
    assert {(r["tweet_id"], r["ticker_symbol"]) for r in first.collect()} == want
    fused = pair_first_posts(posts, pairs)
    assert {(r["tweet_id"], r["ticker_symbol"]) for r in fused.collect()} == want


def test_a_repeated_post_stays_once(spark):
    posts = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x"), (3, "z")], POSTS)
    pairs = spark.createDataFrame([(1, "B"), (1, "A"), (2, "A"), (3, "C")], PAIRS)
    got = sorted(tuple(r) for r in pair_first_posts(posts, pairs).collect())
    assert got == [(1, "x", "A"), (3, "z", "C")]


def test_two_bodies_under_one_id_both_stay(spark):
    posts = spark.createDataFrame([(1, "x"), (1, "y"), (2, "y")], POSTS)
    pairs = spark.createDataFrame([(1, "B"), (1, "A"), (2, "A")], PAIRS)
    got = {tuple(r) for r in pair_first_posts(posts, pairs).collect()}
    assert got == {(1, "x", "A"), (1, "y", "A")}


def test_dedupe_of_a_body_shared_by_a_third_of_the_rows(spark):
    posts = spark.range(3000).select(
        F.col("id").alias("tweet_id"),
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("body"),
    )
    pairs = posts.select("tweet_id", F.lit("A").alias("ticker_symbol"))
    kept = pair_first_posts(posts, pairs)
    assert kept.count() == 2001
    assert kept.where("body = 'same'").first()["tweet_id"] == 0


def test_salted_join_equals_broadcast_join(spark):
    left = spark.range(2000).select(
        F.col("id"), F.when(F.col("id") % 3 > 0, F.col("id") % 50).otherwise(7).alias("k")
    )
    right = spark.createDataFrame([(k, k * 10) for k in range(0, 50, 2)] + [(7, 70)], "k long, v long")
    for how in ("inner", "left", "left_semi", "left_anti"):
        small = join_by_size(left, right, ["k"], how, ["id"])
        large = join_by_size(left, right, ["k"], how, ["id"], limit=0)
        assert sorted(map(str, small.collect())) == sorted(map(str, large.collect())), how


def test_top_k_of_groups_larger_and_smaller_than_k(spark):
    rows = [("a", f"t{i}", i % 7) for i in range(300)] + [("b", "t", 1)]
    df = spark.createDataFrame(rows, "g string, term string, count long")
    want = {
        (g, term): place
        for g in "ab"
        for place, (_, term) in enumerate(
            sorted((-c, t) for h, t, c in rows if h == g)[:60], start=1
        )
    }
    ordered = [F.desc("count"), F.asc("term")]
    for got in (
        top_k(df, ["g"], ordered, 60, "term"),
        most_frequent(df, ["g"], "count", 60, "term", True),
        most_frequent(df, ["g"], "count", 60, "term", False),
    ):
        assert {(r["g"], r["term"]): r["rank"] for r in got.collect()} == want
    whole = most_frequent(df.where("g = 'a'"), [], "count", 60, "term", True)
    assert {("a", r["term"]): r["rank"] for r in whole.collect()} == {
        k: v for k, v in want.items() if k[0] == "a"
    }
