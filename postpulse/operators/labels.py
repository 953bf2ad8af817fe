"""Dates, price moves around a day, engagement levels and sentiment buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postpulse.functions import choose
from postpulse.operators.joins import join_by_size

COUNTERS = ("comment_num", "retweet_num", "like_num")


def add_post_date(df: DataFrame) -> DataFrame:
    """Epoch seconds in `post_date` to a timestamp, and its UTC day in `date`."""
    day = F.date_from_unix_date(F.floor(F.col("post_date") / 86400).cast("int"))
    return df.withColumns({"date": day, "post_date": F.timestamp_seconds("post_date")})


def trading_days(prices: DataFrame) -> DataFrame:
    """The calendar: each day some ticker has a price."""
    return prices.select("date").distinct()


def keep_trading_days(df: DataFrame, prices: DataFrame) -> DataFrame:
    """Rows whose `date` is in the calendar.

    A calendar has one row per day, and a date column can hold 3.7 million days
    at most, so the broadcast is bounded by its type.
    """
    return df.join(F.broadcast(trading_days(prices)), "date", "left_semi")


def price_diffs(prices: DataFrame) -> DataFrame:
    """Price on the next calendar day minus price on the previous one, per ticker.

    Neighbours are days of the calendar that all tickers share, so a ticker
    without a price on one of them has no difference there. Each price is sent to the
    day before and the day after its own, where the two meet: no grid of all
    days by all tickers is built and no ticker's history is gathered in one
    window. Days without a difference are left out. `(date, ticker_symbol)` is
    unique in `prices`.
    """
    known = prices.where(F.col("adj_close").isNotNull() & ~F.isnan("adj_close"))
    # One row per day: bounded by the date type, see keep_trading_days.
    by_day = Window.orderBy("date")
    calendar = trading_days(prices).select(
        "date",
        F.lag("date").over(by_day).alias("day_before"),
        F.lead("date").over(by_day).alias("day_after"),
    )
    nothing = F.lit(None).cast("double")
    sent = F.explode(
        F.array(
            F.struct(
                F.col("day_before").alias("date"),
                F.col("adj_close").alias("after"),
                nothing.alias("before"),
            ),
            F.struct(
                F.col("day_after").alias("date"),
                nothing.alias("after"),
                F.col("adj_close").alias("before"),
            ),
        )
    )
    return (
        known.join(F.broadcast(calendar), "date")
        .select("ticker_symbol", sent.alias("s"))
        .select("ticker_symbol", "s.*")
        .where(F.col("date").isNotNull())
        .groupBy("date", "ticker_symbol")
        .agg((F.max("after") - F.max("before")).alias("price_diff"))
        .where(F.col("price_diff").isNotNull())
    )


def add_price_diff(
    df: DataFrame, prices: DataFrame, spread_by: Sequence[str] = ("tweet_id",)
) -> DataFrame:
    """`price_diff` of the row's ticker around its day; NULL where there is none."""
    diffs = price_diffs(prices)
    return join_by_size(df, diffs, ["date", "ticker_symbol"], "left", spread_by)


def price_change(diff: Column) -> Column:
    """Direction of a price difference; '0' where it is missing."""
    return choose([diff > 0, diff == 0, diff < 0], ["increase", "no change", "decrease"])


def label_price_change(df: DataFrame) -> DataFrame:
    """Add `price_change` and drop rows whose price did not move."""
    labelled = df.withColumn("price_change", price_change(F.col("price_diff")))
    return labelled.where(F.col("price_change") != "no change")


def has_engagement() -> Column:
    """Whether any of the three counters is positive."""
    comment, retweet, like = (F.col(name) > 0 for name in COUNTERS)
    return comment | retweet | like


def engagement_weights(df: DataFrame) -> DataFrame:
    """One row: mean counters over engaged rows and the two like ratios.

    A mean of zero gives a NULL ratio instead of an error.
    """
    means = df.where(has_engagement()).agg(
        *[F.avg(name).alias(f"{name.removesuffix('_num')}_mean") for name in COUNTERS]
    )
    return means.withColumns(
        {
            "likes_to_comments": F.try_divide("like_mean", "comment_mean"),
            "likes_to_retweets": F.try_divide("like_mean", "retweet_mean"),
        }
    )


def interaction_level(combined: Column) -> Column:
    """Level of a combined count; values in (2, 3] are medium."""
    return choose(
        [
            combined > 11,
            (combined > 2) & (combined <= 11),
            (combined > 0) & (combined <= 3),
            combined == 0,
        ],
        ["high", "medium", "low", "none"],
    )


def combined_interactions(likes_to_comments: Column, likes_to_retweets: Column) -> Column:
    """Counters weighted so that each kind counts as much as a like."""
    comment, retweet, like = (F.col(name) for name in COUNTERS)
    return comment * likes_to_comments + retweet * likes_to_retweets + like


def add_interaction_level(df: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """Add `interaction_level`.

    The weights, by default those of `df` itself, enter as a one-row scalar
    subquery: nothing is joined and nothing passes through the driver. It reads
    three columns of `df`, so materialise an expensive `df` first.
    """
    weights = engagement_weights(df) if weights is None else weights
    ratios = weights.select(F.struct("likes_to_comments", "likes_to_retweets")).scalar()
    combined = combined_interactions(
        ratios.getField("likes_to_comments"), ratios.getField("likes_to_retweets")
    )
    return df.withColumn("interaction_level", interaction_level(combined))


def sentiment(polarity: Column) -> Column:
    """Sentiment bucket of a polarity; '0' where it is missing."""
    return choose(
        [polarity <= -0.5, (polarity > -0.5) & (polarity < 0.5), polarity >= 0.5],
        ["negative", "neutral", "positive"],
    )


def add_sentiment(df: DataFrame) -> DataFrame:
    """Add `sentiment` from `polarity`."""
    return df.withColumn("sentiment", sentiment(F.col("polarity")))


def drop_missing(df: DataFrame) -> DataFrame:
    """Rows without any NULL or NaN."""
    return df.na.drop("any")


def missing_counts(df: DataFrame) -> DataFrame:
    """One row: number of rows before and after `drop_missing`, in one pass."""
    missing = F.lit(False)
    for name, kind in df.dtypes:
        gone = F.col(name).isNull()
        missing = missing | (gone | F.isnan(name) if kind in ("double", "float") else gone)
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(~missing).alias("rows_after")
    )


def preview(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first `n` rows by `order`."""
    return df.orderBy(*order).limit(n)
