"""The given tables in the roles of posts, ticker map, prices and word lists.

Each role is a DataFrame here and a common table expression in `catalog.sql`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postpulse.sources import local_frame, spread

# Role tables that the given data has no table for.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
EXPLICIT_TERMS = (
    "trash", "scum", "idiot", "clown", "worthless",
    "moron", "pathetic", "loser", "stupid", "disgusting",
)
LEXICON = (
    ("best", 1.0, None, False),
    ("trash", -0.625, None, False),
    ("scum", -0.75, None, False),
    ("idiot", -0.75, None, False),
    ("clown", -0.25, None, False),
    ("worthless", -0.5, None, False),
    ("moron", -0.75, None, False),
    ("pathetic", -0.625, None, False),
    ("stupid", -0.5, None, False),
    ("disgusting", -1.0, None, False),
    ("very", None, 1.25, False),
    ("of", None, 0.5, False),
    ("the", None, None, True),
    ("not", None, None, True),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = {"A": "comment_num", "N": "retweet_num", "R": "like_num"}
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("tweet_id"))
        .agg(*[F.count_if(F.col("l_returnflag") == f).alias(n) for f, n in flags.items()])
    )


def posts(
    spark: SparkSession, sf_dir: str, of_texts: Callable[[DataFrame], DataFrame] = lambda texts: texts
) -> DataFrame:
    """Documents as posts of the orders of their ids; `of_texts` may replace the body before the joins."""
    epoch = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), "o_orderdate")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("tweet_id"), epoch.alias("post_date")
    )
    texts = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("tweet_id"),
        F.col("source").alias("writer"),
        F.col("text").alias("body"),
    )
    names = ("comment_num", "retweet_num", "like_num")
    texts = of_texts(spread(texts, "tweet_id"))
    rest = [name for name in texts.columns if name not in ("tweet_id", "writer")]
    return (
        texts.join(orders, "tweet_id")
        .join(counters(spark, sf_dir), "tweet_id", "left")
        .select(
            "tweet_id",
            "writer",
            "post_date",
            *rest,
            *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in names],
        )
    )


def ticker_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ticker per post."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("tweet_id"), F.col("o_orderpriority").alias("ticker_symbol")
    )


def ticker_map_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several tickers per post."""
    names = F.array(*[F.lit(p) for p in PRIORITIES])
    pick = F.get(names, (F.col("l_suppkey") % 5).cast("int"))
    return (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_orderkey").alias("tweet_id"), pick.alias("ticker_symbol"))
        .distinct()
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("ticker_symbol")
        )
        .agg(F.max("o_totalprice").alias("adj_close"))
    )


def explicit_terms(spark: SparkSession) -> DataFrame:
    return local_frame(spark, [(t,) for t in EXPLICIT_TERMS], "term string")


def lexicon(spark: SparkSession) -> DataFrame:
    return local_frame(
        spark, LEXICON, "term string, polarity double, intensity double, negator boolean"
    )


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct lower-case words of the benchmark texts."""
    from postpulse.functions import words

    texts = table(spark, sf_dir, "benchmark")
    return texts.select(F.explode(words(F.lower("text"))).alias("term")).distinct()
