"""Joins that hold when one key carries a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32


def _row_bytes(df: DataFrame) -> Column:
    size = F.lit(16)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType | T.BinaryType):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0)) + F.lit(8)
        elif isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType):
            # Every element takes a word at least, and its text is as long as it or longer.
            text = F.to_json(F.struct(field.name))
            size = size + F.lit(8) * F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(8)
        else:
            size = size + F.lit(8)
    return size


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of `df`, measured by one distributed sum, stay under `limit`."""
    total = df.agg(F.sum(_row_bytes(df).cast("long")).alias("bytes")).first()["bytes"]
    return (total or 0) <= limit


def join_by_size(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    spread_by: Sequence[str],
    limit: int = BROADCAST_BYTES,
    small: bool | None = None,
) -> DataFrame:
    """Join a large `left` to a lookup side of unknown size.

    The lookup side is measured, unless the caller has done so and says `small`.
    Small enough, it is broadcast and the left side
    is not shuffled. Otherwise the left rows of each key are dealt over `SALTS`
    sub-keys by a hash of `spread_by` (columns that differ within a key) and the
    lookup side is repeated once per sub-key, so a key that holds a third of all
    rows is worked on by many tasks. `how` is inner, left, left_semi or
    left_anti, for each of which meeting one copy is the same as meeting the key.
    """
    on = list(on)
    if fits_broadcast(right, limit) if small is None else small:
        return left.join(F.broadcast(right), on, how)
    salted_left = left.withColumn(
        "_salt", F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int")
    )
    copies = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted_right = right.withColumn("_salt", copies)
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")


def dedupe_first(df: DataFrame, subset: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per value of `subset`: the first by `order`, which must be unique.

    An aggregation rather than a window: repeats are folded in the tasks that
    read them, so a value that a third of the rows share is shuffled once per
    task and never gathered whole.
    """
    rest = [name for name in df.columns if name not in subset]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    kept = df.groupBy(*subset).agg(first)
    return kept.select(
        *[F.col(name) if name in subset else F.col(f"_first.{name}") for name in df.columns]
    )


def few_groups(df: DataFrame, by: Sequence[str]) -> bool:
    """Whether one row per group of `by` is small enough to broadcast."""
    return not by or fits_broadcast(df.select(*by).distinct())


def top_k(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, spread_by: str
) -> DataFrame:
    """The first `k` rows of each group by `order`, numbered in `rank`.

    Two levels: the first `k` of each of many slices of a group, then the first
    `k` of what is left. A group's full rows never meet in one task.
    """
    by = list(by)
    slices = Window.partitionBy(*by, "_slice").orderBy(*order)
    whole = Window.partitionBy(*by).orderBy(*order)
    return (
        df.withColumn("_slice", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int"))
        .withColumn("_rank", F.row_number().over(slices))
        .where(F.col("_rank") <= k)
        .drop("_rank", "_slice")
        .withColumn("rank", F.row_number().over(whole))
        .where(F.col("rank") <= k)
    )


def most_frequent(
    df: DataFrame, by: Sequence[str], count: str, k: int, term: str, few: bool
) -> DataFrame:
    """`top_k` of already counted terms: highest `count` first, then by `term`.

    How many terms have each count says which count the k-th term has. Only terms
    with at least that count are ranked, so the long tail of rare terms is never
    sorted. `few` says whether one row per group can be broadcast.
    """
    by = list(by)
    tally = df.groupBy(*by, count).agg(F.count(F.lit(1)).alias("_terms"))
    reached = F.sum("_terms").over(Window.partitionBy(*by).orderBy(F.desc(count)))
    # A group of fewer than k terms has no such count and keeps them all.
    enough = F.max(F.when(F.col("_reached") >= k, F.col(count)))
    least = tally.withColumn("_reached", reached).groupBy(*by).agg(
        F.coalesce(enough, F.lit(0)).alias("_least")
    )
    if by:
        marked = join_by_size(df, least, by, "inner", [term], small=few)
    else:
        marked = df.withColumn("_least", least.scalar())
    kept = marked.where(F.col(count) >= F.col("_least")).drop("_least")
    return top_k(kept, by, [F.desc(count), F.asc(term)], k, term)


def pair_posts(posts: DataFrame, ticker_map: DataFrame) -> DataFrame:
    """Every (post, ticker) pair: inner join on the post id, N:M."""
    return posts.join(ticker_map, "tweet_id", "inner")


def body_digest(body: str = "body") -> Column:
    """SHA-256 of a body in hex digits; empty where there is none."""
    return F.coalesce(F.sha2(body, 256), F.lit(""))


def first_pairs(digested: DataFrame, ticker_map: DataFrame, digest: str = "digest") -> DataFrame:
    """Rows of `digested`, which has digests of bodies, kept under the first pair of each digest.

    Of rows that agree in id and digest the least one stays. Bodies need not be among the
    columns, and then none crosses the network.
    """
    tickers = ticker_map.groupBy("tweet_id").agg(F.min("ticker_symbol").alias("ticker_symbol"))
    winners = (
        digested.select("tweet_id", digest)
        .join(tickers.select("tweet_id"), "tweet_id", "left_semi")
        .groupBy(digest)
        .agg(F.min("tweet_id").alias("tweet_id"))
        .join(tickers, "tweet_id")
    )
    chosen = digested.join(winners, ["tweet_id", digest], "inner")
    # Repeats of a post lie together after the join; their fold moves nothing.
    rest = [name for name in digested.columns if name not in ("tweet_id", digest)]
    folded = chosen.groupBy("tweet_id", digest, "ticker_symbol").agg(
        F.min(F.struct(*rest)).alias("_row")
    )
    return folded.select("tweet_id", digest, "_row.*", "ticker_symbol").select(
        *digested.columns, "ticker_symbol"
    )


def pair_first_posts(posts: DataFrame, ticker_map: DataFrame) -> DataFrame:
    """Pairs kept when each distinct body stays once, under its first pair.

    Equal to `dedupe_first(pair_posts(...), ["body"], ["tweet_id",
    "ticker_symbol"])`, but which post wins is settled on (id, digest of the body)
    alone, so the bodies cross the network once, in the final join. A NULL body
    counts as one body. Of rows that agree in id and body the least one stays.
    """
    digested = posts.withColumn("_digest", body_digest())
    return first_pairs(digested, ticker_map, "_digest").drop("_digest")
