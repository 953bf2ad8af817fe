"""Most frequent terms of rows that are not counted yet, without shuffling the rare ones.

Terms are dealt into a fixed number of buckets by hash. A bucket's load, the number of its
rows, is an upper bound for each of its terms. Counting the terms of the heaviest buckets
exactly gives a count that k terms have for certain, and a bucket with a smaller load holds
none of the first k. Only the terms of the others are grouped exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postpulse.operators.joins import fits_broadcast, join_by_size, top_k
from postpulse.sources import materialise

BUCKETS = 1 << 13
PROBED = 4  # buckets counted to find the k-th count, for each of the k terms


def bucket_loads(dealt: DataFrame, by: Sequence[str] = ("_by",)) -> DataFrame:
    """(by, _bucket, _load): at most BUCKETS rows a group, folded where the rows are read."""
    return dealt.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_load"))


def kth_counts(counted: DataFrame, k: int) -> DataFrame:
    """(_by, _least): the count of the k-th term, 0 in groups of fewer terms.

    From how many terms have each count, so the terms themselves are not sorted.
    """
    tally = counted.groupBy("_by", "count").agg(F.count(F.lit(1)).alias("_terms"))
    reached = F.sum("_terms").over(Window.partitionBy("_by").orderBy(F.desc("count")))
    enough = F.max(F.when(F.col("_reached") >= k, F.col("count")))
    found = tally.withColumn("_reached", reached).groupBy("_by")
    return found.agg(F.coalesce(enough, F.lit(0)).alias("_least"))


def most_frequent_of(
    rows: DataFrame, by: Sequence[str], term: str, k: int, parts: Sequence[Column] = (), made: Column | None = None
) -> DataFrame:
    """(by, term, count, rank): the `k` terms that come most often in each group, ties by term.

    `rows` has one row for each occurrence and is read three times, so it should be cheap
    to make or stored. Groups may be NULL, terms not. A row may have no term yet: `made`
    gives it, and `parts` are columns that are equal within a group where terms are. Terms
    are then made only of rows whose bucket is counted.
    """
    by, made = list(by), F.col(term) if made is None else made
    dealt = rows.withColumn("_hash", F.xxhash64(*(parts or [term])))
    dealt = dealt.withColumn("_bucket", F.pmod("_hash", F.lit(BUCKETS)).cast("int"))
    # Structs are equal where their fields are, NULL to NULL as well.
    group = (F.struct(*by) if by else F.lit(0)).alias("_by")
    # Groups that share the hash of a cell are counted as well, which changes no count.
    cell = F.xxhash64(*by, "_bucket").alias("_cell")
    loads = materialise(bucket_loads(dealt, by).select(group, "_bucket", cell, "_load"), "loads")
    few = fits_broadcast(loads)

    def counted(cells: DataFrame) -> DataFrame:
        own = join_by_size(dealt.withColumn("_cell", cell), cells, ["_cell"], "left_semi", ["_hash"], small=few)
        own = own.select(*by, made.alias(term)).groupBy(*by, term).agg(F.count(F.lit(1)).alias("count"))
        return own.select(group, *by, term, "count")

    by_load = Window.partitionBy("_by").orderBy(F.desc("_load"), "_bucket")
    heaviest = loads.withColumn("_place", F.row_number().over(by_load))
    probed = heaviest.where(F.col("_place") <= PROBED * k).select("_cell")
    least = materialise(kth_counts(counted(probed), k), "least")
    bounds = loads.join(least, "_by").where(F.col("_load") >= F.col("_least"))
    found = join_by_size(counted(bounds.select("_cell")), least, ["_by"], "inner", [term], small=few)
    kept = found.where(F.col("count") >= F.col("_least")).drop("_by", "_least")
    return top_k(kept, by, [F.desc("count"), F.asc(term)], k, term)
