"""Most frequent terms behind bounds of hash buckets, against plain counts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postpulse.operators import heavy
from postpulse.operators.joins import BROADCAST_BYTES

ROWS = "g string, h int, term string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    made = []
    for g, h in (("a", 1), ("a", None), (None, 1), (None, None), ("b", 2)):
        # Frequent terms with ties, a tail of terms met once or twice, and a group of few terms.
        made += [(g, h, f"t{k}") for k in range(30) for _ in range(60 - k // 3)]
        made += [(g, h, f"rare{rng.randrange(1500)}") for _ in range(2000)] if h else []
    made += [("few", 1, "x"), ("few", 1, "y"), ("few", 1, "y"), ("", 1, "")]
    rng.shuffle(made)
    return made


def wanted(rows, key, k):
    counts = {}
    for g, h, term in rows:
        counts.setdefault(key(g, h), Counter())[term] += 1
    return {
        (*group, i, term, n)
        for group, own in counts.items()
        for i, (term, n) in enumerate(sorted(own.items(), key=lambda e: (-e[1], e[0]))[:k], 1)
    }


@pytest.mark.parametrize("buckets", [1, 7, 1 << 13])
@pytest.mark.parametrize("by", [[], ["g"], ["g", "h"]])
def test_equal_to_plain_counts(spark, monkeypatch, rows, buckets, by):
    monkeypatch.setattr(heavy, "BUCKETS", buckets)
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    for k in (1, 10, 40):
        got = heavy.most_frequent_of(df, by, "term", k)
        assert got.columns == [*by, "term", "count", "rank"]
        found = [(*(r[c] for c in by), r["rank"], r["term"], r["count"]) for r in got.collect()]
        assert len(found) == len(set(found))
        assert set(found) == wanted(rows, lambda g, h: (g, h)[: len(by)], k)


@pytest.mark.parametrize("limit", [0, BROADCAST_BYTES])
def test_salted_and_broadcast_bounds_agree(spark, monkeypatch, rows, limit):
    monkeypatch.setattr(heavy, "fits_broadcast", lambda df: limit > 0)
    got = heavy.most_frequent_of(spark.createDataFrame(rows, ROWS), ["g"], "term", 12)
    found = {(r["g"], r["rank"], r["term"], r["count"]) for r in got.collect()}
    assert found == wanted(rows, lambda g, h: (g,), 12)


def test_empty_rows(spark):
    df = spark.createDataFrame([], ROWS)
    for by in ([], ["g"]):
        assert heavy.most_frequent_of(df, by, "term", 5).collect() == []


def test_loads_bound_every_term(spark, monkeypatch, rows):
    monkeypatch.setattr(heavy, "BUCKETS", 50)
    df = spark.createDataFrame(rows, ROWS)
    dealt = df.select(
        F.struct("g").alias("_by"), "term", F.pmod(F.xxhash64("term"), F.lit(50)).cast("int").alias("_bucket")
    )
    loads = heavy.bucket_loads(dealt)
    assert loads.groupBy("_by").count().where("count > 50").count() == 0
    counts = dealt.groupBy("_by", "_bucket", "term").count()
    # The probed k-th count is one that k terms reach, and no load is below a term's count.
    assert counts.join(loads, ["_by", "_bucket"]).where("count > _load").count() == 0
    least = {r["_by"]["g"]: r["_least"] for r in heavy.kth_counts(counts, 10).collect()}
    for g, own in least.items():
        tenth = sorted(Counter(t for k, _, t in rows if k == g).values(), reverse=True)[9:10]
        assert own == (tenth[0] if tenth else 0)


@pytest.mark.parametrize("buckets", [1, 1 << 13])
def test_terms_made_of_counted_rows(spark, monkeypatch, rows, buckets):
    """Rows without a term, known by the hash of their parts, give the counts of their terms."""
    monkeypatch.setattr(heavy, "BUCKETS", buckets)
    df = spark.createDataFrame(rows, ROWS).select("g", F.substring("term", 1, 1).alias("a"), F.expr("substr(term, 2)").alias("b"))
    got = heavy.most_frequent_of(df, ["g"], "term", 12, [F.col("a"), F.col("b")], F.concat("a", "b"))
    found = {(r["g"], r["rank"], r["term"], r["count"]) for r in got.collect()}
    assert found == wanted(rows, lambda g, h: (g,), 12)
