import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from postpulse.operators import sampling


def ordered(keys, seed=42):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    return [(i, "hot" if i % 3 else rng.choice(["a", "b", "c"]), rng.choice("xy")) for i in range(3000)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "tweet_id long, label string, g string").repartition(5).cache()


def test_prefixes_grow_with_the_group():
    assert sampling.prefix_digits(10) == 2
    assert sampling.prefix_digits(10**12) == 5


def test_balanced_sample_is_exact_and_seeded(frame, rows):
    got = sampling.balanced_sample(frame, "label", 40, ["g"]).collect()
    want = set()
    for g in "xy":
        for label in {r[1] for r in rows}:
            want |= set(ordered(r[0] for r in rows if r[1:] == (label, g))[:40])
    assert {r["tweet_id"] for r in got} == want and len(got) == 8 * 40
    again = sampling.balanced_sample(frame.repartition(3), "label", 40, ["g"]).collect()
    other = sampling.balanced_sample(frame, "label", 40, ["g"], seed=1).collect()
    assert {r["tweet_id"] for r in again} == want
    assert {r["tweet_id"] for r in other} != want


def test_prefix_length_does_not_change_the_sample(frame, rows, monkeypatch):
    monkeypatch.setattr(sampling, "PREFIX_ROWS", 1)
    got = sampling.balanced_sample(frame, "label", 100).groupBy("label").count().collect()
    assert {r["count"] for r in got} == {100}
    hot = sampling.balanced_sample(frame, "label", 100).where("label = 'hot'").collect()
    assert {r["tweet_id"] for r in hot} == set(ordered(r[0] for r in rows if r[1] == "hot")[:100])


def test_small_classes(frame, rows):
    with pytest.raises(ValueError, match="smaller than the sample"):
        sampling.balanced_sample(frame, "label", 1000)
    kept = sampling.balanced_sample(frame, "label", 1000, strict=False).groupBy("label").count()
    sizes = {r["label"]: r["count"] for r in kept.collect()}
    assert sizes["hot"] == 1000
    assert sizes["a"] == sum(r[1] == "a" for r in rows)
    each = {("hot",): 7, ("a",): 3, ("b",): 0, ("c",): 1}
    got = sampling.balanced_sample(frame, "label", each).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in got} == {"hot": 7, "a": 3, "c": 1}


def test_rows_without_a_label_are_not_sampled(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "a")], "tweet_id long, label string")
    assert sampling.balanced_sample(df, "label", 2).count() == 2


@pytest.mark.parametrize("size,share", [(1, 0.2), (5, 0.2), (101, 0.2), (999, 0.33), (7, 0.0)])
def test_split_has_the_exact_size(spark, size, share):
    df = spark.range(size).withColumnRenamed("id", "tweet_id")
    got = sampling.split_exact(df, share).where("is_test").collect()
    want = ordered(range(size))[: math.ceil(round(share * size, 9))]
    assert {r["tweet_id"] for r in got} == set(want)


@pytest.mark.parametrize("k", [2, 10])
def test_plain_folds_are_contiguous_runs(frame, rows, k):
    got = {r["tweet_id"]: r["fold"] for r in sampling.plain_folds(frame, k).collect()}
    parts = np.array_split(np.array(ordered(r[0] for r in rows)), k)
    assert got == {int(key): fold for fold, part in enumerate(parts) for key in part}


def by_the_book(rows, k):
    """Stratified folds: allocation of labels laid end to end, dealt round-robin."""
    keys = ordered(r[0] for r in rows)
    label = {r[0]: r[1] for r in rows}
    classes = list(dict.fromkeys(label[key] for key in keys))
    laid = [c for c in classes for key in keys if label[key] == c]
    folds = {}
    for c in classes:
        mine = [key for key in keys if label[key] == c]
        shares = [sum(x == c for x in laid[f::k]) for f in range(k)]
        places = [f for f in range(k) for _ in range(shares[f])]
        folds.update(zip(mine, places, strict=True))
    return folds


@pytest.mark.parametrize("k", [3, 10])
def test_stratified_folds(frame, rows, k):
    got = {r["tweet_id"]: r["fold"] for r in sampling.stratified_folds(frame, "label", k).collect()}
    assert got == by_the_book(rows, k)


def test_stratified_folds_of_tiny_classes(spark):
    rows = [(i, "big" if i > 4 else f"tiny{i}") for i in range(23)]
    df = spark.createDataFrame(rows, "tweet_id long, label string")
    got = {r["tweet_id"]: r["fold"] for r in sampling.stratified_folds(df, "label", 10).collect()}
    assert got == by_the_book(rows, 10)


def test_too_few_rows_for_the_folds(spark):
    df = spark.createDataFrame([(1, "a")], "tweet_id long, label string")
    for make in (sampling.plain_folds, lambda f, k: sampling.stratified_folds(f, "label", k)):
        with pytest.raises(ValueError, match="folds"):
            make(df, 3)


def test_renumber(frame, rows):
    got = {r["tweet_id"]: r["row_id"] for r in sampling.renumber(frame, ["label"]).collect()}
    for label in {r[1] for r in rows}:
        keys = ordered(r[0] for r in rows if r[1] == label)
        assert [got[key] for key in keys] == list(range(len(keys)))


def test_describe_is_exact_with_a_value_a_third_of_rows_share(spark):
    rng = random.Random(11)
    values = [(0.0 if i % 3 == 0 else rng.gauss(0, 5), rng.randint(0, 3)) for i in range(5001)]
    df = spark.createDataFrame([(*v,) for v in values] + [(None, None)], "x double, n long")
    got = {r["column"]: r for r in sampling.describe_numeric(df, ["x", "n"]).collect()}
    for i, name in enumerate(("x", "n")):
        column = np.array([v[i] for v in values], dtype=float)
        row = got[name]
        assert row["count"] == 5001
        assert (row["min"], row["max"]) == (column.min(), column.max())
        assert np.allclose([row["mean"], row["std"]], [column.mean(), column.std(ddof=1)])
        assert np.allclose([row[p] for p in ("p25", "p50", "p75")], np.percentile(column, [25, 50, 75]))


def test_sample_never_sorts_or_shuffles_the_wide_rows(spark, tmp_path):
    """Only the last pass reads the body, and it is a filter on a broadcast."""
    wide = spark.range(500).select(
        F.col("id").alias("tweet_id"), F.lit("a").alias("label"), F.lit("text").alias("body")
    )
    wide.write.parquet(str(tmp_path / "w"))
    sample = sampling.balanced_sample(spark.read.parquet(str(tmp_path / "w")), "label", 5)
    plan = sample._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert sum("body" in line for line in scans) == 1


def test_nulls_are_groups_labels_and_keys_like_others(spark):
    rows = [(1, "a", 1), (2, None, 2), (3, None, None), (4, "a", 4)]
    frame = spark.createDataFrame(rows, "id long, g string, tweet_id long")
    numbered = sampling.renumber(frame, ["g"]).collect()
    assert sorted((r["g"] or "", r["row_id"]) for r in numbered) == [("", 0), ("", 1), ("a", 0), ("a", 1)]
    folded = sampling.stratified_folds(frame, "g", 2).collect()
    assert sorted((r["g"] or "", r["fold"]) for r in folded) == [("", 0), ("", 1), ("a", 0), ("a", 1)]
    marked = sampling.split_exact(frame, 0.5).collect()
    assert sorted(r["is_test"] for r in marked) == [False, False, True, True]


def test_a_column_without_values_is_described(spark):
    frame = spark.createDataFrame([(1.0, None), (3.0, None)], "x double, never double")
    got = {r["column"]: r for r in sampling.describe_numeric(frame, ["x", "never"]).collect()}
    assert got["x"]["p50"] == 2.0 and got["never"]["count"] == 0 and got["never"]["max"] is None


def test_more_groups_than_the_driver_should_hold(spark):
    """A size, a cut and folds for each of 200,000 groups, one of them with a third of the rows."""
    group = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 199_999)
    frame = spark.range(600_000).select(F.col("id").alias("tweet_id"), group.alias("g"))
    sizes = {r["g"]: r["count"] for r in frame.groupBy("g").count().collect()}
    assert len(sizes) > 190_000
    got = sampling.sample_keys(frame, ["g"], 1, "tweet_id").groupBy("g").count()
    assert got.count() == len(sizes) and got.where("count <> 1").isEmpty()
    least = sampling.sample_keys(frame, ["g"], 1, "tweet_id").where("g = 7").first()["tweet_id"]
    assert least == ordered(r["tweet_id"] for r in frame.where("g = 7").collect())[0]
    folded = sampling.stratified_folds(frame, "g", 4)
    folds = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}
    assert set(folds.values()) == {150_000}
    hot = [r["count"] for r in folded.where("g = -1").groupBy("fold").count().collect()]
    assert max(hot) - min(hot) <= 1 and sum(hot) == sizes[-1]


def test_a_group_without_a_size_is_an_error(frame):
    with pytest.raises(KeyError, match="without a size"):
        sampling.balanced_sample(frame, "label", {("hot",): 7})


def test_quantiles_are_narrowed_to_few_values(spark, monkeypatch):
    """Distinct doubles, and a value that many rows share next to them: at most RANKED are ranked."""
    monkeypatch.setattr(sampling, "RANKED", 40)
    monkeypatch.setattr(sampling, "CUTS", 16)
    rng = random.Random(3)
    x = [rng.gauss(0, 1) for _ in range(20_000)]
    y = [1.5 if i % 3 == 0 else rng.lognormvariate(0, 4) for i in range(20_000)]
    z = [rng.choice([-math.inf, math.inf, 0.0, -0.0, 5.0]) for _ in range(20_000)]
    ranked, original = [], sampling._in_spans

    def watched(values, spans, borders=None):
        if borders is None:
            ranked.append([span.rows for span in spans])
        return original(values, spans, borders)

    monkeypatch.setattr(sampling, "_in_spans", watched)
    frame = spark.createDataFrame(list(zip(x, y, z, strict=True)), "x double, y double, z double")
    columns = {"x": sorted(x), "y": sorted(y), "z": sorted(z)}
    wanted = (1, 2, 777, 4_321, 10_007, 13_338, 20_000)
    values = frame.unpivot([], list(columns), "column", "value")
    # First borders that narrow nothing: all the work is left to the rounds.
    spans = [sampling.Span(name, None, None, 0, 20_000, wanted) for name in columns]
    got = sampling.values_at(values, spans, [[own[0]] for own in columns.values()])
    assert got == {(name, rank): own[rank - 1] for name, own in columns.items() for rank in wanted}
    assert max(ranked[0]) > 10_000 and max(ranked[-1]) <= 40
