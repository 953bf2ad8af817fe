"""Trees of all labelled posts: no post is left out, whatever its ticker and label."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as contract
from catalog import queries as catalog
from catalog import standins as s
from check import difference, spark_rows
from postpulse.operators import bow, trees
from postpulse.plans import training
from postpulse.sources import materialise

TICKERS = ("1-URGENT", "2-HIGH", "3-MEDIUM")
SIZES = (80, 50, 1)


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """Posts of three tickers, more than a sample takes of most levels, on days whose neighbours have prices."""
    folder = tmp_path_factory.mktemp("tables")

    def store(name, **columns):
        pq.write_table(pa.table(columns), folder / f"{name}.parquet")

    tickers = [t for t, size in zip(TICKERS, SIZES, strict=True) for _ in range(size)]
    ids, first = list(range(len(tickers))), dt.datetime(1996, 1, 1)
    days = [(1000 + 10 * i + k, first + dt.timedelta(k), t) for i, t in enumerate(TICKERS) for k in (0, 2)]
    store(
        "orders", o_orderkey=[*ids, *[d[0] for d in days]],
        o_orderdate=pa.array([first + dt.timedelta(1)] * len(ids) + [d[1] for d in days], pa.timestamp("us")),
        o_orderpriority=[*tickers, *[d[2] for d in days]], o_totalprice=[float(i) for i in range(len(ids) + len(days))],
    )
    lines = [(i, "ANR"[j % 3]) for i in ids for j in range(i % 5 % 3 * 3)]
    store("lineitem", l_orderkey=[i for i, _ in lines], l_returnflag=[f for _, f in lines])
    texts = [f"post number {i} " + " ".join(["best"] * (i % 7) + ["trash"] * (i % 3)) + f" of {TICKERS.index(t)}x" for i, t in zip(ids, tickers, strict=True)]
    store("documents", doc_id=ids, source=["web"] * len(ids), text=texts)
    store("benchmark", item_id=[0], text=["post number on the day"])
    return str(folder)


def test_tree_nodes_are_fitted_on_every_post(spark, tables):
    nodes = contract.queries()["tree_nodes"](spark, tables).collect()
    root = next(r for r in nodes if r["id"] == 0)
    assert root["rawCount"] == sum(SIZES) and sum(root["impurityStats"]) == sum(SIZES)
    assert sum(r["rawCount"] for r in nodes if r["leftChild"] < 0) == sum(SIZES)


@pytest.mark.parametrize("name", ["pruned_tree", "pruned_tree_price", "pruned_tree_sentiment"])
def test_pruned_tree_scores_a_fifth_of_all_posts(spark, tables, name):
    report = {r["label"]: r["support"] for r in contract.queries()[name](spark, tables).collect()}
    assert report["accuracy"] == 27


def test_whole_matrix_is_that_of_one_vocabulary(spark, tables):
    """For one ticker, the rows of a sample that is large enough."""
    ticker, target, words = TICKERS[0], "interaction_level", 10
    labels = catalog._labels(spark, tables, [target])
    given = [catalog._bodies(spark, tables), s.lexicon(spark), s.explicit_terms(spark), s.dictionary(spark, tables)]
    own = materialise(labels.where(labels["ticker_symbol"] == ticker))
    sets = training.training_sets_of_labels(own, *given, 1000, words, strict=False, targets=[target])
    want = training.training_matrix(sets, target, words)
    got = training.whole_matrix(own, *given, target, words)
    assert got.dtypes == want.dtypes and want.count() == SIZES[0]
    assert difference(spark_rows(got), spark_rows(want)) is None
    # Of all tickers, a word column is the same word for each: rows of a post differ in no ticker's count.
    whole = training.whole_matrix(labels, *given, target, 200)
    assert whole.count() == sum(SIZES)
    names = bow.vocabulary_terms(bow.vocabulary(given[0], 200))
    last = whole.where("tweet_id = 130").first()
    assert {n for i, n in enumerate(names) if last[bow.word_column(i + 1)]} == {"post", "number", "130", "best", "trash", "of", "2x"} & set(names)


def test_word_columns_without_a_vocabulary(spark):
    row = bow.bag_of_words_positions(spark.sql("SELECT 1 AS tweet_id, 'a word' AS body"), [], 2).first()
    assert (row["w_001"], row["w_002"]) == (0, 0)


def test_thresholds_come_from_all_rows(spark):
    """Each feature differs from 0 in one of 40,000 rows, which a sample of 10,000 would mostly miss."""
    names = [f"x{i}" for i in range(20)]
    cells = [f"CAST(id = {7 + 1999 * i} AS DOUBLE) AS {name}" for i, name in enumerate(names)]
    label = f"IF(id % 1999 = 7 AND id < {7 + 1999 * 20}, 'b', 'a') AS label"
    rows = spark.range(40_000).selectExpr("id AS tweet_id", *cells, label)
    data = trees.prepare(materialise(rows), names, "label")
    bins = trees.bins_of_all_rows(data, 32)
    assert bins == 200
    tree = trees.fit_tree(data, max_bins=bins).tree
    assert {names[f] for f in tree.feature[tree.inner()]} == set(names)
