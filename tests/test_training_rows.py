"""Row counts of the training sets that models are fitted and scored on, from small given tables."""

import datetime as dt
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as contract
from catalog import queries as catalog
from check import connect, difference, duck_rows, spark_rows
from postpulse.sources import scratch_dir

TICKERS = ("1-URGENT", "2-HIGH", "3-MEDIUM")
# The last ticker has one post, which is a test row of a set without training rows.
SIZES = (9, 6, 1)


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """Posts of three tickers, on days whose neighbours have prices, with counters of every level."""
    folder = tmp_path_factory.mktemp("tables")

    def store(name, **columns):
        pq.write_table(pa.table(columns), folder / f"{name}.parquet")

    tickers = [t for t, size in zip(TICKERS, SIZES, strict=True) for _ in range(size)]
    ids, first = list(range(len(tickers))), dt.datetime(1996, 1, 1)
    # Prices of the day before and after come from orders without a document.
    days = [(100 + 10 * i + k, first + dt.timedelta(k), t) for i, t in enumerate(TICKERS) for k in (0, 2)]
    store(
        "orders", o_orderkey=[*ids, *[d[0] for d in days]],
        o_orderdate=pa.array([first + dt.timedelta(1)] * len(ids) + [d[1] for d in days], pa.timestamp("us")),
        o_orderpriority=[*tickers, *[d[2] for d in days]], o_totalprice=[float(i) for i in range(len(ids) + len(days))],
    )
    lines = [(i, "ANR"[j % 3]) for i in ids for j in range(i % 5 * 2)]
    store("lineitem", l_orderkey=[i for i, _ in lines], l_returnflag=[f for _, f in lines])
    store("documents", doc_id=ids, source=["web"] * len(ids), text=[f"post number {i} on the day" for i in ids])
    store("benchmark", item_id=[0], text=["post number on the day"])
    for name in ("region", "nation", "customer", "supplier", "part", "events", "embeddings", "pages", "labels", "conversations"):
        store(name, id=[0])
    return str(folder)


def test_train_test_rows_hold_all_tickers(spark, tables):
    rows = {r["part"]: r["posts"] for r in contract.queries()["train_test_rows"](spark, tables).collect()}
    assert rows == {"train": 12, "test": 4}


def test_set_model_rows_hold_sets_without_a_tree(spark, tables):
    got = spark_rows(contract.queries()["set_model_rows"](spark, tables))
    assert difference(got, duck_rows(connect(tables), contract.oracle_sql()["set_model_rows"])) is None
    one = got[(got["ticker_symbol"] == TICKERS[2]) & (got["target"] == "interaction_level")]
    assert one[["part", "posts"]].values.tolist() == [["test", 1]]


def test_model_sets_describe_sampled_posts_only(spark, tables):
    """What a set stores of all posts has neither bodies nor counts of their words."""
    folder = Path(scratch_dir(spark))
    before = set(folder.iterdir())
    catalog._set(spark, tables, "price_change", TICKERS[0])
    stored = [p for p in set(folder.iterdir()) - before if p.name.split("-")[0] not in ("set", "vocabulary")]
    kept = {p.name.split("-")[0]: spark.read.parquet(str(p)) for p in stored}
    assert [name for name, table in kept.items() if {"body", "num_words"} & set(table.columns)] == ["sampled"]
    assert (kept["labels"].count(), kept["sampled"].count()) == (sum(SIZES), SIZES[0])
