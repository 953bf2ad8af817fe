"""Every registered query against its SQL, on the smallest given tables."""

import os

import pytest

import __spark_entry__ as contract
from check import connect, difference, duck_rows, spark_rows, type_difference

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_stop_words_are_the_listed_ones(spark):
    from catalog.sql import ENGLISH_STOP_WORDS
    from postpulse.operators.ngrams import DOMAIN_STOP_WORDS, stop_words

    assert len(DOMAIN_STOP_WORDS) == 29
    assert set(stop_words()) == {*ENGLISH_STOP_WORDS, *DOMAIN_STOP_WORDS}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    answer = QUERIES[name](spark, SF)
    got = spark_rows(answer)
    assert difference(got, duck_rows(con, ORACLES[name])) is None
    assert type_difference(answer, con, ORACLES[name]) is None


# Learned models need more rows than the smallest tables have.
MODEL_SF = os.environ.get("TEST_MODEL_SF_DIR", "/root/testdata/sf0.01")
MODELS = [
    "set_models",
    "pruned_tree", "tree_onehot_regression_price", "random_forest_sentiment", "tree_text",
    "pruning_path", "forest_params", "alpha_sweep", "best_forest_accuracy",
]


@pytest.mark.parametrize("name", MODELS)
def test_model_queries_return_rows(spark, name):
    assert QUERIES[name](spark, MODEL_SF).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
