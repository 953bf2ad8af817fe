"""Training sets from narrow labels: the rows of sets from the whole feature table, bodies left where they are."""

import pytest

from catalog import standins as s
from check import difference, spark_rows
from postpulse.plans import feature_table, post_keys, post_labels, training_sets, training_sets_of_labels
from postpulse.sources import materialise

DAY = 86_400


@pytest.fixture(scope="module")
def given(spark):
    """Posts with repeated ids, bodies and rows, and some without a body, of two tickers on three days."""
    bodies = ["the BEST day, 1 trash", "Not very trash of all", "clown best", None, "", "plain words\tonly 22", "“best” Été"]
    rows = [
        (i // 2 if i % 5 == 0 else i, "ab"[i % 2], DAY * (1 + i % 3 % 2), bodies[i % 7] if i % 4 else f"{bodies[i % 7]} {i}", i % 6, i % 3, i % 13)
        for i in range(80)
    ]
    kinds = "tweet_id long, writer string, post_date long, body string, comment_num long, retweet_num long, like_num long"
    posts = materialise(spark.createDataFrame(rows + rows[:9], kinds), "posts")
    tickers = spark.createDataFrame([(i, "AB"[i % 2]) for i in range(78)] + [(3, "A"), (None, "B")], "tweet_id long, ticker_symbol string")
    prices = spark.sql(
        """SELECT date_from_unix_date(cast(id AS int)) AS date, t AS ticker_symbol, cast(id * (5 - id) AS double) AS adj_close
        FROM range(4) LATERAL VIEW explode(array('A', 'B')) e AS t"""
    )
    return posts, tickers, prices


def labels_of(given, lexicon):
    posts, tickers, prices = given
    return post_labels(post_keys(posts, lexicon), tickers, prices)


def rows_of(sets):
    return spark_rows(sets.select(*sorted(sets.columns)))


def test_sets_of_labels_are_those_of_the_feature_table(spark, given):
    posts, tickers, prices = given
    lexicon, terms = s.lexicon(spark), s.explicit_terms(spark)
    words = spark.createDataFrame([("best",), ("day",), ("the",)], "term string")
    whole = materialise(feature_table(posts, tickers, prices, lexicon), "whole")
    want = rows_of(training_sets(whole, terms, words, 4, 10, strict=False))
    narrow = labels_of(given, lexicon)
    got = rows_of(training_sets_of_labels(narrow, posts, lexicon, terms, words, 4, 10, strict=False))
    assert len(want) > 20 and difference(got, want) is None
    # One target's labels are enough for its sets.
    price = rows_of(
        training_sets_of_labels(
            labels_of(given, None), posts, lexicon, terms, words, 4, 10, strict=False, targets=["price_change"]
        )
    )
    assert difference(price, want[want["target"] == "price_change"]) is None


def test_labels_hold_every_post_and_no_body(spark, given):
    posts, tickers, prices = given
    lexicon = s.lexicon(spark)
    names = ["tweet_id", "ticker_symbol", "price_change", "interaction_level", "sentiment"]
    labels = labels_of(given, lexicon)
    assert "body" not in labels.columns and "sentiment" not in labels_of(given, None).columns
    whole = feature_table(posts, tickers, prices, lexicon)
    assert difference(spark_rows(labels.select(names)), spark_rows(whole.select(names))) is None
