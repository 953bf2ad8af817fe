import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postpulse.operators import bow, ngrams

POSTS = "tweet_id long, g string, body string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = ["ab", "abc", "a", "the", "x1", "zz", "été", "don't", "big", "Big"]
    made = [
        (i, rng.choice("pq"), " ".join(rng.choices(vocabulary, k=rng.randint(0, 9))))
        for i in range(300)
    ]
    return [*made, (900, "p", "one two three"), (901, "p", ""), (902, "q", None)]


@pytest.fixture(scope="module")
def posts(spark, rows):
    return spark.createDataFrame(rows, POSTS).cache()


def top(counter, k):
    return [(t, c) for t, c in sorted(counter.items(), key=lambda e: (-e[1], e[0]))[:k]]


def ranked(df):
    return [(r["term"], r["count"]) for r in df.orderBy("rank").collect()]


def word_counts(texts, n):
    counts = Counter()
    for text in texts:
        split = (text or "").split()
        if len(split) > n:
            counts.update(" ".join(split[i : i + n]) for i in range(len(split) - n + 1))
    return counts


def char_counts(texts, n):
    counts = Counter()
    for text in texts:
        for word in (text or "").split():
            if len(word) > n:
                counts.update(word[i : i + n] for i in range(len(word) - n + 1))
    return counts


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_ngrams_match_plain_counts(posts, rows, n):
    texts = [r[2] for r in rows]
    assert ranked(ngrams.ngram_counts(posts, n, 15)) == top(word_counts(texts, n), 15)
    chars = [(" ".join(t), c) for t, c in top(char_counts(texts, n), 15)]
    assert ranked(ngrams.char_ngram_counts(posts, n, 15)) == chars
    for g in "pq":
        texts = [r[2] for r in rows if r[1] == g]
        got = ngrams.ngram_counts(posts, n, 15, ["g"]).where(F.col("g") == g)
        assert ranked(got) == top(word_counts(texts, n), 15)


def test_a_row_of_exactly_n_words_adds_nothing(spark):
    df = spark.createDataFrame([(1, "p", "one two three")], POSTS)
    assert ngrams.ngram_counts(df, 3).count() == 0
    assert ngrams.ngram_counts(df, 2).count() == 2
    assert ngrams.char_ngram_counts(df, 5).count() == 0


def test_text_trends_equal_the_single_counts(posts, rows):
    got = {}
    for r in ngrams.text_trends(posts, "g", (1, 2, 3), 10, stop=["the"]).collect():
        got.setdefault((r["g"], r["unit"], r["n"]), []).append((r["rank"], r["term"], r["count"]))
    for g in "pq":
        texts = []
        for _, group, text in rows:
            if group == g and text is not None:
                kept = re.sub("[^a-zA-Z]", " ", text).lower().split()
                texts.append(" ".join(w for w in kept if w != "the"))
        for n in (1, 2, 3):
            for unit, count in (("word", word_counts), ("char", char_counts)):
                shown = (lambda t: " ".join(t)) if unit == "char" else str
                want = [
                    (i, shown(t), c) for i, (t, c) in enumerate(top(count(texts, n), 10), start=1)
                ]
                assert sorted(got.get((g, unit, n), [])) == want


def test_word_frequencies(posts, rows):
    counts = Counter()
    for _, _, text in rows:
        counts.update(w for w in re.findall(r"\w+", (text or "").lower()) if w != "the")
    got = ngrams.word_frequencies(posts, ["the"], 5).orderBy("rank").collect()
    assert [(r["term"], r["count"]) for r in got] == top(counts, 5)
    assert got[0]["weight"] == 1.0


def test_stop_words(spark):
    listed = ngrams.stop_words()
    assert {"the", "qqqstks", "spy"} <= set(listed)
    one = spark.createDataFrame([("a",), ("b",)], "term string")
    assert ngrams.stop_word_table(one, one).count() == 2


def expected_vocabulary(texts, n, max_df):
    total, docs = Counter(), Counter()
    for text in texts:
        tokens = re.findall(r"\b\w\w+\b", (text or "").lower())
        total.update(tokens)
        docs.update(set(tokens))
    kept = Counter({t: c for t, c in total.items() if docs[t] <= max_df * len(texts)})
    return {t: (c, docs[t]) for t, c in top(kept, n)}


def test_vocabulary_and_counts_match_plain_python(posts, rows):
    vocab = bow.vocabulary(posts, 5, 0.5, ["g"]).cache()
    for g in "pq":
        texts = [r[2] for r in rows if r[1] == g]
        want = expected_vocabulary(texts, 5, 0.5)
        got = vocab.where(F.col("g") == g).orderBy("position").collect()
        assert {r["term"]: (r["total"], r["docs"]) for r in got} == want
        assert [r["term"] for r in got] == sorted(want)
    wide = bow.bag_of_words_wide(posts, vocab, 5, ["g"]).collect()
    assert len(wide) == len(rows)
    names = {(r["g"], r["position"]): r["term"] for r in vocab.collect()}
    for r in wide:
        tokens = Counter(re.findall(r"\b\w\w+\b", (r["body"] or "").lower()))
        for i in range(1, 6):
            assert r[f"w_{i:03d}"] == tokens[names[r["g"], i]]


def test_a_term_in_all_rows_is_dropped(spark):
    df = spark.createDataFrame([(i, "p", f"same word{i % 3}") for i in range(20)], POSTS)
    assert {r["term"] for r in bow.vocabulary(df, 10).collect()} == {"word0", "word1", "word2"}
    assert "same" in {r["term"] for r in bow.vocabulary(df, 10, max_df=1.0).collect()}


def test_binary_counts_and_fixed_columns(spark):
    df = spark.createDataFrame([(1, "p", "date date typo"), (2, "p", "")], POSTS)
    vocab = bow.vocabulary(df, 10)
    assert {r["cnt"] for r in bow.bag_of_words(df, vocab, binary=True).collect()} == {1}
    terms = bow.vocabulary_terms(vocab)
    assert terms == ["date", "typo"]
    row = bow.bag_of_words_columns(df, terms).orderBy("tweet_id").first()
    assert (row["w_date"], row["w_typo"]) == (2, 1)


def test_term_rank(spark):
    df = spark.createDataFrame([(1, "p", "aa aa bb"), (2, "p", "bb cc")], POSTS)
    bag = bow.bag_of_words(df, bow.vocabulary(df, 10, 1.0))
    got = {r["term"]: (r["max_cnt"], r["rank"], r["rank_high"]) for r in bow.term_rank(bag).collect()}
    assert got == {"aa": (2, 3, 1), "bb": (1, 1, 3), "cc": (1, 2, 2)}


def test_wide_limits(posts):
    with pytest.raises(ValueError, match="word columns"):
        bow.bag_of_words_wide(posts, None, 5000)
