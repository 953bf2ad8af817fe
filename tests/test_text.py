import random
import re
import string

import pytest
from pyspark.sql import functions as F

from postpulse.functions import (
    META_FEATURES,
    choose,
    clean_reviews_text,
    clean_text,
    letters_only,
    upper_word_list,
    vocabulary_tokens,
    word_tokens,
    words,
)
from postpulse.functions.text import CLEANED_AWAY, case_counts
from postpulse.operators.features import add_meta_features, add_word_count, clean_body

LITERAL = [
    "", " ", "$AAPL 123 It's A1B Éa", "$TSLA up–big, wow!!", "\tone two\n three ",
    "A.B.C a.b.c A.b Ab.Cd aB ²³ ½ ٣", "ALL CAPS words Title Case MiXeD x_y _ __",
    "don't stop\r\nme\x0bnow\x1cplease", "x" * 3000, "Aa." * 1500, "ǅungla ǆ Ǆ",
]


@pytest.fixture(scope="module")
def samples():
    rng = random.Random(7)
    alphabet = string.printable + "äöüßÉéñçÑ–…€²³¹٣  　日本ǅ"
    made = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(400)]
    return LITERAL + made


@pytest.fixture(scope="module")
def frame(spark, samples):
    return spark.createDataFrame(list(enumerate(samples)), "tweet_id long, body string").cache()


def expected_meta(text):
    split = text.split()
    upper = sum(w.isupper() for w in split)
    return {
        "num_words": len(split),
        "num_unique_words": len(set(split)),
        "num_chars": len(text),
        "num_punctuations": sum(c in string.punctuation for c in text),
        "num_words_upper": upper,
        "num_words_title": sum(w.istitle() for w in split),
        "mean_word_len": sum(map(len, split)) / len(split) if split else None,
        "num_special_char": len(re.findall(r"[^a-zA-Z0-9 ]", text)),
        "num_numerics": sum(c.isdigit() for c in text),
        "num_uppercase": upper,
        "num_lowercase": sum(w.islower() for w in split),
    }


def test_meta_features_match_plain_python(frame, samples):
    rows = {r["tweet_id"]: r for r in add_meta_features(frame).collect()}
    for i, text in enumerate(samples):
        got = {name: rows[i][name] for name in META_FEATURES}
        assert got == expected_meta(text), repr(text)
        assert rows[i]["original_text"] == text


def test_null_body_goes(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "tweet_id long, body string")
    assert [r["tweet_id"] for r in add_meta_features(df).collect()] == [2]


def test_tokenisers_match_plain_python(frame, samples):
    body = F.col("body")
    rows = frame.select(
        "tweet_id",
        words(body).alias("w"),
        word_tokens(body).alias("t"),
        vocabulary_tokens(body).alias("v"),
        upper_word_list(body).alias("u"),
    ).collect()
    for row in rows:
        text = samples[row["tweet_id"]]
        assert row["w"] == text.split()
        assert row["t"] == re.findall(r"\w+", text)
        assert row["v"] == re.findall(r"\b\w\w+\b", text.lower())
        assert row["u"] == re.findall(r"\w+", text.upper())


def test_latin_and_other_texts_agree(spark):
    """A letter beyond the first 256 characters, in a word of its own, changes no other word."""
    rows = [(f"a{chr(i)}b {chr(i)} B{chr(i)}c",) for i in range(1, 256)]
    found = spark.createDataFrame(rows, "body string")
    for read in (words, word_tokens, lambda body: F.split(clean_text(body), " ")):
        latin, wide = read(F.col("body")), read(F.concat("body", F.lit(" \u0416")))
        kept = F.array_remove(F.slice(wide, 1, F.size(wide) - 1), "")
        assert found.where(F.array_remove(latin, "") != kept).count() == 0


def test_lower_case_words_leave_before_others_are_matched(spark):
    """Each match is made a string, so tokens and lower-case words are not counted by matches."""
    df = spark.createDataFrame([("one two, Three FOUR x1 \u00e9t\u00e9 1.",), ("",)], "body string")
    body = F.array_join(words(F.col("body")), " ")
    assert [tuple(r) for r in df.select(*case_counts(body)).collect()] == [(1, 1, 4), (0, 0, 0)]
    lower = df.select(case_counts(body)[2], word_tokens(F.col("body")))
    assert "regexp_extract_all" not in lower._jdf.queryExecution().optimizedPlan().toString()


def test_cleaning_matches_plain_python(frame, samples):
    stop = ["the", "me", "dont", "x"]
    rows = frame.select(
        "tweet_id",
        clean_text(F.col("body")).alias("c"),
        letters_only(F.col("body")).alias("l"),
        clean_reviews_text(F.col("body"), stop).alias("r"),
    ).collect()
    for row in rows:
        text = samples[row["tweet_id"]]
        spaced = "".join(" " if c in CLEANED_AWAY else c for c in text)
        assert row["c"] == " ".join(spaced.split())
        assert row["l"] == " ".join(re.sub("[^a-zA-Z]", " ", text).lower().split())
        kept = re.sub(r"[^a-zA-Z0-9\s]", "", text).lower().split()
        assert row["r"] == " ".join(w for w in kept if w not in stop)


def test_cleaning_example(spark):
    df = spark.createDataFrame([(1, "$TSLA up–big, wow!!")], "tweet_id long, body string")
    assert clean_body(df).first()["body"] == "$TSLA up big wow"


def test_word_count(spark):
    df = spark.createDataFrame([(1, " a  b ")], "tweet_id long, body string")
    assert add_word_count(df).first()["word_count"] == 2


def test_choose_takes_the_first_match_and_the_default(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    x = F.col("x")
    rows = df.select(
        choose([x > 0, x > 3], ["low", "high"]).alias("a"),
        choose([x > 3], ["high"], default=None).alias("b"),
    ).collect()
    assert [r["a"] for r in rows] == ["low", "low", "0"]
    assert [r["b"] for r in rows] == [None, "high", None]


def test_features_run_on_a_stream(spark, tmp_path):
    """Row expressions need no change on a streaming input."""
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, "Up BIG"), (2, "down")], "tweet_id long, body string").write.json(source)
    stream = spark.readStream.schema("tweet_id long, body string").json(source)
    query = (
        clean_body(add_meta_features(stream))
        .writeStream.format("memory").queryName("featured").outputMode("append").start()
    )
    query.processAllAvailable()
    query.stop()
    rows = spark.sql("SELECT * FROM featured ORDER BY tweet_id").collect()
    assert [(r["num_words"], r["num_words_upper"]) for r in rows] == [(2, 1), (1, 0)]
