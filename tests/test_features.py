import random

import pytest
from pyspark.sql import functions as F

from postpulse.operators import features
from postpulse.sources import (
    materialise,
    read_posts,
    read_terms,
    read_ticker_map,
    scratch_dir,
    spread,
    write_table,
)

POSTS = "tweet_id long, body string"


@pytest.fixture(scope="module")
def posts(spark):
    texts = [
        "you idiot", "you Idiot", "idiots all", "blow job here", "", "a_idiot idiot_",
        "sell the Buy", "buy buy 12 3.5 , . typo_word good",
    ]
    return spark.createDataFrame(list(enumerate(texts)), POSTS).cache()


@pytest.fixture(scope="module")
def terms(spark):
    return spark.createDataFrame([("idiot",), ("blow job",), ("Goddamn",)], "term string")


def flags(df, name="isExplicit"):
    return [r[name] for r in df.orderBy("tweet_id").collect()]


def test_explicit_flag_is_case_sensitive_and_word_based(posts, terms):
    want = [1, 0, 0, 0, 0, 0, 0, 0]
    assert flags(features.explicit_flag(posts, terms)) == want
    assert flags(features.explicit_flag(posts, terms, limit=0)) == want


def test_explicit_flag_options(posts, terms):
    assert flags(features.explicit_flag(posts, terms, case_insensitive=True))[:3] == [1, 1, 0]
    assert flags(features.explicit_flag(posts, terms, phrases=True))[3] == 1
    joined = features.explicit_flag(posts, terms, phrases=True, limit=0)
    assert flags(joined) == flags(features.explicit_flag(posts, terms, phrases=True))


def test_phrases_are_met_wherever_they_stand(spark):
    """Entries that begin, end or hold other entries, by brute force over short texts."""
    rng = random.Random(8)
    entries = ["a b", "a b c", "b a d", "a a b a", "d d", "e", "", "f ", " f", "f  f", None, "a b"]
    texts = [" ".join(rng.choice("aabbcdf") for _ in range(rng.randint(0, 7))) for _ in range(300)] + ["e", "E", None]
    posts = spark.createDataFrame(list(enumerate(texts)), "tweet_id long, body string")
    listed = spark.createDataFrame([(e,) for e in entries], "term string")

    def holds(text):
        words = (text or "").split()
        runs = {" ".join(words[i:j]) for i in range(len(words)) for j in range(i + 1, len(words) + 1)}
        return int(bool(runs & {e for e in entries if e}))

    for limit in (100, 0):
        got = features.explicit_flag(posts, listed, phrases=True, limit=limit).collect()
        assert {r["tweet_id"]: r["isExplicit"] for r in got} == {k: holds(t) for k, t in enumerate(texts)}
    none = features.explicit_flag(posts, listed.limit(0), phrases=True).agg(F.sum("isExplicit")).first()[0]
    assert none == 0
    assert features.phrase_edges(["x y z", "x y"]) == [("0 x", 1), ("1 y", -1)]


def test_rows_that_share_an_id_have_their_own_answers(spark):
    rows = spark.createDataFrame([(1, "bad day"), (1, "good day"), (2, None)], "tweet_id long, body string")
    words = spark.createDataFrame([("bad",), ("day",)], "term string")
    lexicon = spark.createDataFrame(
        [("bad", -0.5, None, False), ("good", 1.0, None, False)],
        "term string, polarity double, intensity double, negator boolean",
    )
    for limit in (10, 0):
        hits = features.explicit_flag(rows, words.where("term = 'bad'"), limit=limit)
        got = {(r["body"], r["isExplicit"]) for r in hits.collect()}
        assert got == {("bad day", 1), ("good day", 0), (None, 0)}
        typos = features.unknown_words(rows, words, limit=limit)
        got = {(r["body"], r["typo"]) for r in typos.collect()}
        assert got == {("bad day", 0), ("good day", 1), (None, 0)}
        scored = features.lexicon_polarity(rows, lexicon, limit=limit)
        got = {(r["body"], r["polarity"]) for r in scored.collect()}
        assert got == {("bad day", -0.5), ("good day", 1.0), (None, 0.0)}


def test_explicit_flag_of_an_empty_list(spark, posts):
    nothing = spark.createDataFrame([], "term string")
    assert set(flags(features.explicit_flag(posts, nothing))) == {0}


def test_token_flags_and_counts(posts):
    flagged = features.token_flags(posts, ["sell", "buy"])
    assert flags(flagged, "has_Sell")[6:] == [1, 0]
    assert flags(flagged, "has_Buy")[6:] == [0, 1]
    counts = features.flag_counts(flagged, ["has_Sell", "has_Buy"]).first()
    assert (counts["count_has_Sell"], counts["count_has_Buy"]) == (1, 1)


def test_unknown_words_skip_numbers_and_signs(spark, posts):
    dictionary = spark.createDataFrame([("Buy",), ("good",), ("you",)], "term string")
    counted = features.unknown_words(posts, dictionary)
    assert flags(counted, "typo") == [1, 1, 2, 3, 0, 2, 2, 1]
    last = features.unknown_terms(posts, dictionary).where("tweet_id = 7").collect()
    assert [r["term"] for r in last] == ["typo_word"]


LEXICON = [
    ("good", 0.75, None, False), ("bad", -0.5, None, False), ("great", 1.0, None, False),
    ("very", None, 1.5, False), ("slightly", None, 0.5, False), ("not", None, None, True),
]


def test_polarity_with_modifiers_and_negators(spark):
    cases = {
        "good": 0.75,
        "Good bad": 0.125,
        "very good": 1.0,  # 1.125, clamped
        "slightly bad": -0.25,
        "not good": -0.375,
        "not very bad": 0.375,
        "very not bad": 0.25,
        "not a good": 0.75,
        "very": 0.0,
        "nothing here": 0.0,
        "": 0.0,
    }
    posts = spark.createDataFrame(list(enumerate(cases)), POSTS)
    lexicon = spark.createDataFrame(
        LEXICON, "term string, polarity double, intensity double, negator boolean"
    )
    scored = features.lexicon_polarity(posts, lexicon).collect()
    got = {r["body"]: r["polarity"] for r in scored}
    assert got == cases


def test_csv_round_trip_keeps_lines_quotes_and_spaces(spark, tmp_path):
    rows = [
        (1, "w", 10, 'two\nlines, "quoted", and \\ back', 1, 2, 3),
        (2, None, 20, "  padded\t", 0, 0, 0),
        (3, "é", 30, "üñí – €", 0, 0, 1),
    ]
    from postpulse.sources import POST_SCHEMA

    path = str(tmp_path / "posts")
    write_table(spark.createDataFrame(rows, POST_SCHEMA), path, fmt="csv")
    assert sorted(tuple(r) for r in read_posts(spark, path).collect()) == rows


def test_ticker_map_and_terms_are_read_verbatim(spark, tmp_path):
    (tmp_path / "map.csv").write_text("tweet_id,ticker_symbol\n1,AAPL\n1,TSLA\n")
    assert read_ticker_map(spark, str(tmp_path / "map.csv")).count() == 2
    (tmp_path / "terms.txt").write_text("plain\ntwo words\nCapital\nplain\n")
    got = {r["term"] for r in read_terms(spark, str(tmp_path / "terms.txt")).collect()}
    assert got == {"plain", "two words", "Capital"}


def test_partitioned_sink_and_scratch_folder(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, g string")
    write_table(df, str(tmp_path / "t"), ["g"])
    assert sorted(p.name for p in (tmp_path / "t").glob("g=*")) == ["g=a", "g=b"]
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert materialise(df).count() == 2


def test_spread_leaves_enough_pieces_alone(spark):
    wide = spark.range(100, numPartitions=64)
    assert spread(wide, "id") is wide
    assert spread(spark.range(100, numPartitions=1), "id").rdd.getNumPartitions() == 8


@pytest.mark.parametrize("limit", [10_000, 0])
def test_lists_with_null_and_repeated_terms(spark, limit):
    rows = [(1, "good bad"), (2, "very good"), (3, "not very good"), (4, "odd"), (5, None), (6, "very odd bad")]
    posts = spark.createDataFrame(rows, "tweet_id long, body string")
    lexicon = spark.createDataFrame(
        [
            ("good", 0.1, None, False), ("good", 0.5, None, None), ("bad", -0.4, None, False),
            (None, 1.0, None, False), (None, None, 2.0, True), ("very", None, 1.5, False),
            ("very", None, 2.5, None), ("not", None, None, True), ("not", None, None, False),
            ("odd", None, None, None),
        ],
        "term string, polarity double, intensity double, negator boolean",
    )
    scored = features.lexicon_polarity(posts, lexicon, limit=limit)
    got = {r["tweet_id"]: round(r["polarity"], 9) for r in scored.collect()}
    assert got == {1: -0.05, 2: 0.6, 3: -0.3, 4: 0.0, 5: 0.0, 6: -0.4}
    words = spark.createDataFrame([("good",), (None,), ("good",), ("Bad",)], "term string")
    typos = features.unknown_words(posts, words, limit=limit)
    assert {r["tweet_id"]: r["typo"] for r in typos.collect()} == {1: 0, 2: 1, 3: 2, 4: 1, 5: 0, 6: 2}
    flagged = features.explicit_flag(posts, words, limit=limit)
    assert {r["tweet_id"] for r in flagged.where("isExplicit = 1").collect()} == {1, 2, 3}
    none = features.explicit_flag(posts, words.where("term is null"), limit=limit)
    assert none.where("isExplicit = 1").count() == 0


def test_long_constants_answer_as_joins(spark):
    posts = spark.createDataFrame([(k, f"w{k} w{k + 1} x{k}") for k in range(200)], "tweet_id long, body string")
    words = spark.range(9_000).selectExpr("concat('w', id * 2) as term")
    near = features.unknown_words(posts, words).select("tweet_id", "typo").collect()
    far = features.unknown_words(posts, words, limit=0).select("tweet_id", "typo").collect()
    assert sorted(near) == sorted(far) and {r["typo"] for r in near} == {2}
