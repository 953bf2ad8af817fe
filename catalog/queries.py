"""Every registered query: (spark, sf_dir) -> DataFrame over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import standins as s
from catalog.rules import INTERACTION_TREE, PRINTED_DEPTH
from postpulse import plans
from postpulse.functions import (
    META_FEATURES,
    upper_word_list,
    word_tokens,
)
from postpulse.operators import bow, evaluate, features, labels, ngrams, rules, sampling, trees
from postpulse.operators.joins import dedupe_first, pair_first_posts, pair_posts
from postpulse.plans import Exploration, training
from postpulse.sources import (
    local_frame,
    materialise,
    price_range,
    read_posts,
    read_terms,
    read_ticker_map,
    scratch_dir,
    spread,
    unpivot_prices,
    write_table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Sizes of the training sets cut from the given data.
PER_CLASS = 30
WORDS = 100


def query(name: str | None = None, **fixed) -> Callable[[Callable], Callable]:
    def register(build: Callable) -> Callable:
        QUERIES[name or build.__name__] = partial(build, **fixed) if fixed else build
        return build

    return register


def _scratch(spark: SparkSession, name: str) -> str:
    import uuid

    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---- sources and sinks -----------------------------------------------------


@query()
def csv_round_trip(spark, d):
    path = _scratch(spark, "posts")
    write_table(s.posts(spark, d), path, fmt="csv")
    return read_posts(spark, path)


@query()
def ticker_map_round_trip(spark, d):
    path = _scratch(spark, "tickers")
    write_table(s.ticker_map_many(spark, d), path, fmt="csv")
    return read_ticker_map(spark, path)


@query()
def term_list(spark, d):
    path = _scratch(spark, "terms")
    s.dictionary(spark, d).select("term").write.text(path)
    return read_terms(spark, path)


@query("price_range")
def price_window(spark, d):
    picked = s.prices(spark, d)
    return price_range(picked, "1996-01-01", "1998-06-30", ["1-URGENT", "3-MEDIUM"])


@query()
def prices_unpivoted(spark, d):
    tickers = list(s.PRIORITIES)
    wide = s.prices(spark, d).groupBy("date").pivot("ticker_symbol", tickers).max("adj_close")
    return unpivot_prices(wide, tickers)


# ---- joins and labels ------------------------------------------------------


@query()
def post_dates(spark, d):
    dated = labels.add_post_date(s.posts(spark, d))
    seconds = F.unix_timestamp("post_date").alias("seconds")
    return dated.select("tweet_id", seconds, "date")


@query()
def post_company_join(spark, d):
    pairs = pair_posts(s.posts(spark, d), s.ticker_map_many(spark, d))
    return pairs.select("tweet_id", "ticker_symbol", "writer", "comment_num", "like_num")


@query()
def dedupe_first_pair(spark, d):
    texts = s.documents(spark, d).select(F.col("doc_id").alias("tweet_id"), "text", "source")
    pairs = texts.join(s.ticker_map_many(spark, d), "tweet_id")
    kept = dedupe_first(pairs, ["text"], ["tweet_id", "ticker_symbol"])
    return kept.select("tweet_id", "ticker_symbol", "source", F.md5("text").alias("text_md5"))


@query()
def first_posts(spark, d):
    kept = pair_first_posts(s.posts(spark, d), s.ticker_map_many(spark, d))
    return kept.select("tweet_id", "ticker_symbol", "writer", F.md5("body").alias("body_md5"))


@query()
def first_posts_repeated(spark, d):
    """Every post twice: the answer is that of `first_posts`."""
    posts = s.posts(spark, d)
    kept = pair_first_posts(posts.unionByName(posts), s.ticker_map_many(spark, d))
    return kept.select("tweet_id", "ticker_symbol", "writer", F.md5("body").alias("body_md5"))


@query()
def trading_day_filter(spark, d):
    shipped = s.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("date")
    )
    return labels.keep_trading_days(shipped, s.prices(spark, d))


@query()
def price_diff(spark, d):
    return labels.price_diffs(s.prices(spark, d))


def _labelled(spark, d):
    return training.label_posts(s.posts(spark, d), s.ticker_map(spark, d), s.prices(spark, d))


@query()
def price_change_label(spark, d):
    return _labelled(spark, d).select(
        "tweet_id", "ticker_symbol", "date", "price_diff", "price_change"
    )


@query()
def price_change_counts(spark, d):
    return (
        _labelled(spark, d)
        .groupBy("ticker_symbol", "price_change")
        .agg(F.count(F.lit(1)).alias("posts"))
    )


@query()
def missing_counts(spark, d):
    diffs = labels.price_diffs(s.prices(spark, d))
    orders = s.table(spark, d, "orders").select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("date"),
        F.col("o_orderpriority").alias("ticker_symbol"),
    )
    return labels.missing_counts(orders.join(diffs, ["date", "ticker_symbol"], "left"))


@query()
def drop_missing(spark, d):
    joined = s.table(spark, d, "documents").join(
        s.table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left"
    )
    return labels.drop_missing(joined).drop("text")


@query()
def preview_first(spark, d):
    shown = s.table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return labels.preview(shown, ["doc_id"], 10)


# ---- engagement ------------------------------------------------------------


def _event_counters(spark, d):
    kinds = {"error": "comment_num", "purchase": "retweet_num", "click": "like_num"}
    return (
        s.table(spark, d, "events")
        .groupBy("user_id", F.to_date("ts").alias("date"))
        .agg(*[F.count_if(F.col("event_type") == k).alias(n) for k, n in kinds.items()])
    )


@query()
def engagement_weights(spark, d):
    return labels.engagement_weights(s.counters(spark, d))


@query()
def engagement_weights_events(spark, d):
    return labels.engagement_weights(_event_counters(spark, d))


@query()
def interaction_level(spark, d):
    return labels.add_interaction_level(s.counters(spark, d))


@query()
def interaction_level_events(spark, d):
    return labels.add_interaction_level(_event_counters(spark, d))


@query()
def describe_numeric(spark, d):
    return sampling.describe_numeric(
        s.counters(spark, d), ["comment_num", "retweet_num", "like_num"]
    ).select(
        "column",
        "count",
        F.round("mean", 6).alias("mean"),
        F.round("std", 6).alias("std"),
        "min",
        "p25",
        "p50",
        "p75",
        "max",
    )


@query()
def describe_prices(spark, d):
    described = sampling.describe_numeric(
        spread(s.table(spark, d, "lineitem"), "l_orderkey"),
        ["l_extendedprice", "l_discount", "l_quantity"],
    )
    names = [c for c in described.columns if c not in ("column", "count")]
    return described.select("column", "count", *[F.round(c, 4).alias(c) for c in names])


@query()
def describe_sparse(spark, d):
    """A column with few values and one with none."""
    rows = s.table(spark, d, "orders").select(
        F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice")).alias("rare"),
        F.when(F.col("o_orderstatus") == "-", F.col("o_totalprice")).alias("never"),
    )
    described = sampling.describe_numeric(spread(rows, "rare"), ["rare", "never"])
    names = [c for c in described.columns if c not in ("column", "count")]
    return described.select("column", "count", *[F.round(c, 4).alias(c) for c in names])


# ---- text features ---------------------------------------------------------


def _texts(spark, d):
    return s.documents(spark, d).select(
        F.col("doc_id").alias("tweet_id"), "lang", F.col("text").alias("body")
    )


@query()
def meta_features(spark, d):
    return features.add_meta_features(_texts(spark, d)).select("tweet_id", *META_FEATURES)


@query()
def meta_features_null_body(spark, d):
    """Texts under 100 characters are taken as missing: their rows go."""
    texts = s.documents(spark, d).select(
        F.col("doc_id").alias("tweet_id"),
        F.when(F.col("n_chars") >= 100, F.col("text")).alias("body"),
    )
    kept = features.add_meta_features(texts)
    return kept.select("tweet_id", "num_words", F.md5("original_text").alias("original_md5"))


@query()
def clean_body(spark, d):
    return features.clean_body(_texts(spark, d))


@query()
def word_count(spark, d):
    return features.add_word_count(_texts(spark, d)).select("tweet_id", "word_count")


@query()
def word_list_upper(spark, d):
    listed = F.array_join(upper_word_list(F.col("body")), " ")
    return _texts(spark, d).select("tweet_id", listed.alias("word_list"))


@query("word_tokens")
def tokens(spark, d):
    listed = F.array_join(word_tokens(F.col("body")), " ")
    return _texts(spark, d).select("tweet_id", listed.alias("tokens"))


@query()
def normalise_letters(spark, d):
    return ngrams.normalise_letters(_texts(spark, d))


@query()
def clean_reviews(spark, d):
    return ngrams.clean_reviews(_texts(spark, d), ngrams.stop_words())


@query()
def stop_word_table(spark, d):
    own = local_frame(spark, [(w,) for w in ngrams.DOMAIN_STOP_WORDS], "term string")
    return ngrams.stop_word_table(s.dictionary(spark, d), own)


@query()
def explicit_flag(spark, d):
    flagged = features.explicit_flag(_texts(spark, d), s.explicit_terms(spark))
    return flagged.select("tweet_id", "isExplicit")


@query()
def explicit_flag_any_case(spark, d):
    flagged = features.explicit_flag(
        _texts(spark, d), s.explicit_terms(spark), case_insensitive=True
    )
    return flagged.select("tweet_id", "isExplicit")


def _openings(spark, d):
    """The first two and the first three words of each benchmark text, as entries of a list."""
    tokens = F.col("tokens")
    texts = s.table(spark, d, "benchmark").select(word_tokens(F.col("text")).alias("tokens"))
    return texts.select(
        F.explode(F.array(*[F.array_join(F.slice(tokens, 1, n), " ") for n in (2, 3)])).alias("term")
    )


@query()
def explicit_phrases(spark, d):
    """Entries of several words, met as runs of neighbouring tokens."""
    flagged = features.explicit_flag(_texts(spark, d), _openings(spark, d), phrases=True)
    return flagged.select("tweet_id", "isExplicit")


@query()
def explicit_phrases_joined(spark, d):
    """As `explicit_phrases`, with a list treated as too long for a constant."""
    flagged = features.explicit_flag(_texts(spark, d), _openings(spark, d), phrases=True, limit=0)
    return flagged.select("tweet_id", "isExplicit")


@query()
def explicit_flag_long_list(spark, d):
    """The dictionary as a word list, treated as too long for a literal."""
    flagged = features.explicit_flag(_texts(spark, d), s.dictionary(spark, d), limit=0)
    return flagged.select("tweet_id", "isExplicit")


def _pair_texts(spark, d):
    """Several rows an id, of two different bodies: the text, or its source's name."""
    source = F.concat(F.col("source"), F.lit(" trash"))
    texts = s.documents(spark, d).select(F.col("doc_id").alias("tweet_id"), "text", source.alias("s"))
    pairs = texts.join(s.ticker_map_many(spark, d), "tweet_id")
    body = F.when(F.col("ticker_symbol") == "2-HIGH", F.col("s")).otherwise(F.col("text"))
    return pairs.select("tweet_id", "ticker_symbol", body.alias("body"))


@query()
def explicit_flag_pairs(spark, d):
    flagged = features.explicit_flag(_pair_texts(spark, d), s.explicit_terms(spark))
    return flagged.select("tweet_id", "ticker_symbol", "isExplicit")


@query()
def explicit_flag_pairs_joined(spark, d):
    """The same with the list treated as too long for a literal."""
    flagged = features.explicit_flag(_pair_texts(spark, d), s.explicit_terms(spark), limit=0)
    return flagged.select("tweet_id", "ticker_symbol", "isExplicit")


@query()
def buy_sell_flags(spark, d):
    flagged = features.token_flags(_texts(spark, d), ["the", "best"])
    return flagged.select("tweet_id", "has_The", "has_Best")


@query()
def flag_counts(spark, d):
    flagged = features.token_flags(_texts(spark, d), ["the", "best"])
    flagged = features.explicit_flag(flagged, s.explicit_terms(spark))
    return features.flag_counts(flagged, ["isExplicit", "has_The", "has_Best"])


@query()
def unknown_words(spark, d):
    cleaned = features.clean_body(_texts(spark, d))
    counted = features.unknown_words(cleaned, s.dictionary(spark, d))
    return counted.select("tweet_id", "typo")


@query()
def unknown_words_joined(spark, d):
    """The dictionary treated as too long for a literal."""
    cleaned = features.clean_body(_texts(spark, d))
    counted = features.unknown_words(cleaned, s.dictionary(spark, d), limit=0)
    return counted.select("tweet_id", "typo")


@query()
def unknown_terms(spark, d):
    cleaned = features.clean_body(_texts(spark, d))
    return features.unknown_terms(cleaned, s.dictionary(spark, d))


@query()
def lexicon_polarity(spark, d):
    cleaned = features.clean_body(_texts(spark, d))
    scored = features.lexicon_polarity(cleaned, s.lexicon(spark))
    return scored.select("tweet_id", F.round("polarity", 9).alias("polarity"))


@query()
def lexicon_polarity_joined(spark, d):
    """The lexicon treated as too long for a literal."""
    cleaned = features.clean_body(_texts(spark, d))
    scored = features.lexicon_polarity(cleaned, s.lexicon(spark), limit=0)
    return scored.select("tweet_id", F.round("polarity", 9).alias("polarity"))


@query()
def sentiment_label(spark, d):
    cleaned = features.clean_body(_texts(spark, d))
    scored = labels.add_sentiment(features.lexicon_polarity(cleaned, s.lexicon(spark)))
    return scored.select("tweet_id", "sentiment")


# ---- text aggregation ------------------------------------------------------


def _word_ngrams(spark, d, n):
    return ngrams.ngram_counts(_texts(spark, d), n, 15, ["lang"])


def _char_ngrams(spark, d, n):
    return ngrams.char_ngram_counts(_texts(spark, d), n, 15, ["lang"])


for size in (1, 2, 3, 4):
    QUERIES[f"word_ngrams_{size}"] = partial(_word_ngrams, n=size)
    QUERIES[f"char_ngrams_{size}"] = partial(_char_ngrams, n=size)


@query()
def text_trends(spark, d):
    texts = _texts(spark, d)
    total = F.col("comment_num") + F.col("retweet_num") + F.col("like_num")
    popular = s.counters(spark, d).where(total >= 4).select("tweet_id", F.lit(True).alias("p"))
    flagged = texts.join(popular, "tweet_id", "left").select(
        "body", F.coalesce("p", F.lit(False)).alias("popular")
    )
    return ngrams.text_trends(flagged, "popular")


@query()
def word_frequencies(spark, d):
    return ngrams.word_frequencies(_texts(spark, d), ngrams.stop_words(), 200)


def _vocabulary(spark, d, n=WORDS):
    cleaned = features.clean_body(_texts(spark, d))
    return cleaned, materialise(bow.vocabulary(cleaned, n, by=["lang"]), "vocabulary")


@query()
def vocabulary(spark, d):
    return bow.vocabulary(features.clean_body(_texts(spark, d)), WORDS, by=["lang"])


@query()
def vocabulary_500(spark, d):
    return bow.vocabulary(_texts(spark, d), 500)


@query()
def bag_of_words_long(spark, d):
    cleaned, vocab = _vocabulary(spark, d)
    return bow.bag_of_words(cleaned, vocab, ["lang"])


@query()
def bag_of_words_binary(spark, d):
    cleaned, vocab = _vocabulary(spark, d)
    return bow.bag_of_words(cleaned, vocab, ["lang"], binary=True)


@query()
def bag_of_words_wide(spark, d):
    cleaned, vocab = _vocabulary(spark, d)
    return bow.bag_of_words_wide(cleaned, vocab, WORDS, ["lang"]).drop("body")


@query()
def bag_of_words_fixed(spark, d):
    """Counts of a fixed vocabulary, by a row-by-row transform."""
    terms = sorted(s.EXPLICIT_TERMS)
    counted = bow.bag_of_words_columns(_texts(spark, d), terms)
    return counted.drop("body", "lang")


@query()
def term_rank(spark, d):
    cleaned, vocab = _vocabulary(spark, d)
    return bow.term_rank(bow.bag_of_words(cleaned, vocab, ["lang"]), ["lang"], 100)


# ---- sampling --------------------------------------------------------------


def _keys(spark, d):
    return s.table(spark, d, "documents").select(
        F.col("doc_id").alias("tweet_id"), "lang", "source", "n_chars"
    )


@query()
def balanced_sample(spark, d):
    return sampling.balanced_sample(_keys(spark, d), "lang", 100, strict=False)


@query()
def balanced_sample_orders(spark, d):
    rows = s.table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return sampling.balanced_sample(
        rows, "o_orderstatus", 40, ["o_orderpriority"], "o_orderkey", strict=False
    )


@query()
def split_exact(spark, d):
    return sampling.split_exact(_keys(spark, d), 0.2).select("tweet_id", "is_test")


@query()
def stratified_folds(spark, d):
    folded = sampling.stratified_folds(_keys(spark, d), "lang", 10)
    return folded.select("tweet_id", "lang", "fold")


@query()
def plain_folds(spark, d):
    return sampling.plain_folds(_keys(spark, d), 10).select("tweet_id", "fold")


@query()
def renumber(spark, d):
    return sampling.renumber(_keys(spark, d), ["lang"]).select("tweet_id", "lang", "row_id")


@query()
def renumber_null_group(spark, d):
    rows = _keys(spark, d).withColumn("lang", F.nullif("lang", F.lit("fr")))
    return sampling.renumber(rows, ["lang"]).select("tweet_id", "lang", "row_id")


# ---- training sets ---------------------------------------------------------


def _labels(spark, d, targets=training.TARGETS):
    lexicon = s.lexicon(spark) if "sentiment" in targets else None
    keys = s.posts(spark, d, lambda texts: training.post_keys(texts, lexicon))
    return training.post_labels(keys, s.ticker_map(spark, d), s.prices(spark, d))


def _bodies(spark, d):
    return s.table(spark, d, "documents").select(F.col("doc_id").alias("tweet_id"), F.col("text").alias("body"))


def _training_sets(spark, d, ticker=None, targets=training.TARGETS):
    labelled = _labels(spark, d, targets)
    return training.training_sets_of_labels(
        labelled if ticker is None else labelled.where(F.col("ticker_symbol") == ticker),
        _bodies(spark, d),
        s.lexicon(spark),
        s.explicit_terms(spark),
        s.dictionary(spark, d),
        PER_CLASS,
        WORDS,
        strict=False,
        targets=targets,
    )


@query()
def feature_table(spark, d):
    built = training.feature_table(
        s.posts(spark, d), s.ticker_map(spark, d), s.prices(spark, d), s.lexicon(spark)
    )
    return built.select(
        "tweet_id",
        "writer",
        "ticker_symbol",
        "date",
        "comment_num",
        "retweet_num",
        "like_num",
        "price_diff",
        "price_change",
        "interaction_level",
        *META_FEATURES,
        F.round("polarity", 9).alias("polarity"),
        "sentiment",
        F.md5("body").alias("body_md5"),
    )


@query()
def training_samples(spark, d):
    return training.training_samples(_labels(spark, d), PER_CLASS, strict=False)


def _matrix(spark, d, target, sets=None):
    sets = _training_sets(spark, d, targets=[target]) if sets is None else sets
    return _rounded(training.training_matrix(sets, target, WORDS))


def _rounded(matrix):
    if "polarity" in matrix.columns:
        matrix = matrix.withColumn("polarity", F.round("polarity", 9))
    return matrix


for short, target in (
    ("price", "price_change"),
    ("interaction", "interaction_level"),
    ("sentiment", "sentiment"),
):
    QUERIES[f"training_matrix_{short}"] = partial(_matrix, target=target)


@query()
def one_hot(spark, d):
    levelled = labels.add_interaction_level(s.counters(spark, d))
    hot = evaluate.one_hot(levelled, "interaction_level", ["none", "low", "medium", "high"])
    return hot.drop("interaction_level")


@query()
def write_training_sets(spark, d):
    """What the written folders hold, read back: one row per ticker and target."""
    path = _scratch(spark, "sets")
    training.write_training_sets(_training_sets(spark, d), path)
    return (
        spark.read.parquet(path)
        .groupBy("ticker_symbol", "target")
        .agg(F.count(F.lit(1)).alias("posts"), F.sum("num_words").alias("words"))
    )


def _explored(spark, d, words):
    total = F.col("comment_num") + F.col("retweet_num") + F.col("like_num")
    flagged = s.posts(spark, d).select("tweet_id", "body", (total >= 4).alias("popular"))
    return Exploration(materialise(flagged, "flagged"), "popular", 5000, words, strict=False)


@query()
def explore_matrix(spark, d):
    matrix = _explored(spark, d, 100).matrix(
        s.explicit_terms(spark), s.dictionary(spark, d), s.lexicon(spark), ["the", "best"]
    )
    rounded = matrix.withColumn("polarity", F.round("polarity", 9))
    return rounded.drop("body", "original_text")


@query()
def explore_vocabulary_500(spark, d):
    return _explored(spark, d, 500).vocabulary


@query()
def explore_trends(spark, d):
    return _explored(spark, d, 100).trends()


@query()
def explore_frequencies(spark, d):
    return _explored(spark, d, 100).frequencies()


# ---- scores of fixed predictions -------------------------------------------


def _predicted(spark, d):
    guess = F.when(F.col("n_chars") >= 800, 1).otherwise(0).alias("guess")
    share = F.when(F.col("n_chars") >= 800, 0.875).otherwise(0.375).alias("share_1")
    texts = s.table(spark, d, "documents").select("doc_id", guess, share)
    return s.table(spark, d, "labels").join(texts, "doc_id").select(
        "doc_id", F.col("quality").cast("string").alias("quality"), "guess", "share_1"
    )


@query()
def confusion(spark, d):
    return evaluate.confusion(_predicted(spark, d), "quality", "guess")


@query()
def macro_prf(spark, d):
    return evaluate.macro_prf(_predicted(spark, d), "quality", "guess")


@query()
def class_report(spark, d):
    return evaluate.class_report(_predicted(spark, d), "quality", "guess")


@query()
def class_report_never_predicted(spark, d):
    always = _predicted(spark, d).withColumn("guess", F.lit(1))
    return evaluate.class_report(always, "quality", "guess", zero_division=1)


@query()
def accuracy(spark, d):
    return evaluate.accuracy(_predicted(spark, d), "quality", "guess")


@query()
def r2_onehot(spark, d):
    rows = _predicted(spark, d).withColumn("share_0", 1 - F.col("share_1"))
    return evaluate.r2_onehot(rows, "quality", {"0": "share_0", "1": "share_1"})


@query()
def score_rules(spark, d):
    """The published tree on the interaction matrix of every ticker."""
    matrix = _matrix(spark, d, "interaction_level")
    names = training.feature_columns("interaction_level", WORDS)
    scored = rules.score_rules(matrix, INTERACTION_TREE, names)
    return scored.select("tweet_id", "ticker_symbol", "interaction_level", "predicted")


@query()
def score_printed_rules(spark, d):
    """The same tree from a print that stops at the sixth test; what it cuts off is unknown."""
    matrix = _matrix(spark, d, "interaction_level")
    names = training.feature_columns("interaction_level", WORDS)
    printed = rules.print_rules(INTERACTION_TREE, PRINTED_DEPTH)
    scored = rules.score_rules(matrix, rules.read_rules(printed), names)
    return scored.select("tweet_id", "ticker_symbol", "interaction_level", "predicted")


@query()
def fold_summary(spark, d):
    """Accuracy of the fixed predictions per fold, then its mean and deviation."""
    folded = sampling.stratified_folds(_predicted(spark, d), "quality", 10, "doc_id")
    right = F.avg((F.col("quality") == F.col("guess").cast("string")).cast("double"))
    scores = folded.groupBy("fold").agg(right.alias("score")).withColumn("alpha", F.lit(0.0))
    summary = trees.summarise_folds(scores)
    return summary.select(*[F.round(c, 9).alias(c) for c in summary.columns])


# ---- learned models --------------------------------------------------------

SHORT_TARGETS = {
    "price": "price_change",
    "interaction": "interaction_level",
    "sentiment": "sentiment",
}


# The set that a model is fitted on is one ticker's: word columns mean other words for another.
MODEL_TICKER = s.PRIORITIES[0]


def _set(spark, d, target, ticker=MODEL_TICKER):
    """The stored training matrix of a target for a ticker, or for all: PER_CLASS rows a class and ticker."""
    sets = _training_sets(spark, d, ticker, [target])
    return materialise(_matrix(spark, d, target, sets), "set")


def _whole_set(spark, d, target):
    """The stored matrix of a target over every labelled post of all tickers, with one vocabulary."""
    matrix = training.whole_matrix(
        _labels(spark, d, [target]), _bodies(spark, d), s.lexicon(spark), s.explicit_terms(spark),
        s.dictionary(spark, d), target, WORDS,
    )
    return materialise(_rounded(matrix), "set")


@query()
def set_models(spark, d):
    """Every ticker and target by itself: rows, leaves and scores of its tree."""
    found = plans.set_models(_training_sets(spark, d), words=WORDS)
    rounded = ("accuracy_train", "accuracy_test", "precision", "recall", "f1")
    return found.withColumns({c: F.round(c, 9) for c in rounded})


@query()
def set_model_rows(spark, d):
    """Rows that each set's tree was fitted and scored on, by part and label, from its confusions."""
    cells = plans.set_cells(_training_sets(spark, d), words=WORDS)
    by = ["ticker_symbol", "target", "part", "truth"]
    return cells.groupBy(*by).agg(F.sum("cnt").alias("posts"))


def _prepared(spark, d, target="interaction_level"):
    names = training.feature_columns(target, WORDS)
    return trees.prepare(_set(spark, d, target), names, target)


def _split(spark, d, target="interaction_level", folds=None, ticker=MODEL_TICKER, whole=False):
    """Training rows, with `folds` if asked for, and test rows of a training set, or of all labelled posts."""
    names = training.feature_columns(target, WORDS)
    rows = _whole_set(spark, d, target) if whole else _set(spark, d, target, ticker)
    marked = sampling.split_exact(rows)
    train, test = marked.where(~F.col("is_test")), marked.where("is_test")
    if folds:
        train = sampling.stratified_folds(train, target, folds)
    train = trees.prepare(train, names, target)
    return train, trees.prepare(test, names, target, train.labels)


@query()
def tree_entropy(spark, d, target="interaction_level"):
    train, test = _split(spark, d, target)
    fit = trees.fit_tree(train)
    return evaluate.confusion(fit.score(test.rows), target, "predicted")


@query()
def pruned_tree(spark, d, target="interaction_level"):
    """Scores of the pruned tree of all labelled posts: four in five are fitted, the others scored."""
    train, test = _split(spark, d, target, whole=True)
    fit = trees.fit_tree(train, alpha=0.0025, max_bins=trees.bins_of_all_rows(train))
    return evaluate.class_report(fit.score(test.rows), target, "predicted", 1.0)


@query()
def tree_onehot_regression(spark, d, target="interaction_level"):
    """R squared of the share tree, fitted and scored on all rows of the set."""
    data = _prepared(spark, d, target)
    scored = trees.fit_share_tree(data, 0.0006).score(data.rows)
    columns = {label: f"p_{i}" for i, label in enumerate(data.labels)}
    shares = [F.get("probability", F.lit(i)).alias(f"p_{i}") for i in range(len(data.labels))]
    return evaluate.r2_onehot(scored.select(target, *shares), target, columns)


@query()
def random_forest(spark, d, target="interaction_level"):
    train, test = _split(spark, d, target)
    forest = trees.fit_forest(train)
    return evaluate.class_report(forest.score(test.rows), target, "predicted")


for short in ("price", "sentiment"):
    for build in (tree_entropy, pruned_tree, tree_onehot_regression, random_forest):
        name = f"{build.__name__}_{short}"
        QUERIES[name] = partial(build, target=SHORT_TARGETS[short])


@query()
def forest_first_tree(spark, d):
    train, _ = _split(spark, d)
    forest = trees.fit_forest(train)
    return trees.tree_rules(spark, forest.first_tree(), forest.labels, forest.features)


@query()
def forest_params(spark, d):
    train, _ = _split(spark, d)
    return trees.resolved_params(spark, trees.fit_forest(train).model).where(
        ~F.col("param").isin("leafCol", "featuresCol")
    )


@query()
def tree_rules(spark, d):
    data = _prepared(spark, d)
    fit = trees.fit_tree(data, alpha=0.0025)
    pruned = trees.prune(fit.tree, 0.0025)
    return trees.tree_rules(spark, pruned, fit.labels, fit.features)


@query()
def tree_nodes(spark, d):
    """Nodes of the tree of all labelled posts, grown in full."""
    target = "interaction_level"
    names = training.feature_columns(target, WORDS)
    data = trees.prepare(_whole_set(spark, d, target), names, target)
    fit = trees.fit_tree(data, max_bins=trees.bins_of_all_rows(data))
    return trees.tree_nodes(fit.model, fit.features)


@query()
def tree_text(spark, d):
    fit = trees.fit_tree(_prepared(spark, d))
    path = _scratch(spark, "tree")
    trees.write_tree_text(spark, trees.tree_text(fit.tree, fit.labels), path)
    return spark.read.text(path)


@query()
def pruning_path(spark, d):
    return trees.pruning_path(spark, trees.fit_tree(_prepared(spark, d)).tree)


@query()
def alpha_sweep(spark, d):
    train, _ = _split(spark, d, folds=10)
    return trees.alpha_sweep(train, 10, "entropy")


@query()
def alpha_sweep_regression(spark, d):
    target = "interaction_level"
    folded = sampling.plain_folds(_set(spark, d, target), 10)
    data = trees.prepare(folded, training.feature_columns(target, WORDS), target)
    return trees.alpha_sweep(data, 10, "gini")


def _search(spark, d):
    train, test = _split(spark, d, folds=3)
    return trees.grid_search(train, trees.FULL_GRID, 3), train, test


@query()
def grid_search(spark, d):
    return _search(spark, d)[0].results


@query()
def best_params(spark, d):
    found, _, _ = _search(spark, d)
    return trees.params_table(spark, found.best_params)


@query()
def best_forest_accuracy(spark, d):
    """Accuracy of the refitted best forest on the training and on the test rows."""
    found, train, test = _search(spark, d)
    parts = []
    for name, rows in (("train", train.rows), ("test", test.rows)):
        right = evaluate.accuracy(found.best.score(rows), "interaction_level", "predicted")
        parts.append(right.select(F.lit(name).alias("part"), *right.columns))
    return parts[0].unionByName(parts[1])


@query()
def tree_stump(spark, d):
    """Root of a tree of depth one: whether an order has four or more lines, from its counters."""
    total = F.col("comment_num") + F.col("retweet_num") + F.col("like_num")
    size = F.when(total >= 4, "many").otherwise("few")
    names = ["comment_num", "retweet_num", "like_num"]
    rows = materialise(s.counters(spark, d).withColumn("size", size), "sizes")
    tree = trees.fit_tree(trees.prepare(rows, names, "size"), max_depth=1).tree
    low, high = int(tree.left[0]), int(tree.right[0])
    root = names[tree.feature[0]], float(tree.threshold[0])
    row = (*root, int(tree.rows[low]), int(tree.rows[high]))
    return local_frame(
        spark, [row], "feature string, threshold double, rows_low long, rows_high long"
    )


@query()
def train_test_rows(spark, d):
    """Rows of all tickers that a tree is fitted on and scored on, from its confusions."""
    train, test = _split(spark, d, ticker=None)
    fit = trees.fit_tree(train)
    parts = []
    for name, rows in (("train", train.rows), ("test", test.rows)):
        cells = evaluate.confusion(fit.score(rows), "interaction_level", "predicted")
        parts.append(cells.agg(F.lit(name).alias("part"), F.sum("cnt").alias("posts")))
    return parts[0].unionByName(parts[1])
