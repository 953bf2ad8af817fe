"""From raw posts to balanced training sets and model matrices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postpulse.functions import META_FEATURES
from postpulse.operators.bow import (
    bag_of_words_positions,
    bag_of_words_wide,
    vocabulary,
    vocabulary_terms,
    word_column,
)
from postpulse.operators.features import (
    add_meta_features,
    add_slow_features,
    clean_body,
    lexicon_polarity,
)
from postpulse.operators.joins import body_digest, first_pairs, join_by_size, pair_first_posts
from postpulse.operators.labels import (
    COUNTERS,
    add_interaction_level,
    add_post_date,
    add_price_diff,
    add_sentiment,
    drop_missing,
    keep_trading_days,
    label_price_change,
)
from postpulse.operators.sampling import sample_keys
from postpulse.sources import materialise, write_table

TARGETS = ("price_change", "interaction_level", "sentiment")
ROWS_PER_CLASS = 1500
WORDS = 100

# The columns each target was derived from, which its model must not see.
_LEAKS = {
    "price_change": ("price_diff", "interaction_level", "sentiment"),
    "interaction_level": (*COUNTERS, "price_change", "sentiment"),
    "sentiment": ("polarity", "price_change", "interaction_level"),
}
_FEATURES = (
    *COUNTERS,
    "price_diff",
    *META_FEATURES,
    "polarity",
    "isExplicit",
    "typo",
)


def label_posts(posts: DataFrame, ticker_map: DataFrame, prices: DataFrame) -> DataFrame:
    """Distinct bodies on trading days with `price_diff` and `price_change`."""
    return _price_labels(pair_first_posts(posts, ticker_map), prices)


def _price_labels(pairs: DataFrame, prices: DataFrame) -> DataFrame:
    traded = keep_trading_days(add_post_date(pairs), prices)
    return label_price_change(add_price_diff(traded, prices))


def text_features(df: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Meta-features, cleaned text and sentiment of the rows that have a body."""
    return add_sentiment(lexicon_polarity(clean_body(add_meta_features(df)), lexicon))


def feature_table(
    posts: DataFrame, ticker_map: DataFrame, prices: DataFrame, lexicon: DataFrame
) -> DataFrame:
    """Labelled posts with levels, meta-features, cleaned text and sentiment.

    The labelled posts are written once: the engagement weights and the table
    itself would otherwise each repeat the join and the dedupe.
    """
    labelled = materialise(label_posts(posts, ticker_map, prices), "labelled")
    return text_features(add_interaction_level(labelled), lexicon)


def post_keys(posts: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """Posts with the digest of the body in its place and, if given a lexicon, their sentiment.

    Row work that can be done where the posts are read: what is joined, deduped and
    sampled from then on is narrow.
    """
    keyed = posts.withColumn("digest", body_digest())
    if lexicon is not None:
        keyed = add_sentiment(lexicon_polarity(clean_body(keyed), lexicon)).drop("polarity")
    return keyed.drop("body")


def post_labels(keys: DataFrame, ticker_map: DataFrame, prices: DataFrame) -> DataFrame:
    """The posts of `feature_table` with their labels, from `post_keys`, stored.

    The sentiment is a label if the keys have it. Every post is labelled; bodies and the
    features that are no labels are left to `text_features`.
    """
    keys = materialise(keys, "keys")
    labelled = materialise(_price_labels(first_pairs(keys, ticker_map), prices), "labelled")
    # The weights count the post without a body, which goes then.
    return materialise(add_interaction_level(labelled).where("digest <> ''"), "labels")


def with_bodies(keyed: DataFrame, posts: DataFrame, few: bool = True) -> DataFrame:
    """Rows of `keyed` with their bodies, found among `posts` by id and digest.

    If they are `few` of the posts, the others' bodies stay where they are read.
    """
    near = posts.select("tweet_id", "body")
    if few:
        ids = keyed.select("tweet_id").distinct()
        near = join_by_size(near, ids, ["tweet_id"], "left_semi", ["tweet_id"])
    found = near.withColumn("digest", body_digest()).dropDuplicates(["tweet_id", "digest"])
    return keyed.join(found, ["tweet_id", "digest"]).drop("digest")


def training_samples(
    features: DataFrame,
    n: int | Mapping[tuple, int] = ROWS_PER_CLASS,
    strict: bool = True,
    seed: int | str = 42,
    targets: Sequence[str] = TARGETS,
) -> DataFrame:
    """(tweet_id, target): an equal random number of posts per ticker and class.

    Only ids and labels are read; each post enters once per target. A size
    given as a mapping is keyed by (target, ticker_symbol, class).
    """
    labels = F.array(
        *[F.struct(F.lit(t).alias("target"), F.col(t).alias("label")) for t in targets]
    )
    entries = features.select("tweet_id", "ticker_symbol", F.explode(labels).alias("e"))
    entries = entries.select("tweet_id", "ticker_symbol", "e.*")
    picked = sample_keys(
        entries, ["target", "ticker_symbol", "label"], n, "tweet_id", seed, strict
    )
    return picked.select("tweet_id", "target")


def training_sets(
    features: DataFrame,
    terms: DataFrame,
    dictionary: DataFrame,
    n: int | Mapping[tuple, int] = ROWS_PER_CLASS,
    words: int = WORDS,
    strict: bool = True,
    seed: int | str = 42,
    targets: Sequence[str] = TARGETS,
) -> DataFrame:
    """All (ticker, target) training sets as one table, keyed by `target`.

    `features` should be a stored table: sampling passes over its labels, and
    the slow features and words are then worked out for sampled posts only,
    once per post even when several targets picked it.
    """
    picked = materialise(training_samples(features, n, strict, seed, targets), "picked")
    return _word_sets(_picked_rows(features, picked), picked, terms, dictionary, words)


def training_sets_of_labels(
    labels: DataFrame,
    posts: DataFrame,
    lexicon: DataFrame,
    terms: DataFrame,
    dictionary: DataFrame,
    n: int | Mapping[tuple, int] = ROWS_PER_CLASS,
    words: int = WORDS,
    strict: bool = True,
    seed: int | str = 42,
    targets: Sequence[str] = TARGETS,
) -> DataFrame:
    """`training_sets`, the same rows, from `post_labels` and the (tweet_id, body) of all posts.

    A post's features depend on that post alone, but for its labels. So all posts are labelled
    and sampled, and bodies are read again and described for sampled posts only.
    """
    picked = materialise(training_samples(labels, n, strict, seed, targets), "picked")
    sampled = with_bodies(_picked_rows(labels, picked), posts)
    return _word_sets(text_features(sampled, lexicon), picked, terms, dictionary, words)


def _picked_rows(table: DataFrame, picked: DataFrame) -> DataFrame:
    ids = picked.select("tweet_id").distinct()
    return join_by_size(table, ids, ["tweet_id"], "left_semi", ["tweet_id"])


def _word_sets(
    sampled: DataFrame, picked: DataFrame, terms: DataFrame, dictionary: DataFrame, words: int
) -> DataFrame:
    slow = add_slow_features(sampled, terms, dictionary)
    sets = materialise(slow.join(picked, "tweet_id"), "sampled")
    by = ["target", "ticker_symbol"]
    vocab = materialise(vocabulary(sets, words, by=by), "vocabulary")
    return bag_of_words_wide(sets, vocab, words, by=by)


def feature_columns(target: str, words: int = WORDS) -> list[str]:
    """Feature names of a target's matrix in model order."""
    kept = [name for name in _FEATURES if name not in _LEAKS[target]]
    return kept + [word_column(i) for i in range(1, words + 1)]


def training_matrix(sets: DataFrame, target: str, words: int = WORDS) -> DataFrame:
    """Rows of a target without missing values: key, ticker, features, label.

    A row with any missing value goes, also where the column itself is not
    a feature. Columns the label was derived from are dropped.
    """
    rows = drop_missing(sets.where(F.col("target") == target))
    return rows.select(*_matrix_columns(target, words))


def _matrix_columns(target: str, words: int) -> list[str]:
    return ["tweet_id", "ticker_symbol", *feature_columns(target, words), target]


def whole_matrix(
    labels: DataFrame,
    posts: DataFrame,
    lexicon: DataFrame,
    terms: DataFrame,
    dictionary: DataFrame,
    target: str,
    words: int = WORDS,
) -> DataFrame:
    """The `training_matrix` of every post with a label, from `post_labels` and the bodies of all posts.

    Nothing is sampled, and the posts of all tickers share one vocabulary. Bodies cross the
    network once, on their way to the labels; words are counted where the rows lie.
    """
    labelled = labels.dropna(subset=["ticker_symbol", target])
    described = text_features(with_bodies(labelled, posts, few=False), lexicon)
    slow = add_slow_features(described.drop("original_text"), terms, dictionary)
    rows = materialise(slow.withColumn("target", F.lit(target)), "described")
    entries = vocabulary_terms(vocabulary(rows, words, by=["target"], stored=True))
    # Counts are never missing, so rows with gaps go before they are made.
    counted = bag_of_words_positions(drop_missing(rows), entries, words)
    return counted.select(*_matrix_columns(target, words))


def write_training_sets(sets: DataFrame, path: str) -> None:
    """One folder per ticker and target."""
    write_table(sets, path, ["ticker_symbol", "target"])
