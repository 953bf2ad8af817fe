"""Word and character n-gram counts, trend reports and word frequencies."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postpulse.functions.text import (
    clean_reviews_text,
    exploded,
    letters_only,
    positions,
    without,
    word_tokens,
    words,
)
from postpulse.operators.heavy import most_frequent_of
from postpulse.operators.joins import few_groups, most_frequent
from postpulse.sources import materialise

# Stop words of the domain, added to the English list. `qqqstks`
# is one entry.
DOMAIN_STOP_WORDS = (
    "http", "com", "bit", "ly", "utm", "index", "html", "bi", "twitter", "source",
    "medium", "iwm", "qqqstks", "co", "xref", "utm_source", "utm_medium", "https",
    "utm_campaign", "1126416â", "php", "js", "dlvr", "htm", "owler", "us", "read",
    "tweet", "spy",
)


def stop_words(extra: Iterable[str] = DOMAIN_STOP_WORDS) -> list[str]:
    """English stop words together with `extra`."""
    return sorted(set(StopWordsRemover.loadDefaultStopWords("english")) | set(extra))


def stop_word_table(listed: DataFrame, extra: DataFrame) -> DataFrame:
    """Union of two term tables, each term once."""
    return listed.select("term").union(extra.select("term")).distinct()


def clean_reviews(df: DataFrame, stop: Iterable[str], body: str = "body") -> DataFrame:
    """Replace the body by its cleaned words without stop words."""
    return df.where(F.col(body).isNotNull()).withColumn(
        body, clean_reviews_text(F.col(body), stop)
    )


def normalise_letters(df: DataFrame, body: str = "body") -> DataFrame:
    """Replace the body by its lower-cased ASCII letters and single spaces."""
    return df.where(F.col(body).isNotNull()).withColumn(body, letters_only(F.col(body)))


def _sized(
    placed: DataFrame, keep: Sequence[str], sizes: Sequence[int], gram: Callable[[int], Column]
) -> DataFrame:
    """(keep, n, term) of the n-grams of every size that start at a position.

    `gram(n)` is NULL where no n-gram of that size starts.
    """
    if len(sizes) == 1:
        return placed.select(*keep, F.lit(sizes[0]).alias("n"), gram(sizes[0]).alias("term"))
    listed = F.posexplode(F.array(*[gram(n) for n in sizes])).alias("_at", "term")
    found = placed.select(*keep, listed).where(F.col("term").isNotNull())
    n = F.get(F.array(*[F.lit(n) for n in sizes]), F.col("_at"))
    return found.select(*keep, n.alias("n"), "term")


def _top_word_grams(tokens: DataFrame, by: Sequence[str], sizes: Sequence[int], k: int) -> DataFrame:
    """(by, n, term, count, rank) of the `k` most frequent n-grams of every size.

    Starting positions and sizes are exploded beside the word arrays, which carries
    numbers only. An n-gram's words are hashed where they stand, and its text is made if its
    bucket is counted. A row of no more than n words adds nothing, also when it has exactly n.
    """
    least = min(sizes)
    starts = positions(F.col("_tokens"), least + 1, least)
    placed = tokens.select(*by, "_tokens", starts.alias("_i"))
    if len(sizes) == 1:
        placed = placed.withColumn("n", F.lit(least))
    else:
        listed = F.explode(F.array(*[F.lit(n) for n in sizes])).alias("n")
        fits = F.col("n") <= F.size("_tokens") - F.greatest("_i", F.lit(1))
        placed = placed.select(*by, "_tokens", "_i", listed).where(fits)
    word = F.get("_tokens", F.col("_i"))
    words_from = [word]
    for j in range(1, max(sizes)):
        word = F.get("_tokens", F.col("_i") + F.lit(j))
        words_from.append(word if j < least else F.when(F.col("n") > j, word))
    made = F.concat_ws(" ", *words_from) if max(sizes) > 1 else word
    return most_frequent_of(placed, [*by, "n"], "term", k, words_from, made)


def _char_grams(tokens: DataFrame, by: Sequence[str], sizes: Sequence[int]) -> DataFrame:
    """(by, n, term, count): counted per distinct word, weighted by its count.

    A corpus has far fewer distinct words than words, so the words are counted
    first and cut up once each. A word of no more than n characters adds nothing.
    """
    counted = (
        tokens.select(*by, exploded(F.col("_tokens")).alias("_word"))
        .groupBy(*by, "_word")
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    least = min(sizes)
    length = F.length("_word")
    starts = F.explode(F.when(length > least, F.sequence(F.lit(1), length - (least - 1))))
    placed = counted.select(*by, "_times", "_word", starts.alias("_i"))

    def gram(n: int) -> Column:
        text = F.substring("_word", F.col("_i"), F.lit(n))
        if n == least:
            return text
        return F.when((length > n) & (F.col("_i") + (n - 1) <= length), text)

    return (
        _sized(placed, [*by, "_times"], sizes, gram)
        .groupBy(*by, "n", "term")
        .agg(F.sum("_times").alias("count"))
    )


def _spaced(gram: Column) -> Column:
    return F.trim(F.regexp_replace(gram, "(?s)(.)", "$1 "))


def _token_rows(df: DataFrame, by: Sequence[str], body: str) -> DataFrame:
    return df.select(*by, words(F.col(body)).alias("_tokens"))


def ngram_counts(
    df: DataFrame, n: int, k: int = 15, by: Sequence[str] = (), body: str = "body"
) -> DataFrame:
    """The `k` most frequent word n-grams per group; ties go by term."""
    # Stored, as the grams are made three times of them.
    tokens = materialise(_token_rows(df, by, body), "tokens")
    return _top_word_grams(tokens, by, [n], k).select(*by, "term", "count", "rank")


def char_ngram_counts(
    df: DataFrame, n: int, k: int = 15, by: Sequence[str] = (), body: str = "body"
) -> DataFrame:
    """The `k` most frequent character n-grams inside words, per group.

    A word of at most `n` characters adds nothing; characters are shown with
    spaces between them.
    """
    grams = _char_grams(_token_rows(df, by, body), by, [n])
    best = most_frequent(grams, by, "count", k, "term", few_groups(df, by))
    return best.select(*by, _spaced(F.col("term")).alias("term"), "count", "rank")


def text_trends(
    df: DataFrame,
    group_col: str,
    sizes: Sequence[int] = (1, 2, 3, 4),
    k: int = 15,
    body: str = "body",
    stop: Iterable[str] | None = None,
) -> DataFrame:
    """Top word and character n-grams of every size for each group.

    Bodies are reduced to letters, then stop words are dropped.
    """
    stop = stop_words() if stop is None else stop
    # Nothing is left to delete from a text of letters and single spaces.
    cleaned = without(F.array_remove(F.split(letters_only(F.col(body)), " "), ""), stop)
    tokens = materialise(df.select(group_col, cleaned.alias("_tokens")), "tokens")
    by = [group_col, "unit", "n"]
    few = few_groups(tokens, [group_col])
    whole = _top_word_grams(tokens, [group_col], sizes, k).withColumn("unit", F.lit("word"))
    chars = _char_grams(tokens, [group_col], sizes).withColumn("unit", F.lit("char"))
    best = whole.unionByName(most_frequent(chars, by, "count", k, "term", few))
    shown = F.when(F.col("unit") == "char", _spaced(F.col("term"))).otherwise(F.col("term"))
    return best.select(*by, shown.alias("term"), "count", "rank")


def word_frequencies(
    df: DataFrame,
    stop: Iterable[str],
    k: int = 200,
    body: str = "body",
    by: Sequence[str] = (),
) -> DataFrame:
    """The `k` most frequent lower-cased word tokens that are not stop words.

    `weight` is the count relative to the most frequent one of the group.
    """
    counted = (
        df.select(*by, F.explode(word_tokens(F.lower(body))).alias("term"))
        .where(~F.col("term").isin(sorted(set(stop))))
        .groupBy(*by, "term")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    best = most_frequent(counted, by, "count", k, "term", few_groups(df, by))
    # Over the kept rows only, so at most k per group.
    most = F.max("count").over(Window.partitionBy(*by))
    return best.withColumn("weight", F.col("count") / most)
