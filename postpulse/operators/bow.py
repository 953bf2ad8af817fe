"""Vocabulary, bag of words and term rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postpulse.functions.text import vocabulary_tokens
from postpulse.operators.joins import few_groups, join_by_size, most_frequent
from postpulse.sources import materialise

# A wide result has one column per vocabulary entry.
MOST_WIDE_TERMS = 1000


def vocabulary(
    df: DataFrame,
    n: int = 100,
    max_df: float = 0.95,
    by: Sequence[str] = (),
    body: str = "body",
    stored: bool = False,
) -> DataFrame:
    """Top `n` terms per group: (by, term, total, docs, rank, position).

    Terms in more than `max_df` of the group's rows are left out. `rank` goes
    by total count, then term; `position` is the alphabetical place from 1.

    One pass over the text and one shuffle: each row sends its tokens once for
    the total and its distinct tokens once for the document count, both folded in
    the reading task. Counts that are `stored` are never made again to be ranked.
    """
    by = list(by)
    tokens = df.select(*by, vocabulary_tokens(F.col(body)).alias("_tokens"))
    # A NULL body has no tokens array and so sends nothing.
    sent = F.concat(
        F.transform("_tokens", lambda t: F.struct(t.alias("term"), F.lit(0).alias("doc"))),
        F.transform(
            F.array_distinct("_tokens"),
            lambda t: F.struct(t.alias("term"), F.lit(1).alias("doc")),
        ),
    )
    stats = (
        tokens.select(*by, F.explode(sent).alias("s"))
        .groupBy(*by, F.col("s.term").alias("term"))
        .agg(
            F.count_if(F.col("s.doc") == 0).alias("total"),
            F.count_if(F.col("s.doc") == 1).alias("docs"),
        )
    )
    rows = F.count(F.lit(1)).alias("_rows")
    few = few_groups(df, by)
    if by:
        sized = join_by_size(stats, df.groupBy(*by).agg(rows), by, "inner", ["term"], small=few)
    else:
        sized = stats.withColumn("_rows", df.agg(rows).scalar())
    kept = sized.where(F.col("docs") <= F.lit(max_df) * F.col("_rows")).drop("_rows")
    if stored:
        kept = materialise(kept, "terms")
    best = most_frequent(kept, by, "total", n, "term", few)
    position = F.row_number().over(Window.partitionBy(*by).orderBy("term"))
    return best.withColumn("position", position)


def bag_of_words(
    df: DataFrame,
    vocab: DataFrame,
    by: Sequence[str] = (),
    key: Sequence[str] = ("tweet_id",),
    body: str = "body",
    binary: bool = False,
) -> DataFrame:
    """(key, by, term, position, cnt): counts of vocabulary terms per row.

    Long form without zeros. Tokens meet the vocabulary where they are read
    and a row's tokens lie in one task, so only folded hits are shuffled.
    """
    by, key = list(by), list(key)
    rest = [name for name in key if name not in by]
    tokens = df.select(*by, *rest, F.explode(vocabulary_tokens(F.col(body))).alias("term"))
    entries = vocab.select(*by, "term", "position")
    hits = join_by_size(tokens, entries, [*by, "term"], "inner", rest)
    count = F.lit(1) if binary else F.count(F.lit(1)).cast("int")
    return hits.groupBy(*by, *rest, "term", "position").agg(
        (F.max(count) if binary else count).alias("cnt")
    )


def word_column(position: int) -> str:
    """Column name of the vocabulary entry at an alphabetical position."""
    return f"w_{position:03d}"


def bag_of_words_wide(
    df: DataFrame,
    vocab: DataFrame,
    n: int,
    by: Sequence[str] = (),
    key: Sequence[str] = ("tweet_id",),
    body: str = "body",
) -> DataFrame:
    """`df` with columns `w_001` … `w_<n>`: counts by position, zeros kept.

    Every group has its own vocabulary, so columns go by position; entry names
    are in `vocab`. For one group, `bag_of_words_columns` names them by term.
    """
    if n > MOST_WIDE_TERMS:
        raise ValueError(f"at most {MOST_WIDE_TERMS} word columns; use bag_of_words")
    on = list(dict.fromkeys([*by, *key]))
    names = [word_column(i) for i in range(1, n + 1)]
    counts = (
        bag_of_words(df, vocab, by, key, body)
        .groupBy(*on)
        .pivot("position", list(range(1, n + 1)))
        .agg(F.sum("cnt"))
    )
    counts = counts.toDF(*on, *names)
    joined = df.join(counts, on, "left")
    return joined.withColumns(
        {name: F.coalesce(F.col(name), F.lit(0)).cast("int") for name in names}
    )


def vocabulary_terms(vocab: DataFrame, limit: int = MOST_WIDE_TERMS) -> list[str]:
    """The terms of a single-group vocabulary, in alphabetical order."""
    rows = vocab.select("term").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} terms")
    return sorted(row["term"] for row in rows)


def bag_of_words_vector(
    df: DataFrame, terms: Sequence[str], body: str = "body", binary: bool = False
) -> DataFrame:
    """Add `word_counts`: a sparse vector of counts of a fixed vocabulary.

    A row-by-row transform with a fitted vocabulary: nothing is shuffled.
    """
    model = CountVectorizerModel.from_vocabulary(
        list(terms), inputCol="_tokens", outputCol="word_counts"
    ).setBinary(binary)
    tokens = df.withColumn("_tokens", vocabulary_tokens(F.col(body)))
    return model.transform(tokens).drop("_tokens")


def bag_of_words_columns(
    df: DataFrame, terms: Sequence[str], body: str = "body", prefix: str = "w_"
) -> DataFrame:
    """Add one count column per term, named `w_<term>`; no shuffle.

    The prefix keeps a word such as `date` apart from a feature of that name.
    """
    if len(terms) > MOST_WIDE_TERMS:
        raise ValueError(f"at most {MOST_WIDE_TERMS} word columns; use bag_of_words")
    from pyspark.ml.functions import vector_to_array

    counted = bag_of_words_vector(df, terms, body).withColumn(
        "_counts", vector_to_array("word_counts")
    )
    columns = {
        f"{prefix}{term}": F.get("_counts", F.lit(i)).cast("int") for i, term in enumerate(terms)
    }
    return counted.withColumns(columns).drop("_counts", "word_counts")


def bag_of_words_positions(df: DataFrame, terms: Sequence[str], n: int, body: str = "body") -> DataFrame:
    """`bag_of_words_wide` of one vocabulary, given as its terms in alphabetical order; no shuffle."""
    if n > MOST_WIDE_TERMS:
        raise ValueError(f"at most {MOST_WIDE_TERMS} word columns; use bag_of_words")
    from pyspark.ml.functions import vector_to_array

    counts = {word_column(i): F.lit(0) for i in range(1, n + 1)}
    if not terms:
        return df.withColumns(counts)
    counted = bag_of_words_vector(df, terms, body).withColumn(
        "_counts", vector_to_array("word_counts")
    )
    for i in range(len(terms)):
        counts[word_column(i + 1)] = F.coalesce(F.get("_counts", F.lit(i)), F.lit(0)).cast("int")
    return counted.withColumns(counts).drop("_counts", "word_counts")


def term_rank(bag: DataFrame, by: Sequence[str] = (), k: int = 100) -> DataFrame:
    """Terms by their largest count in one row: (by, term, max_cnt, rank).

    Lowest first, ties by term; `rank_high` numbers them from the other end.
    The vocabulary bounds a group's rows.
    """
    by = list(by)
    most = bag.groupBy(*by, "term").agg(F.max("cnt").alias("max_cnt"))
    low = Window.partitionBy(*by).orderBy("max_cnt", "term")
    high = Window.partitionBy(*by).orderBy(F.desc("max_cnt"), F.desc("term"))
    ranked = most.withColumns(
        {"rank": F.row_number().over(low), "rank_high": F.row_number().over(high)}
    )
    return ranked.where((F.col("rank") <= k) | (F.col("rank_high") <= k))
