"""Text features as DataFrame steps: meta-features, flags, lexicon look-ups."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postpulse.functions.text import (
    PUNCTUATION,
    clean_text,
    count_tokens,
    meta_feature_columns,
    positions,
    word_tokens,
    words,
)
from postpulse.operators.joins import fits_broadcast, join_by_size
from postpulse.sources import local_frame

# Word lists up to this many entries become a constant in the plan (`small_lookup`).
# Longer ones are joined, with the same answers.
LITERAL_TERMS = 10_000
# Lists up to this many entries are also a set in the plan.
LISTED_TERMS = 200
# Fixed value: a word of this form is a number and is not looked up.
_NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def add_meta_features(df: DataFrame, body: str = "body") -> DataFrame:
    """Drop rows without a body, keep the raw text, add the eleven features."""
    text = F.col(body)
    return df.where(text.isNotNull()).withColumns(
        {"original_text": text, **meta_feature_columns(text)}
    )


def clean_body(df: DataFrame, body: str = "body") -> DataFrame:
    """Replace the body by its cleaned text."""
    return df.withColumn(body, clean_text(F.col(body)))


def add_word_count(df: DataFrame, body: str = "body") -> DataFrame:
    """Add `word_count`."""
    return df.withColumn("word_count", count_tokens(F.col(body)))


def small_lookup(
    table: DataFrame, fields: str, limit: int = LITERAL_TERMS
) -> Callable[[Column], Column] | None:
    """A table of up to `limit` terms as a constant: a function from a word to its row or null.

    `fields` is the schema of the columns besides `term`, and a term has one row. The
    constant is an array of small buckets by hash of the term, so a word costs one hash
    and a look at a row or two, however many terms there are. In a short list most words
    aren't found and go no further than a set of the terms. None if there are more.
    """
    names = [field.split(" ")[0] for field in fields.split(", ") if field]
    rows = table.select("term", *names, F.xxhash64("term").alias("_hash")).limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    size = max(2 * len(rows), 1)
    buckets: list[list] = [[] for _ in range(size)]
    for row in rows:
        buckets[row["_hash"] % size].append({name: row[name] for name in ("term", *names)})
    row_type = f"struct<term:string{''.join(', ' + f.replace(' ', ':', 1) for f in fields.split(', ') if f)}>"
    constant = F.from_json(F.lit(json.dumps(buckets, ensure_ascii=False)), f"array<array<{row_type}>>")

    listed = [row["term"] for row in rows] if len(rows) <= LISTED_TERMS else None

    def row_of(word: Column) -> Column:
        bucket = F.get(constant, F.pmod(F.xxhash64(word), F.lit(size)).cast("int"))
        found = F.get(F.filter(bucket, lambda row: row["term"] == word), F.lit(0))
        return F.when(word.isin(listed), found) if listed else found

    return row_of


def _terms(terms: DataFrame, term: Column) -> DataFrame:
    """Different entries; a NULL one is no entry."""
    return terms.select(term.alias("term")).where(F.col("term").isNotNull()).distinct()


def word_lookup(terms: DataFrame, limit: int = LITERAL_TERMS) -> Callable[[Column], Column] | None:
    """Whether an array of tokens holds one of up to `limit` terms; None if there are more."""
    row_of = small_lookup(terms, "", limit)
    if row_of is None:
        return None
    return lambda tokens: F.exists(tokens, lambda word: row_of(word).isNotNull())


def _edge(state: Column | int, word: Column | str) -> Column | str:
    """Name of the way out of a state by a word."""
    if isinstance(word, str):
        return f"{state} {word}"
    return F.concat(state.cast("string"), F.lit(" "), word)


def phrase_edges(entries: Sequence[str]) -> list[tuple[str, int]]:
    """(edge, next state) of the tree of the entries' words; an entry's last word leads to -1."""
    states: dict[tuple[str, ...], int] = {(): 0}
    edges: dict[str, int] = {}
    for entry in sorted(set(entries)):
        words = tuple(entry.split(" "))
        for i, word in enumerate(words):
            edge = _edge(states[words[:i]], word)
            if edges.get(edge) == -1:
                break  # a shorter entry is met before
            last = i + 1 == len(words)
            # The way of a longer entry is never needed once a shorter one ends on it.
            edges[edge] = -1 if last else states.setdefault(words[: i + 1], len(states))
    return list(edges.items())


def phrase_lookup(terms: DataFrame, limit: int = LITERAL_TERMS) -> Callable[[Column], Column] | None:
    """Whether neighbouring tokens are one of up to `limit` entries; None if there are more.

    The entries' words are a tree, its edges a constant. One fold over the tokens carries
    the states that the last tokens lead to, which are fewer than the longest entry's words.
    """
    entries = [row["term"] for row in terms.select("term").limit(limit + 1).collect()]
    if len(entries) > limit:
        return None
    edges = phrase_edges(entries)
    table = local_frame(terms.sparkSession, edges, "term string, next int")
    row_of = small_lookup(table, "next int", len(edges))
    done = F.array(F.lit(-1))

    def step(states: Column, word: Column) -> Column:
        onward = F.transform(F.concat(F.array(F.lit(0)), states), lambda at: row_of(_edge(at, word))["next"])
        reached = F.filter(onward, lambda at: at.isNotNull())
        return F.when(F.array_contains(states, -1), done).otherwise(reached)

    none = F.array().cast("array<int>")
    return lambda tokens: F.array_contains(F.aggregate(tokens, none, step), -1)


def explicit_flag(
    df: DataFrame,
    terms: DataFrame,
    body: str = "body",
    key: str = "tweet_id",
    case_insensitive: bool = False,
    phrases: bool = False,
    limit: int = LITERAL_TERMS,
) -> DataFrame:
    """Add `isExplicit`: 1 when a word token of the body equals an entry.

    Matching is case-sensitive, and an entry with a space in it never matches,
    unless `case_insensitive` or `phrases` asks for more; with `phrases`, neighbouring
    tokens that are an entry's words, split at single spaces, match it. NULL entries are
    left out. A list of up to `limit` entries is a constant in the plan and the flag a row
    expression. A longer list is joined to the distinct tokens (and runs) instead.
    """
    terms = _terms(terms, F.lower("term") if case_insensitive else F.col("term"))
    text = F.lower(body) if case_insensitive else F.col(body)
    tokens = word_tokens(text)
    holds = (phrase_lookup if phrases else word_lookup)(terms, limit)
    if holds is not None:
        hit = F.coalesce(holds(tokens), F.lit(False))
        return df.withColumn("isExplicit", hit.cast("int"))
    looked_up = [tokens]
    if phrases:
        sizes = terms.select(F.size(F.split("term", " ")).alias("n")).where("n > 1").distinct()
        looked_up += [_runs(tokens, row["n"]) for row in sizes.collect()]
    every = F.array_distinct(F.concat(*looked_up))
    marked = df.withColumn("_text", F.xxhash64(body))
    found = marked.select(key, "_text", F.explode(every).alias("term"))
    hits = (
        join_by_size(found, terms, ["term"], "left_semi", [key])
        .select(key, "_text")
        .distinct()
        .withColumn("isExplicit", F.lit(1))
    )
    return _rows_with(marked, hits, key, "isExplicit", F.lit(0))


def _runs(tokens: Column, size: int) -> Column:
    """All runs of `size` neighbouring tokens, each joined by a space."""

    def runs(tokens: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(tokens) - size + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, size), " "))

    # As the element of an array the tokens are made once and not for each run.
    every = F.get(F.transform(F.array(tokens), runs), F.lit(0))
    return F.when(F.size(tokens) >= size, every).otherwise(F.array().cast("array<string>"))


def _rows_with(marked: DataFrame, found: DataFrame, key: str, name: str, none: Column) -> DataFrame:
    """Add a value found by key and text (`_text`) to each row that has both."""
    other = found.select(F.col(key).alias("_key"), F.col("_text").alias("_same"), name)
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_text") == F.col("_same"))
    joined = marked.join(other, same, "left").drop("_key", "_same", "_text")
    return joined.withColumn(name, F.coalesce(name, none))


def token_flags(df: DataFrame, tokens: Sequence[str], body: str = "body") -> DataFrame:
    """Add `has_<Token>`: 1 when that exact word token is in the body."""
    found = word_tokens(F.col(body))
    return df.withColumns(
        {
            f"has_{token.capitalize()}": F.coalesce(
                F.array_contains(found, token), F.lit(False)
            ).cast("int")
            for token in tokens
        }
    )


def flag_counts(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """One row: how many rows have each 0/1 flag set."""
    return df.agg(*[F.count_if(F.col(flag) == 1).alias(f"count_{flag}") for flag in flags])


def _spelled(body: str) -> Column:
    """Distinct lower-cased words that are looked up: no numbers, no single signs."""
    return F.filter(
        F.array_distinct(words(F.lower(body))),
        lambda word: ~word.rlike(_NUMBER) & ~word.rlike(f"^[{PUNCTUATION}]$"),
    )


def unknown_terms(
    df: DataFrame, dictionary: DataFrame, body: str = "body", key: str = "tweet_id"
) -> DataFrame:
    """Distinct lower-cased words of each row that the dictionary lacks.

    Numbers and single punctuation signs are not looked up.
    """
    looked_up = df.select(key, F.explode(_spelled(body)).alias("term"))
    entries = _terms(dictionary, F.lower("term"))
    return join_by_size(looked_up, entries, ["term"], "left_anti", [key])


def unknown_words(
    df: DataFrame,
    dictionary: DataFrame,
    body: str = "body",
    key: str = "tweet_id",
    limit: int = LITERAL_TERMS,
) -> DataFrame:
    """Add `typo`: how many distinct words of the row the dictionary lacks.

    A dictionary of up to `limit` words is a constant in the plan, and the count a row
    expression. NULL words are left out. A longer one is joined to the words: those of a row lie in one task, so
    counting them folds to one row per post before anything is shuffled.
    """
    entries = _terms(dictionary, F.lower("term"))
    row_of = small_lookup(entries, "", limit)
    if row_of is not None:
        lacking = F.filter(_spelled(body), lambda word: row_of(word).isNull())
        return df.withColumn("typo", F.coalesce(F.size(lacking), F.lit(0)))
    marked = df.withColumn("_text", F.xxhash64(body))
    looked_up = marked.select(key, "_text", F.explode(_spelled(body)).alias("term")).distinct()
    counts = (
        join_by_size(looked_up, entries, ["term"], "left_anti", [key])
        .groupBy(key, "_text")
        .agg(F.count(F.lit(1)).cast("int").alias("typo"))
    )
    return _rows_with(marked, counts, key, "typo", F.lit(0))


def add_slow_features(
    df: DataFrame,
    terms: DataFrame,
    dictionary: DataFrame,
    body: str = "body",
    key: str = "tweet_id",
) -> DataFrame:
    """Add `isExplicit` and `typo`."""
    return unknown_words(explicit_flag(df, terms, body, key), dictionary, body, key)


def _weighted(polarity: Column, boost: Column, negated: Column) -> Column:
    value = polarity * F.coalesce(boost, F.lit(1.0))
    value = F.when(negated, value * F.lit(-0.5)).otherwise(value)
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value))


def folded_lexicon(lexicon: DataFrame) -> DataFrame:
    """(term, polarity, boost, negates), one row a term: means of what its rows say.

    A row with a polarity gives a value; one without may give an intensity, or negate.
    Rows of NULL term are left out.
    """
    shifts = F.col("polarity").isNull()
    return lexicon.where(F.col("term").isNotNull()).groupBy("term").agg(
        F.avg(F.col("polarity").cast("double")).alias("polarity"),
        F.avg(F.when(shifts, F.col("intensity").cast("double"))).alias("boost"),
        F.coalesce(F.bool_or(shifts & F.col("negator")), F.lit(False)).alias("negates"),
    )


def _row_polarity(tokens: Column, row_of: Callable[[Column], Column]) -> Column:
    """`lexicon_polarity` of a token array, the lexicon's rows looked up in a constant."""

    def value(rows: Column, i: Column) -> Column:
        before, second = F.get(rows, i - 1), F.get(rows, i - 2)
        boost = before["boost"]
        negated = F.coalesce(before["negates"], F.lit(False)) | (
            boost.isNotNull() & F.coalesce(second["negates"], F.lit(False))
        )
        polarity = F.get(rows, i)["polarity"]
        return F.when(polarity.isNotNull(), _weighted(polarity, boost, negated))

    def mean(rows: Column) -> Column:
        found = F.transform(rows, lambda row, i: value(rows, i))
        found = F.filter(found, lambda x: x.isNotNull())
        return F.aggregate(
            found,
            F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n")),
            lambda so_far, x: F.struct(
                (so_far["sum"] + x).alias("sum"), (so_far["n"] + 1).alias("n")
            ),
            lambda so_far: F.when(so_far["n"] > 0, so_far["sum"] / so_far["n"]),
        )

    # As the element of an array the words are looked up once, not at each neighbour's turn.
    return F.get(F.transform(F.array(F.transform(tokens, row_of)), mean), F.lit(0))


def lexicon_polarity(
    df: DataFrame,
    lexicon: DataFrame,
    body: str = "body",
    key: str = "tweet_id",
    limit: int = LITERAL_TERMS,
) -> DataFrame:
    """Add `polarity`: mean of the lexicon values of a row's words, in [-1, 1].

    `lexicon` is (term, polarity, intensity, negator), terms in lower case; several
    rows of a term are folded first (`folded_lexicon`). A word right after a modifier (a term with an intensity and no polarity)
    is multiplied by that intensity; a word after a negator, or after a
    modifier that follows one, by -0.5. A row without lexicon words gets 0.

    A lexicon of up to `limit` terms is a constant in the plan, and the value a row
    expression. A longer one is joined: words are looked up with their two predecessors
    beside them, so no window over a row's words is needed, and a row's words fold to
    one (sum, count) pair in their task before the shuffle.
    """
    lexicon = folded_lexicon(lexicon)
    row_of = small_lookup(lexicon, "polarity double, boost double, negates boolean", limit)
    if row_of is not None:
        value = _row_polarity(word_tokens(F.lower(body)), row_of)
        return df.withColumn("polarity", F.coalesce(value, F.lit(0.0)))
    marked = df.withColumn("_text", F.xxhash64(body))
    once = marked.select(key, "_text", body).dropDuplicates([key, "_text"])
    tokens = once.select(key, "_text", word_tokens(F.lower(body)).alias("_tokens"))
    placed = tokens.select(key, "_text", "_tokens", positions(F.col("_tokens")).alias("_i"))

    def at(offset: int) -> Column:
        return F.get("_tokens", F.col("_i") - F.lit(offset))

    near = placed.select(key, "_text", at(0).alias("term"), at(1).alias("term1"), at(2).alias("term2"))
    scored = lexicon.where(F.col("polarity").isNotNull()).select("term", "polarity")
    modifies = lexicon.where(F.col("boost").isNotNull()).select(F.col("term").alias("term1"), "boost")
    negates = lexicon.where("negates")
    negates1 = negates.select(F.col("term").alias("term1"), F.lit(True).alias("not1"))
    negates2 = negates.select(F.col("term").alias("term2"), F.lit(True).alias("not2"))
    # The four look-up sides are parts of the lexicon: one measurement covers them.
    small = fits_broadcast(lexicon)
    found = join_by_size(near, scored, ["term"], "inner", [key], small=small)
    found = join_by_size(found, modifies, ["term1"], "left", [key], small=small)
    found = join_by_size(found, negates1, ["term1"], "left", [key], small=small)
    found = join_by_size(found, negates2, ["term2"], "left", [key], small=small)
    negated = F.coalesce("not1", F.lit(False)) | (
        F.col("boost").isNotNull() & F.coalesce("not2", F.lit(False))
    )
    means = found.groupBy(key, "_text").agg(
        F.avg(_weighted(F.col("polarity"), F.col("boost"), negated)).alias("polarity")
    )
    return _rows_with(marked, means, key, "polarity", F.lit(0.0))
