"""Quality rules: base counts of a text, and its divergence from its language.

The character-class and common-word histograms of each document are held against
those of its language, gathered over all documents of that language that pass the
base rules. A document whose Jensen-Shannon distance from either is too large is
rejected, if it is long enough for its histogram to say something. What a short text's
histogram differs by chance is taken off first; as that is much with a slot for each
common word, the common words are also compared in a few bands.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postpulse.sources import materialise

# What the base rules count.
SPACES = " \t\n\x0b\f\r"
BETWEEN_WORDS = r"[\x20\x09-\x0D]+"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED_PERCENT = 20, 30

# Classes of characters; what is in none of them is counted last.
CLASSES = {
    "spaces": r"\x20\x09-\x0D",
    "symbols": r"#*$%&|<>",
    "lower": "a-z",
    "upper": "A-Z",
    "digits": "0-9",
    "marks": r".,;:!?'\"()\-",
}
# Frequent short words of each language.
COMMON = {
    "en": "the of and to in a is that for it on with as was be by at from this are or an".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par pas au sur".split(),
}
ALL_COMMON = sorted({word for words in COMMON.values() for word in words})
SLOTS = max(map(len, COMMON.values())) + 1
BANDS = 3  # of common words, with about as many uses in each

# Guards and limits of the verdict.
CHARS_FROM, MOST_CHAR_DISTANCE = 200, 0.26
WORDS_FROM, MOST_WORD_DISTANCE = 30, 0.16
DEVIATIONS = 3  # of what a sample's distance is by chance, taken off


def word_list(text: Column) -> Column:
    """Words of a text that isn't null; blank text has none."""
    bare = F.btrim(text, F.lit(SPACES))
    empty = F.array().cast("array<string>")
    return F.when(bare == "", empty).otherwise(F.split(bare, BETWEEN_WORDS))


def repeated_words(words: Column, windows: Column) -> Column:
    """Words covered by windows that occur twice or more; `windows` has their hashes."""
    sorted_ = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def same(every, k, other):
        return F.get(every, other)["h"] == F.get(every, k)["h"]

    def starts(every):
        twice = F.filter(
            every,
            lambda x, k: F.coalesce(same(every, k, k - 1), F.lit(False))
            | F.coalesce(same(every, k, k + 1), F.lit(False)),
        )
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    # As the element of an array, the sorted windows are computed once, not at each use.
    found = F.get(F.transform(F.array(sorted_), starts), F.lit(0))
    covered = F.aggregate(
        found,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda so_far, at: F.struct(
            (so_far["n"] + at + WINDOW - F.greatest(so_far["end"], at)).alias("n"),
            (at + WINDOW).alias("end"),
        ),
        lambda so_far: so_far["n"].cast("long"),
    )
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(repeats, covered).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """`docs` with base counts and the two histograms, row by row, without a shuffle."""
    whole = F.coalesce(F.col(text), F.lit(""))
    first = docs.withColumns(
        {
            "_words": word_list(whole),
            "_length": F.char_length(whole),
            "_lines": F.filter(
                F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != ""
            ),
            **{
                f"_{name}": F.char_length(F.regexp_replace(whole, f"[^{chars}]+", ""))
                for name, chars in CLASSES.items()
            },
        }
    )
    n = F.size("_words")
    starts = F.sequence(F.lit(1), n - WINDOW + 1)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice("_words", i, WINDOW)))
    none = F.array().cast("array<bigint>")
    second = first.withColumns(
        {
            "_windows": F.when(n >= WINDOW, hashes).otherwise(none),
            "_common": F.filter("_words", lambda word: word.isin(ALL_COMMON)),
        }
    )
    classes = [F.col(f"_{name}") for name in CLASSES]
    rest = F.col("_length")
    for counted in classes:
        rest = rest - counted
    own = F.when(F.col(lang).isin(list(COMMON)), F.col(lang)).otherwise("")
    lists = F.create_map(
        *[F.lit(""), F.array([F.lit(w) for w in ALL_COMMON[: SLOTS - 1]])],
        *[x for k, ws in COMMON.items() for x in (F.lit(k), F.array([F.lit(w) for w in ws]))],
    )
    found = F.transform(
        F.element_at(lists, own), lambda word: F.size("_common") - F.size(F.array_remove("_common", word))
    )
    third = second.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": (F.col("_length") - F.col("_spaces")).cast("long"),
            "n_symbols": F.col("_symbols").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": repeated_words(F.col("_words"), F.col("_windows")),
            "_language": own,
            "_chars": F.array(*classes, rest),
            "_found": found,
        }
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    others = F.col("n_words").cast("int") - F.aggregate("_found", F.lit(0), lambda a, b: a + b)
    return third.withColumns(
        {"base_failed": failed, "_found": F.concat(F.array(others), "_found")}
    ).drop("_words", "_length", "_lines", "_windows", "_common", *[f"_{name}" for name in CLASSES])


def bands(reference: Column) -> Column:
    """Band of each slot: common words from the most to the least used; the others, first, are last."""
    own = F.transform(reference, lambda n, i: F.struct(n.alias("n"), (-i).alias("i")))
    words = F.slice(own, 2, F.size(own) - 1)

    def uses(every):
        return F.aggregate(every, F.lit(0).cast("long"), lambda a, x: a + x["n"])

    def band(word):
        before = uses(F.filter(words, lambda x: x > word))
        return F.least(F.floor(BANDS * before / F.greatest(uses(words), F.lit(1))), F.lit(BANDS - 1))

    return F.concat(F.array(F.lit(BANDS)), F.transform(words, lambda x: band(x).cast("int")))


def in_bands(counts: Column, of: Column) -> Column:
    """The histogram with one slot per band; lists of fewer words have fewer slots."""
    slots = F.arrays_zip(counts.alias("n"), of.alias("band"))

    def summed(band):
        same = F.filter(slots, lambda x: x["band"] == band)
        return F.aggregate(
            same, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x["n"], F.lit(0))
        )

    return F.array(*[summed(band) for band in range(BANDS + 1)])


def references(measured: DataFrame) -> DataFrame:
    """Both histograms summed over the documents of each language that pass the base rules.

    One row per language of `COMMON`, and one for all others: five rows at most, with
    the bands of the words.
    """

    def summed(name, slots):
        return F.array(*[F.coalesce(F.sum(F.get(name, F.lit(i))), F.lit(0)) for i in range(slots)])

    return (
        measured.where(~F.col("base_failed"))
        .groupBy(F.col("_language").alias("_of"))
        .agg(
            summed("_chars", len(CLASSES) + 1).alias("_ref_chars"),
            summed("_found", SLOTS).alias("_ref_found"),
        )
        .withColumn("_bands", bands(F.col("_ref_found")))
    )


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms of counts."""

    def share(every):
        total = F.greatest(F.aggregate(every, F.lit(0).cast("long"), lambda a, b: a + b), F.lit(1))
        shares = F.transform(F.array(total), lambda n: F.transform(every, lambda x: x / n))
        return F.get(shares, F.lit(0))

    def part(x, y):
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    parts = F.zip_with(
        share(counts),
        share(reference),
        lambda p, q: part(p, q) + part(q, p),
    )
    total = F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def beyond_chance(found: Column, counts: Column) -> Column:
    """A distance less what a sample of so many from the reference has by chance.

    For n counted things 8 ln 2 n times its square is about chi-squared with one degree
    of freedom less than there are slots; the mean and `DEVIATIONS` deviations go.
    """
    n = F.greatest(F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b), F.lit(1))
    free = F.size(counts) - 1
    chance = (free + DEVIATIONS * F.sqrt(2 * free)) / (8 * math.log(2) * n)
    return F.sqrt(F.greatest(found * found - chance, F.lit(0.0)))


def judge(measured: DataFrame) -> DataFrame:
    """`measured` with char_distance, word_distance (beyond chance) and kept.

    The word distance is the larger of those by single words and by bands of words.

    Null text counts as empty and fails for its length. A language that isn't in
    `COMMON`, null included, is held against all such documents together. The
    distances of texts under the guards' lengths are given and don't count.
    """
    joined = measured.join(
        F.broadcast(references(measured)), F.col("_language") == F.col("_of"), "left"
    )
    chars = distance(F.col("_chars"), F.col("_ref_chars"))
    chars = beyond_chance(chars, F.col("_chars"))
    words = distance(F.col("_found"), F.col("_ref_found"))
    words = beyond_chance(words, F.col("_found"))
    few, ref_few = (in_bands(F.col(c), F.col("_bands")) for c in ("_found", "_ref_found"))
    joined = joined.withColumns({"_few": few, "_ref_few": ref_few})
    banded = distance(F.col("_few"), F.col("_ref_few"))
    words = F.greatest(words, beyond_chance(banded, F.col("_few")))
    judged = joined.withColumns({"char_distance": chars, "word_distance": words})
    far = (
        (F.col("word_chars") >= CHARS_FROM) & (F.col("char_distance") > MOST_CHAR_DISTANCE)
    ) | ((F.col("n_words") >= WORDS_FROM) & (F.col("word_distance") > MOST_WORD_DISTANCE))
    kept = ~F.col("base_failed") & ~F.coalesce(far, F.lit(False))
    return judged.withColumn("kept", kept).drop(
        "_of", "_ref_chars", "_ref_found", "_language", "_chars", "_found",
        "_bands", "_few", "_ref_few",
    )


def rated(
    docs: DataFrame, text: str = "text", lang: str = "lang", keep: bool = True
) -> DataFrame:
    """`docs` with the base counts, both distances and the verdict; `keep`: with the text.

    Rows are measured once and stored with their other columns; columns of the same
    names in the input are replaced. Repeated rows get repeated results, and an empty
    table gives an empty result.
    """
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    clean = docs.drop(*own, "char_distance", "word_distance", "kept")
    measured = measure(clean, text, lang)
    return judge(materialise(measured if keep else measured.drop(text), "measured"))
