"""Line dedup: equal lines, and lines within a few edits of an earlier one.

A line is cut into one segment more than the edits that are allowed, so a line
within that distance holds one of the segments unchanged, and near its place. Segments
are indexed by content, number and length of their line; other lines probe the index
with the substrings that can stand there. What meets is verified by an edit distance
on a diagonal band, whose cells are the bits of one word for each number of edits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postpulse.sources import materialise

SPACES = " \t\n\x0b\f\r"
EDITS = 1


def least_chars(edits: int) -> int:
    """Characters from which lines are compared: below them a segment has under two."""
    return 2 * edits + 2


def lines_of(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, no, line) of every line with a word; white space at either end is dropped."""
    parts = docs.select(
        F.col(id_col).alias("id"), F.posexplode(F.split(F.col(text), "\n")).alias("no", "_raw")
    )
    lines = parts.select("id", "no", F.btrim("_raw", F.lit(SPACES)).alias("line"))
    return lines.where(F.col("line") != "")


def _segment(length: Column, number: int, edits: int) -> tuple[Column, Column]:
    """Start (from 0) and length of a segment; the last ones are a character longer."""
    parts = edits + 1
    short = F.floor(length / parts).cast("int")
    longer = (length % parts).cast("int")
    before = F.greatest(F.lit(0), F.lit(number) - (parts - longer))
    size = short + F.when(F.lit(number) >= parts - longer, 1).otherwise(0)
    return short * number + before, size


def index_entries(edits: int) -> list[Column]:
    """Hashes of a line's own segments; needs `line` and `n` (its length)."""
    out = []
    for number in range(edits + 1):
        start, size = _segment(F.col("n"), number, edits)
        part = F.substring(F.col("line"), start + 1, size)
        out.append(F.xxhash64(part, F.lit(number), F.col("n")))
    return out


def probe_entries(edits: int) -> list[Column]:
    """Hashes of the substrings that can be a segment of a line at most `edits` shorter.

    Segment `number` can start as far from its place as the edits before it, and the
    edits after it, allow. Null where the substring would leave the line.
    """
    out = []
    for less in range(edits + 1):
        length = F.col("n") - less
        for number in range(edits + 1):
            start, size = _segment(length, number, edits)
            for shift in range(-edits, edits + 1):
                if abs(shift) > number or abs(shift - less) > edits - number:
                    continue
                at = start + shift
                part = F.substring(F.col("line"), at + 1, size)
                inside = (at >= 0) & (at + size <= F.col("n"))
                out.append(F.when(inside, F.xxhash64(part, F.lit(number), length)))
    return out


# Letters whose numbers differ by no more than the edits in two lines that are linked.
COUNTED = "aeinrt"


def letter_counts() -> Column:
    """Numbers of the counted letters, ten bits each."""
    total = F.lit(0).cast("long")
    for k, letter in enumerate(COUNTED):
        count = F.col("n") - F.char_length(F.replace("line", F.lit(letter), F.lit("")))
        total = total + F.shiftleft((count % 1024).cast("long"), 10 * k)
    return total


def near_counts(a: Column, b: Column, edits: int) -> Column:
    """Whether no counted letter's numbers are further apart than the edits (modulo 1024)."""
    near = F.lit(True)
    for k in range(len(COUNTED)):
        one, two = (F.shiftright(x, 10 * k).bitwiseAND(1023) for x in (a, b))
        near = near & (F.pmod(one - two + edits, F.lit(1024)) <= 2 * edits)
    return near


def within(a: Column, b: Column, edits: int) -> Column:
    """Whether the edit distance of two strings, not empty, is at most `edits`.

    Bit d of word e says that the first i characters of `a` and the first i + d - edits
    of `b` are at most e edits apart; a character of `a` moves all cells of the band
    at once.
    """
    mask = (1 << 2 * edits + 1) - 1
    words = [f"e{k}" for k in range(edits + 1)]
    first = [sum(1 << edits + j for j in range(k + 1)) for k in range(edits + 1)]
    start = F.struct(*[F.lit(x).alias(word) for x, word in zip(first, words, strict=True)])

    def compare(pair):
        mine, other = pair["a"], pair["b"]

        def advance(state, i):
            same = F.lit(0)
            for d in range(2 * edits + 1):
                equal = F.get(mine, i).eqNullSafe(F.get(other, i + d - edits))
                same = same.bitwiseOR(F.when(equal, 1 << d).otherwise(0))
            cells = []
            for k, word in enumerate(words):
                cell = state[word].bitwiseAND(same)
                if k:
                    fewer = state[words[k - 1]]
                    cell = cell.bitwiseOR(fewer).bitwiseOR(F.shiftright(fewer, 1))
                    cell = cell.bitwiseOR(F.shiftleft(cells[-1], 1)).bitwiseAND(F.lit(mask))
                cells.append(cell)
            return F.struct(*[cell.alias(word) for cell, word in zip(cells, words, strict=True)])

        end = F.size(other) - F.size(mine) + edits
        places = F.sequence(F.lit(0), F.size(mine) - 1)
        reached = F.aggregate(places, start, advance, lambda state: state[words[-1]])
        return F.when(end.between(0, 2 * edits), F.getbit(reached, end) == 1).otherwise(False)

    # As the element of an array the characters are split once and not at each step.
    every = F.lit("(?s).")
    chars = [F.regexp_extract_all(x, every, F.lit(0)) for x in (a, b)]
    pair = F.array(F.struct(chars[0].alias("a"), chars[1].alias("b")))
    return F.get(F.transform(pair, compare), F.lit(0))


def distinct_lines(docs: DataFrame, id_col: str, text: str, edits: int) -> DataFrame:
    """One row per different line: key, where it is first, letter counts and entries.

    Repeats are folded where they are read, and lines travel as their hashes.
    """
    lines = lines_of(docs, id_col, text).withColumn("n", F.char_length("line"))
    long_enough = F.col("n") >= least_chars(edits)
    entries = {f"_i{k}": x for k, x in enumerate(index_entries(edits))}
    entries |= {f"_p{k}": x for k, x in enumerate(probe_entries(edits))}
    hashed = lines.select(
        "id", "no", F.xxhash64("line").alias("key"), letter_counts().alias("counts"),
        *[F.when(long_enough, x).alias(name) for name, x in entries.items()],
    )
    same = [F.max(name).alias(name) for name in ("counts", *entries)]
    return hashed.groupBy("key").agg(F.min(F.struct("id", "no")).alias("first"), *same)


def similar_lines(docs: DataFrame, distinct: DataFrame, id_col: str, text: str, edits: int):
    """(a, b), both ways: keys of different lines within `edits` edits of each other."""

    def entries(letter):
        names = [c for c in distinct.columns if c.startswith(f"_{letter}")]
        rows = distinct.select("key", "counts", F.explode(F.array(*names)).alias("entry"))
        return rows.where("entry is not null")

    index, probe = entries("i"), entries("p")
    met = (
        probe.select("entry", F.col("key").alias("a"), F.col("counts").alias("_a"))
        .join(index.select("entry", F.col("key").alias("b"), F.col("counts").alias("_b")), "entry")
        .where((F.col("a") != F.col("b")) & near_counts(F.col("_a"), F.col("_b"), edits))
    )
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = materialise(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    places = wanted.join(distinct.select("key", "first.id", "first.no"), "key")
    # The place of the first copy of a line is one row, so each text is fetched once.
    texts = lines_of(docs, id_col, text).join(
        places.select(F.col("id").alias("_id"), F.col("no").alias("_no"), "key"),
        F.col("id").eqNullSafe(F.col("_id")) & (F.col("no") == F.col("_no"))
        & (F.xxhash64("line") == F.col("key")),
    )
    texts = materialise(texts.select("key", "line").dropDuplicates(["key"]), "texts")
    one = texts.select(F.col("key").alias("a"), F.col("line").alias("_one"))
    two = texts.select(F.col("key").alias("b"), F.col("line").alias("_two"))
    linked = pairs.join(one, "a").join(two, "b")
    linked = linked.where(within(F.col("_one"), F.col("_two"), edits)).select("a", "b")
    linked = materialise(linked, "links")
    return linked.union(linked.select("b", "a"))


def judged_lines(docs: DataFrame, id_col: str, text: str, edits: int) -> DataFrame:
    """(id, no, links, kept): each different line where it is first.

    It is kept unless a line within `edits` edits is first met earlier.
    """
    distinct = materialise(distinct_lines(docs, id_col, text, edits), "lines")
    links = similar_lines(docs, distinct, id_col, text, edits)
    first = distinct.select(F.col("key").alias("b"), F.col("first").alias("_other"))
    around = (
        links.join(first, "b")
        .groupBy(F.col("a").alias("key"))
        .agg(F.count(F.lit(1)).alias("links"), F.min("_other").alias("_before"))
    )
    earlier = F.col("_before") < F.col("first")
    return (
        distinct.select("key", "first")
        .join(around, "key", "left")
        .select(
            "first.id", "first.no", F.coalesce("links", F.lit(0)).alias("links"),
            (~F.coalesce(earlier, F.lit(False))).alias("kept"),
        )
    )


def dedupe_lines(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", edits: int = EDITS
) -> DataFrame:
    """id, n_lines, n_removed, n_near and n_links of every row.

    Lines are what `\\n` separates, without white space at either end; those without
    a word don't count. A line goes if an equal line, or one within `edits` edits, is
    met earlier: in a row of smaller id, or further up. This is judged on the input. Of
    those that go, `n_near` have no equal line earlier; `n_links` counts the lines
    within `edits` edits, in the row where a line is first met. Lines of fewer than
    `least_chars(edits)` characters are compared for equality only. Null and empty texts have
    no lines, null ids come first, and rows of equal id are taken as one document, so
    that each of them gets its figures. Lines are known by a 64-bit hash.
    """
    lines = materialise(judged_lines(docs, id_col, text, edits), "judged")
    figures = lines.groupBy(F.col("id").alias("_id")).agg(
        F.count_if("kept").alias("_kept"),
        F.count_if(~F.col("kept")).alias("_near"),
        F.sum("links").alias("_links"),
    )
    every = F.filter(F.split(F.col(text), "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    n = F.coalesce(F.size(every), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).alias("id"), F.greatest(n, F.lit(0)).alias("n_lines"))
    joined = rows.join(figures, F.col("id").eqNullSafe(F.col("_id")), "left")

    def known(name):
        return F.coalesce(name, F.lit(0)).cast("long")

    return joined.select(
        F.col("id").alias(id_col), "n_lines",
        (F.col("n_lines") - known("_kept")).alias("n_removed"),
        known("_near").alias("n_near"), known("_links").alias("n_links"),
    )


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", edits: int = EDITS
) -> DataFrame:
    """The rows of `docs` with the lines that `dedupe_lines` counts as removed taken out.

    Lines without a word stay. Null texts stay null.
    """
    lines = judged_lines(docs, id_col, text, edits).where("kept")
    kept = lines.groupBy(F.col("id").alias("_id")).agg(F.collect_set("no").alias("_kept"))
    joined = docs.join(kept, F.col(id_col).eqNullSafe(F.col("_id")), "left")
    held = F.coalesce("_kept", F.array().cast("array<int>"))
    lines_left = F.filter(
        F.split(F.col(text), "\n"),
        lambda x, no: (F.btrim(x, F.lit(SPACES)) == "") | F.array_contains(held, no),
    )
    return joined.withColumn(text, F.array_join(lines_left, "\n")).select(docs.columns)
