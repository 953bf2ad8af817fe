"""Exact samples, splits, folds and row numbers by a reproducible random order.

Rows are ordered by a hash of a seed and their key. The row at a wanted rank of
a group is found from a histogram over hash prefixes: counts per (group,
prefix) say which prefix the rank falls in, and only that prefix's rows are
ranked. These passes read the group and key columns only. Sizes, wanted ranks and
the rows found there are tables, so any number of groups will do. A sample, a split
or a fold is then a comparison of each row with those: wide rows are neither sorted
nor shuffled where the rows found are few, a group of any size is spread over its
prefixes, and using the result twice repeats no work.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postpulse.operators.joins import join_by_size
from postpulse.sources import local_frame, materialise

# Hash prefixes are made as long as keeps about this many rows of a group in each.
PREFIX_ROWS = 1_000_000
# Labels are laid end to end in as many parts as three hex digits tell apart.
PART_DIGITS = 3
# A quantile is looked for among up to this many different values at a time.
RANKED = 200_000
# Even shares that a range of values is cut at while it holds more.
CUTS = 256


def hash_order(key: str, seed: int | str) -> Column:
    """Reproducible random sort value: the md5 of `<seed>:<key>`; a NULL key counts as empty."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), text))


def prefix_digits(rows: int) -> int:
    """Hex digits of the prefix that cuts a group of `rows` into even buckets."""
    digits = 2
    while rows > PREFIX_ROWS * 16**digits:
        digits += 1
    return digits


def _with_order(df: DataFrame, key: str, seed: int | str, rows: int) -> DataFrame:
    """Add the hash `_h` and its prefix `_bucket`; `rows` is the largest group's size."""
    hashed = df.withColumn("_h", hash_order(key, seed))
    return hashed.withColumn("_bucket", F.substring("_h", 1, prefix_digits(rows)))


def _sizes(df: DataFrame, by: Sequence[str], *extra: Column) -> DataFrame:
    """Row count (`_rows`) and `extra` aggregates of every group without NULLs, stored."""
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *extra)
    return materialise(counted.dropna(subset=list(by)), "sizes")


def _local(df: DataFrame, names: Sequence[str], rows: Sequence, **added: str) -> DataFrame:
    """Driver rows as a table: columns `names` typed as in `df`, then `added`."""
    kinds = [T.StructField(name, df.schema[name].dataType) for name in names]
    kinds += [T.StructField(name, T._parse_datatype_string(kind)) for name, kind in added.items()]
    return local_frame(df.sparkSession, rows, T.StructType(kinds))


def rank_cuts(
    df: DataFrame, by: Sequence[str], bucket: str, order: Sequence[str], wanted: DataFrame
) -> DataFrame:
    """(`by`, `_rank`, `order`): the `order` values at each wanted rank of a group, stored.

    `wanted` has (`by`, `_rank`), ranks from 1. `bucket` must grow with `order`, whose
    first column differs between the rows of a bucket. Equal values are folded before
    they are ranked, so a value a third of the rows share costs one row.
    """
    by, order = list(by), list(order)
    cell = [*by, bucket]
    counted = df.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*by).orderBy(bucket))
    found = counted.withColumn("_upto", upto).join(wanted, by)
    at = F.col("_rank") - F.col("_upto") + F.col("_n")
    inside = found.withColumn("_at", at).where(F.col("_at").between(F.lit(1), F.col("_n")))
    targets = materialise(inside.select(*cell, "_rank", "_at"), "targets")
    rows = df.select(*cell, *order)
    near = join_by_size(rows, targets.select(*cell).distinct(), cell, "left_semi", order[:1])
    values = near.groupBy(*cell, *order).agg(F.count(F.lit(1)).alias("_times"))
    up = F.sum("_times").over(Window.partitionBy(*cell).orderBy(*order))
    hit = (F.col("_at") > F.col("_up") - F.col("_times")) & (F.col("_at") <= F.col("_up"))
    cuts = values.withColumn("_up", up).join(targets, cell).where(hit)
    return materialise(cuts.select(*by, "_rank", *order), "cuts")


def _cuts_of_all(df: DataFrame, key: str, ranks: Sequence[int]) -> list[tuple]:
    """(hash, key) of the rows at the given ranks of the whole table, ascending."""
    wanted = local_frame(df.sparkSession, [(0, rank) for rank in ranks], "_all int, _rank long")
    cuts = rank_cuts(df.withColumn("_all", F.lit(0)), ["_all"], "_bucket", ["_h", key], wanted)
    return [(row["_h"], row[key]) for row in cuts.orderBy("_rank").collect()]


def _after(key: str, cut_hash: Column, cut_key: Column) -> Column:
    """Whether a row comes after the one with the given hash and key."""
    same = F.col("_h") == cut_hash
    # Only equal keys share a hash; a NULL key is neither before nor after itself.
    return (F.col("_h") > cut_hash) | (same & F.coalesce(F.col(key) > cut_key, F.lit(False)))


def sample_keys(
    df: DataFrame,
    by: Sequence[str],
    n: int | Mapping[tuple, int],
    key: str,
    seed: int | str = 42,
    strict: bool = True,
) -> DataFrame:
    """Rows of an exact-size random sample of every group in `by`.

    `n` is one size, or a size per group value (a tuple in the order of `by`).
    A group smaller than its size is an error, or with `strict=False` is kept
    whole. `key` is unique within a group.
    """
    by = list(by)
    sizes = _sizes(df, by)
    if isinstance(n, int):
        sized = sizes.withColumn("_size", F.lit(n).cast("long"))
    else:
        named = _local(df, by, [(*group, size) for group, size in n.items()], _size="long")
        sized = sizes.join(named, by, "left")
    short = F.col("_size") > F.col("_rows")
    figures = sized.agg(
        F.max("_rows").alias("largest"),
        F.count_if(short).alias("short"),
        F.count_if(F.isnull("_size")).alias("unnamed"),
    ).first()
    if figures["unnamed"]:
        unnamed = sized.where("_size is null").select(*by).limit(20).collect()
        raise KeyError(f"groups without a size: {[tuple(row) for row in unnamed]}")
    if strict and figures["short"]:
        some = [tuple(row) for row in sized.where(short).select(*by, "_rows", "_size").limit(20).collect()]
        raise ValueError(f"groups smaller than the sample, as (group, rows, size): {some}")
    ordered = _with_order(df, key, seed, figures["largest"] or 0)
    wanted = sized.select(*by, F.least("_size", "_rows").alias("_rank")).where("_rank > 0")
    cuts = rank_cuts(ordered, by, "_bucket", ["_h", key], wanted).drop("_rank")
    cuts = cuts.withColumnsRenamed({"_h": "_cut_h", key: "_cut_key"})
    late = _after(key, F.col("_cut_h"), F.col("_cut_key"))
    return join_by_size(ordered, cuts, by, "inner", [key]).where(~late).select(*df.columns)


def balanced_sample(
    df: DataFrame,
    label: str,
    n: int | Mapping[tuple, int],
    by: Sequence[str] = (),
    key: str = "tweet_id",
    seed: int | str = 42,
    strict: bool = True,
) -> DataFrame:
    """Exactly `n` random rows per (`by`, `label`), without replacement."""
    return sample_keys(df, [*by, label], n, key, seed, strict)


def split_exact(
    df: DataFrame, test_share: float = 0.2, key: str = "tweet_id", seed: int | str = 42
) -> DataFrame:
    """Add `is_test`, true on exactly ceil(`test_share` of all rows), at random."""
    rows = df.count()
    size = ceil(round(test_share * rows, 9))
    if size == 0:
        return df.withColumn("is_test", F.lit(False))
    ordered = _with_order(df, key, seed, rows)
    (cut,) = _cuts_of_all(ordered, key, [size])
    late = _after(key, *map(F.lit, cut))
    return ordered.select(*df.columns, (~late).alias("is_test"))


def _fold_number(key: str, ends: Column) -> Column:
    """How many of the folds' last rows, given as (hash, key, uses), a row comes after."""
    return F.aggregate(
        ends,
        F.lit(0),
        lambda passed, end: passed
        + F.when(_after(key, end["_h"], end[key]), end["_uses"]).otherwise(0),
    )


def plain_folds(
    df: DataFrame, k: int = 10, key: str = "tweet_id", seed: int | str = 42
) -> DataFrame:
    """Add `fold`: k contiguous runs of the random order, the first ones longer by one."""
    rows = df.count()
    if rows < k:
        raise ValueError(f"{k} folds need at least {k} rows, got {rows}")
    size, longer = divmod(rows, k)
    ends = [(f + 1) * size + min(f + 1, longer) for f in range(k - 1)]
    ordered = _with_order(df, key, seed, rows)
    cuts = _cuts_of_all(ordered, key, ends)
    passed = [_after(key, *map(F.lit, cut)).cast("int") for cut in cuts]
    return ordered.select(*df.columns, sum(passed, F.lit(0)).alias("fold"))


def stratified_folds(
    df: DataFrame, label: str, k: int = 10, key: str = "tweet_id", seed: int | str = 42
) -> DataFrame:
    """Add `fold`, spreading every label evenly over k folds.

    Laid end to end, label after label in order of first appearance, rows deal out
    fold sizes round-robin; each label then fills its share of fold 0, 1, … in
    order. Fold sizes and label shares differ by at most one. NULL is a label like
    any other.
    """
    named = F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit(""))
    marked = df.withColumn("_label", named)
    hashed = marked.withColumn("_h", hash_order(key, seed))
    first = F.min(F.struct("_h", key)).alias("_first")
    classes = _sizes(hashed, ["_label"], first)
    figures = classes.agg(F.sum("_rows").alias("rows"), F.max("_rows").alias("largest")).first()
    if (figures["rows"] or 0) < k:
        raise ValueError(f"{k} folds need at least {k} rows, got {figures['rows'] or 0}")
    if k == 1:
        return df.withColumn("fold", F.lit(0))
    start, stop = F.col("_start"), F.col("_start") + F.col("_rows")

    def dealt(upto: Column, f: int) -> Column:
        """How many of the first `upto` positions go to folds 0 to f."""
        rest = upto % k
        return ((upto - rest) / k).cast("long") * (f + 1) + F.least(rest, F.lit(f + 1))

    # Folds of a tiny class may share an end, or have none: count each use.
    upto = F.array(*[dealt(stop, f) - dealt(start, f) for f in range(k - 1)])
    ends = _laid_out(classes).select("_label", F.explode(upto).alias("_rank"))
    ends = ends.groupBy("_label", "_rank").agg(F.count(F.lit(1)).cast("int").alias("_uses"))
    ends = materialise(ends, "ends")
    ordered = _with_order(marked, key, seed, figures["largest"])
    wanted = ends.where("_rank > 0").select("_label", "_rank")
    cuts = rank_cuts(ordered, ["_label"], "_bucket", ["_h", key], wanted)
    none, end = F.col("_rank") == 0, F.struct("_h", key, "_uses")
    # At most k - 1 ends a label.
    lists = ends.join(cuts, ["_label", "_rank"], "left").groupBy("_label").agg(
        F.coalesce(F.sum(F.when(none, F.col("_uses"))), F.lit(0)).cast("int").alias("_skipped"),
        F.collect_list(F.when(~none, end)).alias("_ends"),
    )
    joined = join_by_size(ordered, materialise(lists, "lists"), ["_label"], "inner", [key])
    return joined.select(
        *df.columns, (F.col("_skipped") + _fold_number(key, F.col("_ends"))).alias("fold")
    )


def _laid_out(classes: DataFrame) -> DataFrame:
    """Add `_start`, the rows of all classes of smaller `_first`.

    Classes are summed by the first digits of their hash, these sums in one task, and
    each part is summed up on its own.
    """
    parted = classes.withColumn("_part", F.substring("_first._h", 1, PART_DIGITS))
    parts = parted.groupBy("_part").agg(F.sum("_rows").alias("_in"))
    before = F.sum("_in").over(Window.orderBy("_part")) - F.col("_in")
    parts = parts.select("_part", before.alias("_before"))
    within = F.sum("_rows").over(Window.partitionBy("_part").orderBy("_first")) - F.col("_rows")
    # As many rows as there are parts: 4096 at most.
    placed = parted.withColumn("_within", within).join(F.broadcast(parts), "_part")
    return placed.withColumn("_start", F.col("_before") + F.col("_within"))


def renumber(
    df: DataFrame,
    by: Sequence[str] = (),
    key: str = "tweet_id",
    seed: int | str = 42,
    name: str = "row_id",
) -> DataFrame:
    """Add `row_id`, 0 … n-1 within each group, in the random order.

    Every row needs its own rank here, so the rows are ranked within (group, hash
    prefix) and the prefix's offset is added; no window spans a group.
    """
    by = list(by)
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    largest = sizes.agg(F.max("_rows")).first()[0] or 0
    ordered = _with_order(df, key, seed, largest)
    counted = ordered.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_bucket")) - F.col("_n")
    group = [F.col(column).alias(f"_of_{i}") for i, column in enumerate(by)]
    offsets = counted.select(*group, F.col("_bucket").alias("_in"), before.alias("_before"))
    # NULL is a group like any other.
    same = F.col("_bucket") == F.col("_in")
    for i, column in enumerate(by):
        same = same & F.col(column).eqNullSafe(F.col(f"_of_{i}"))
    within = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy("_h", key))
    return (
        ordered.withColumn("_within", within)
        .join(offsets, same)
        .select(*df.columns, (F.col("_before") + F.col("_within") - 1).alias(name))
    )


class Span(NamedTuple):
    """An open range of a column's values, the rows below and inside it, ranks to find there."""

    column: str
    low: float | None
    high: float | None
    before: int
    rows: int
    ranks: tuple[int, ...]


def _in_spans(values: DataFrame, spans: Sequence[Span], borders: Sequence | None = None) -> DataFrame:
    """(span, value, borders) of the values inside each span; a value can be in several."""
    borders = borders or [None] * len(spans)
    rows = [(i, s.column, s.low, s.high, b) for i, (s, b) in enumerate(zip(spans, borders, strict=True))]
    kind = "span int, column string, low double, high double, borders array<double>"
    table = local_frame(values.sparkSession, rows, kind)
    value, low, high = F.col("value"), F.col("low"), F.col("high")
    # A row for each column and rank that was asked for.
    met = values.join(F.broadcast(table), "column")
    inside = (low.isNull() | (value > low)) & (high.isNull() | (value < high))
    return met.where(inside).select("span", "value", "borders")


def narrowed(
    values: DataFrame, spans: Sequence[Span], borders: Sequence[Sequence[float]]
) -> tuple[dict[tuple[str, int], float], list[Span]]:
    """Ranks found on a border, by (column, rank), and the spans between borders with the rest.

    One pass counts the values on and between the borders. Those on a border are equal.
    """
    borders = [sorted(set(b)) for b in borders]
    less = F.size(F.filter("borders", lambda b: b < F.col("value")))
    part = 2 * less + F.array_contains("borders", F.col("value")).cast("int")
    counted = _in_spans(values, spans, borders).groupBy("span", part.alias("part")).count()
    # A row for each of a span's parts comes to the driver.
    rows = counted.orderBy("span", "part").collect()
    found, rest, upto = {}, [], {}
    for row in rows:
        span, cuts, (at, on) = spans[row["span"]], borders[row["span"]], divmod(row["part"], 2)
        before = upto.get(row["span"], span.before)
        upto[row["span"]] = before + row["count"]
        ranks = tuple(rank for rank in span.ranks if before < rank <= upto[row["span"]])
        if ranks and on:
            found |= {(span.column, rank): cuts[at] for rank in ranks}
        elif ranks:
            low = cuts[at - 1] if at else span.low
            high = cuts[at] if at < len(cuts) else span.high
            rest.append(Span(span.column, low, high, before, row["count"], ranks))
    return found, rest


def values_at(
    values: DataFrame, spans: Sequence[Span], borders: Sequence[Sequence[float]]
) -> dict[tuple[str, int], float]:
    """The value at each rank of the spans, by (column, rank), from the first `borders`.

    Spans are narrowed, by even shares after the first round, until each holds up to
    `RANKED` values, and only those are ranked.
    """
    shares = F.array(*[F.lit(i / CUTS) for i in range(CUTS + 1)])
    found, spans = narrowed(values, spans, borders)
    while wide := [span for span in spans if span.rows > RANKED]:
        sketch = F.percentile_approx("value", shares, F.lit(10_000)).alias("at")
        cuts = {r["span"]: r["at"] for r in _in_spans(values, wide).groupBy("span").agg(sketch).collect()}
        more, inner = narrowed(values, wide, [cuts[i] for i in range(len(wide))])
        found |= more
        spans = [span for span in spans if span.rows <= RANKED] + inner
    if not spans:
        return found
    folded = _in_spans(values, spans).groupBy("span", "value").count()
    upto = F.sum("count").over(Window.partitionBy("span").orderBy("value"))
    rows = [(i, rank, rank - span.before) for i, span in enumerate(spans) for rank in span.ranks]
    wanted = local_frame(values.sparkSession, rows, "span int, rank long, place long")
    hit = (F.col("place") > F.col("upto") - F.col("count")) & (F.col("place") <= F.col("upto"))
    # A row for each rank that was asked for.
    ranked = folded.withColumn("upto", upto).join(F.broadcast(wanted), "span").where(hit).collect()
    return found | {(spans[row["span"]].column, row["rank"]): row["value"] for row in ranked}


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max of each column, one row per column.

    A column without values has count 0 and NULL for the rest.

    Quartiles are exact and interpolated. Rather than sorting a column in one
    task, approximate percentiles mark a narrow range around each quartile, which is
    narrowed until it holds few enough values to rank (`values_at`).
    """
    entry = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
        for c in columns
    ]
    values = (
        df.select(F.explode(F.array(*entry)).alias("s"))
        .select("s.*")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
    )
    # Borders a little outside twice the sketch's error on both sides of each quartile.
    near = [share + side for share in (0.25, 0.5, 0.75) for side in (-0.0002, 0.0002)]
    shares = F.array(*[F.lit(share) for share in near])
    # Borders and moments of every column in one pass.
    stats = values.groupBy("column").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.percentile_approx("value", shares, F.lit(10_000)).alias("_borders"),
    )
    # One row per named column comes to the driver, to work out the wanted ranks.
    known = {row["column"]: row for row in stats.collect()}
    quartiles = (0.25, 0.5, 0.75)

    def around(row: Row, share: float) -> tuple[int, int, float]:
        """Ranks on both sides of a quartile, from 1, and how far between them it is."""
        place = share * (row["count"] - 1)
        return int(place) + 1, ceil(place) + 1, place - int(place)

    wanted = {
        (name, rank)
        for name, row in known.items()
        for share in quartiles
        for rank in around(row, share)[:2]
    }
    ranks: dict[str, set[int]] = {}
    for name, rank in wanted:
        ranks.setdefault(name, set()).add(rank)
    spans = [Span(name, None, None, 0, known[name]["count"], tuple(sorted(ranks[name]))) for name in known]
    at = values_at(values, spans, [known[name]["_borders"] for name in known]) if spans else {}
    rows = []
    for name, row in known.items():
        cells = []
        for share in quartiles:
            low, high, part = around(row, share)
            below, above = at[name, low], at[name, high]
            cells.append(below + (above - below) * part)
        rows.append((name, row["count"], row["mean"], row["std"], row["min"], *cells, row["max"]))
    rows += [(name, 0, *[None] * 7) for name in columns if name not in known]
    return local_frame(
        df.sparkSession,
        rows,
        "column string, count long, mean double, std double, min double, "
        "p25 double, p50 double, p75 double, max double",
    )
