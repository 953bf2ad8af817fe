"""Mixing sources to target weights along a curriculum.

Each source has a weight schedule over the run. The words that the run asks of a
source up to a moment are the integral of its schedule, scaled so that the whole
run asks for the source's target. A document stands at some place in the words
its source can give; inverting the integral at that place gives the moment at
which the document is trained on, and a range sort by that moment is the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postpulse.sources import materialise

# Fixed value: white space between words; everything else belongs to a word.
SPACES = " \t\n\x0b\f\r"
BETWEEN_WORDS = r"[\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE_NUM, SHARE_DEN = 3, 2  # the mix holds 150 % of all words
MOST_REPEATS = 2
# The schedule of a source of weight w rises or falls linearly from (1 - s) to (1 + s)
# times its mean; by weight, heavy sources early and light ones late.
SLOPES = {3: -0.5, 1: 0.5, 2: 0.0}
BUCKET_ROWS = 4096


def word_list(text: Column) -> Column:
    """Words of a text; null and blank text have none."""
    bare = F.btrim(text, F.lit(SPACES))
    empty = F.array().cast("array<string>")
    return F.when(F.coalesce(bare, F.lit("")) == "", empty).otherwise(F.split(bare, BETWEEN_WORDS))


def targets(
    sources: DataFrame, source: str = "source", weights: Sequence[int] = WEIGHTS
) -> DataFrame:
    """Per source: its weight and target, from (source, source_size).

    Targets are weight * level, and at most `MOST_REPEATS` times the size; what goes
    beyond that is shared again by weight among the others, until none is above.
    In the order of size / weight, those that reach their limit come first, so one
    running sum finds the level: a row per source is all that is sorted.
    """
    by_name = Window.orderBy(F.col(source).asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn.cast("int") + 1)
    limit = F.col("source_size") * MOST_REPEATS
    ranked = sources.withColumns({"weight": weight.cast("long"), "_limit": limit})
    by_ratio = Window.orderBy(
        F.col("source_size") / F.col("weight"), F.col(source).asc_nulls_last()
    )
    every = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    here_on = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    # What is left for this source and all after it, if all before it are at their limits.
    left = F.sum("source_size").over(every) * SHARE_NUM - SHARE_DEN * F.coalesce(
        F.sum("_limit").over(before), F.lit(0)
    )
    heavy = F.sum("weight").over(here_on)
    states = ranked.withColumns({"_left": left, "_heavy": heavy})
    capped = F.col("_limit") * SHARE_DEN * F.col("_heavy") <= F.col("_left") * F.col("weight")
    states = states.withColumn("_capped", capped)
    first = F.struct(F.col("_left").alias("l"), F.col("_heavy").alias("h"))
    level = F.first(F.when(~F.col("_capped"), first), ignorenulls=True).over(every)
    states = states.withColumn("_level", level)
    share = (F.col("weight") * F.col("_level.l")).cast("double") / (
        SHARE_DEN * F.col("_level.h")
    ).cast("double")
    target = F.when(F.col("_capped"), F.col("_limit").cast("double")).otherwise(share)
    return states.select(source, "source_size", "weight", target.alias("target"))


def moment(place: Column, slope: Column) -> Column:
    """The time in [0, 1] by which a share `place` of a source's words is asked for.

    The schedule is 1 - s + 2 s t with s = slope; its integral (1 - s) t + s t^2 is
    inverted in the form that holds for s = 0 too.
    """
    lead = 1 - slope
    return 2 * place / (lead + F.sqrt(F.greatest(lead * lead + 4 * slope * place, F.lit(0.0))))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
    bucket_rows: int = BUCKET_ROWS,
    carry: bool = False,
) -> DataFrame:
    """One row per input row: id, source, size, source_size, target, taken and parts.

    Within a source documents stand in the order of the MD5 of their id (then of
    size and a hash of the text), once for each repeat. A document's words count as
    taken as far as they come before the target; the last one of a source may be taken
    in part. `parts` has the moment and the words of each time that it is taken.
    A null text has size 0, and a document without words is never taken. Null source
    is a source. Rows that agree in id, size and text are interchangeable. `carry`
    adds all input columns as the struct `row`, whatever their names.

    Places in a source are found in two levels, so that a source with a third of
    all rows is worked on by many tasks: buckets by the leading digits of the MD5,
    their running sums, and sums within each bucket. Targets need a row per source,
    which one task sorts.
    """
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    own = [
        F.col(id_col).alias("id"),
        F.col(source).alias("source"),
        F.size(word_list(F.col(text))).cast("long").alias("size"),
        key.alias("_key"),
        F.xxhash64(text).alias("_text"),
    ]
    narrow = materialise(docs.select(*own), "sized")
    rows = docs.select(*own, F.struct("*").alias("row")) if carry else narrow
    found = _places(narrow, rows, bucket_rows)
    return found.withColumnRenamed("id", id_col)


def _places(narrow: DataFrame, rows: DataFrame, bucket_rows: int) -> DataFrame:
    # Enough buckets for the largest source; the key's digits deal rows out evenly.
    n = narrow.count()
    digits = 1
    while bucket_rows * 16**digits < n:
        digits += 1
    bucket = F.substring("_key", 1, digits)
    # Source and bucket in one string: the sums and the join share one shuffle of the rows.
    cell = F.concat(bucket, F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    cells = narrow.withColumns({"_bucket": bucket, "_cell": cell})
    sums = cells.groupBy("source", "_bucket", "_cell").agg(F.sum("size").alias("_sum"))
    so_far = Window.partitionBy("source").orderBy("_bucket")
    starts = sums.withColumn("_before", F.sum("_sum").over(so_far) - F.col("_sum"))
    sizes = sums.groupBy("source").agg(F.sum("_sum").alias("source_size"))
    wanted = targets(sizes)
    slopes = F.create_map(*[F.lit(x) for pair in SLOPES.items() for x in pair])
    wanted = wanted.withColumn("slope", F.element_at(slopes, F.col("weight").cast("int")))
    plan = starts.join(
        wanted.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))
    ).select(
        "_cell", "_before", "source_size", "target", "slope",
    )
    inside = Window.partitionBy("_cell").orderBy("_key", "size", "_text")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_cell", cell)
    local = local.withColumn("_local", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = local.join(plan, "_cell")
    place = F.col("_before") + F.col("_local")
    whole = F.floor("target")

    def words(turn):
        start = place + turn * F.col("source_size")
        return F.greatest(F.least(F.col("size"), whole - start), F.lit(0)).cast("long")

    turns = [words(k) for k in range(MOST_REPEATS)]
    taken = turns[0]
    for more in turns[1:]:
        taken = taken + more
    middles = [
        moment(
            F.least(F.try_divide(middle, F.col("target")), F.lit(1.0)),
            F.col("slope"),
        )
        for middle in (place + k * F.col("source_size") + turns[k] / 2 for k in range(MOST_REPEATS))
    ]
    parts = F.filter(
        F.array(*[F.struct(m.alias("moment"), w.alias("words")) for m, w in zip(middles, turns)]),  # noqa: B905
        lambda part: part["words"] > 0,
    )
    carried = [c for c in ("row",) if c in rows.columns]
    return joined.select(
        "id", "source", "size", "source_size", "target", taken.alias("taken"),
        parts.alias("parts"), "_text", *carried,
    )


def training_order(mixed: DataFrame, partitions: int | None = None) -> DataFrame:
    """A row for each time that a document is taken, range-sorted by its moment.

    `moment` and `words` (how many are taken, from the start) stand for `parts`.
    """
    rest = [c for c in mixed.columns if c != "parts"]
    taken = mixed.select(*rest, F.inline("parts"))
    n = partitions or int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["moment", "_text"]
    return taken.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("_text")


def mixed_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents of the mix, in training order, with the columns of `docs`.

    A document that is taken twice is there twice. The one of a source that its target ends
    in stays whole or goes, whichever brings the source's words nearer to the target.
    """
    ordered = training_order(mix(docs, text=text, carry=True))
    return ordered.where(F.col("words") * 2 >= F.col("size")).select("row.*")
