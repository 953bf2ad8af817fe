"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows of equal text are a group and go to one shard. Groups of a size worth packing
by itself are items; all smaller ones are first gathered into bundles by their hash,
so that the number of items is bounded whatever the number of rows. Items in
decreasing size enter the shard with the least room that still holds them. Only
items go through the driver; rows get their shard by joining the items' list.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postpulse.sources import local_frame, materialise

OVERHEAD = 16
BUNDLES_PER_SHARD = 128
PIECES_PER_SHARD = 16
CELL_ROWS = 2048


def best_fit(
    sizes: list[tuple[int, str]], capacity: float, shards: int | None = None
) -> dict[str, int]:
    """Shard of each item, from (size, item), by best fit in decreasing size.

    Shards stand in order by the room left, and the tightest that holds the item is
    found by halving. Where none does, a new shard is opened; with a given number of
    shards, the one with most room takes it.
    """
    room = sorted((capacity, -shard) for shard in range(shards or 0))
    chosen = {}
    for size, item in sorted(sizes, key=lambda x: (-x[0], x[1])):
        at = bisect_left(room, (size, -len(room)))
        if at == len(room):
            if shards:
                at -= 1
            else:
                room.append((max(capacity, size), -len(room)))
        left, shard = room.pop(at)
        chosen[item] = -shard
        insort(room, (left - size, shard))
    return chosen


def _sized(docs: DataFrame, text: str) -> DataFrame:
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns(
        {
            "size": size,
            "_group": F.xxhash64(content),
            "_check": F.xxhash64(F.lit(1), content),
            "text_crc32": F.crc32(content.cast("binary")).cast("long"),
        }
    )


def items(sized: DataFrame, row_key: list[str], shards: int) -> tuple[DataFrame, DataFrame, dict]:
    """(large groups, items, figures) of a table with size, _group and _check.

    A group above 1 / BUNDLES_PER_SHARD of a shard is an item of its own, so there
    are at most shards * BUNDLES_PER_SHARD of these. Only a group above one shard can't
    stay whole in shards of near equal sizes; it is cut into pieces of about
    1 / PIECES_PER_SHARD of a shard by a hash of its rows' keys.
    """
    groups = sized.groupBy("_group", "_check").agg(F.sum("size").alias("_bytes"))
    groups = materialise(groups, "groups")
    total = groups.agg(F.sum("_bytes")).first()[0] or 0
    share = total / shards
    pieces = F.when(
        F.col("_bytes") > share, F.ceil(F.col("_bytes") * PIECES_PER_SHARD / max(share, 1.0))
    ).otherwise(1)
    large = groups.where(F.col("_bytes") > share / BUNDLES_PER_SHARD)
    large = large.select("_group", "_check", pieces.cast("int").alias("_pieces"))
    return large, with_items(sized, large, row_key, shards), {"total": total, "share": share}


def with_items(sized: DataFrame, large: DataFrame, row_key: list[str], shards: int) -> DataFrame:
    """`sized` with the item of each row; `large` is bounded, see `items`."""
    piece = F.pmod(F.xxhash64(*row_key), F.col("_pieces"))
    own = F.concat_ws(":", F.lit("g"), F.col("_group"), F.col("_check"), piece)
    bundle = F.pmod(F.col("_group"), F.lit(shards * BUNDLES_PER_SHARD))
    item = F.coalesce(
        F.when(F.col("_pieces").isNotNull(), own), F.concat_ws(":", F.lit("b"), bundle)
    )
    joined = sized.join(F.broadcast(large), ["_group", "_check"], "left")
    return joined.withColumn("_item", item).drop("_pieces")


def assign_shards(
    docs: DataFrame,
    shards: int = 40,
    id_col: str = "doc_id",
    text: str = "text",
    keep_text: bool = True,
) -> DataFrame:
    """`docs` with size, text_crc32, shard and slot; law `bytes`: sizes near equal.

    Size is the UTF-8 length of the text (null: 0) plus `OVERHEAD`. Null and empty
    text are one group. Slots number the rows of a shard from 0 without gaps, in the
    order of item, id, size; rows that agree in all columns are interchangeable.
    Input columns named size, text_crc32, shard or slot are replaced. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    sized = _sized(docs.drop("size", "text_crc32", "shard", "slot"), text)
    if keep_text:
        narrow = sized.select(id_col, "size", "_group", "_check")
        narrow = materialise(narrow, "sized")
    else:
        narrow = sized = materialise(sized.drop(text), "sized")
    large, marked, figures = items(narrow, [id_col], shards)
    large = materialise(large, "large")
    # Rows of an item that share a number of the id's hash are numbered together; there
    # are as many cells as it takes for about CELL_ROWS rows in each.
    totals = materialise(
        with_items(narrow, large, [id_col], shards)
        .groupBy("_item")
        .agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")),
        "items",
    )
    # Bounded: shards * (2 * BUNDLES_PER_SHARD + 2 * PIECES_PER_SHARD) items at most.
    found = [(r["_bytes"], r["_item"], r["_rows"]) for r in totals.collect()]
    largest = max((size for size, _, _ in found), default=0)
    capacity = max(figures["share"], largest)
    chosen = best_fit([(size, item) for size, item, _ in found], capacity, shards)
    cells = {item: -(-rows // CELL_ROWS) for _, item, rows in found}
    plan = local_frame(
        spark,
        [(item, shard, cells[item]) for item, shard in sorted(chosen.items())],
        "_item string, shard int, _cells int",
    )
    cell = F.pmod(F.xxhash64(id_col), F.col("_cells"))

    def placed(rows):
        return (
            with_items(rows, large, [id_col], shards)
            .join(F.broadcast(plan), "_item")
            .withColumn("_cell", cell)
        )

    counts = placed(narrow).groupBy("shard", "_item", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_item", "_cell")
    starts = counts.select(
        F.col("_item").alias("_i"), F.col("_cell").alias("_c"),
        (F.sum("_n").over(before) - F.col("_n")).alias("_start"),
    )
    inside = Window.partitionBy("_item", "_cell").orderBy(id_col, "size")
    numbered = placed(sized).withColumn("_in", F.row_number().over(inside) - 1)
    out = numbered.join(
        starts, (F.col("_item") == F.col("_i")) & (F.col("_cell") == F.col("_c"))
    ).withColumn("slot", (F.col("_start") + F.col("_in")).cast("long"))
    return out.drop("_item", "_cell", "_cells", "_i", "_c", "_start", "_in", "_group", "_check")
