"""Sources and sinks: posts, ticker map, prices, word lists, written tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

POST_SCHEMA = T.StructType(
    [
        T.StructField("tweet_id", T.LongType()),
        T.StructField("writer", T.StringType()),
        T.StructField("post_date", T.LongType()),
        T.StructField("body", T.StringType()),
        T.StructField("comment_num", T.LongType()),
        T.StructField("retweet_num", T.LongType()),
        T.StructField("like_num", T.LongType()),
    ]
)

TICKER_MAP_SCHEMA = T.StructType(
    [
        T.StructField("tweet_id", T.LongType()),
        T.StructField("ticker_symbol", T.StringType()),
    ]
)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, line, quotes): lines of text files, in order of `at` within a split.

    Only a line feed ends a line, so a carriage return stays in it.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
        (F.length("value") - F.length(F.translate("value", '"', ""))).alias("quotes"),
    )


def _numbered(lines: DataFrame) -> DataFrame:
    """Add `even` and `odd`: the record a line is in, counted from its split's first record.

    A line starts a record if an even number of quotes stands before it in the file. What
    stands before the split isn't known here: `even` holds if it is an even number and `odd`
    if not. Record 0 began in an earlier split.
    """
    own = Window.partitionBy("file", "block").orderBy("at")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    return (
        lines.withColumn("inside", inside)
        .withColumn("even", F.count_if(F.col("inside") == 0).over(upto))
        .withColumn("odd", F.count_if(F.col("inside") == 1).over(upto))
    )


def _splits(lines: DataFrame) -> DataFrame:
    """(file, block, open, from_block, from_record): how each split of the files begins.

    `open` if it begins inside a quoted field; then its first lines belong to record
    `from_record` of split `from_block`. A row a split is scanned, file by file; the lines
    themselves are counted as numbers only.
    """
    counted = _numbered(lines.select("file", "block", "at", "quotes"))
    ends = counted.groupBy("file", "block").agg(
        (F.sum("quotes") % 2).alias("quotes"), F.max("even").alias("even"), F.max("odd").alias("odd")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1
    ends = ends.withColumn("open", opened)
    records = F.when(F.col("open"), F.col("odd")).otherwise(F.col("even"))
    last = F.when(records > 0, F.struct(F.col("block").alias("b"), records.alias("r")))
    begun = F.last(last, ignorenulls=True).over(earlier)
    found = ends.select("file", "block", "open", begun.alias("begun"))
    return found.select(
        "file", "block", "open", F.col("begun.b").alias("from_block"), F.col("begun.r").alias("from_record")
    )


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, record, text): the records of CSV files whose quoted fields may hold line ends.

    Files are read in splits of any size, by as many tasks. Whether a split begins inside a
    field follows from the parity of the quotes before it, scanned over the splits' counts;
    a record is where it begins and is put together across borders. A record crosses the
    network once. Blank records are left out.
    """
    lines = _lines(spark, path)
    splits = _splits(lines)
    numbered = _numbered(lines).join(splits, ["file", "block"])
    own = F.when(F.col("open"), F.col("odd")).otherwise(F.col("even"))
    begun = (own > 0) | F.col("from_block").isNull()
    placed = numbered.select(
        "file", F.when(begun, F.col("block")).otherwise(F.col("from_block")).alias("first"),
        F.when(begun, own).otherwise(F.col("from_record")).alias("record"), "block", "at", "line",
    )
    # Lines of a record that are in one split are joined where they are.
    part = placed.groupBy("file", "block", "first", "record").agg(_in_order("at", "line").alias("line"))
    whole = part.groupBy("file", "first", "record").agg(_in_order("block", "line").alias("text"))
    text = F.regexp_replace("text", "\r$", "")
    return whole.select("file", F.col("first").alias("block"), "record", text.alias("text")).where("text <> ''")


def _in_order(order: str, line: str) -> Column:
    pieces = F.array_sort(F.collect_list(F.struct(order, line)))
    return F.array_join(F.transform(pieces, lambda piece: piece[line]), "\n")


def _csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line a file, quoted fields and doubled quotes, read in splits."""
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    records = csv_records(spark, path).where("not (block = 0 and record = 1)")
    row = F.from_csv("text", F.lit(schema.simpleString()[len("struct<") : -1].replace(":", " ")), options)
    return records.select(row.alias("row")).select("row.*")


def read_posts(spark: SparkSession, path: str, schema: T.StructType = POST_SCHEMA) -> DataFrame:
    """Posts from CSV with quoted, multi-line bodies; a file is read by many tasks.

    Each reading scans the files twice, so land them once as Parquet (`write_table`)
    before running anything large on them.
    """
    return _csv(spark, path, schema)


def read_ticker_map(spark: SparkSession, path: str) -> DataFrame:
    """Post-to-ticker pairs from CSV; one post may name several tickers."""
    return _csv(spark, path, TICKER_MAP_SCHEMA)


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """Word list, one entry per line, kept verbatim: column `term`."""
    return spark.read.text(path).select(F.col("value").alias("term")).distinct()


def price_range(
    prices: DataFrame,
    start: str,
    end: str,
    tickers: list[str] | None = None,
    field: str = "adj_close",
) -> DataFrame:
    """One price field per (date, ticker) in the half-open range [start, end)."""
    picked = prices.where(
        (F.col("date") >= F.lit(start).cast("date")) & (F.col("date") < F.lit(end).cast("date"))
    )
    if tickers:
        picked = picked.where(F.col("ticker_symbol").isin(tickers))
    return picked.select("date", "ticker_symbol", F.col(field).alias("adj_close"))


def unpivot_prices(wide: DataFrame, tickers: list[str]) -> DataFrame:
    """Wide price table (a date and one column per ticker) to long rows."""
    return wide.unpivot("date", tickers, "ticker_symbol", "adj_close").where(
        F.col("adj_close").isNotNull()
    )


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
) -> None:
    """Overwrite `path` with the rows of `df`, optionally partitioned by columns.

    Rows go to the sink from the tasks that hold them: one group that holds a
    third of the rows is then written by many tasks, not gathered in one.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
        for side in ("Leading", "Trailing"):
            writer = writer.option(f"ignore{side}WhiteSpace", False)
        writer.csv(path)
    else:
        writer.format(fmt).save(path)


def local_frame(
    spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str
) -> DataFrame:
    """A small table the driver holds, as part of the plan rather than as a job's input."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows, strict=True)) or [()] * len(arrow)
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's `spark.checkpoint.dir`.

    A local-mode session without the setting gets a temporary folder; on a
    cluster the setting is required, since executors share no local disk.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="postpulse-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def materialise(df: DataFrame, name: str = "step") -> DataFrame:
    """Write `df` to the shared scratch folder and read it back.

    Used where several later passes would each recompute an expensive plan.
    Parquet rather than `checkpoint()`, so that a later pass over two columns
    reads two columns. Survives the loss of any executor.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-repartition an input that came in fewer pieces than there are cores.

    One unsplittable file would otherwise keep a whole text job on one core. An
    input with enough pieces is returned as it is, without a shuffle. Meant for a
    table just read: counting the pieces of a plan with joins would run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
