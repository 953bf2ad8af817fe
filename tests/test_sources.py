"""CSV read in splits against Spark's own reader of whole files."""

import random

import pytest

from postpulse.sources import POST_SCHEMA, read_posts, write_table
from postpulse.sources.tables import _lines

PARTS = ["a", "é", '"', "\n", "\r\n", ",", "\r", " ", "word", "\n\n", '""', '"\n', "日本"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(1)
    rows = [
        (k, rng.choice(["w", None, "x,y"]), 5, "".join(rng.choices(PARTS, k=rng.randint(0, 40))) or None, 1, 2, None)
        for k in range(300)
    ]
    rows += [(1000, "long", 1, "line\n" * 2000, 1, 1, 1), (1001, "quotes", 1, '"' * 999, 1, 1, 1)]
    path = str(tmp_path_factory.mktemp("csv") / "posts")
    write_table(spark.createDataFrame(rows, POST_SCHEMA).repartition(1), path, fmt="csv")
    return path


@pytest.mark.parametrize("size", ["128m", "4k", "700", "64"])
def test_a_file_is_read_in_splits(spark, folder, size):
    whole = spark.read.schema(POST_SCHEMA).options(header=True, multiLine=True, quote='"', escape='"').csv(folder)
    want = sorted(map(tuple, whole.collect()), key=str)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = sorted(map(tuple, read_posts(spark, folder).collect()), key=str)
        splits = _lines(spark, folder).select("block").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == want and len(got) == 302
    assert (splits > 5) == (size != "128m")


def test_a_folder_without_rows(spark, tmp_path):
    write_table(spark.createDataFrame([], POST_SCHEMA), str(tmp_path / "none"), fmt="csv")
    assert read_posts(spark, str(tmp_path / "none")).collect() == []
