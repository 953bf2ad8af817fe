"""One model for every ticker and target.

Word columns stand by rank in the vocabulary of a ticker and target, so a column means
another word in each set, and a model is fitted on one set alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postpulse.operators import trees
from postpulse.operators.evaluate import _pair_counts
from postpulse.operators.sampling import split_exact
from postpulse.plans.training import TARGETS, WORDS, feature_columns, training_matrix
from postpulse.sources import scratch_dir, write_table

RESULT = "ticker_symbol string, target string, part string, leaves int, truth string, predicted string, cnt long"


def set_cells(
    sets: DataFrame,
    targets: Sequence[str] = TARGETS,
    words: int = WORDS,
    alpha: float = 0.0025,
    test_share: float = 0.2,
    seed: int | str = 42,
    parallelism: int = 4,
) -> DataFrame:
    """Confusion counts of each set's pruned entropy tree, on its training and its test rows.

    The matrices are written once, partitioned by ticker, so a fit reads its own set. The
    fits are a pool of independent jobs, each of which appends its counts to one stored
    table; what comes back to the driver is the list of sets and each fitted tree. Test rows
    that no tree can score, of a label without training rows or a set without any, are counted
    with `predicted` and `leaves` NULL.
    """
    spark = sets.sparkSession
    base = f"{scratch_dir(spark)}/sets-{uuid.uuid4().hex}"
    keys, schemas = [], {}
    for target in targets:
        path = f"{base}/{target}"
        matrix = training_matrix(sets, target, words)
        write_table(matrix, path, ["ticker_symbol"])
        schemas[target] = matrix.schema
        found = matrix.select("ticker_symbol").distinct().collect()
        keys += [(target, row["ticker_symbol"]) for row in found]

    def fit(key):
        target, ticker = key
        rows = spark.read.schema(schemas[target]).parquet(f"{base}/{target}")
        rows = rows.where(F.col("ticker_symbol").eqNullSafe(F.lit(ticker)))
        names = feature_columns(target, words)
        marked = split_exact(rows, test_share, seed=seed)
        train = trees.prepare(marked.where("not is_test"), names, target)
        left = marked.where("is_test")
        cells = []
        if train.labels:
            tree = trees.fit_tree(train, alpha=alpha)
            test = trees.prepare(left, names, target, train.labels)
            for part, data in (("train", train), ("test", test)):
                counts = _pair_counts(tree.score(data.rows), target, "predicted")
                cells.append((part, len(tree.stand_ins), counts))
            left = left.where(~F.col(target).isin(train.labels))
        unscored = _pair_counts(left.withColumn("predicted", F.lit(None).cast("string")), target, "predicted")
        cells.append(("test", None, unscored))
        named = [
            counts.select(
                F.lit(ticker).cast("string").alias("ticker_symbol"), F.lit(target).alias("target"),
                F.lit(part).alias("part"), F.lit(leaves).cast("int").alias("leaves"),
                "truth", "predicted", F.col("cnt").cast("long").alias("cnt"),
            )
            for part, leaves, counts in cells
        ]
        reduce(DataFrame.unionByName, named).coalesce(1).write.parquet(f"{base}/cells/{uuid.uuid4().hex}")

    with ThreadPool(parallelism) as pool:
        pool.map(fit, sorted(keys, key=lambda key: (key[0], key[1] or "")), chunksize=1)
    if not keys:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).option("recursiveFileLookup", True).parquet(f"{base}/cells")


def set_models(sets: DataFrame, targets: Sequence[str] = TARGETS, words: int = WORDS, **fit) -> DataFrame:
    """A row per ticker and target: rows fitted and scored, leaves, accuracy and macro scores of the test rows.

    Scores are worked out from the stored counts by set and label. A label without
    predictions or without rows scores 0; a set without test rows has null scores. Rows that no
    tree can score are left out, and so is a set without a tree.
    """
    cells = set_cells(sets, targets, words, **fit).where("predicted is not null")
    by = ["ticker_symbol", "target"]
    right = F.when(F.col("truth") == F.col("predicted"), F.col("cnt")).otherwise(0)
    test = F.col("part") == "test"
    totals = cells.groupBy(*by).agg(
        F.sum(F.when(~test, F.col("cnt")).otherwise(0)).alias("rows_train"),
        F.sum(F.when(test, F.col("cnt")).otherwise(0)).alias("rows_test"),
        F.max("leaves").alias("leaves"),
        (F.sum(F.when(~test, right)) / F.sum(F.when(~test, F.col("cnt")))).alias("accuracy_train"),
        (F.sum(F.when(test, right)) / F.sum(F.when(test, F.col("cnt")))).alias("accuracy_test"),
    )
    sides = F.explode(
        F.array(
            F.struct(F.col("truth").alias("label"), F.col("cnt").alias("support"), F.lit(0).cast("long").alias("guessed")),
            F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("support"), F.col("cnt").alias("guessed")),
        )
    )
    hit = F.when((F.col("truth") == F.col("predicted")) & (F.col("s.support") > 0), F.col("cnt")).otherwise(0)
    labels = cells.where(test).select(*by, "truth", "predicted", "cnt", sides.alias("s"))
    labels = labels.groupBy(*by, F.col("s.label").alias("label")).agg(
        F.sum("s.support").alias("support"), F.sum("s.guessed").alias("guessed"), F.sum(hit).alias("hits")
    )

    def share(bottom: str):
        return F.when(F.col(bottom) > 0, F.col("hits") / F.col(bottom)).otherwise(F.lit(0.0))

    f1 = 2 * F.col("hits") / (F.col("support") + F.col("guessed"))
    macro = labels.groupBy(*by).agg(
        F.avg(share("guessed")).alias("precision"), F.avg(share("support")).alias("recall"), F.avg(f1).alias("f1")
    )
    same = [totals[c].eqNullSafe(macro[c]) for c in by]
    return totals.join(macro, same[0] & same[1], "left").drop(*[macro[c] for c in by])
