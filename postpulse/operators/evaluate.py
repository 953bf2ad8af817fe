"""Scores of predictions: confusion matrix, reports, accuracy, R²."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pair_counts(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(
        F.col(truth).cast("string").alias("truth"), F.col(predicted).cast("string").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("cnt"))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(truth, predicted, cnt) for every pair of labels seen, zeros kept.

    After the first aggregation everything is label by label in size.
    """
    pairs = _pair_counts(df, truth, predicted)
    labels = pairs.select(F.explode(F.array("truth", "predicted")).alias("label")).agg(
        F.sort_array(F.collect_set("label")).alias("labels")
    )
    grid = labels.select("labels", F.explode("labels").alias("truth")).select(
        "truth", F.explode("labels").alias("predicted")
    )
    return grid.join(pairs, ["truth", "predicted"], "left").select(
        "truth", "predicted", F.coalesce("cnt", F.lit(0)).alias("cnt")
    )


def _ratio(top: Column, bottom: Column, zero_division: float) -> Column:
    return F.when(bottom == 0, F.lit(float(zero_division))).otherwise(
        F.try_divide(top.cast("double"), bottom.cast("double"))
    )


def label_scores(
    df: DataFrame, truth: str, predicted: str, zero_division: float = 0.0
) -> DataFrame:
    """(label, precision, recall, f1, support, hits) for each label seen."""
    sides = F.explode(
        F.array(
            F.struct(
                F.col("truth").alias("label"),
                F.col("cnt").alias("support"),
                F.lit(0).cast("long").alias("guessed"),
            ),
            F.struct(
                F.col("predicted").alias("label"),
                F.lit(0).cast("long").alias("support"),
                F.col("cnt").alias("guessed"),
            ),
        )
    )
    pairs = _pair_counts(df, truth, predicted)
    own = F.when(F.col("truth") == F.col("predicted"), F.col("cnt")).otherwise(F.lit(0))
    totals = (
        pairs.select(own.alias("own"), sides.alias("s"))
        .groupBy(F.col("s.label").alias("label"))
        .agg(
            F.sum("s.support").alias("support"),
            F.sum("s.guessed").alias("guessed"),
            # A pair on the diagonal is seen from both of its sides.
            F.sum(F.when(F.col("s.support") > 0, F.col("own")).otherwise(F.lit(0))).alias("hits"),
        )
    )
    precision = _ratio(F.col("hits"), F.col("guessed"), zero_division)
    recall = _ratio(F.col("hits"), F.col("support"), zero_division)
    scored = totals.withColumns({"precision": precision, "recall": recall})
    both = F.col("precision") + F.col("recall")
    f1 = F.when(both == 0, F.lit(0.0)).otherwise(
        F.try_divide(F.lit(2.0) * F.col("precision") * F.col("recall"), both)
    )
    return scored.select("label", "precision", "recall", f1.alias("f1"), "support", "hits")


def macro_prf(
    df: DataFrame, truth: str, predicted: str, zero_division: float = 0.0
) -> DataFrame:
    """One row: unweighted means of precision, recall and F1 over the labels."""
    scores = label_scores(df, truth, predicted, zero_division)
    return scores.agg(*[F.avg(name).alias(name) for name in ("precision", "recall", "f1")])


def accuracy(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row: share of rows predicted right, and their number."""
    right = F.col(truth).cast("string") == F.col(predicted).cast("string")
    return df.agg(
        (F.count_if(right) / F.count(F.lit(1))).alias("accuracy"),
        F.count(F.lit(1)).alias("support"),
    )


def class_report(
    df: DataFrame, truth: str, predicted: str, zero_division: float = 0.0
) -> DataFrame:
    """Scores per label, then `accuracy`, `macro avg` and `weighted avg` rows.

    All rows come from one aggregation over the labels. On the accuracy row the
    value stands under `f1`.
    """
    scores = label_scores(df, truth, predicted, zero_division)
    names = ("precision", "recall", "f1")
    summary = scores.agg(
        F.sum("support").alias("total"),
        F.sum("hits").alias("right"),
        F.collect_list(F.struct("label", *names, "support")).alias("rows"),
        *[F.avg(name).alias(f"macro_{name}") for name in names],
        *[
            F.try_divide(F.sum(F.col(name) * F.col("support")), F.sum("support")).alias(
                f"weighted_{name}"
            )
            for name in names
        ],
    )
    blank = F.lit(None).cast("double")

    def line(label: str, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(
            F.lit(label).alias("label"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            F.col("total").alias("support"),
        )

    extra = F.array(
        line("accuracy", blank, blank, F.try_divide("right", "total")),
        *[
            line(f"{kind} avg", *[F.col(f"{kind}_{name}") for name in names])
            for kind in ("macro", "weighted")
        ],
    )
    return summary.select(F.explode(F.concat("rows", extra)).alias("r")).select("r.*")


def one_hot(df: DataFrame, label: str, labels: Sequence[str], prefix: str = "is_") -> DataFrame:
    """Add one 0/1 column per label, in alphabetical order."""
    return df.withColumns(
        {
            f"{prefix}{value}": F.when(F.col(label) == value, 1).otherwise(0)
            for value in sorted(labels)
        }
    )


def r2_onehot(df: DataFrame, label: str, scores: dict[str, str]) -> DataFrame:
    """R² of predicted shares against one-hot labels, averaged over labels.

    `scores` maps each label to the column with its predicted share. A label
    without variance scores 1 when met exactly and 0 otherwise.
    """
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for i, (value, column) in enumerate(sorted(scores.items())):
        hit = F.when(F.col(label) == value, 1.0).otherwise(0.0)
        miss = hit - F.col(column)
        aggregates += [F.sum(miss * miss).alias(f"_res{i}"), F.sum(hit).alias(f"_n{i}")]
    sums = df.agg(*aggregates)
    total = F.lit(0.0)
    for i in range(len(scores)):
        count, rest = F.col(f"_n{i}"), F.col(f"_res{i}")
        spread = count - count * count / F.col("_rows")
        flat = F.when(rest == 0, 1.0).otherwise(0.0)
        total = total + F.when(spread == 0, flat).otherwise(1 - F.try_divide(rest, spread))
    return sums.select((total / len(scores)).alias("r2"), F.col("_rows").alias("support"))
