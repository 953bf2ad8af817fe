import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from postpulse.operators import evaluate


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(2)
    made = [(rng.choice("abc"), rng.choice("ab")) for _ in range(200)]
    return [*made, ("a", "z")]


@pytest.fixture(scope="module")
def frame(spark, pairs):
    return spark.createDataFrame(pairs, "y string, p string").cache()


def by_hand(pairs, zero):
    out = {}
    for label in sorted({x for pair in pairs for x in pair}):
        hits = sum(y == p == label for y, p in pairs)
        guessed = sum(p == label for _, p in pairs)
        support = sum(y == label for y, _ in pairs)
        precision = hits / guessed if guessed else zero
        recall = hits / support if support else zero
        both = precision + recall
        out[label] = (precision, recall, 2 * precision * recall / both if both else 0.0, support)
    return out


def test_confusion_keeps_zero_cells(frame, pairs):
    got = {(r["truth"], r["predicted"]): r["cnt"] for r in evaluate.confusion(frame, "y", "p").collect()}
    labels = "abcz"
    assert got == {(a, b): pairs.count((a, b)) for a in labels for b in labels}
    assert sum(got.values()) == len(pairs)


@pytest.mark.parametrize("zero", [0.0, 1.0])
def test_report(frame, pairs, zero):
    want = by_hand(pairs, zero)
    rows = {r["label"]: r for r in evaluate.class_report(frame, "y", "p", zero).collect()}
    for label, scores in want.items():
        r = rows[label]
        assert (r["precision"], r["recall"], r["f1"], r["support"]) == pytest.approx(scores)
    assert rows["accuracy"]["f1"] == pytest.approx(np.mean([y == p for y, p in pairs]))
    assert rows["accuracy"]["precision"] is None
    macro = np.mean([s[:3] for s in want.values()], axis=0)
    weighted = np.average([s[:3] for s in want.values()], axis=0, weights=[s[3] for s in want.values()])
    for name, expected in (("macro avg", macro), ("weighted avg", weighted)):
        r = rows[name]
        assert [r["precision"], r["recall"], r["f1"]] == pytest.approx(list(expected))
        assert r["support"] == len(pairs)
    got = evaluate.macro_prf(frame, "y", "p", zero).first()
    assert list(got) == pytest.approx(list(macro))


def test_a_class_never_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a")], "y string, p string")
    for zero in (0.0, 1.0):
        rows = {r["label"]: r for r in evaluate.class_report(df, "y", "p", zero).collect()}
        assert (rows["b"]["precision"], rows["b"]["f1"]) == (zero, 0.0)


def test_accuracy_and_one_hot(frame, pairs):
    got = evaluate.accuracy(frame, "y", "p").first()
    assert got["accuracy"] == pytest.approx(np.mean([y == p for y, p in pairs]))
    hot = evaluate.one_hot(frame, "y", ["c", "a", "b"])
    assert hot.columns[-3:] == ["is_a", "is_b", "is_c"]
    assert hot.where(F.col("is_a") + F.col("is_b") + F.col("is_c") != 1).count() == 0


def test_r2(spark):
    rng = np.random.default_rng(1)
    y = rng.choice(["a", "b", "c"], 300)
    shares = rng.dirichlet([1, 1, 1], 300)
    data = [(str(label), *map(float, row)) for label, row in zip(y, shares, strict=True)]
    df = spark.createDataFrame(data, "y string, pa double, pb double, pc double")
    got = evaluate.r2_onehot(df, "y", {"a": "pa", "b": "pb", "c": "pc"}).first()["r2"]
    scores = []
    for i, label in enumerate("abc"):
        hot = (y == label).astype(float)
        scores.append(1 - ((hot - shares[:, i]) ** 2).sum() / ((hot - hot.mean()) ** 2).sum())
    assert got == pytest.approx(np.mean(scores))
    flat = evaluate.r2_onehot(df.where("y = 'a'"), "y", {"a": "pa", "b": "pb"}).first()["r2"]
    assert flat == 0.0
