import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog.rules import INTERACTION_TREE
from postpulse.operators import evaluate, rules, sampling, trees
from postpulse.plans import feature_columns
from postpulse.sources import materialise

NAMES = ["x0", "x1", "x2"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 3)).round(2)
    score = x[:, 0] + 0.5 * x[:, 1] + rng.normal(scale=0.7, size=900)
    y = np.select([score < -0.5, score < 0.6], ["low", "mid"], "top")
    rows = [(i, *map(float, x[i]), str(y[i])) for i in range(900)]
    df = spark.createDataFrame(rows, "tweet_id long, x0 double, x1 double, x2 double, label string")
    folded = sampling.stratified_folds(df, "label", 3)
    return trees.prepare(materialise(folded), NAMES, "label")


@pytest.fixture(scope="module")
def fit(data):
    return trees.fit_tree(data, "entropy", 0.0, max_depth=8)


def scored(fit, data):
    return fit.score(data.rows).select("tweet_id", "predicted", "probability", "label")


def test_prepare_indexes_alphabetically_and_drops_gaps(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (None, "a")], "x double, label string")
    for labels in (None, ["b", "a"]):
        got = trees.prepare(df, ["x"], "label", labels)
        assert got.labels == ["a", "b"]
        assert sorted((r["x"], r["label_index"]) for r in got.rows.collect()) == [(1.0, 1.0), (2.0, 0.0)]


def test_unpruned_scores_are_the_learners_own(fit, data):
    fit = trees.FittedTree(fit.model, fit.tree, fit.features, fit.labels, fit.tree.leaves())
    own = {
        r["tweet_id"]: r["probability"].toArray().tolist()
        for r in fit.model.transform(data.rows).select("tweet_id", "probability").collect()
    }
    got = {r["tweet_id"]: r["probability"] for r in scored(fit, data).collect()}
    assert all(got[key] == pytest.approx(own[key]) for key in own)


def test_pruning_path_rises_to_the_root(fit):
    steps = trees.pruning_steps(fit.tree)
    alphas, leaves, risks = zip(*steps, strict=True)
    assert list(alphas) == sorted(alphas) and alphas[0] == 0.0
    assert list(leaves) == sorted(leaves, reverse=True) and leaves[-1] == 1
    assert list(risks) == sorted(risks)
    assert risks[-1] == pytest.approx(fit.tree.impurity[0])


def brute_prune(tree, alpha):
    """Smallest subtree of least cost, from the definition, bottom up."""
    total = tree.counts[0].sum()

    def best(node):
        own = tree.impurity[node] * tree.counts[node].sum() / total + alpha
        if tree.left[node] < 0:
            return own, [node]
        low, low_leaves = best(tree.left[node])
        high, high_leaves = best(tree.right[node])
        if own <= low + high + 1e-12:
            return own, [node]
        return low + high, low_leaves + high_leaves

    return set(best(0)[1])


def test_pruning_finds_the_cheapest_subtree(fit):
    alphas = [a for a, _, _ in trees.pruning_steps(fit.tree)]
    between = [(a + b) / 2 for a, b in zip(alphas, alphas[1:], strict=False)]
    for alpha in between:
        assert set(trees.cut_at(fit.tree, alpha)) == brute_prune(fit.tree, alpha)


def test_pruned_tree_object_matches_the_stand_ins(fit, data):
    alpha = trees.pruning_steps(fit.tree)[4][0]
    pruned = trees.prune(fit.tree, alpha)
    assert len(pruned.leaves()) == len(set(trees.cut_at(fit.tree, alpha)))
    listed = trees.tree_rules(data.rows.sparkSession, pruned, fit.labels, NAMES).collect()
    assert sum(r["rows"] for r in listed) == 900
    got = {r["tweet_id"]: r["predicted"] for r in scored(fit.at(alpha), data).collect()}
    seen = 0
    for rule in listed:
        for row in data.rows.where(rule["rule"]).select("tweet_id").collect():
            seen += 1
            assert got[row["tweet_id"]] == rule["prediction"]
    assert seen == 900


def test_zero_alpha_keeps_training_accuracy(fit, data):
    whole = trees.FittedTree(fit.model, fit.tree, fit.features, fit.labels, fit.tree.leaves())
    shares = [
        evaluate.accuracy(f.score(data.rows), "label", "predicted").first()["accuracy"]
        for f in (whole, fit)
    ]
    assert shares[0] == shares[1]


def test_one_tree_per_fold_scores_every_alpha_as_refitting_would(data):
    alphas = [0.0, 0.01, 0.05]
    fast = {
        (r["alpha"], r["fold"]): r["score"]
        for r in trees.fold_scores(data, alphas, 3, "entropy", max_depth=5).collect()
    }
    for fold in range(3):
        part = trees.Prepared(data.rows.where(F.col("fold") != fold), NAMES, data.labels)
        held = data.rows.where(F.col("fold") == fold)
        for alpha in alphas:
            refit = trees.fit_tree(part, "entropy", alpha, max_depth=5)
            slow = evaluate.accuracy(refit.score(held), "label", "predicted").first()["accuracy"]
            assert fast[alpha, fold] == pytest.approx(slow)


def test_share_tree_scores_as_r2_of_its_shares(data):
    alpha = 0.002
    fast = {
        r["fold"]: r["score"]
        for r in trees.fold_scores(data, [alpha], 3, "gini", max_depth=5).collect()
    }
    part = trees.Prepared(data.rows.where("fold != 0"), NAMES, data.labels)
    refit = trees.fit_share_tree(part, alpha, max_depth=5)
    rows = refit.score(data.rows.where("fold = 0"))
    columns = {label: f"p{i}" for i, label in enumerate(data.labels)}
    named = rows.select(
        "label", *[F.get("probability", F.lit(i)).alias(f"p{i}") for i in range(3)]
    )
    slow = evaluate.r2_onehot(named, "label", columns).first()["r2"]
    assert fast[0] == pytest.approx(slow)


def test_a_share_tree_of_two_labels_splits_where_the_top_label_stays(spark):
    # 60 % and 90 % of "b" on the two sides of x = 0.5: the same top label, other shares.
    rows = [(i, float(i % 2), "b" if i % 20 < (12 if i % 2 == 0 else 18) else "a") for i in range(1200)]
    rows = [(i, x, "b" if (i // 2) % 10 < (6 if x == 0 else 9) else "a") for i, x, _ in rows]
    frame = spark.createDataFrame(rows, "tweet_id long, x double, label string")
    fit = trees.fit_share_tree(trees.prepare(frame, ["x"], "label"))
    assert len(fit.tree.leaves()) == 2
    assert sorted(fit.tree.shares(n).round(9).tolist() for n in fit.tree.leaves()) == [[0.1, 0.9], [0.4, 0.6]]
    for node in range(3):
        shares = fit.tree.shares(node)
        assert fit.tree.impurity[node] == pytest.approx(1 - (shares**2).sum())


def test_share_trees_of_more_labels_merge_leaves_with_one_top_label(spark):
    rows = [(i, float(i % 2), "b" if (i // 2) % 10 < (6 if i % 2 == 0 else 9) else "ac"[i % 4 // 2]) for i in range(1200)]
    frame = spark.createDataFrame(rows, "tweet_id long, x double, label string")
    fit = trees.fit_share_tree(trees.prepare(frame, ["x"], "label"))
    assert len(fit.labels) == 3 and len(fit.tree.leaves()) == 1


def test_pruning_of_a_large_tree_is_quick():
    import time

    n = 2**12
    size = 2 * n - 1
    inner = np.arange(n - 1)
    left, right = np.full(size, -1), np.full(size, -1)
    left[inner], right[inner] = 2 * inner + 1, 2 * inner + 2
    counts = np.zeros((size, 2))
    counts[n - 1 :] = np.random.default_rng(3).integers(1, 30, (n, 2))
    for node in inner[::-1]:
        counts[node] = counts[left[node]] + counts[right[node]]
    share = counts / counts.sum(axis=1, keepdims=True)
    tree = trees.Tree(
        np.zeros(size, int), np.zeros(size), left, right, 1 - (share**2).sum(axis=1), counts,
        counts.sum(axis=1),
    )
    start = time.perf_counter()
    steps = trees.pruning_steps(tree)
    assert time.perf_counter() - start < 5
    assert steps[0][1] > 0.99 * n and steps[-1][1] == 1  # some splits save nothing
    assert all(a[0] <= b[0] and a[1] > b[1] and a[2] <= b[2] + 1e-9 for a, b in zip(steps, steps[1:]))


def test_gini_is_k_times_the_one_hot_squared_error(data):
    tree = trees.fit_share_tree(data, max_depth=3).tree
    for node in range(len(tree.left)):
        shares = tree.shares(node)
        error = np.mean(shares * (1 - shares))  # variance of each 0/1 target
        assert tree.impurity[node] == pytest.approx(len(shares) * error)


def test_sweep_has_a_row_per_alpha(data):
    got = trees.alpha_sweep(data, 3, "entropy", max_depth=3).orderBy("alpha").collect()
    whole = trees.fit_tree(data, "entropy", max_depth=3)
    assert len(got) == len(trees.pruning_steps(whole.tree)) - 1
    assert all(0 <= r["mean_accuracy"] <= 1 and r["std"] >= 0 for r in got)


def test_small_splits_collapse(fit):
    stand_ins = trees.collapse_small(fit.tree, 50)
    for leaf, node in zip(fit.tree.leaves(), stand_ins, strict=True):
        above = fit.tree.parent[node]
        assert above < 0 or fit.tree.rows[above] >= 50
        assert node == leaf or fit.tree.rows[node] < 50
    assert trees.collapse_small(fit.tree, 2) == fit.tree.leaves()


def test_forest_scores_average_its_trees(data):
    forest = trees.fit_forest(data, trees=5)
    own = {
        r["tweet_id"]: r["probability"].toArray().tolist()
        for r in forest.model.transform(data.rows).select("tweet_id", "probability").collect()
    }
    for r in forest.score(data.rows).select("tweet_id", "probability").collect():
        assert r["probability"] == pytest.approx(own[r["tweet_id"]])
    assert len(forest.trees) == 5 and forest.first_tree() is forest.trees[0]


def test_tree_text_and_nodes(spark, fit):
    text = trees.tree_text(fit.tree, fit.labels)
    assert text.splitlines()[0].startswith("|--- feature_0 <= ")
    assert text.count("class: ") == len(fit.tree.leaves())
    short = trees.tree_text(fit.tree, fit.labels, NAMES, max_depth=2)
    assert "truncated branch of depth" in short and "x0 <= " in short
    nodes = trees.tree_nodes(fit.model, NAMES)
    assert nodes.count() == len(fit.tree.left)
    assert nodes.where("feature IS NULL").count() == len(fit.tree.leaves())


def leaves_of(part):
    return 1 if isinstance(part, str) else leaves_of(part[2]) + leaves_of(part[3])


def test_published_rules_give_each_row_one_leaf(spark):
    assert leaves_of(INTERACTION_TREE) == 29
    names = feature_columns("interaction_level")
    assert len(names) == 115 and names[0] == "price_diff" and names[12] == "polarity"
    assert len(feature_columns("sentiment")) == len(feature_columns("price_change")) == 117
    rng = np.random.default_rng(0)
    values = np.column_stack([rng.normal(scale=20, size=(500, 15)), rng.integers(0, 2, (500, 100))])
    df = spark.createDataFrame([tuple(map(float, row)) for row in values], names)
    got = [r["predicted"] for r in rules.score_rules(df, INTERACTION_TREE, names).collect()]

    def walk(part, row):
        while not isinstance(part, str):
            index, threshold, low, high = part
            part = low if row[index] <= threshold else high
        return part

    assert got == [walk(INTERACTION_TREE, row) for row in values]


def test_grid(spark, data):
    assert trees.forest_sizes() == [10, 17, 25, 33, 41, 48, 56, 64, 72, 80]
    assert len(trees.grid_points(trees.FULL_GRID)) == 320
    grid = {"numTrees": [3], "maxFeatures": ["auto", "sqrt"], "minSplit": [2, 200], "maxDepth": [4]}
    fits = []
    original = trees.fit_forest

    def counted(*args, **options):
        fits.append(options)
        return original(*args, **options)

    trees.fit_forest = counted
    try:
        found = trees.grid_search(data, grid, 3)
    finally:
        trees.fit_forest = original
    # One shared fit per fold, and the refit of the best point.
    assert len(fits) == 4
    rows = {r["params"]: r["mean_accuracy"] for r in found.results.collect()}
    assert len(rows) == 4
    assert max(rows.values()) == pytest.approx(
        rows[next(k for k in rows if trees.json.loads(k) == found.best_params)]
    )
    got = evaluate.accuracy(found.best.score(data.rows), "label", "predicted").first()
    assert got["accuracy"] > 0.4
    assert trees.params_table(spark, found.best_params).count() == 4
    resolved = {r["param"] for r in trees.resolved_params(spark, found.best.model).collect()}
    assert {"numTrees", "maxDepth"} <= resolved


def test_printed_rules_are_read_back(fit):
    assert rules.read_rules(rules.print_rules(INTERACTION_TREE, 99)) == INTERACTION_TREE
    whole = rules.read_rules(trees.tree_text(fit.tree, fit.labels, max_depth=99))
    assert leaves_of(whole) == len(fit.tree.leaves())
    cut = rules.read_rules(trees.tree_text(fit.tree, fit.labels, max_depth=1))
    assert "unknown" in str(cut) and leaves_of(cut) < leaves_of(whole)
    with pytest.raises(ValueError, match="expected"):
        rules.read_rules("|--- feature_0 <= 1.00\n|   |--- class: a\n|--- feature_1 >  1.00\n|   |--- class: b")
    with pytest.raises(ValueError, match="expected the end"):
        rules.read_rules("|--- class: a\n|--- class: b")
    with pytest.raises(ValueError, match="expected a test"):
        rules.read_rules("|--- feature_0 <= 1.00\n")
    named = rules.read_rules("|--- a b <= -1.50\n|   |--- class: x y\n|--- a b >  -1.50\n|   |--- class: z", ["c", "a b"])
    assert named == (1, -1.5, "x y", "z")


def test_votes_of_the_first_trees_are_counted_in_tasks(data):
    fit = trees.fit_forest(data, 5, 3)
    got = trees._held_out_scores(fit, data.rows, [1, 3, 5], [2, 100])
    rows = fit.model.transform(data.rows).select("leaf", "label_index").collect()
    for (size, least), score in got.items():
        table = [[tree.shares(n) for n in trees.collapse_small(tree, least)] for tree in fit.trees]
        votes = [sum(table[t][int(r["leaf"][t])] for t in range(size)).argmax() for r in rows]
        assert score == pytest.approx(np.mean([v == r["label_index"] for v, r in zip(votes, rows, strict=True)]))
    assert len(got) == 6
    assert set(trees._held_out_scores(fit, data.rows.limit(0), [1], [2]).values()) == {0.0}


def test_rules_are_walked_as_a_table(spark):
    """Cut-off branches, missing and odd features, a tree of one leaf, and one of 60 levels."""
    cut = rules.read_rules(rules.print_rules((0, 1.0, (1, 2.0, (0, 0.0, "a", "b"), "c"), "d"), 1))
    assert cut == (0, 1.0, (1, 2.0, rules.CUT_OFF, "c"), "d")
    rows = [(0.5, 1), (0.5, 3), (1.5, None), (None, 1), (0.5, None), (float("nan"), 1), (1.0, 2)]
    df = spark.createDataFrame(rows, "x double, y int")
    got = [r["predicted"] for r in rules.score_rules(df, cut, ["x", "y"]).collect()]
    assert got == ["unknown", "c", "d", None, None, "d", "unknown"]
    assert {r["predicted"] for r in rules.score_rules(df, "only", ["x", "y"]).collect()} == {"only"}
    deep = "end"
    for level in reversed(range(60)):
        deep = (0, float(level), f"at {level}", deep)
    assert rules.rule_table(spark, deep).where("class is null").count() == 60
    values = spark.range(62).select(F.col("id").alias("x"))
    got = {r["x"]: r["predicted"] for r in rules.score_rules(values, deep, ["x"]).collect()}
    assert got == {**{k: f"at {k}" for k in range(60)}, 60: "end", 61: "end"}
