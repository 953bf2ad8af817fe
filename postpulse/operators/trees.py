"""Decision trees and forests: fitting, pruning, scoring, reading.

Spark's tree learners do the fitting. What they lack (cost-complexity pruning, a
least size for a split, leaf-by-leaf scoring) works on the fitted tree's node
table on the driver: it is as large as the fitted tree, and a tree grown without a
depth limit has up to a leaf a row, read as columns of numbers.
The rows stay in Spark: the learner names each row's leaf, and a pruned tree is
a look-up from leaf to class shares.
"""

from __future__ import annotations

import heapq
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from itertools import product
from math import isqrt
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postpulse.sources import local_frame, scratch_dir

# Spark's learners stop at this depth.
DEEPEST = 30
# A text rule print stops at this depth, as the published prints do.
PRINT_DEPTH = 10


# ---- data for the learners -------------------------------------------------


@dataclass
class Prepared:
    """Rows with `features` and `label_index`, and what the two stand for."""

    rows: DataFrame
    features: list[str]
    labels: list[str]


def prepare(
    df: DataFrame, features: Sequence[str], label: str, labels: Sequence[str] | None = None
) -> Prepared:
    """Assemble `features` and index `label` alphabetically; rows with gaps go."""
    complete = df.na.drop("any", subset=[*features, label])
    if labels is None:
        indexer = StringIndexer(
            inputCol=label, outputCol="label_index", stringOrderType="alphabetAsc"
        ).fit(complete)
    else:
        indexer = StringIndexerModel.from_labels(
            sorted(labels), inputCol=label, outputCol="label_index", handleInvalid="skip"
        )
    indexed = indexer.transform(complete)
    assembler = VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid="skip"
    )
    return Prepared(assembler.transform(indexed), list(features), list(indexer.labels))


# ---- node tables -----------------------------------------------------------


@dataclass
class Tree:
    """A fitted tree as arrays over its nodes, parents before their children."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    impurity: np.ndarray
    counts: np.ndarray
    rows: np.ndarray
    parent: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.parent = np.full(len(self.left), -1)
        for node in self.inner():
            self.parent[self.left[node]] = self.parent[self.right[node]] = node

    def inner(self) -> np.ndarray:
        """Nodes with children."""
        return np.flatnonzero(self.left >= 0)

    def leaves(self) -> list[int]:
        """Leaf nodes from left to right, the order in which Spark numbers them."""
        out, todo = [], [0]
        while todo:
            node = todo.pop()
            if self.left[node] < 0:
                out.append(node)
            else:
                todo += [self.right[node], self.left[node]]
        return out

    def levels(self) -> list[np.ndarray]:
        """Nodes by depth, the root's level first."""
        out = [np.array([0])]
        while True:
            inner = out[-1][self.left[out[-1]] >= 0]
            if not len(inner):
                return out
            out.append(np.concatenate([self.left[inner], self.right[inner]]))

    def shares(self, node: int) -> np.ndarray:
        """Class shares among a node's training rows."""
        total = self.counts[node].sum()
        return self.counts[node] / total if total else self.counts[node]


def saved_nodes(model: Model) -> DataFrame:
    """Node rows of a fitted tree or forest, read back from the saved model."""
    spark = SparkSession.active()
    path = f"{scratch_dir(spark)}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:
        return nodes.select(F.col("treeID").alias("tree"), "nodeData.*")
    return nodes.select(F.lit(0).alias("tree"), "*")


def tree_nodes(model: Model, features: Sequence[str] | None = None) -> DataFrame:
    """Node table of a tree or forest: the structure for drawings and rules.

    `feature` is a name when `features` are given, and otherwise `feature_<i>`.
    A categorical split has no threshold.
    """
    nodes = saved_nodes(model)
    index = F.col("split.featureIndex")
    name = F.concat(F.lit("feature_"), index.cast("string"))
    if features:
        name = F.get(F.array(*[F.lit(f) for f in features]), index)
    inner = F.col("leftChild") >= 0
    number = (F.col("split.numCategories") == -1) & inner
    return nodes.select(
        "tree",
        "id",
        F.when(inner, name).alias("feature"),
        F.when(number, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        "leftChild",
        "rightChild",
        "impurity",
        "impurityStats",
        "rawCount",
        "prediction",
    )


def node_impurity(counts: np.ndarray, measure: str) -> np.ndarray:
    """Impurity of nodes from their class counts, entropy in bits."""
    shares = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    if measure == "entropy":
        logs = np.log2(shares, out=np.zeros_like(shares), where=shares > 0)
        return -(shares * logs).sum(axis=1)
    return 1 - (shares**2).sum(axis=1)


def read_trees(model: Model) -> list[Tree]:
    """Fitted trees as arrays; the learner itself already holds them on the driver.

    The impurity is worked out from a node's counts: the learner leaves -1 where it
    looked for a split and found none. A regression tree on 0/1 labels has count, sum
    and sum of squares of the label, which give the counts of both labels.
    """
    measure = model.getOrDefault("impurity")
    index = F.col("split.featureIndex")
    threshold = F.when(index >= 0, F.get("split.leftCategoriesOrThreshold", F.lit(0)))
    flat = saved_nodes(model).select(
        "tree", "id", index.alias("feature"), threshold.alias("threshold"), "leftChild",
        "rightChild", "impurityStats", "rawCount",
    )
    # Columns, not rows: the tree of all posts has many nodes.
    nodes = flat.toArrow().to_pandas().sort_values(["tree", "id"])
    trees = []
    for _, part in nodes.groupby("tree", sort=True):
        counts = np.stack(part["impurityStats"].to_list()).astype(float)
        if measure == "variance":
            counts = np.column_stack([counts[:, 0] - counts[:, 1], counts[:, 1]])
        trees.append(
            Tree(
                feature=part["feature"].to_numpy().copy(),
                threshold=part["threshold"].to_numpy(dtype=float).copy(),
                left=part["leftChild"].to_numpy().copy(),
                right=part["rightChild"].to_numpy().copy(),
                impurity=node_impurity(counts, measure),
                counts=counts,
                rows=part["rawCount"].to_numpy().copy(),
            )
        )
    return trees


# ---- pruning ---------------------------------------------------------------


def _weakest_links(tree: Tree) -> list[tuple[float, int]]:
    """(alpha, node) in the order in which weakest-link pruning cuts nodes.

    A node's strength is the risk its subtree saves per leaf it adds. The node
    with the least is cut, its ancestors' sums are brought up to date, and so on
    up to the root. Alphas never fall. A heap holds the strengths; a node has a new
    entry after each change, and older entries are passed over.
    """
    size = len(tree.left)
    risk = tree.impurity * tree.counts.sum(axis=1) / tree.counts[0].sum()
    subtree, leaves = risk.copy(), np.ones(size)
    inner = tree.inner()
    for level in tree.levels()[::-1]:
        split = level[tree.left[level] >= 0]
        subtree[split] = subtree[tree.left[split]] + subtree[tree.right[split]]
        leaves[split] = leaves[tree.left[split]] + leaves[tree.right[split]]
    strength = np.full(size, np.inf)
    strength[inner] = (risk[inner] - subtree[inner]) / (leaves[inner] - 1)
    heap = [(float(strength[node]), int(node)) for node in inner]
    heapq.heapify(heap)
    cuts, highest = [], 0.0
    while heap:
        value, node = heapq.heappop(heap)
        if value != strength[node]:
            continue
        # Differences of sums can come out a hair below the alpha before.
        highest = max(highest, value)
        cuts.append((highest, node))
        saved, fewer = risk[node] - subtree[node], leaves[node] - 1
        below = [node]
        while below:
            gone = below.pop()
            if np.isfinite(strength[gone]):
                strength[gone] = np.inf
                below += [tree.left[gone], tree.right[gone]]
        above = tree.parent[node]
        subtree[node], leaves[node] = risk[node], 1
        while above >= 0:
            subtree[above] += saved
            leaves[above] -= fewer
            strength[above] = (risk[above] - subtree[above]) / (leaves[above] - 1)
            heapq.heappush(heap, (float(strength[above]), int(above)))
            above = tree.parent[above]
    return cuts


def pruning_steps(tree: Tree) -> list[tuple[float, int, float]]:
    """(alpha, leaves, risk) of the whole tree and after each pruning step.

    Nodes cut at the same alpha are one step; the last one leaves the root only.
    """
    cuts, steps = _weakest_links(tree), []
    risk = tree.impurity * tree.counts.sum(axis=1) / tree.counts[0].sum()
    stands = _StandIns(tree, cuts)
    for alpha in dict.fromkeys([0.0, *[a for a, _ in cuts]]):
        kept = np.unique(stands.at(alpha))
        steps.append((alpha, len(kept), float(risk[kept].sum())))
    return steps


def cut_at(tree: Tree, alpha: float) -> list[int]:
    """For each leaf, left to right, the node that stands for it at `alpha`."""
    return _StandIns(tree, _weakest_links(tree)).at(alpha).tolist()


def collapse_small(tree: Tree, least: int) -> list[int]:
    """For each leaf, its topmost ancestor with fewer than `least` rows, or itself."""
    small = [(0.0, int(n)) for n in tree.inner() if tree.rows[n] < least]
    return _StandIns(tree, small).at(0.0).tolist()


class _StandIns:
    """For any alpha, the topmost node on each leaf's way that is cut by then."""

    def __init__(self, tree: Tree, cuts: list[tuple[float, int]]):
        self.parent, self.levels = tree.parent, tree.levels()
        self.leaves = np.array(tree.leaves())
        self.cut = np.full(len(tree.left), np.inf)
        for alpha, node in cuts:
            self.cut[node] = min(self.cut[node], alpha)

    def at(self, alpha: float) -> np.ndarray:
        stand = np.arange(len(self.cut))
        for level in self.levels[1:]:
            above = stand[self.parent[level]]
            stand[level] = np.where(self.cut[above] <= alpha, above, level)
        return stand[self.leaves]


def prune(tree: Tree, alpha: float) -> Tree:
    """The tree cut back to what is worth `alpha` per leaf."""
    stand_ins = set(cut_at(tree, alpha))
    order, todo = [], [0]
    while todo:
        node = todo.pop()
        order.append(node)
        if node not in stand_ins:
            todo += [tree.right[node], tree.left[node]]
    place = {node: i for i, node in enumerate(order)}

    def child(side: np.ndarray) -> np.ndarray:
        return np.array([-1 if n in stand_ins else place[side[n]] for n in order])

    return Tree(
        feature=np.array([-1 if n in stand_ins else tree.feature[n] for n in order]),
        threshold=np.array([np.nan if n in stand_ins else tree.threshold[n] for n in order]),
        left=child(tree.left),
        right=child(tree.right),
        impurity=tree.impurity[order],
        counts=tree.counts[order],
        rows=tree.rows[order],
    )


# ---- fitting and scoring ---------------------------------------------------


@dataclass
class FittedTree:
    """A fitted tree, its class names, and the stand-in node of each leaf."""

    model: Model
    tree: Tree
    features: list[str]
    labels: list[str]
    stand_ins: list[int]

    def at(self, alpha: float) -> FittedTree:
        """The same fit, pruned at `alpha`."""
        cut = cut_at(self.tree, alpha)
        return FittedTree(self.model, self.tree, self.features, self.labels, cut)

    def score(self, rows: DataFrame) -> DataFrame:
        """Add `leaf`, `probability` (an array by label) and `predicted`."""
        # Few nodes stand for the many leaves of a pruned tree, so leaves are numbers of nodes.
        nodes = {node: i for i, node in enumerate(dict.fromkeys(self.stand_ins))}
        table = [[self.tree.shares(node).tolist() for node in nodes]]
        numbers = F.from_json(F.lit(json.dumps([nodes[n] for n in self.stand_ins])), "array<int>")
        stand = F.array(F.get(numbers, F.col("leaf").cast("int")))
        scored = self.model.transform(rows).drop("rawPrediction", "probability", "prediction")
        return _with_prediction(scored, _mean_shares(stand, table), self.labels)


def _literal(values: list) -> Column:
    """Nested number lists as one constant, folded when the query is planned."""
    kind = "array<array<array<double>>>"
    return F.from_json(F.lit(json.dumps(values)), kind)


def _mean_shares(leaves: Column, table: list[list[list[float]]]) -> Column:
    """Class shares averaged over trees, looked up by each tree's leaf number."""
    looked_up = F.transform(
        leaves, lambda leaf, t: F.get(F.get(_literal(table), t), leaf.cast("int"))
    )

    def share(label: int) -> Column:
        total = F.aggregate(
            looked_up, F.lit(0.0), lambda sofar, shares: sofar + F.get(shares, F.lit(label))
        )
        return total / len(table)

    return F.array(*[share(label) for label in range(len(table[0][0]))])


def _with_prediction(df: DataFrame, shares: Column, labels: Sequence[str]) -> DataFrame:
    names = F.array(*[F.lit(label) for label in labels])
    best = F.array_position("probability", F.array_max("probability")) - 1
    return df.withColumn("probability", shares).withColumn(
        "predicted", F.get(names, best.cast("int"))
    )


def bins_of_all_rows(data: Prepared, least: int = 256) -> int:
    """`max_bins` with which thresholds come from all rows: Spark looks for them among max_bins² rows."""
    return max(least, isqrt(max(data.rows.count() - 1, 0)) + 1)


def fit_tree(
    data: Prepared,
    impurity: str = "entropy",
    alpha: float = 0.0,
    max_depth: int = DEEPEST,
    max_bins: int = 256,
    seed: int = 42,
) -> FittedTree:
    """Decision tree grown in full, then pruned at `alpha`."""
    learner = DecisionTreeClassifier(
        labelCol="label_index",
        impurity=impurity,
        maxDepth=max_depth,
        maxBins=max_bins,
        seed=seed,
        leafCol="leaf",
    )
    model = learner.fit(data.rows)
    tree = read_trees(model)[0]
    return FittedTree(model, tree, data.features, data.labels, cut_at(tree, alpha))


def fit_share_tree(
    data: Prepared,
    alpha: float = 0.0,
    max_depth: int = DEEPEST,
    max_bins: int = 256,
    seed: int = 42,
) -> FittedTree:
    """Regression tree on one-hot labels: predicts the shares of the labels.

    The squared error of K one-hot targets, averaged over them, is the Gini
    impurity divided by K, so a node is pruned at K times `alpha`. For two labels
    this is Spark's regression tree on one of them. For more it is the Gini tree,
    in which Spark merges sibling leaves with the same most frequent label: splits that
    change shares without changing that label are lost.
    """
    if len(data.labels) != 2:
        return fit_tree(data, "gini", alpha * len(data.labels), max_depth, max_bins, seed)
    learner = DecisionTreeRegressor(
        labelCol="label_index", maxDepth=max_depth, maxBins=max_bins, seed=seed, leafCol="leaf"
    )
    model = learner.fit(data.rows)
    tree = read_trees(model)[0]
    return FittedTree(model, tree, data.features, data.labels, cut_at(tree, 2 * alpha))


@dataclass
class FittedForest:
    """A fitted forest and the class shares of every leaf of every tree."""

    model: Model
    trees: list[Tree]
    features: list[str]
    labels: list[str]
    min_split: int = 2

    def shares(self) -> Column:
        """Class shares of a transformed row: the mean over its leaves."""
        table = [
            [t.shares(node).tolist() for node in collapse_small(t, self.min_split)]
            for t in self.trees
        ]
        return _mean_shares(vector_to_array("leaf"), table)

    def score(self, rows: DataFrame) -> DataFrame:
        """Add `probability` (mean of the trees' shares) and `predicted`."""
        scored = self.model.transform(rows).drop("rawPrediction", "probability", "prediction")
        return _with_prediction(scored, self.shares(), self.labels).drop("leaf")

    def first_tree(self) -> Tree:
        """The first tree, for printing."""
        return self.trees[0]


def fit_forest(
    data: Prepared,
    trees: int = 17,
    max_depth: int = 4,
    min_leaf: int = 2,
    min_split: int = 2,
    bootstrap: bool = False,
    features_per_split: str = "sqrt",
    seed: int = 42,
) -> FittedForest:
    """Random forest; a split needs `min_split` rows, a leaf `min_leaf`."""
    learner = RandomForestClassifier(
        labelCol="label_index",
        numTrees=trees,
        maxDepth=max_depth,
        minInstancesPerNode=min_leaf,
        bootstrap=bootstrap,
        featureSubsetStrategy=features_per_split,
        impurity="gini",
        seed=seed,
        leafCol="leaf",
    )
    model = learner.fit(data.rows)
    return FittedForest(model, read_trees(model), data.features, data.labels, min_split)


# ---- reading a tree --------------------------------------------------------


def tree_text(
    tree: Tree, labels: Sequence[str], names: Sequence[str] | None = None,
    max_depth: int = PRINT_DEPTH,
) -> str:
    """Indented rules of a tree; deeper branches are shown as cut off."""

    def depth_below(node: int) -> int:
        deepest, todo = 0, [(node, 1)]
        while todo:
            here, depth = todo.pop()
            deepest = max(deepest, depth)
            if tree.left[here] >= 0:
                todo += [(tree.left[here], depth + 1), (tree.right[here], depth + 1)]
        return deepest

    lines, todo = [], [(0, 0, None)]
    while todo:
        node, depth, rule = todo.pop()
        if rule:
            lines.append(f"{'|   ' * (depth - 1)}|--- {rule}")
        bar = f"{'|   ' * depth}|--- "
        if tree.left[node] < 0:
            lines.append(f"{bar}class: {labels[int(np.argmax(tree.counts[node]))]}")
        elif depth > max_depth:
            lines.append(f"{bar}truncated branch of depth {depth_below(node)}")
        else:
            index = tree.feature[node]
            name = names[index] if names else f"feature_{index}"
            cut = f"{tree.threshold[node]:.2f}"
            todo.append((tree.right[node], depth + 1, f"{name} >  {cut}"))
            todo.append((tree.left[node], depth + 1, f"{name} <= {cut}"))
    return "\n".join(lines)


def write_tree_text(spark: SparkSession, text: str, path: str) -> None:
    """Write rule text to a folder as one text file."""
    lines = list(enumerate(text.split("\n")))
    rows = local_frame(spark, lines, "line int, value string").coalesce(1)
    rows.sortWithinPartitions("line").select("value").write.mode("overwrite").text(path)


def tree_rules(spark: SparkSession, tree: Tree, labels: Sequence[str], names: Sequence[str]) -> DataFrame:
    """(leaf_id, rule, prediction, rows): one row per leaf, left to right."""
    out = []
    for number, leaf in enumerate(tree.leaves()):
        parts, node = [], leaf
        while tree.parent[node] >= 0:
            above = tree.parent[node]
            sign = "<=" if tree.left[above] == node else ">"
            parts.append(f"{names[tree.feature[above]]} {sign} {float(tree.threshold[above])!r}")
            node = above
        label = labels[int(np.argmax(tree.counts[leaf]))]
        out.append((number, " AND ".join(reversed(parts)), label, int(tree.rows[leaf])))
    return local_frame(spark, out, "leaf_id int, rule string, prediction string, rows long")


# ---- model selection -------------------------------------------------------


def pruning_path(spark: SparkSession, tree: Tree, keep_root: bool = False) -> DataFrame:
    """(step, alpha, leaves, risk), alphas ascending; the root-only step is left out."""
    steps = pruning_steps(tree)
    steps = steps if keep_root else steps[:-1]
    rows = [(i, *step) for i, step in enumerate(steps)]
    return local_frame(spark, rows, "step int, alpha double, leaves int, risk double")


def _leaf_label_counts(fit: FittedTree, rows: DataFrame) -> np.ndarray:
    """How many rows of each label reach each leaf: all a fold's scores need."""
    counts = np.zeros((len(fit.stand_ins), len(fit.labels)))
    placed = fit.model.transform(rows).groupBy("leaf", "label_index").count()
    for row in placed.collect():
        counts[int(row["leaf"]), int(row["label_index"])] = row["count"]
    return counts


def _right_share(counts: np.ndarray, shares: np.ndarray) -> float:
    return float(counts[np.arange(len(counts)), shares.argmax(axis=1)].sum() / counts.sum())


def _mean_r2(counts: np.ndarray, shares: np.ndarray) -> float:
    total, scores = counts.sum(), []
    for label in range(counts.shape[1]):
        hits, share = counts[:, label], shares[:, label]
        miss = (hits * (1 - share) ** 2 + (counts.sum(axis=1) - hits) * share**2).sum()
        spread = hits.sum() - hits.sum() ** 2 / total
        scores.append(1 - miss / spread if spread else float(miss == 0))
    return float(np.mean(scores))


def _grow(data: Prepared, impurity: str, **options) -> FittedTree:
    """A tree that isn't pruned: of shares for Gini, of classes for entropy."""
    if impurity == "gini":
        return fit_share_tree(data, 0.0, **options)
    return fit_tree(data, impurity, **options)


def fold_scores(
    data: Prepared,
    alphas: Sequence[float],
    folds: int,
    impurity: str = "entropy",
    fold_col: str = "fold",
    parallelism: int = 4,
    **options,
) -> DataFrame:
    """(alpha, fold, score): held-out score of the tree pruned at every alpha.

    One tree is grown per fold and every alpha prunes that same tree, which gives
    what growing it anew per alpha would. The held-out rows are read once per
    fold: their label counts per leaf hold every pruned tree's score. Entropy
    trees score accuracy; Gini trees are share trees (see `fit_share_tree`) and
    score R², with alpha on the squared-error scale.
    """
    shares_tree = impurity == "gini"
    rows = data.rows.persist()

    def one(fold: int) -> list[tuple]:
        training = Prepared(rows.where(F.col(fold_col) != fold), data.features, data.labels)
        fit = _grow(training, impurity, **options)
        counts = _leaf_label_counts(fit, rows.where(F.col(fold_col) == fold))
        stands, out = _StandIns(fit.tree, _weakest_links(fit.tree)), []
        totals = np.maximum(fit.tree.counts.sum(axis=1, keepdims=True), 1)
        every = fit.tree.counts / totals
        for alpha in alphas:
            scaled = alpha * len(data.labels) if shares_tree else alpha
            shares = every[stands.at(scaled)]
            score = _mean_r2(counts, shares) if shares_tree else _right_share(counts, shares)
            out.append((float(alpha), fold, score))
        return out

    with ThreadPool(min(parallelism, folds)) as pool:
        scored = [row for part in pool.map(one, range(folds)) for row in part]
    rows.unpersist()
    return local_frame(
        data.rows.sparkSession, scored, "alpha double, fold int, score double"
    )


def summarise_folds(scores: DataFrame) -> DataFrame:
    """(alpha, mean_accuracy, std): mean and population deviation over the folds."""
    return scores.groupBy("alpha").agg(
        F.avg("score").alias("mean_accuracy"), F.stddev_pop("score").alias("std")
    )


def alpha_sweep(
    data: Prepared, folds: int = 10, impurity: str = "entropy", fold_col: str = "fold", **options
) -> DataFrame:
    """(alpha, mean_accuracy, std) for every alpha on the whole data's pruning path."""
    whole = _grow(data, impurity, **options)
    scale = len(data.labels) if impurity == "gini" else 1
    alphas = [alpha / scale for alpha, _, _ in pruning_steps(whole.tree)[:-1]]
    return summarise_folds(fold_scores(data, alphas, folds, impurity, fold_col, **options))


def forest_sizes(start: int = 10, stop: int = 80, num: int = 10) -> list[int]:
    """Evenly spaced forest sizes, cut to whole numbers."""
    return [int(x) for x in np.linspace(start, stop, num)]


# The published search grid.
FULL_GRID = {
    "numTrees": forest_sizes(),
    "maxFeatures": ["auto", "sqrt"],
    "maxDepth": [2, 4],
    "minSplit": [2, 5],
    "minLeaf": [1, 2],
    "bootstrap": [True, False],
}


def grid_points(grid: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of the listed values."""
    return [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]


@dataclass
class Search:
    """Outcome of a grid search."""

    results: DataFrame
    best: FittedForest
    best_params: dict


def _fit_point(params: Mapping) -> tuple:
    """What of a grid point a forest's trees depend on; `auto` is a name for `sqrt`."""
    rule = params.get("maxFeatures", "sqrt")
    return (
        params.get("maxDepth", 4),
        params.get("minLeaf", 2),
        params.get("bootstrap", False),
        "sqrt" if rule == "auto" else rule,
    )


def _fit_forest_at(
    data: Prepared, point: tuple, trees: int, min_split: int, seed: int
) -> FittedForest:
    depth, leaf, bootstrap, rule = point
    return fit_forest(data, trees, depth, leaf, min_split, bootstrap, rule, seed)


def _held_out_scores(
    fit: FittedForest, held: DataFrame, sizes: Sequence[int], splits: Sequence[int]
) -> dict[tuple[int, int], float]:
    """Accuracy of the forest's first trees, for each (number of trees, least split).

    Rows that reach the same leaves of all trees and have the same label vote once. The votes
    are added up in the tasks, and one row of counts comes back.
    """
    leaves = vector_to_array("leaf").cast("array<int>").alias("leaves")
    kinds = fit.model.transform(held).groupBy(leaves, "label_index").count()
    none = F.array(*[F.lit(0.0) for _ in fit.labels])
    start = F.struct(none.alias("sums"), F.array().cast("array<boolean>").alias("right"))

    def step(state: Column, shares: Column) -> Column:
        def counted(sums: Column) -> Column:
            best = F.array_position(sums, F.array_max(sums)) - 1
            right = F.concat(state["right"], F.array(best == F.col("label_index")))
            return F.struct(sums.alias("sums"), right.alias("right"))

        sums = F.zip_with(state["sums"], shares, lambda a, b: a + b)
        # As the element of an array the sums are made once and not for each use.
        return F.get(F.transform(F.array(sums), counted), F.lit(0))

    def right_after(least: int) -> Column:
        """Whether the first tree, the first two, … give a row's label."""
        table = [[tree.shares(n).tolist() for n in collapse_small(tree, least)] for tree in fit.trees]
        votes = F.transform("leaves", lambda leaf, t: F.get(F.get(_literal(table), t), leaf))
        return F.aggregate(votes, start, step, lambda state: state["right"])

    voted = kinds.select("count", *[right_after(least).alias(f"after_{least}") for least in splits])
    points = list(product(sizes, splits))
    hits = [F.sum(F.when(F.get(f"after_{least}", F.lit(n - 1)), F.col("count"))) for n, least in points]
    total, *right = voted.agg(F.sum("count"), *hits).first()
    return {point: (count or 0) / total if total else 0.0 for point, count in zip(points, right, strict=True)}


def grid_search(
    data: Prepared,
    grid: Mapping[str, Sequence] = FULL_GRID,
    folds: int = 3,
    fold_col: str = "fold",
    parallelism: int = 4,
    seed: int = 42,
) -> Search:
    """Cross-validated accuracy of every grid point, best one refitted on all rows.

    `grid` lists values of numTrees, maxFeatures, maxDepth, minSplit, minLeaf and
    bootstrap. The trees of a forest are drawn independently, so the first n trees of
    a larger forest are a forest of n: points that differ only in `numTrees`,
    `minSplit` or in the two names of one feature rule share the fit of the largest,
    and its held-out rows are read once. Of equally good points the first wins.
    """
    points = grid_points(grid)
    sizes = sorted({params.get("numTrees", 17) for params in points})
    splits = sorted({params.get("minSplit", 2) for params in points})
    rows = data.rows.persist()

    def one(task: tuple[int, tuple]) -> dict[tuple, float]:
        fold, point = task
        part = Prepared(rows.where(F.col(fold_col) != fold), data.features, data.labels)
        fit = _fit_forest_at(part, point, sizes[-1], 2, seed)
        found = _held_out_scores(fit, rows.where(F.col(fold_col) == fold), sizes, splits)
        return {(point, *own, fold): score for own, score in found.items()}

    scores: dict[tuple, float] = {}
    tasks = list(product(range(folds), dict.fromkeys(map(_fit_point, points))))
    with ThreadPool(parallelism) as pool:
        for part in pool.imap_unordered(one, tasks):
            scores.update(part)
    summary = []
    for params in points:
        own = _fit_point(params), params.get("numTrees", 17), params.get("minSplit", 2)
        found = [scores[*own, fold] for fold in range(folds)]
        summary.append((json.dumps(params), float(np.mean(found)), float(np.std(found))))
    chosen = points[int(np.argmax([mean for _, mean, _ in summary]))]
    whole = Prepared(rows, data.features, data.labels)
    best = _fit_forest_at(
        whole, _fit_point(chosen), chosen.get("numTrees", 17), chosen.get("minSplit", 2), seed
    )
    rows.unpersist()
    results = local_frame(
        data.rows.sparkSession, summary, "params string, mean_accuracy double, std double"
    )
    return Search(results, best, chosen)


def params_table(spark: SparkSession, params: Mapping) -> DataFrame:
    """(param, value) rows of a parameter set."""
    rows = [(name, str(value)) for name, value in sorted(params.items())]
    return local_frame(spark, rows, "param string, value string")


def resolved_params(spark: SparkSession, model: Model) -> DataFrame:
    """(param, value) of everything a fitted model was set to."""
    found = {param.name: value for param, value in model.extractParamMap().items()}
    return params_table(spark, found)
