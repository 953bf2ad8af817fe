"""Rule tables: printed trees read back, and rows scored by walking the table.

Rules are nested (feature position, threshold, rules if <=, rules if >), with classes as
plain strings. As a table they are one row per node, which is a constant in the plan of a
size that grows with the nodes only; a row walks it level by level in one expression.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postpulse.sources import local_frame

# The class of a branch that a print leaves out.
CUT_OFF = "unknown"
NODE = "id int, feature int, threshold double, low int, high int, class string"


def print_rules(rules: tuple | str, max_depth: int) -> str:
    """Nested rules as indented text; branches below `max_depth` tests are shown as cut off."""

    def depth_of(part: tuple | str) -> int:
        return 1 if isinstance(part, str) else 1 + max(depth_of(part[2]), depth_of(part[3]))

    def lines_of(part: tuple | str, depth: int) -> list[str]:
        bar = f"{'|   ' * depth}|--- "
        if isinstance(part, str):
            return [f"{bar}class: {part}"]
        if depth > max_depth:
            return [f"{bar}truncated branch of depth {depth_of(part)}"]
        index, threshold, low, high = part
        return [
            f"{bar}feature_{index} <= {threshold:.2f}", *lines_of(low, depth + 1),
            f"{bar}feature_{index} >  {threshold:.2f}", *lines_of(high, depth + 1),
        ]

    return "\n".join(lines_of(rules, 0))


def read_rules(text: str, names: Sequence[str] = ()) -> tuple | str:
    """A printed tree as nested rules; a branch cut off is `CUT_OFF`.

    A line per test or class, indented by its depth, the `<=` side of a test before its
    `>` side. Features are numbers (`feature_7`), or `names`, whose places count.
    """
    lines = [line for line in text.splitlines() if line.strip()]
    places = {name: i for i, name in enumerate(names)}
    place = 0

    def said() -> str:
        if place >= len(lines) or "|--- " not in lines[place]:
            raise ValueError(f"line {place + 1}: expected a test or a class")
        return lines[place].split("|--- ", 1)[1].strip()

    def node() -> tuple | str:
        nonlocal place
        words = said()
        place += 1
        if words.startswith("class: "):
            return words.removeprefix("class: ")
        if words.startswith("truncated branch"):
            return CUT_OFF
        feature, sign, threshold = words.rsplit(maxsplit=2)
        if sign != "<=":
            raise ValueError(f"line {place}: expected a <= test, found {words!r}")
        low = node()
        if said().rsplit(maxsplit=2)[:2] != [feature, ">"]:
            raise ValueError(f"line {place + 1}: expected the > side of {feature}")
        place += 1
        number = places[feature] if feature in places else int(feature.rpartition("_")[2])
        return number, float(threshold), low, node()

    rules = node()
    if place < len(lines):
        raise ValueError(f"line {place + 1}: expected the end, found {lines[place]!r}")
    return rules


def rule_nodes(rules: tuple | str) -> list[tuple]:
    """Rows of `NODE`: tests with a feature and two children, leaves with a class; 0 is the root."""
    rows: list = []

    def add(part: tuple | str) -> int:
        number = len(rows)
        rows.append(None)
        if isinstance(part, str):
            rows[number] = (number, None, None, None, None, part)
        else:
            index, threshold, low, high = part
            rows[number] = (number, index, float(threshold), add(low), add(high), None)
        return number

    add(rules)
    return rows


def rule_table(spark: SparkSession, rules: tuple | str) -> DataFrame:
    """The nodes of a tree as a table."""
    return local_frame(spark, rule_nodes(rules), NODE)


def _depth(nodes: Sequence[tuple]) -> int:
    """Tests on the longest way; a node comes before its children."""
    depth = [0] * len(nodes)
    for number, _, _, low, high, _ in nodes:
        for child in (low, high):
            if child is not None:
                depth[child] = depth[number] + 1
    return max(depth)


def rule_class(nodes: Sequence[tuple], columns: Sequence[Column]) -> Column:
    """The class of the leaf a row comes to; NULL if a feature on its way is missing.

    `nodes` are rows of `NODE`, `columns` the features by position. Only features that
    some test names are read.
    """
    used = sorted({node[1] for node in nodes if node[1] is not None})
    names = [field.split(" ")[0] for field in NODE.split(", ")]
    rows = [dict(zip(names, node, strict=True)) for node in nodes]
    for row in rows:
        row["feature"] = None if row["feature"] is None else used.index(row["feature"])
    kind = f"array<struct<{NODE.replace(', ', ',').replace(' ', ':')}>>"
    table = F.from_json(F.lit(json.dumps(rows, ensure_ascii=False)), kind)
    values = F.array(*[columns[index].cast("double") for index in used]).cast("array<double>")

    def end(value: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            node = F.get(table, at)
            mine = F.get(value, node["feature"])
            below = F.when(mine <= node["threshold"], node["low"]).when(
                mine > node["threshold"], node["high"]
            )
            return F.when(node["class"].isNotNull(), at).otherwise(below)

        steps = F.sequence(F.lit(0), F.lit(_depth(nodes)))
        return F.get(table, F.aggregate(steps, F.lit(0), step))["class"]

    # As the element of an array the features are gathered once and not at each step.
    return F.get(F.transform(F.array(values), end), F.lit(0))


def score_rules(
    df: DataFrame, rules: tuple | str, features: Sequence[str], name: str = "predicted"
) -> DataFrame:
    """Add the class a published tree gives each row, features by position."""
    return df.withColumn(name, rule_class(rule_nodes(rules), [F.col(f) for f in features]))
