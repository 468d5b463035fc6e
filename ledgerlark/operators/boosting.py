"""Boosted trees by second-order histogram splits: binary logistic loss, columns drawn for each tree.

Every feature is binned once at cuts of nearly equal counts. A tree whose features have few bins together is one
aggregate: the sums of gradients and hessians by cell, a bin of each feature, combined map-side. Other trees are
an aggregate for each level, by node, feature and bin. The driver sees these sums only, at most ``CELLS`` or
nodes x features x bins rows whatever the table, and chooses the splits. Sums are taken over whole numbers
(gradients in units that no sum of the table can overflow), so trees do not depend on how rows are dealt.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.features import uniform
from ledgerlark.operators.psi import long_form
from ledgerlark.operators.running import running_totals
from ledgerlark.session import written

# The usual regularisation of such trees.
LAMBDA = 1.0
MIN_HESSIAN = 1.0

BINS = 256
#: Most cells whose sums the driver takes for a whole tree.
CELLS = 1 << 17
#: Margins are written after this many trees; in between they are worked out from the trees since.
TREES_PER_TABLE = 5


@dataclass(frozen=True)
class Node:
    """A split (rows below ``cut`` go left, missing ones by ``missing_left``), or a leaf's ``value``."""

    value: float = 0.0
    feature: str | None = None
    place: int = 0
    cut: float = 0.0
    missing_left: bool = True
    left: Node | None = None
    right: Node | None = None

    def sql(self, test) -> str:
        """Nested CASE over the splits; ``test(node)`` is what sends a row left."""
        if self.feature is None:
            return f"{self.value!r}D"
        return f"CASE WHEN {test(self)} THEN {self.left.sql(test)} ELSE {self.right.sql(test)} END"


def binned_test(node: Node) -> str:
    """Bins count the cuts at or below a value; a missing value has bin -1."""
    bin_of = f"`_bin_{node.feature}`"
    return f"{bin_of} < {node.place}" if node.missing_left else f"{bin_of} BETWEEN 0 AND {node.place - 1}"


@dataclass(frozen=True)
class BoostedTrees:
    """The trees of a model; a row's margin is the sum of what its leaves hold."""

    features: tuple[str, ...]
    trees: tuple[Node, ...]

    def with_probability(self, rows: DataFrame, name: str = "probability") -> DataFrame:
        """Add the probability of the class 1, from the feature columns as doubles.

        Trees are walked as arrays in the tasks: as expressions, a hundred of them take longer to plan than
        most tables to score.
        """
        margin = F.pandas_udf(_walk([_flat(t, self.features) for t in self.trees]), "double")
        return rows.withColumn(name, _logistic(margin(*[F.col(f).cast("double") for f in self.features])))

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per tree, in place of what is there."""
        rows = [(i, list(self.features), json.dumps(_nested(t))) for i, t in enumerate(self.trees)]
        frame = spark.createDataFrame(rows, "tree int, features array<string>, nodes string")
        frame.coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        rows = spark.read.parquet(path).orderBy("tree").collect()
        return BoostedTrees(tuple(rows[0].features), tuple(_unnested(json.loads(r.nodes)) for r in rows))


def _nested(node: Node) -> dict:
    if node.feature is None:
        return {"value": node.value}
    own = {k: getattr(node, k) for k in ("feature", "place", "cut", "missing_left")}
    return {**own, "left": _nested(node.left), "right": _nested(node.right)}


def _unnested(stored: dict) -> Node:
    sides = {k: _unnested(stored[k]) for k in ("left", "right") if k in stored}
    return Node(**{**stored, **sides})


def _flat(tree: Node, features: Sequence[str]) -> tuple[np.ndarray, ...]:
    """Feature number (-1 in a leaf), cut, missing goes left, places of both sides and value of each node."""
    nodes, sides = [tree], {}
    for at, node in enumerate(nodes):  # grows while it is walked
        if node.feature is not None:
            sides[at] = (len(nodes), len(nodes) + 1)
            nodes += [node.left, node.right]
    number = [-1 if n.feature is None else list(features).index(n.feature) for n in nodes]
    left, right = zip(*(sides.get(at, (at, at)) for at in range(len(nodes))))
    columns = (number, [n.cut for n in nodes], [n.missing_left for n in nodes], left, right, [n.value for n in nodes])
    return tuple(np.array(c) for c in columns)


def _walk(trees: list[tuple[np.ndarray, ...]]) -> Callable[..., pd.Series]:
    """The sum of the leaves that rows fall into."""

    def margin(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(np.float64, na_value=np.nan) for c in columns])
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for number, cut, missing_left, left, right, value in trees:
            at = np.zeros(len(x), np.int64)
            while (number[at] >= 0).any():
                own = x[rows, number[at]]
                goes_left = (own < cut[at]) | (missing_left[at] & np.isnan(own))
                at = np.where(goes_left, left[at], right[at])  # a leaf is on both its sides
            total += value[at]
        return pd.Series(total)

    return margin


def _summed(terms: Sequence[str]) -> str:
    """A balanced sum, so that the expression is not as deep as there are trees."""
    if not terms:
        return "0D"
    if len(terms) == 1:
        return terms[0]
    half = len(terms) // 2
    return f"({_summed(terms[:half])} + {_summed(terms[half:])})"


def _logistic(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def feature_cuts(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """At most ``bins`` rising cuts for each feature, each the smallest value of a run of nearly equal counts."""
    values = long_form(rows, list(features)).where(F.abs("value") < float("inf"))
    counts = values.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    share = F.floor((F.col("n_cum") - F.col("n")) * F.lit(bins) / F.col("n_total"))
    ranked = running_totals(counts, "value", ["n"], "variable")
    cuts = ranked.groupBy("variable", share.alias("share")).agg(F.min("value").alias("cut")).collect()
    return {f: sorted(r.cut for r in cuts if r.variable == f) for f in features}


def _bin_sql(feature: str, cuts: list[float], low: int, high: int) -> str:
    """Binary search of how many cuts are at or below the value."""
    if low == high:
        return str(low)
    middle = (low + high) // 2
    below, above = _bin_sql(feature, cuts, low, middle), _bin_sql(feature, cuts, middle + 1, high)
    return f"CASE WHEN `{feature}` < {cuts[middle]!r}D THEN {below} ELSE {above} END"


def bin_column(feature: str, cuts: list[float]) -> Column:
    missing = F.col(feature).isNull() | F.isnan(feature)
    return F.when(missing, F.lit(-1)).otherwise(F.expr(_bin_sql(feature, cuts, 0, len(cuts)))).cast("short")


def tree_features(features: Sequence[str], share: float, seed: int, tree: int) -> list[str]:
    """The columns drawn for a tree, one at least, in the order of ``features``."""
    drawn = random.Random(f"{seed}-{tree}").sample(list(features), max(1, int(share * len(features))))
    return [f for f in features if f in drawn]


def sampled(key: Column, share: float, seed: int, tree: int) -> Column:
    """Whether a tree sees the row with this key."""
    return uniform(F.concat_ws("-", F.lit(str(tree)), key), seed) < share


def best_split(gradients: np.ndarray, hessians: np.ndarray) -> tuple[float, int, bool] | None:
    """(gain, place, missing goes left) of one feature in one node, from its sums by bin, missing ones first.

    Rows with a bin below ``place`` go left. Among equal gains the lowest place, then missing to the left.
    """
    g_all, h_all = gradients.sum(), hessians.sum()
    found = []
    for missing_left in (True, False):
        g = np.cumsum(gradients[1:])[:-1] + (gradients[0] if missing_left else 0.0)
        h = np.cumsum(hessians[1:])[:-1] + (hessians[0] if missing_left else 0.0)
        gain = g**2 / (h + LAMBDA) + (g_all - g) ** 2 / (h_all - h + LAMBDA) - g_all**2 / (h_all + LAMBDA)
        gain[(h < MIN_HESSIAN) | (h_all - h < MIN_HESSIAN)] = -1.0
        if len(gain):
            at = int(np.argmax(gain))
            found.append((float(gain[at]), at + 1, missing_left))
    best = max(found, key=lambda f: (f[0], -f[1], f[2]), default=None)
    return best if best and best[0] > 1e-6 else None


def fit_boosted_trees(
    rows: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    weight: Column | None = None,
    trees: int = 100,
    depth: int = 5,
    step: float = 0.05,
    row_share: float = 0.8,
    column_share: float = 0.8,
    seed: int = 42,
    bins: int = BINS,
) -> BoostedTrees:
    """Fit on ``rows``; each tree sees the rows whose ``key`` is drawn for it, and its own draw of columns.

    Missing features (NULL or NaN) go to the side that gains more. Rows without a label take no part; an
    empty table raises ValueError. Equal keys are drawn together.
    """
    doubles = [F.col(f).cast("double").alias(f) for f in features]
    factor = F.lit(1.0) if weight is None else weight
    kept = rows.where(F.col(label).isNotNull()).select(
        F.col(key).cast("string").alias("_key"), F.col(label).cast("double").alias("_y"), factor.alias("_w"), *doubles
    )
    # Every tree reads all rows: they are dealt over the cores, as a small table would be one file and one task.
    kept = written(kept.repartition(kept.sparkSession.sparkContext.defaultParallelism), "boosting-rows")
    size = kept.agg(F.count(F.lit(1)).alias("n"), F.sum("_w").alias("w")).first()
    if not size["n"]:
        raise ValueError("no labelled rows to fit trees on")
    unit = 2.0 ** min(40, 61 - math.ceil(math.log2(size["w"] + size["n"])))
    cuts = feature_cuts(kept, features, bins)
    binned = [bin_column(f, cuts[f]).alias(f"_bin_{f}") for f in features]
    stored = written(kept.select("_key", "_y", "_w", *binned, F.lit(0.0).alias("_margin")), "boosting-bins")
    made: list[Node] = []
    since: list[Node] = []
    for tree in range(trees):
        p = _logistic(F.col("_margin"))
        whole = lambda c: F.floor(c * F.lit(unit) + F.lit(0.5)).cast("long")
        drawn = tree_features(features, column_share, seed, tree)
        seen = with_margins(stored.where(sampled(F.col("_key"), row_share, seed, tree)), since)
        seen = seen.select(
            *[f"_bin_{f}" for f in drawn],
            whole((p - F.col("_y")) * F.col("_w")).alias("_g"),
            whole(p * (F.lit(1.0) - p) * F.col("_w")).alias("_h"),
        )
        few = math.prod(len(cuts[f]) + 2 for f in drawn) <= CELLS
        grown = _grow(_cell_sums(seen, drawn, cuts, unit) if few else _level_sums(seen, drawn, unit), drawn, cuts, depth, step)
        made.append(grown)
        since.append(grown)
        if len(since) == TREES_PER_TABLE:
            stored = written(with_margins(stored, since), "boosting-margins")
            since = []
    return BoostedTrees(tuple(features), tuple(made))


def with_margins(rows: DataFrame, trees: Sequence[Node]) -> DataFrame:
    """Add to ``_margin`` of binned rows what the trees give."""
    return rows.withColumn("_margin", F.expr(_summed(["_margin", *[t.sql(binned_test) for t in trees]])))


#: From the splits so far and the open nodes: {(number of the node, feature): [(bin, gradient, hessian)]}.
Sums = Callable[[dict[str, Node], list[str]], dict]


def _grow(sums_of: Sums, drawn: list[str], cuts: dict, depth: int, step: float) -> Node:
    """One tree, level by level. While it grows a node is named by its path of L and R."""
    splits: dict[str, Node] = {}
    values: dict[str, float] = {}
    open_nodes = [""]
    for _ in range(depth):
        sums = sums_of(splits, open_nodes)
        following = []
        for i, path in enumerate(open_nodes):
            best = None
            for f in drawn:
                g, h = np.zeros(len(cuts[f]) + 2), np.zeros(len(cuts[f]) + 2)
                for bin_of, own_g, own_h in sums.get((i, f), ()):
                    g[bin_of + 1], h[bin_of + 1] = own_g, own_h
                if path == "":
                    values[""] = _leaf(g.sum(), h.sum(), step)
                split = best_split(g, h)
                if split and (best is None or split[0] > best[0]):
                    best = (split[0], f, split[1], split[2], g, h)
            if best is None:
                continue
            _, f, place, missing_left, g, h = best
            # Places count bins, the first of which holds what is below all cuts.
            splits[path] = Node(feature=f, place=place, cut=cuts[f][place - 1], missing_left=missing_left)
            left_g, left_h = g[1 : place + 1].sum(), h[1 : place + 1].sum()
            if missing_left:
                left_g, left_h = left_g + g[0], left_h + h[0]
            values[path + "L"] = _leaf(left_g, left_h, step)
            values[path + "R"] = _leaf(g.sum() - left_g, h.sum() - left_h, step)
            following += [path + "L", path + "R"]
        open_nodes = following
        if not open_nodes:
            break
    return _joined("", splits, values)


def _leaf(g: float, h: float, step: float) -> float:
    return float(-step * g / (h + LAMBDA))


def _joined(path: str, splits: dict[str, Node], values: dict[str, float]) -> Node:
    if path not in splits:
        return Node(value=values.get(path, 0.0))
    sides = {name: _joined(path + name[0].upper(), splits, values) for name in ("left", "right")}
    return replace(splits[path], **sides)


def _numbered(path: str, splits: dict[str, Node], numbers: dict[str, int]) -> str:
    """The number of the open node that a row is in, NULL in a leaf that is done."""
    if path not in splits:
        return str(numbers[path]) if path in numbers else "CAST(NULL AS INT)"
    left, right = _numbered(path + "L", splits, numbers), _numbered(path + "R", splits, numbers)
    return f"CASE WHEN {binned_test(splits[path])} THEN {left} ELSE {right} END"


def _level_sums(seen: DataFrame, drawn: list[str], unit: float) -> Sums:
    """An aggregate over the rows for each level."""

    def sums_of(splits: dict[str, Node], open_nodes: list[str]) -> dict:
        where = _numbered("", splits, {path: i for i, path in enumerate(open_nodes)})
        return _histogram(seen, where, drawn, unit)

    return sums_of


def _histogram(seen: DataFrame, where: str, drawn: list[str], unit: float | None) -> dict:
    """{(node, feature): [(bin, gradient, hessian)]}, the sums as whole numbers without a unit."""
    names = ", ".join(f"{i}, `_bin_{f}`" for i, f in enumerate(drawn))
    rows = (
        seen.withColumn("_node", F.expr(where))
        .where("_node IS NOT NULL")
        .selectExpr("_node", "_g", "_h", f"stack({len(drawn)}, {names}) AS (_f, _b)")
        .groupBy("_node", "_f", "_b")
        .agg(F.sum("_g").alias("g"), F.sum("_h").alias("h"))
    )
    sums: dict = {}
    for r in rows.collect():
        g, h = (r["g"] / unit, r["h"] / unit) if unit else (r["g"], r["h"])
        sums.setdefault((r["_node"], drawn[r["_f"]]), []).append((r["_b"], g, h))
    return sums


def _cell_sums(seen: DataFrame, drawn: list[str], cuts: dict, unit: float) -> Sums:
    """One aggregate over the rows, by the number of their cell; levels add up cells."""
    sizes = [len(cuts[f]) + 2 for f in drawn]
    number = "0"
    for f, size in zip(drawn, sizes):
        number = f"({number} * {size} + `_bin_{f}` + 1)"
    found = _histogram(seen.selectExpr(f"{number} AS `_bin__cell`", "_g", "_h"), "0", ["_cell"], None)
    cell, g_of, h_of = (np.array(c, np.int64) for c in zip(*sorted(found.get((0, "_cell"), [(0, 0, 0)]))))
    bins = {f: b - 1 for f, b in zip(drawn, np.unravel_index(cell, sizes))}

    def inside(path: str, splits: dict[str, Node]) -> np.ndarray:
        """The cells of a node."""
        if path == "":
            return np.arange(len(cell))
        own, node = inside(path[:-1], splits), splits[path[:-1]]
        bin_of = bins[node.feature][own]
        left = bin_of < node.place
        if not node.missing_left:
            left &= bin_of >= 0
        return own[left if path[-1] == "L" else ~left]

    def sums_of(splits: dict[str, Node], open_nodes: list[str]) -> dict:
        sums = {}
        for i, path in enumerate(open_nodes):
            own = inside(path, splits)
            for f in drawn:
                values, place = np.unique(bins[f][own], return_inverse=True)
                g, h = np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
                np.add.at(g, place, g_of[own])
                np.add.at(h, place, h_of[own])
                sums[(i, f)] = list(zip(values.tolist(), (g / unit).tolist(), (h / unit).tolist()))
        return sums

    return sums_of
