"""Leaf-wise gradient boosting on binned features: every histogram is a grouped sum, and the driver sees one row per tree node.

A feature's values become bins once (``bin_edges``, ``binned``): 0 for NULL and NaN, then 1, 2, ... between ascending edges. A round
takes the gradient of the squared error as a whole number of ``unit`` steps, so that its sums are the same whatever the
partitions, and a task computed again after a lost executor changes nothing. ``grow`` splits the leaf of greatest gain first, up to
``max_leaves``. As the gain of a leaf depends on its own rows only, the leaves that may be split next are measured together: one
job sums (node, feature, bin), scans the bins in order with the missing ones on either side, and returns the best
split per node. A tree costs about as many jobs as it is deep, not one per split.

``fit`` adds trees until ``rounds`` or until the validation error has not improved for ``patience`` rounds; then no further tree is fitted.
Scores are checkpointed every ``CUT`` rounds to ``spark.checkpoint.dir``.

Defined cases: rows with a NULL, NaN or infinite target or a NULL ``valid`` flag take no part in a fit; no such rows give a model that predicts 0; a
feature without values or with one value never splits; infinite feature values fall into the outer bins; ties of gain go to the smallest feature
position, then bin, then to missing values on the right; among leaves, to the one made first; columns of any other
name pass through ``predict``, and a column named like the output is replaced."""

from __future__ import annotations

import heapq
import math
import random
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadcast.session import ensure_checkpoint_dir

CUT = 4             # rounds between two checkpoints of the scores
RESOLUTION = 30     # bits of the largest first gradient; sums stay exact up to 2**(62 - RESOLUTION) rows

# node -> (feature, bin, missing_left, left node, right node); a leaf has a value instead
Split = tuple[int, int, bool, int, int]


@dataclass
class Tree:
    splits: dict[int, Split]
    values: dict[int, float]                           # leaf -> value, shrinkage included
    gains: dict[int, float] = field(default_factory=dict)
    rows: dict[int, int] = field(default_factory=dict)  # rows of each node


@dataclass
class Boosted:
    """A fitted model. ``errors``: mean absolute validation error after 0, 1, 2, ... trees (empty without such rows)."""

    features: list[str]
    edges: dict[str, list[float]]
    base: float
    trees: list[Tree]
    errors: list[float] = field(default_factory=list)

    def predict(self, df: DataFrame, output: str = "prediction", rounds: int | None = None) -> DataFrame:
        """``df`` with ``output``. The trees travel with the tasks (at most rounds x leaves nodes, whatever the rows)."""
        tables = [_table(t) for t in self.trees[:rounds]]
        base = self.base

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            out = np.full(len(x), base)
            if len(x):
                bins = np.stack(x.to_numpy())
                for feature, cut, missing_left, left, right, value in tables:
                    at = np.zeros(len(x), dtype=np.int64)
                    while True:
                        f = feature[at]
                        inner = f >= 0
                        if not inner.any():
                            break
                        b = bins[np.arange(len(x)), np.maximum(f, 0)]
                        goes = np.where((b <= cut[at]) & ((b > 0) | missing_left[at]), left[at], right[at])
                        at = np.where(inner, goes, at)
                    out += value[at]
            return pd.Series(out)

        return df.withColumn(output, score(binned(self.edges, self.features)))

    def save(self, path: str) -> None:
        """ACTION: one row per tree node, and one row of edges and errors, as Parquet under ``path``."""
        spark = SparkSession.active()
        rows = []
        for number, t in enumerate(self.trees):
            rows += [(number, n, *s, None, t.gains.get(n), t.rows.get(n)) for n, s in t.splits.items()]
            rows += [(number, n, None, None, None, None, None, v, None, t.rows.get(n)) for n, v in t.values.items()]
        spark.createDataFrame(rows, _NODES).write.mode("overwrite").parquet(f"{path}/nodes")
        about = (self.features, [self.edges[c] for c in self.features], self.base, len(self.trees), self.errors)
        spark.createDataFrame([about], _ABOUT).coalesce(1).write.mode("overwrite").parquet(f"{path}/about")

    @classmethod
    def load(cls, path: str) -> Boosted:
        """ACTION: a saved model (its nodes are the driver's by definition: rounds x leaves)."""
        spark = SparkSession.active()
        about = spark.read.parquet(f"{path}/about").first()
        trees = [Tree({}, {}) for _ in range(about["n_trees"])]
        for r in spark.read.parquet(f"{path}/nodes").collect():
            t = trees[r["tree"]]
            if r["value"] is None:
                t.splits[r["node"]] = (r["feature"], r["bin"], r["missing_left"], r["left"], r["right"])
            else:
                t.values[r["node"]] = r["value"]
            if r["gain"] is not None:
                t.gains[r["node"]] = r["gain"]
            if r["n"] is not None:
                t.rows[r["node"]] = r["n"]
        return cls(list(about["features"]), dict(zip(about["features"], map(list, about["edges"]))), about["base"], trees,
                   list(about["errors"]))


_NODES = ("tree int, node int, feature int, bin int, missing_left boolean, left int, right int, value double, gain double, n bigint")
_ABOUT = "features array<string>, edges array<array<double>>, base double, n_trees int, errors array<double>"


def _table(tree: Tree) -> tuple[np.ndarray, ...]:
    """A tree as arrays by node number; leaves have feature -1. Nodes that were measured but not kept have no place."""
    number = {n: i for i, n in enumerate(sorted([*tree.splits, *tree.values]))}  # the root, 0, comes first
    feature, cut, left, right = (np.full(len(number), -1, dtype=np.int64) for _ in range(4))
    missing, value = np.zeros(len(number), dtype=bool), np.zeros(len(number))
    for n, (f, b, ml, lo, hi) in tree.splits.items():
        i = number[n]
        feature[i], cut[i], missing[i], left[i], right[i] = f, b, ml, number[lo], number[hi]
    for n, v in tree.values.items():
        value[number[n]] = v
    return feature, cut, missing, left, right, value


def _missing(c: str) -> Column:
    v = F.col(f"`{c}`").cast("double")
    return v.isNull() | F.isnan(v)


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = 255, equal_width: bool = False, accuracy: int = 10_000) -> dict[str, list[float]]:
    """ACTION (one aggregate over all rows): ascending inner edges per feature, at most ``bins - 1``: approximate quantiles, or
    equal steps between the smallest and the largest finite value."""
    known = {c: F.when(~_missing(c) & (F.abs(F.col(f"`{c}`").cast("double")) < math.inf), F.col(f"`{c}`").cast("double")) for c in features}
    if equal_width:
        wanted = [F.array(F.min(v), F.max(v)) for v in known.values()]
    else:
        wanted = [F.percentile_approx(v, [k / bins for k in range(1, bins)], accuracy) for v in known.values()]
    if not wanted:
        return {}
    found = df.agg(*[w.alias(f"e{i}") for i, w in enumerate(wanted)]).first()
    edges = {}
    for c, at in zip(features, found):
        if at is None or at[0] is None:
            edges[c] = []
        elif equal_width:
            lo, hi = at
            edges[c] = sorted({lo + (hi - lo) * k / bins for k in range(1, bins)}) if lo < hi else []
        else:
            edges[c] = sorted(set(at))
    return edges


def binned(edges: dict[str, list[float]], features: Sequence[str]) -> Column:
    """Array of the features' bins: 0 missing, else 1 + the number of edges below the value (binary search)."""
    out = []
    for c in features:
        v, some = F.col(f"`{c}`").cast("double"), edges[c]
        if not some:
            at = F.lit(1)
        else:
            places = F.expr("array({})".format(", ".join(f"{e!r}D" for e in some)))
            steps = F.expr("array({})".format(", ".join(str(1 << i) for i in reversed(range(len(some).bit_length())))))
            at = 1 + F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(places, n + step - 1) < v, n + step).otherwise(n))
        out.append(F.when(_missing(c), 0).otherwise(at).cast("int"))
    return F.array(*out)


def _goes_left(split: Split) -> Column:
    at = F.col("x")[split[0]]
    return (at <= split[1]) if split[2] else ((at <= split[1]) & (at > 0))


def _walk(splits: dict[int, Split], leaf, node: int = 0) -> Column:
    """``leaf(node)`` of the leaf a row's bins lead to."""
    if node not in splits:
        return leaf(node)
    s = splits[node]
    return F.when(_goes_left(s), _walk(splits, leaf, s[3])).otherwise(_walk(splits, leaf, s[4]))


def best_splits(rows: DataFrame, features: Sequence[int], l2: float, min_rows: int) -> DataFrame:
    """``rows(node, x, g)`` to the best split of each node: ``node, best``, a struct of loss (the negative gain), feature, bin,
    missing_left, n_left, s_left, n, s. Partial sums run before the shuffle, which moves nodes x features x bins rows."""
    cells = rows.select("node", "g", F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col("x")[f].alias("bin")) for f in features])).alias("c")) \
        .groupBy("node", "c.feature", "c.bin").agg(F.count("*").alias("n"), F.sum("g").alias("s"))
    whole = Window.partitionBy("node", "feature")
    so_far = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lost = [F.sum(F.when(F.col("bin") == 0, F.col(c)).otherwise(0)).over(whole) for c in ("n", "s")]
    summed = cells.select("node", "feature", "bin", F.sum("n").over(whole).alias("n"), F.sum("s").over(whole).alias("s"),
                          F.sum("n").over(so_far).alias("cn"), F.sum("s").over(so_far).alias("cs"), lost[0].alias("mn"), lost[1].alias("ms"))
    sides = F.array(F.struct(F.lit(False).alias("missing_left"), (F.col("cn") - F.col("mn")).alias("n_left"), (F.col("cs") - F.col("ms")).alias("s_left")),
                    F.struct(F.lit(True).alias("missing_left"), F.col("cn").alias("n_left"), F.col("cs").alias("s_left")))

    def part(s: Column, n: Column) -> Column:
        return s.cast("double") * s.cast("double") / (n + F.lit(float(l2)))

    tried = summed.select("node", "feature", "bin", "n", "s", F.inline(sides)) \
        .filter((F.col("n_left") >= min_rows) & (F.col("n") - F.col("n_left") >= min_rows))
    gain = part(F.col("s_left"), F.col("n_left")) + part(F.col("s") - F.col("s_left"), F.col("n") - F.col("n_left")) - part(F.col("s"), F.col("n"))
    return tried.withColumn("loss", -gain).filter("loss < 0").groupBy("node").agg(
        F.min(F.struct("loss", "feature", "bin", "missing_left", "n_left", "s_left", "n", "s")).alias("best"))


def grow(rows: DataFrame, features: Sequence[int], max_leaves: int, l2: float, min_rows: int, totals: tuple[int, int]) -> Tree:
    """ACTION. ``rows(x, g)`` to a tree; its leaf values are the mean negative gradient with ``l2``, in gradient steps. ``totals``: number of
    rows and sum of ``g``. The open leaves of greatest gain, as many as the tree may still split, get their children measured in one job."""
    expanded: dict[int, Split] = {}
    best: dict[int, object] = {}
    stats = {0: totals}
    todo = [0] if max_leaves > 1 else []
    while True:
        if todo:
            wanted = set(todo)
            node = _walk(expanded, lambda n: F.lit(n if n in wanted else None).cast("int"))
            found = best_splits(rows.withColumn("node", node).filter("node is not null"), features, l2, min_rows).collect()  # a row per node
            best.update(dict.fromkeys(todo))
            best.update({r["node"]: r["best"] for r in found})
        kept: dict[int, Split] = {}
        heap = [(best[0].loss, 0)] if best.get(0) else []
        while heap and len(kept) < max_leaves - 1 and heap[0][1] in expanded:
            n = heapq.heappop(heap)[1]
            kept[n] = expanded[n]
            for child in expanded[n][3:]:
                if best[child]:
                    heapq.heappush(heap, (best[child].loss, child))
        if heap and len(kept) == max_leaves - 2:  # the last split: its children need no measuring
            b, n = best[heap[0][1]], heap[0][1]
            lo, hi = len(stats), len(stats) + 1
            kept[n] = (b.feature, b.bin, b.missing_left, lo, hi)
            stats[lo], stats[hi] = (b.n_left, b.s_left), (b.n - b.n_left, b.s - b.s_left)
            break
        if not heap or len(kept) == max_leaves - 1:
            break
        # children by their parent's place: the same numbers whatever order the jobs ran in
        todo = []
        for _, n in heapq.nsmallest(max_leaves - 1 - len(kept), heap):
            if n not in expanded:
                b = best[n]
                lo, hi = len(stats), len(stats) + 1
                expanded[n] = (b.feature, b.bin, b.missing_left, lo, hi)
                stats[lo], stats[hi] = (b.n_left, b.s_left), (b.n - b.n_left, b.s - b.s_left)
                todo += [lo, hi]
    leaves = {c for s in kept.values() for c in s[3:]} - set(kept) or {0}
    values = {n: -stats[n][1] / (stats[n][0] + l2) if stats[n][0] else 0.0 for n in leaves}
    return Tree(kept, values, {n: -best[n].loss for n in kept}, {n: stats[n][0] for n in [*kept, *leaves]})


def fit(df: DataFrame, features: Sequence[str], target: str, valid: Column | None = None, rounds: int = 1000, max_leaves: int = 63,
        step: float = 0.03, column_share: float = 0.8, l2: float = 0.0, min_rows: int = 20, patience: int = 100, bins: int = 255,
        seed: int = 42, edges: dict[str, list[float]] | None = None, unit: float | None = None) -> Boosted:
    """ACTION. Fit ``target`` on the rows where ``valid`` is false (all, without it); the rows where it is true judge each round. The
    model is cut to the trees of the least validation error (the earliest of ties). ``edges``: bins of the features, by default
    quantiles of the fitted rows. ``unit``: a gradient step, by default the power of two that gives the largest first gradient ``RESOLUTION`` bits."""
    ensure_checkpoint_dir(df.sparkSession)
    y = F.col(f"`{target}`").cast("double")
    usable = df.filter(y.isNotNull() & ~F.isnan(y) & (F.abs(y) < math.inf))
    flag = F.lit(False) if valid is None else valid
    features = list(features)
    edges = edges if edges is not None else bin_edges(usable.filter(~flag), features, bins)
    state = usable.select(binned(edges, features).alias("x"), y.alias("y"), flag.alias("valid")).filter("valid is not null")
    state = state.checkpoint()
    # the mean of whole steps: the same whatever order the rows are summed in
    about = state.filter("not valid").agg(F.count("*").alias("n"), F.max(F.abs("y")).alias("top")).first()
    if not about["n"]:
        return Boosted(features, edges, 0.0, [])
    if unit is None:
        unit = 2.0 ** (math.frexp(about["top"] or 1.0)[1] + 1 - RESOLUTION)
    base = state.filter("not valid").agg(F.sum(F.round(F.col("y") / unit).cast("bigint"))).first()[0] / about["n"] * unit
    state = state.withColumn("f", F.lit(base)).persist(StorageLevel.MEMORY_AND_DISK)
    held = [state]
    model, errors, best = Boosted(features, edges, base, []), [], 0

    def judged(s: DataFrame):
        """Rows and gradient steps of the fit, and the mean error of the validation rows (rounded sums of whole steps)."""
        g = F.round((F.col("f") - F.col("y")) / unit).cast("bigint")
        return s.agg(F.sum(F.when(~F.col("valid"), g)).alias("s"), (F.sum(F.when(F.col("valid"), F.abs(g))) / F.count_if("valid") * unit).alias("mae")).first()

    for number in range(rounds + 1):
        now = judged(state)
        if now["mae"] is not None:
            errors.append(now["mae"])
            best = best if errors[best] <= errors[-1] else number
            if number - best >= patience:
                break
        if number == rounds:
            break
        chosen = sorted(random.Random(seed * 1_000_003 + number).sample(range(len(features)), math.ceil(column_share * len(features))))
        grads = state.filter("not valid").select("x", F.round((F.col("f") - F.col("y")) / unit).cast("bigint").alias("g"))
        if not chosen:
            break
        tree = grow(grads, chosen, max_leaves, l2, min_rows, (about["n"], now["s"]))
        tree.values = {n: v * unit * step for n, v in tree.values.items()}
        model.trees.append(tree)
        state = state.withColumn("f", F.col("f") + _walk(tree.splits, lambda n: F.lit(tree.values[n])))
        if (number + 1) % CUT == 0:
            state = state.checkpoint().persist(StorageLevel.MEMORY_AND_DISK)
            held.append(state)
            while len(held) > 1:
                held.pop(0).unpersist()
    for s in held:
        s.unpersist()
    model.errors = errors
    if errors:
        model.trees = model.trees[:best]
    return model


def splits_table(spark: SparkSession, model: Boosted) -> DataFrame:
    """Inner nodes of a model: ``tree, node, feature`` (its name), ``bin, missing_left, n``, from the root down."""
    rows = [(i, n, model.features[s[0]], s[1], s[2], t.rows[n]) for i, t in enumerate(model.trees) for n, s in sorted(t.splits.items())]
    return spark.createDataFrame(rows, "tree int, node int, feature string, bin int, missing_left boolean, n bigint")
