"""Leaf-wise boosting against a plain Python version, and its defined cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadcast.plans import boosting, ml

SCHEMA = "id int, a double, b double, c double, y double"


def _rows(n, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rnd.uniform(0, 9), float(rnd.randrange(4)), rnd.uniform(-1, 1)
        y = (3 if a > 4 else -1) + (5 if b == 2 and a > 6 else 0) + c * c
        out.append((i, None if rnd.random() < .2 else a, float("nan") if rnd.random() < .1 else b, c, y + (2 if i % 5 == 0 else 0)))
    return out


def _plain_tree(x, g, max_leaves, min_rows):
    """Best-first tree by trying every threshold of every feature: list of (feature, bin, missing_left, rows), and leaf masks."""
    def best(mask):
        n, s, found = int(mask.sum()), int(g[mask].sum()), None
        for f in range(x.shape[1]):
            for b in sorted(set(x[mask, f].tolist())):
                for ml in (False, True):
                    left = mask & (x[:, f] <= b) & (ml | (x[:, f] > 0))
                    nl, sl = int(left.sum()), int(g[left].sum())
                    if nl < min_rows or n - nl < min_rows:
                        continue
                    gain = float(sl) * float(sl) / nl + float(s - sl) * float(s - sl) / (n - nl) - float(s) * float(s) / n
                    key = (-gain, f, b, ml)
                    if gain > 0 and (found is None or key < found[0]):
                        found = (key, left)
        return found

    leaves, splits = [(np.ones(len(x), dtype=bool))], []
    known = [best(leaves[0])]
    while len(leaves) < max_leaves and any(known):
        at = min((i for i in range(len(known)) if known[i]), key=lambda i: (known[i][0][0], i))
        (_, f, b, ml), left = known[at]
        mask = leaves[at]
        splits.append((f, b, ml, int(mask.sum())))
        for part in (left, mask & ~left):
            leaves.append(part)
            known.append(best(part))
        del leaves[at], known[at]
    return splits, leaves


@pytest.mark.parametrize("max_leaves", [2, 7])
def test_trees_equal_the_plain_version(spark, max_leaves):
    df = spark.createDataFrame(_rows(300), SCHEMA).repartition(5)
    edges = boosting.bin_edges(df, ["a", "b", "c"], 12)
    model = boosting.fit(df, ["a", "b", "c"], "y", rounds=6, max_leaves=max_leaves, step=.3, column_share=1.0, min_rows=5, edges=edges, unit=2.0 ** -20)
    got = df.select("y", boosting.binned(edges, ["a", "b", "c"]).alias("x")).toPandas()
    x, y, unit = np.stack(got.x), got.y.to_numpy(), 2.0 ** -20
    f = np.full(len(y), int(np.floor(y / unit + .5).sum()) / len(y) * unit)
    for tree in model.trees:
        g = (np.sign(f - y) * np.floor(np.abs(f - y) / unit + .5)).astype(np.int64)
        splits, leaves = _plain_tree(x, g, max_leaves, 5)
        assert sorted(splits) == sorted((s[0], s[1], s[2], tree.rows[n]) for n, s in tree.splits.items())
        assert len(tree.values) == len(leaves) <= max_leaves
        for m in leaves:
            f[m] += -int(g[m].sum()) / int(m.sum()) * unit * .3
    said = model.predict(df).toPandas().prediction.to_numpy()
    order = df.toPandas().y.to_numpy()
    assert np.allclose(np.sort(said - order), np.sort(f - y))
    assert ((said - order) ** 2).mean() < ((order - order.mean()) ** 2).mean()


def test_bins_and_missing_values(spark):
    df = spark.createDataFrame([(1, None, 0.0, 1.0, 1.0), (2, float("nan"), -math.inf, 1.0, 1.0), (3, 1.0, math.inf, 1.0, 1.0),
                                (4, 2.0, 3.0, 1.0, 1.0)], SCHEMA)
    edges = boosting.bin_edges(df, ["a", "b", "c"], 4, equal_width=True)
    assert edges == {"a": [1.25, 1.5, 1.75], "b": [.75, 1.5, 2.25], "c": []}
    got = [r.x for r in df.orderBy("id").select(boosting.binned(edges, ["a", "b", "c"]).alias("x")).collect()]
    assert got == [[0, 1, 1], [0, 1, 1], [1, 4, 1], [4, 4, 1]]


def test_missing_side_is_learned(spark):
    rows = [(i, None if i % 2 else float(i % 7), 0.0, 0.0, 9.0 if i % 2 or i % 7 > 4 else 0.0) for i in range(140)]
    model = boosting.fit(spark.createDataFrame(rows, SCHEMA), ["a"], "y", rounds=1, max_leaves=2, step=1.0, column_share=1.0)
    assert [(s[0], s[2]) for s in model.trees[0].splits.values()] == [(0, False)]  # missing rows go right, to the large values
    assert model.predict(spark.createDataFrame(rows, SCHEMA)).filter(F.abs(F.col("prediction") - F.col("y")) > 1e-6).isEmpty()


def test_stop_ends_the_fit_and_models_are_saved(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(i, rnd.random(), rnd.random(), rnd.random(), rnd.random()) for i in range(300)]  # noise: more trees only hurt
    df = spark.createDataFrame(rows, SCHEMA)
    model = boosting.fit(df, ["a", "b", "c"], "y", valid=F.col("id") % 3 == 0, rounds=200, max_leaves=8, step=.5, min_rows=2, patience=3)
    best = min(range(len(model.errors)), key=lambda k: (model.errors[k], k))
    assert len(model.errors) == best + 4 < 100 and len(model.trees) == best
    fitted = boosting.fit(df, ["a", "b", "c"], "y", rounds=5, max_leaves=4, min_rows=2)
    assert not fitted.errors and len(fitted.trees) == 5
    assert any(len({s[0] for s in t.splits.values()}) <= 3 for t in fitted.trees)
    fitted.save(str(tmp_path / "m"))
    again = boosting.Boosted.load(str(tmp_path / "m"))
    assert again == fitted
    assert again.predict(df).exceptAll(fitted.predict(df)).isEmpty()


def test_defined_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = boosting.fit(empty, ["a", "b"], "y", rounds=3)
    assert model.trees == [] and model.predict(empty).isEmpty()
    odd = spark.createDataFrame([(1, 1.0, None, None, None), (2, 2.0, None, None, float("nan")), (3, None, None, None, 4.0),
                                 (4, 1.0, None, None, 4.0)], SCHEMA)
    model = boosting.fit(odd, ["a", "b"], "y", rounds=2, min_rows=1)
    assert [r.prediction for r in model.predict(odd.withColumn("x", F.lit("kept"))).collect()] == [4.0] * 4
    assert model.predict(odd.withColumn("x", F.lit("kept")), "y").columns == [*odd.columns, "x"]
    assert boosting.fit(odd, [], "y", rounds=2).predict(odd).first().prediction == 4.0


def test_labels_are_ranked_without_the_driver(spark):
    rnd = random.Random(5)
    rows = [(i, None if i % 7 == 0 else f"k{rnd.randrange(5000)}", "hot" if i % 3 else f"z{i % 4}", i % 2 == 0) for i in range(6000)]
    df = spark.createDataFrame(rows, "id int, a string, `b.c` string, d boolean").withColumn("a_code", F.lit("old")).repartition(7)
    cats = ["a", "b.c", "d"]
    dictionary = ml.label_dictionary(df, cats)
    want = {c: sorted({str(r[i]).lower() if c == "d" else r[i] for r in rows if r[i] is not None}) for i, c in enumerate(cats, 1)}
    assert sorted(map(tuple, dictionary.collect())) == sorted((c, x, k) for c in cats for k, x in enumerate(want[c]))
    got = {r.id: r for r in ml.encode_labels(df, dictionary, cats).collect()}
    code = {c: {x: k for k, x in enumerate(want[c])} for c in cats}
    assert len(got) == len(rows)
    for i, a, b, d in rows:
        assert got[i]["a_code"] == code["a"].get(a, len(want["a"])) and got[i]["b.c_code"] == code["b.c"][b] and got[i]["d_code"] == int(d)
    new = spark.createDataFrame([(1, "never", "hot", None)], "id int, a string, `b.c` string, d boolean")
    r = ml.encode_labels(new, dictionary, cats).first()
    assert (r["a_code"], r["b.c_code"], r["d_code"]) == (len(want["a"]), code["b.c"]["hot"], 2)
    assert ml.label_dictionary(df.limit(0), cats).isEmpty() and ml.label_dictionary(df, []).isEmpty()
    assert ml.encode_labels(df.limit(0), dictionary, cats).isEmpty()
