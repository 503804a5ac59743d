"""Hard negatives against brute force: odd rows, copies, ties, many rounds and blocks, large values."""

import math

import numpy as np
import pytest

from loadcast.llm import negatives
from loadcast.llm.negatives import Book, k_means, multi_sequence

SCHEMA = "vec_id bigint, embedding array<double>, label int, score bigint, cls string"


def brute(rows, every=50, positives=5, negatives_=3, low=50, high=95, scale=256.0):
    usable = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((i, tuple(math.floor(scale * x) for x in v), label))
    out = []
    place = lambda i: (i is None, i or 0)
    for k, (i, v, label) in enumerate(usable):
        if i is None or i % every:
            continue
        near = []
        for n, (j, w, other) in enumerate(usable):
            if n != k and len(w) == len(v):
                s = max(-(1 << 62), min(1 << 62, sum(a * b for a, b in zip(v, w))))
                near.append((-s, place(j), n, j, other))
        near.sort()
        for s, _, _, j, other in [r for r in near if r[4] == label][:positives]:
            rank = 0
            for t, _, _, m, o in near:
                if o != label and low * -s <= 100 * -t <= high * -s and rank < negatives_:
                    rank += 1
                    out.append((i, j, rank, m, -s, -t))
    return sorted(out, key=str)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(3)
    got = negatives.hard_negatives(df, **options).collect()
    return sorted((tuple(r) for r in got), key=str)


def clustered(n, dim, seed, spread=0.1):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(8, dim))
    x = centre[rng.integers(0, 8, n)] + spread * rng.normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True), rng


def test_clusters_over_many_rounds_and_blocks(spark):
    x, rng = clustered(600, 8, 1)
    rows = [(int(i), x[i].tolist(), int(rng.integers(0, 4))) for i in range(600)]
    assert mined(spark, rows, first_rows=5, block=64, past=3) == brute(rows)


def test_odd_rows_and_copies(spark):
    x, rng = clustered(60, 6, 2, 0.4)
    rows = [(int(i) * 10, x[i].tolist(), int(rng.integers(0, 3))) for i in range(60)]
    rows += [(1000 + k, x[5].tolist(), 1) for k in range(40)]                     # copies, one label and another
    rows += [(2000 + 50 * k, x[5].tolist(), 2) for k in range(9)]
    rows += [(100, x[7].tolist(), 0), (100, x[7].tolist(), 0), (100, x[9].tolist(), 1)]  # a repeated id
    rows += [(None, x[3].tolist(), 0), (None, x[3].tolist(), 0), (None, None, 1), (350, None, 1), (400, x[1].tolist(), None)]
    rows += [(450, [None] * 6, 1), (500, [float("nan")] * 6, 1), (550, [float("inf")] + [0.0] * 5, 1), (3000, [0.0] * 6, 1), (3050, [0.0] * 6, 2)]
    rows += [(4000 + k, [], k % 2) for k in range(4)] + [(5000 + 25 * k, [0.5 * k - 1], k % 2) for k in range(8)]
    rows += [(6000 + 10 * k, [1.0, 0.25 * k], k % 3) for k in range(12)]
    assert mined(spark, rows, first_rows=4, block=16) == brute(rows)


def test_large_values_stay_whole_numbers(spark):
    rng = np.random.default_rng(4)
    rows = [(50 * k, (rng.normal(size=4) * 10.0 ** float(rng.integers(0, 9))).tolist(), int(k % 2)) for k in range(40)]
    rows += [(50 * k, [1e30 * k, -1e29, 3.0, 1.0], k % 2) for k in range(60, 66)]
    assert mined(spark, rows) == brute(rows)


def test_empty_tables(spark):
    assert negatives.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mined(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 1)]) == []  # no anchor
    assert mined(spark, [(50, [1.0, 2.0], 0)]) == []


def test_multi_sequence_is_ordered_and_whole():
    rng = np.random.default_rng(0)
    for n, m in ((1, 1), (1, 7), (6, 1), (9, 12)):
        a, b = rng.integers(0, 9, n).astype(float), rng.integers(0, 9, m).astype(float)
        pairs = list(multi_sequence(a, b))
        assert sorted(pairs) == [(i, j) for i in range(n) for j in range(m)]
        sums = [a[i] + b[j] for i, j in pairs]
        assert sums == sorted(sums, reverse=True)


def test_bounds_hold_and_exclude_cells():
    x, _ = clustered(2000, 16, 7, 0.03)
    x = np.floor(256 * x)
    book = Book(16, [k_means(x[:, :8], 8), k_means(x[:, 8:], 8)])
    near, far = book.assign(x)
    for h in (0, 1):
        np.maximum.at(book.radius[h], near[h], far[h])
    excluded = 0
    for a in x[:20]:
        (h1, h2), (l1, l2) = book.bounds(a)
        score = x @ a
        assert (score <= h1[near[0]] + h2[near[1]]).all() and (score >= l1[near[0]] + l2[near[1]]).all()
        excluded += (h1[near[0]] + h2[near[1]] < np.sort(score)[-6]).mean()
    assert excluded / 20 > 0.5


def test_registered_query_columns(spark):
    from loadcast.llm import queries
    got = queries.QUERIES["op12_inverted_multi_index"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert [t for _, t in got.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    src = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
           for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(src)
