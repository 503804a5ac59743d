"""Fit of the quality ranking: every labelled document and every pair, in the driver's process or by tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadcast.llm import quality
from loadcast.llm.textbytes import slices

WORDS = "the of and meter load price winter forecast hour day grid Peak 2024 !! ** buy now free".split()


def corpus(spark, n):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(n):
        some = rng.choice(WORDS[:14] if k % 3 else WORDS, rng.integers(1, 60))
        rows.append((k, ("\n" if k % 5 else " ").join(some) if k % 50 else None, int(k % 3 != 0 or rng.random() < 0.2)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, quality int").repartition(5)
    return df.select("doc_id", "text"), df.select("doc_id", "quality", F.lit(0).alias("toxic")), rows


def by_pairs(spark, docs, labels):
    """Features, labels and weights by the definition: a difference of columns for every pair."""
    table = docs.filter(~quality.held_out()).join(labels, "doc_id").orderBy("doc_id").select("doc_id", "text", "quality").toArrow()
    raw = np.concatenate([quality.features(d, o) for b in table.to_batches() for _, _, d, o in slices(b, "text")])
    good = np.array(table.column("quality").to_pylist()) == 1
    edges = np.quantile(raw, np.arange(1, quality.BINS) / quality.BINS, axis=0)
    x = quality.Ranker(edges, raw.mean(axis=0), raw.std(axis=0) + 1e-9, np.zeros(0), 0.0).design(raw)
    d = (x[good][:, None, :] - x[~good][None]).reshape(-1, x.shape[1])
    share, w = quality.PAIRS / len(d), np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-d @ w))
        w = w + np.linalg.solve(share * (d * (p * (1 - p))[:, None]).T @ d + 2 * np.eye(len(w)), share * (d.T @ (1 - p)) - 2 * w)
    return edges, w, np.quantile(x @ w, (~good).mean())


@pytest.mark.parametrize("held", [quality.HELD, 0])
def test_training_takes_every_label_and_every_pair(spark, held):
    docs, labels, _ = corpus(spark, 240)
    model = quality.train(docs, labels, held=held)
    edges, weights, threshold = by_pairs(spark, docs, labels)
    assert model.edges == pytest.approx(edges, rel=1e-12, abs=1e-12)
    assert np.abs(weights).max() > 0.5 and model.weights == pytest.approx(weights, abs=1e-7)
    assert model.threshold == pytest.approx(threshold, abs=1e-6)


def test_no_label_is_beyond_a_limit(spark):
    """More labelled documents than the learner once took: each of them moves the statistics of the features."""
    n = 33_000
    ids = spark.range(n, numPartitions=4).withColumnRenamed("id", "doc_id")
    docs = ids.withColumn("text", F.concat(F.lit("word "), F.expr("repeat('ab ', int(doc_id % 7))"), F.when(F.col("doc_id") % 4 == 0, "!!").otherwise("ok")))
    labels = ids.select("doc_id", (F.col("doc_id") % 4 != 0).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    model = quality.train(docs, labels)
    rows = docs.filter(~quality.held_out()).toArrow()
    raw = np.concatenate([quality.features(d, o) for b in rows.to_batches() for _, _, d, o in slices(b, "text")])
    assert len(raw) > quality.HELD
    assert model.centre == pytest.approx(raw.mean(axis=0), rel=1e-9) and model.scale == pytest.approx(raw.std(axis=0) + 1e-9, rel=1e-6, abs=1e-12)
    assert model.edges == pytest.approx(np.quantile(raw, np.arange(1, 10) / 10, axis=0), rel=1e-12)
    wrong = quality.score(docs, model).join(labels, "doc_id").filter("predicted != quality")
    assert wrong.isEmpty()


def test_series_of_the_sigmoid():
    at = np.array([-300.0, -20.0, -1.0, 0.0, 0.5, 7.0, 300.0])
    got = quality._series(at)
    for h in (-0.25, 0.1, 0.25):
        want = 1 / (1 + np.exp(-(at + h)))
        assert sum(got[k] * h**k for k in range(quality.ORDER + 1)) == pytest.approx(want, rel=1e-13, abs=1e-15)
