"""Connected components of an edge table by contraction, without collecting edges or nodes.

Every round points each node at its smallest neighbour, follows the pointers to their roots
(pointer doubling; pointers only go to smaller ids, so they form a forest), renames the edge ends to
the roots and drops loops. A star is done in one round, a path in one round of log(n) doublings.
Each step is a grouped minimum (partial aggregation) or an equi-join on a column that is unique
on one side, and is written to the shared folder, so no group is gathered anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.scratch import materialize


def connected(edges: DataFrame) -> DataFrame:
    """ACTION: ``(src, dst)`` bigint edges (either direction, repeats, loops and NULL ends allowed;
    NULL ends are ignored) to ``(node, label)``: one row per node with an edge to another node,
    label = smallest node id reachable. An empty edge table gives an empty result."""
    spark = edges.sparkSession
    e = materialize(
        edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
        .filter(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("a") != F.col("b"))).distinct()
    )
    labels = None
    while not e.isEmpty():
        both = e.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
                                          F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("x"))
        parent = materialize(both.groupBy("x.node").agg(F.min("x.other").alias("m"))
                             .select("node", F.least("node", "m").alias("label")))
        while True:  # pointer doubling until every pointer is a root
            up = parent.select(F.col("node").alias("label"), F.col("label").alias("up"))
            stepped = materialize(parent.join(up, "label").select("node", F.col("up").alias("label"),
                                                                  (F.col("up") != F.col("label")).alias("moved")))
            parent = stepped.select("node", "label")
            if stepped.filter("moved").isEmpty():
                break
        if labels is None:
            labels = parent
        else:
            up = parent.select(F.col("node").alias("label"), F.col("label").alias("up"))
            labels = materialize(labels.join(up, "label", "left")
                                 .select("node", F.coalesce("up", "label").alias("label")))
        pa = parent.select(F.col("node").alias("a"), F.col("label").alias("ra"))
        pb = parent.select(F.col("node").alias("b"), F.col("label").alias("rb"))
        e = materialize(e.join(pa, "a").join(pb, "b").filter("ra <> rb")
                        .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    if labels is None:
        return spark.createDataFrame([], "node bigint, label bigint")
    return labels
