"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, exact reranking.

Iterative quantisation learns rotations on a bounded sample: alternately the nearest binary codes of
the rotated, centred unit vectors and the rotation closest to those codes (a singular value
decomposition). Every vector gets the code bits of several such rotations. The code is cut into
disjoint substrings, one table each; vectors that agree on a whole substring meet. Width and number of
tables follow from the table size and the threshold: about ``GROUP`` chance members per key for spread vectors.

Angles around the learned mean say nothing certain about the cosine, so as many tables again take signs of the
uncentred vectors on independent normal directions. Those bits agree with chance 1 - angle / pi, one
independently of the other and whatever the data, so a pair exactly at the threshold meets in none of these
tables with a chance of at most ``MISS``. The number of tables grows as n**0.15. Vectors that share a strong
common direction share keys: their groups, and the comparisons, grow, up to all pairs of a tight group.

Members of a key are compared with their original vectors in double precision, block by block, so no
candidate pair is written: each cell returns per vector its number of links and a root of the cell's link
forest. A pair that shares several keys counts in the first of them only. Equal vectors are one class
with a multiplicity. Large groups are cut into blocks, one cell per pair of blocks.

Defined cases: NULL vectors, zero vectors and vectors with NULL or non-finite components link with nothing;
vectors of different length never link; equal vectors link; rows that repeat a vec_id stay; a NULL
vec_id is a component id only if no other id is in its component; extra columns are ignored; an
empty table gives an empty result."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.components import connected
from loadcast.llm.neardup import _cell_groups
from loadcast.llm.scratch import materialize

SAMPLE = 20_000   # vectors the rotations are learned from
ROUNDS = 30       # alternations per rotation
MISS = 0.004      # accepted chance to miss a pair exactly at the threshold
GROUP = 8         # chance members per key aimed at
BLOCK = 512


def learn_rotations(sample: np.ndarray, count: int, rounds: int = ROUNDS, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Mean and ``count`` rotations of unit vectors (rows of ``sample``)."""
    mean = sample.mean(axis=0)
    x = sample - mean
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(count):
        r = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))[0]
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(np.where(x @ r >= 0, 1.0, -1.0).T @ x)
            r = (u @ vt).T
        out.append(r)
    return mean, np.concatenate(out, axis=1)


def plain_directions(dim: int, count: int, seed: int = 17) -> np.ndarray:
    """``count`` independent normal directions (columns): signs on them depend on the angle of two vectors only."""
    return np.random.default_rng(seed).normal(size=(dim, count))


def table_shape(n: int, threshold: float, miss: float = MISS, group: int = GROUP) -> tuple[int, int]:
    """Bits per substring and number of tables of either kind (learned, plain) for ``n`` vectors."""
    width = min(30, max(6, round(math.log2(max(2, n) / group))))
    same = 1 - math.acos(threshold) / math.pi  # chance that a bit agrees at the threshold
    return width, max(4, math.ceil(math.log(miss) / math.log(1 - same**width)))


def _vectors(rows: DataFrame, column: str) -> DataFrame:
    """``vec_id, dim, cls, vector``: little-endian doubles of usable vectors (NULL otherwise) and their digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, classes, raw = [], [], []
            for v in batch.column(1).to_pylist():
                x = np.array([np.nan] if v is None else v, dtype=np.float64)
                if len(x) and np.isfinite(x).all() and np.any(x):
                    b = (x + 0.0).astype("<f8").tobytes()
                    raw.append(b)
                    dims.append(len(x))
                    classes.append(int.from_bytes(hashlib.blake2b(b, digest_size=8).digest(), "little", signed=True))
                else:
                    raw.append(None)
                    dims.append(None)
                    classes.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(dims, pa.int32()),
                                              pa.array(classes, pa.int64()), pa.array(raw, pa.binary())],
                                             names=["vec_id", "dim", "cls", "vector"])

    return rows.select("vec_id", F.col(column).alias("v")).mapInArrow(run, "vec_id bigint, dim int, cls bigint, vector binary")


def _matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(-1, dim)


def _coded(classes: DataFrame, models: dict[int, tuple]) -> DataFrame:
    """``keys``: the substrings of each vector's code as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                mean, rotation, plain, width, tables = models[dim]
                x = _matrix(part.column(2), dim)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                learned = ((x - mean) @ rotation >= 0)[:, :width * tables]
                bits = np.concatenate([learned, x @ plain >= 0], axis=1).reshape(len(x), 2 * tables, width)
                keys = (bits * (1 << np.arange(width, dtype=np.int64))).sum(axis=2).astype("<u4")
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([k.tobytes() for k in keys], pa.binary())],
                                                 names=["cls", "dim", "vector", "copies", "keys"])

    return classes.select("cls", "dim", "vector", "copies").mapInArrow(
        run, "cls bigint, dim int, vector binary, copies bigint, keys binary")


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable over the links (i, j), for each of n members."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _linked(cells: DataFrame, threshold: float) -> DataFrame:
    """Per cell and vector with links: ``cls, links`` (copies of partners counted) and ``root``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _cell_groups(batches, ["dim", "half", "key", "cell_a", "cell_b"]):
            n = g.num_rows
            if n < 2:
                continue
            dim, table = g["dim"][0].as_py(), g["half"][0].as_py()
            x = _matrix(g["vector"].combine_chunks(), dim)
            norm = np.linalg.norm(x, axis=1)
            near = x @ x.T >= threshold * np.outer(norm, norm)
            block = g["block"].to_numpy()
            if g["cell_a"][0].as_py() != g["cell_b"][0].as_py():
                near &= block[:, None] != block[None, :]
            i, j = np.nonzero(np.triu(near, 1))
            if table and len(i):
                keys = np.frombuffer(b"".join(g["keys"].to_pylist()), dtype="<u4").reshape(n, -1)[:, :table]
                first = ~(keys[i] == keys[j]).any(axis=1)
                i, j = i[first], j[first]
            if not len(i):
                continue
            cls, copies = g["cls"].to_numpy(), g["copies"].to_numpy()
            links = np.bincount(i, copies[j], n).astype(np.int64) + np.bincount(j, copies[i], n).astype(np.int64)
            root = _roots(n, i, j)
            has = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(cls[has]), pa.array(links[has]), pa.array(cls[root[has]])],
                                             names=["cls", "links", "root"])

    keys = ["dim", "half", "key", "cell_a", "cell_b"]
    return cells.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "cls bigint, links bigint, root bigint")


def near_duplicates(rows: DataFrame, column: str = "embedding", threshold: float = 0.95, miss: float = MISS,
                    sample: int = SAMPLE, group: int = GROUP, block: int = BLOCK) -> DataFrame:
    """ACTION. ``rows(vec_id, <column>)`` to ``vec_id, n_links, component_id, kept``, one row per input row.
    Links are pairs found with cosine >= threshold; the rotations are learned from ``sample`` vectors."""
    vectors = materialize(_vectors(rows, column))
    classes = materialize(vectors.filter("cls is not null").groupBy("cls", "dim")
                          .agg(F.min("vector").alias("vector"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("low")))
    models = {}
    for r in classes.groupBy("dim").count().collect():  # one row per vector length
        width, tables = table_shape(r["count"], threshold, miss, group)
        picked = classes.filter(F.col("dim") == r["dim"]).select("vector", F.xxhash64("cls").alias("o")).orderBy("o").limit(sample).collect()
        x = np.frombuffer(b"".join(bytes(p["vector"]) for p in picked), dtype="<f8").reshape(-1, r["dim"])
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        models[r["dim"]] = (*learn_rotations(x, -(-width * tables // r["dim"])), plain_directions(r["dim"], width * tables), width, tables)
    if not models:
        links = None
    else:
        coded = materialize(_coded(classes, models))
        count = F.expr("octet_length(keys) div 4").cast("int")
        parts = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(
            i.alias("half"), F.conv(F.hex(F.substring("keys", i * 4 + 1, F.lit(4))), 16, 10).cast("bigint").alias("key")))
        keyed = coded.select("cls", "dim", F.explode(parts).alias("p")).select("cls", "dim", "p.half", "p.key")
        groups = keyed.groupBy("dim", "half", "key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
        cut = F.ceil(F.col("members") / block).cast("int")
        dealt = (keyed.join(groups, ["dim", "half", "key"])
                 .withColumns({"cut": cut, "block": F.pmod(F.xxhash64("cls"), cut).cast("int")})
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
                 .select("cls", "half", "key", "block", F.least("block", "other").alias("cell_a"),
                         F.greatest("block", "other").alias("cell_b")))
        links = materialize(_linked(dealt.join(coded, "cls"), threshold))
    if links is None:
        named = classes.select("cls", F.col("copies").alias("c"), F.lit(0).cast("bigint").alias("links"), F.col("low").alias("component_low"))
    else:
        counts = links.groupBy("cls").agg(F.sum("links").alias("links"))
        comps = connected(links.select(F.col("cls").alias("src"), F.col("root").alias("dst")))
        joined = classes.join(counts, "cls", "left").join(comps.select(F.col("node").alias("cls"), "label"), "cls", "left") \
            .select("cls", F.col("copies").alias("c"), F.coalesce("links", F.lit(0)).alias("links"), "low",
                    F.coalesce("label", "cls").alias("label"))
        lows = joined.groupBy("label").agg(F.min("low").alias("component_low"))
        named = joined.join(lows, "label").select("cls", "c", "links", "component_low")
    out = vectors.select("vec_id", "cls").join(named, "cls", "left")
    comp = F.when(F.col("cls").isNotNull(), F.col("component_low")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce(F.col("links") + F.col("c") - 1, F.lit(0)).alias("n_links"),
                      comp.alias("component_id"), F.col("vec_id").eqNullSafe(comp).alias("kept"))
