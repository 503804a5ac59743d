"""Quality classifier by Bradley-Terry ranking: P(a better than b) = sigmoid(score(a) - score(b)).

Scores are linear in features of the text alone, learned by logistic loss on feature differences of
preference pairs (every document labelled good against every one labelled bad). The decision threshold is the
quantile of the training scores at the share of bad documents; the reported score is the sigmoid of the
distance to it, so 0.5 is the threshold.

Features are computed for every whole text on the executors, vectorised over the UTF-8 bytes: shares
of character classes, word lengths, repetition of words, pairs and lines, and lengths; each enters with
indicators of its training quantiles, so the linear score can bend.

Fitting takes all labelled documents outside the held-out part, and all their pairs, in time linear in the documents: see ``_Pulls``.
Up to ``HELD`` feature rows are fitted in the driver's process; more stay in a stored table that tasks pass over twice per
Newton step, and the driver gets sums. Scoring reads all rows.

Defined cases: NULL and empty texts get the features of a text without words, and a score; labels
that are NULL or repeat a doc_id with both values are left out; without both labels every score is 0.5;
extra columns are kept by ``keep_good``; an empty table gives an empty result."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from loadcast.llm.scratch import materialize
from loadcast.llm.textbytes import Words, slices

HELD = 20_000       # training rows that the driver's process may hold (192 bytes each)
PAIRS = 30_000      # weight of all pairs together, against the penalty
BINS = 10
ROUNDS = 50         # Newton steps at most
LEAST_STEP = 1e-9   # of any weight, in the last step
WIDTH, ORDER = 0.25, 14  # grid of scores and terms of the series: (WIDTH / pi) ** 15 is below rounding
PIECE = 2_000       # rows whose indicators are held at once: 4 MB
MERGES = 8          # tasks that add up the sums of the others

# Byte classes whose shares are features.
_CLASSES = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " ", "\n", ".", ",", "!", "?", "|",
            "*#$%&@~^", "<>{}[]()=/\\_", "'\"-:;"]
_CLASS_OF = np.full(256, len(_CLASSES), dtype=np.int64)
for _k, _chars in enumerate(_CLASSES):
    _CLASS_OF[[ord(c) for c in _chars]] = _k
_CLASS_OF[128:] = len(_CLASSES) + 1
N_FEATURES = len(_CLASSES) + 2 + 9


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features per text."""
    n = len(offsets) - 1
    out = np.zeros((n, N_FEATURES))
    words = Words(data, offsets, lower=True)
    length = np.diff(offsets)
    text_of = np.repeat(np.arange(n), length)
    width = len(_CLASSES) + 2
    counts = np.bincount(text_of * width + _CLASS_OF[data], minlength=n * width).reshape(n, width)
    out[:, :width] = counts / np.maximum(1, length)[:, None]
    size = words.end - words.start
    word_of = np.repeat(np.arange(n), words.count)
    c = np.maximum(1, words.count)
    mean = np.bincount(word_of, size, n) / c
    out[:, width] = mean
    out[:, width + 1] = np.sqrt(np.maximum(0, np.bincount(word_of, size.astype(float)**2, n) / c - mean**2))
    out[:, width + 2] = np.log1p(words.count)
    twice = (words.hash[1:] == words.hash[:-1]) & (word_of[1:] == word_of[:-1])
    out[:, width + 3] = np.bincount(word_of[1:][twice], minlength=n) / c
    pairs = words.windows(2)
    line_ends = np.flatnonzero(data == 10)
    lines = np.searchsorted(line_ends, offsets[1:]) - np.searchsorted(line_ends, offsets[:-1]) + 1
    out[:, width + 4] = np.log1p(length / lines)
    for t, (a, k) in enumerate(zip(words.first[:-1].tolist(), words.count.tolist())):
        if k:
            seen, times = np.unique(words.hash[a:a + k], return_counts=True)
            out[t, width + 5] = len(seen) / k
            out[t, width + 6] = times.max() / k
            p = times / k
            out[t, width + 7] = -(p * np.log(p)).sum() / np.log(k + 1)
            out[t, width + 8] = len(np.unique(pairs[a:a + k - 1])) / (k - 1) if k > 1 else 1.0
    return out


class Ranker:
    """Learned weights over binned features, and the score threshold."""

    def __init__(self, edges: np.ndarray, centre: np.ndarray, scale: np.ndarray, weights: np.ndarray, threshold: float):
        self.edges, self.centre, self.scale, self.weights, self.threshold = edges, centre, scale, weights, threshold

    def design(self, raw: np.ndarray) -> np.ndarray:
        linear = np.clip((raw - self.centre) / self.scale, -4, 4)
        steps = [(raw >= e).astype(float) for e in self.edges]
        return np.concatenate([linear, *steps], axis=1)

    def score(self, raw: np.ndarray) -> np.ndarray:
        z = self.design(raw) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _series(at: np.ndarray) -> np.ndarray:
    """Taylor coefficients of the sigmoid at each point, ``ORDER`` + 1 rows (from s' = s - s * s, on the side without cancellation)."""
    out = np.zeros((ORDER + 1, *at.shape))
    out[0] = 1 / (1 + np.exp(np.minimum(np.abs(at), 700)))
    for n in range(ORDER):
        out[n + 1] = (out[n] - sum(out[k] * out[n - k] for k in range(n + 1))) / (n + 1)
    flip = -(-1.0) ** np.arange(ORDER + 1).reshape(-1, *[1] * at.ndim)
    return np.where(at > 0, flip * out + (flip == -1) * (np.arange(ORDER + 1).reshape(flip.shape) == 0), out)


def _moments(raw: np.ndarray, good: np.ndarray, model: Ranker) -> list[tuple[np.ndarray, np.ndarray]]:
    """For the bad and the good rows: cells of the grid of scores, and in each the sums of powers of the distance to its centre."""
    s = _raw_score(raw, model)[:, 0]
    out = []
    for chosen in (~good, good):
        cells, place = np.unique(np.rint(s[chosen] / WIDTH), return_inverse=True)
        off = s[chosen] - cells[place] * WIDTH
        out.append((cells, np.stack([np.bincount(place, off**k, len(cells)) for k in range(ORDER + 1)], axis=1)))
    return out


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Moments of several row sets as one."""
    cells, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    sums = np.zeros((len(cells), ORDER + 1))
    np.add.at(sums, place, np.concatenate([m for _, m in parts]))
    return cells, sums


class _Pulls:
    """Pull of all rows of the other label on a row, by its score: ``good`` gets the sum over bad rows of sigmoid(their score - its), ``bad`` the
    sum over good rows of sigmoid(its score - theirs).

    The sigmoid of a difference is a power series in both rows' distances to the centres of their cells, so sums of powers per cell
    give the sum over every pair; the distances differ by ``WIDTH`` at most and the series' radius is pi, so what is left after
    ``ORDER`` terms is below rounding. ``weights``: the sigmoid's slope between cells, for the curvature."""

    def __init__(self, bad: tuple[np.ndarray, np.ndarray], good: tuple[np.ndarray, np.ndarray]):
        self.cells = (bad[0], good[0])
        self.of_bad, self.of_good = np.zeros_like(bad[1]), np.zeros_like(good[1])
        self.weights = np.zeros((len(good[0]), len(bad[0])))
        step = max(1, 500_000 // max(1, len(bad[0])))
        for at in range(0, len(good[0]), step):
            here = slice(at, at + step)
            series = _series((bad[0][None, :] - good[0][here, None]) * WIDTH)
            self.weights[here] = series[1]
            for n in range(ORDER + 1):
                for k in range(n + 1):
                    self.of_good[here, n - k] += math.comb(n, k) * (-1) ** (n - k) * (series[n] @ bad[1][:, k])
                    self.of_bad[:, k] += math.comb(n, k) * (-1) ** (n - k) * (good[1][here, n - k] @ series[n])
        # each row's share of the curvature, the same for all rows of a cell: then the curvature is that of a sum over pairs
        self.slopes = (good[1][:, 0] @ self.weights, self.weights @ bad[1][:, 0])

    def sums(self, raw: np.ndarray, good: np.ndarray, model: Ranker) -> list[np.ndarray]:
        """Of the rows: the gradient, the weighted products of their columns, and the sums of their columns by cell (bad, good)."""
        k = len(model.weights)
        gradient, products = np.zeros(k), np.zeros((k, k))
        by_cell = [np.zeros((len(cells), k)) for cells in self.cells]
        for at in range(0, len(raw), PIECE):
            x = model.design(raw[at:at + PIECE])
            s = x @ model.weights
            for sign, label, powers, slopes in zip((-1, 1), (False, True), (self.of_bad, self.of_good), self.slopes):
                chosen = good[at:at + PIECE] == label
                if not chosen.any():
                    continue
                xs, cells = x[chosen], self.cells[label]
                place = np.minimum(np.searchsorted(cells, np.rint(s[chosen] / WIDTH)), len(cells) - 1)
                off = s[chosen] - cells[place] * WIDTH
                pull = sum(off**n * powers[place, n] for n in range(ORDER + 1))
                gradient += sign * (pull @ xs)
                products += (xs * slopes[place][:, None]).T @ xs
                order = np.argsort(place, kind="stable")
                first = np.flatnonzero(np.diff(place[order], prepend=-1))
                by_cell[label][place[order][first]] += np.add.reduceat(xs[order], first, axis=0)
        return [gradient, products, *by_cell]


def _spread(raw: np.ndarray, good: np.ndarray) -> list[np.ndarray]:
    """Number of rows and of good ones, means, squared deviations."""
    return [np.array([len(raw), good.sum()], dtype=float), raw.mean(axis=0), ((raw - raw.mean(axis=0)) ** 2).sum(axis=0)]


class Held:
    """Training rows in this process."""

    def __init__(self, raw: np.ndarray, good: np.ndarray):
        self.raw, self.good = raw, good

    def each(self, f) -> list:
        """``f(raw, good)`` of parts that make up all rows."""
        return [f(self.raw, self.good)] if len(self.raw) else []

    def summed(self, f) -> list[np.ndarray]:
        """The arrays of ``f(raw, good)`` added up over all rows."""
        return f(self.raw, self.good)

    def quantiles(self, f, shares: Sequence[float]) -> np.ndarray:
        """Exact quantiles (a row per share) of each column of ``f(raw)``, linear between neighbours."""
        return np.quantile(f(self.raw), shares, axis=0)


class Stored:
    """Training rows in a stored table ``good, x``: tasks pass over them, the driver gets sums."""

    def __init__(self, table: DataFrame):
        self.table = table

    def _run(self, f, schema: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for out in f((_matrix(b.column("x").to_pylist()), np.array(b.column("good").to_pylist(), dtype=bool)) for b in batches if b.num_rows):
                yield pa.RecordBatch.from_arrays(out, schema=arrow)

        arrow = to_arrow_schema(T._parse_datatype_string(schema))
        return self.table.select("good", "x").mapInArrow(run, schema)

    def each(self, f) -> list:
        def part(rows):
            found = [f(*r) for r in rows]
            yield [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([pickle.dumps(found)], pa.binary())]

        rows = self._run(part, "part int, found binary").collect()  # sums by cell: no row per document
        return [x for r in sorted(rows, key=_by_part) for x in pickle.loads(r["found"])]

    def summed(self, f) -> list[np.ndarray]:
        def part(rows):
            total = None
            for r in rows:
                total = _added(total, f(*r))
            if total is not None:
                yield [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([pickle.dumps(total)], pa.binary())]

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = sorted((x for b in batches for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())), key=_by_part)
            if found:
                total = None
                for _, blob in found:
                    total = _added(total, pickle.loads(blob))
                yield pa.RecordBatch.from_arrays([pa.array([found[0][0]], pa.int32()), pa.array([pickle.dumps(total)], pa.binary())], names=["part", "found"])

        # a matrix per task is added up in MERGES tasks, in the tasks' order, before the driver gets it
        found = self._run(part, "part int, found binary").repartition(MERGES, "part").mapInArrow(merge, "part int, found binary")
        total = None
        for r in sorted(found.collect(), key=_by_part):
            total = _added(total, pickle.loads(r["found"]))
        return total

    def quantiles(self, f, shares: Sequence[float]) -> np.ndarray:
        """Values with their counts are dealt to ranges and stored; the driver gets a row per range and column, and the values at the wanted ranks."""
        def part(rows):
            for raw, _ in rows:
                for i, column in enumerate(f(raw).T):
                    value, times = np.unique(column, return_counts=True)
                    yield [pa.array(np.full(len(value), i, dtype=np.int32)), pa.array(value), pa.array(times)]

        counted = self._run(part, "i int, value double, n bigint").groupBy("i", "value").agg(F.sum("n").alias("n"))
        dealt = materialize(counted.repartitionByRange("i", "value").withColumn("part", F.spark_partition_id()))
        sizes = dealt.groupBy("i", "part").agg(F.sum("n").alias("n")).collect()
        columns = 1 + max(r["i"] for r in sizes)
        wanted, weight = [], np.zeros((len(shares), columns))
        for i in range(columns):
            here = sorted((r for r in sizes if r["i"] == i), key=lambda r: r["part"])
            ends = np.cumsum([r["n"] for r in here])
            for k, share in enumerate(shares):
                rank = share * (ends[-1] - 1)
                weight[k, i] = rank - math.floor(rank)
                for side, at in enumerate((math.floor(rank), min(math.floor(rank) + 1, ends[-1] - 1))):
                    p = int(np.searchsorted(ends, at, side="right"))
                    wanted.append((i, here[p]["part"], k, side, int(at - (ends[p] - here[p]["n"]))))
        ranks = self.table.sparkSession.createDataFrame(wanted, "i int, part int, k int, side int, rank bigint")
        needed = F.broadcast(ranks.select("i", "part").distinct())  # ranks: two per column and share
        upto = F.sum("n").over(Window.partitionBy("i", "part").orderBy("value")).alias("upto")
        cut = dealt.join(needed, ["i", "part"]).select("i", "part", "value", "n", upto)
        found = cut.join(F.broadcast(ranks), ["i", "part"]).filter("rank < upto and rank >= upto - n").collect()
        ends = np.zeros((2, len(shares), columns))
        for r in found:
            ends[r["side"], r["k"], r["i"]] = r["value"]
        step = ends[1] - ends[0]
        return np.where(weight < 0.5, ends[0] + step * weight, ends[1] - step * (1 - weight))


def _matrix(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype=float).reshape(-1, N_FEATURES)


def _by_part(row) -> int:
    """Sums are added in the order of the tasks that made them, whichever ended first."""
    return row[0]


def _added(total: list[np.ndarray] | None, more: list[np.ndarray]) -> list[np.ndarray]:
    return more if total is None else [a + b for a, b in zip(total, more)]


def fit(rows: Held | Stored, pairs: float = PAIRS, penalty: float = 2.0, rounds: int = ROUNDS) -> Ranker:
    """Newton steps on the logistic loss of every pair of a good and a bad row (ridge penalty), until they are below ``LEAST_STEP``. All pairs
    together weigh as ``pairs`` of them against the penalty, so its strength does not depend on the number of rows."""
    n, good, mean, spread = 0.0, 0.0, np.zeros(N_FEATURES), np.zeros(N_FEATURES)
    for (m, g), at, more in rows.each(_spread):
        spread = spread + more + (at - mean) ** 2 * (n * m / (n + m))
        n, good, mean = n + m, good + g, mean + (at - mean) * (m / (n + m))
    if not good or good == n:
        return Ranker(np.zeros((0, N_FEATURES)), np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0)
    edges = rows.quantiles(_itself, np.arange(1, BINS) / BINS)
    model = Ranker(edges, mean, np.sqrt(spread / n) + 1e-9, np.zeros(N_FEATURES * BINS), 0.0)
    share = pairs / (good * (n - good))
    for _ in range(rounds):
        found = rows.each(partial(_moments, model=model))
        pulls = _Pulls(_merged([f[0] for f in found]), _merged([f[1] for f in found]))
        gradient, products, bad_cells, good_cells = rows.summed(partial(pulls.sums, model=model))
        across = good_cells.T @ pulls.weights @ bad_cells
        curvature = share * (products - across - across.T) + penalty * np.eye(len(gradient))
        step = np.linalg.solve(curvature, share * gradient - penalty * model.weights)
        model = Ranker(edges, model.centre, model.scale, model.weights + step, 0.0)
        if np.abs(step).max() < LEAST_STEP:
            break
    model.threshold = float(rows.quantiles(partial(_raw_score, model=model), [1 - good / n])[0, 0])
    return model


def _itself(raw: np.ndarray) -> np.ndarray:
    return raw


def _raw_score(raw: np.ndarray, model: Ranker) -> np.ndarray:
    return np.concatenate([model.design(raw[at:at + PIECE]) @ model.weights for at in range(0, max(1, len(raw)), PIECE)])[:, None]


def held_out() -> Column:
    """Rows that are never learned from: crc32 of the id's text is 1 modulo 3 (false for a NULL id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, pairs: float = PAIRS, held: int = HELD) -> Ranker:
    """ACTION: learn from every labelled document outside the held-out part and all their pairs. Feature rows, not texts, are shuffled and
    stored; up to ``held`` of them are fitted in the driver's process, more by tasks (the same steps)."""
    agreed = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id") \
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_hi")).filter("quality = _hi").drop("_hi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([r.tobytes() for r in features(data, offsets)], pa.binary())], names=["doc_id", "x"])

    found = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull() & ~held_out()).mapInArrow(run, "doc_id bigint, x binary")
    # one row per id
    rows = materialize(found.join(agreed, "doc_id").groupBy("doc_id").agg(F.min(F.struct("x", F.col("quality").cast("int").alias("quality"))).alias("r"))
                       .select("doc_id", (F.col("r.quality") == 1).alias("good"), "r.x"))
    if rows.count() > held:
        return fit(Stored(rows), pairs)
    few = rows.orderBy("doc_id").collect()  # at most ``held``
    return fit(Held(_matrix([bytes(r["x"]) for r in few]), np.array([r["good"] for r in few], dtype=bool)), pairs)


def score(docs: DataFrame, model: Ranker) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 where score >= 0.5)."""
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch, "text"):
                s = model.score(features(data, offsets))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(c)) for c in names), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                    names=[*names, "score", "predicted"])

    return docs.select(*names).mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """ACTION: the documents that the learned classifier does not reject, same columns."""
    clash = {c: f"_in_{c}" for c in docs.columns if c in ("score", "predicted")}
    scored = score(docs.withColumnsRenamed(clash), train(docs, labels, **options))
    return scored.filter("predicted = 1").select(*(F.col(clash.get(c, c)).alias(c) for c in docs.columns))
