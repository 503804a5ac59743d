"""Hard-negative mining with an inverted multi-index.

Vectors are scaled to whole numbers and cut into two halves; a codebook per half is learned from a bounded sample
(k-means), and every vector lies in the cell of its two nearest codewords. With the radius of each codeword (the
farthest member's distance) the half score of an anchor with any member of codeword c is at most
``anchor . c + |anchor| * radius(c)``. The multi-sequence heap visits an anchor's cells by decreasing sum of its two
half bounds until enough rows were met. The k-th best score met so far is then a certificate: every cell whose bound reaches it
is visited, no other cell can change the result. Scores are exact whole numbers, so the result is that of comparing all.

Two such searches run. The first finds the best rows of the anchor's own label (its positives). Each positive's
score opens a window, and the second finds the best rows of other labels in every window; cells whose
score can only be above all windows are passed over.

Cells are dealt to tasks by their first codeword, large ones in blocks of about ``BLOCK`` rows; a task holds one block and
lets the anchors stream past it, so neither a popular cell nor many anchors fill a task. Each round is a
shuffle of the rows and of (anchor, block) requests with a bitmap of the cells; codebooks, radii and cell sizes
(at most ``MOST_WORDS`` squared numbers per vector length) are the only things the driver holds. Where the bounds exclude little (spread
vectors of many dimensions), nearly all cells are visited: the result stays exact, the work is that of comparing anchors with all rows.

Rows with equal vector and label have equal scores: they are one class that keeps its first rows by id, as many as
can be returned, so large groups of copies cost one row. Ties go to the smaller vec_id.

Defined cases: rows with NULL label, NULL vector or NULL or non-finite components (also after scaling) take no part;
vectors of different length never meet; an empty vector scores 0; NULL ids are no anchors and come last among equal scores; rows that
repeat an id are rows of their own, and each is an anchor of its own; scores are cut to +-2**62; extra columns are ignored; an
empty table gives an empty result."""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadcast.llm.scratch import materialize

SAMPLE = 20_000     # vectors the codebooks are learned from
MOST_WORDS = 256    # codewords of a half, at most
BLOCK = 16_384      # rows of a block
PAST = 65_536       # anchors that stream past one block in one group, about
FIRST_ROWS = 2_048  # rows met in the first round
WIDER = 16          # factor from round to round while no certificate is known
LIMIT = 1 << 62     # scores are cut to this
CHUNK = 128         # anchors scored at once

_NO_FLOOR = -LIMIT - 1


def codewords(n: int) -> int:
    """Codewords per half for ``n`` classes: cells of about sqrt(n) / 4 rows."""
    return max(1, min(MOST_WORDS, round(2 * n ** 0.25)))


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """At most ``k`` centres of the rows of ``x``."""
    rng = np.random.default_rng(seed)
    centre = np.unique(x[rng.permutation(len(x))[:k]], axis=0)
    for _ in range(rounds):
        near = np.argmin((centre ** 2).sum(axis=1) - 2 * x @ centre.T, axis=1)
        size = np.bincount(near, minlength=len(centre))
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        centre = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centre)
    return centre


def multi_sequence(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of indices by decreasing ``a[i] + b[j]``: a pair enters the heap when both pairs before it were visited."""
    oa, ob = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
    sa, sb = a[oa].tolist(), b[ob].tolist()
    heap, reached = [(-(sa[0] + sb[0]), 0, 0)], [0] * (len(sa) + 1)  # reached[i]: pairs visited in row i
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(oa[i]), int(ob[j])
        reached[i] = j + 1
        if i + 1 < len(sa) and reached[i + 1] == j:
            heapq.heappush(heap, (-(sa[i + 1] + sb[j]), i + 1, j))
        if j + 1 < len(sb) and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (-(sa[i] + sb[j + 1]), i, j + 1))


class Book:
    """Codebooks, radii and cell sizes of one vector length."""

    def __init__(self, dim: int, halves: list[np.ndarray]):
        self.dim, self.cut, self.halves = dim, dim // 2, halves
        self.radius = [np.zeros(len(h)) for h in halves]
        self.size = np.zeros((len(halves[0]), len(halves[1])), dtype=np.int64)

    def split(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[..., :self.cut], x[..., self.cut:]]

    def assign(self, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Nearest codeword and distance, per half."""
        near, far = [], []
        for part, centre in zip(self.split(x), self.halves):
            c = np.argmin((centre ** 2).sum(axis=1) - 2 * part @ centre.T, axis=1)
            near.append(c)
            far.append(np.linalg.norm(part - centre[c], axis=1))
        return near, far

    def bounds(self, anchor: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Largest and smallest possible half scores per codeword, with room for rounding."""
        high, low = [], []
        for part, centre, radius in zip(self.split(anchor), self.halves, self.radius):
            score, norm = centre @ part, np.linalg.norm(part)
            reach = norm * radius + 1 + 1e-9 * norm * (np.linalg.norm(centre, axis=1) + radius)
            high.append(score + reach)
            low.append(score - reach)
        return high, low


def _prepared(rows: DataFrame, column: str, label: str, scale: float) -> DataFrame:
    """``vec_id, label, cls, dim, vector``: usable rows as little-endian doubles with whole values, and a 128-bit digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, dims, classes, raw = [], [], [], []
            for k, v in enumerate(batch.column(2).to_pylist()):
                if v is None or None in v:
                    continue
                with np.errstate(over="ignore"):
                    x = np.floor(scale * np.array(v, dtype=np.float64)) + 0.0
                if not np.isfinite(x).all():
                    continue
                b = x.astype("<f8").tobytes()
                keep.append(k)
                dims.append(len(x))
                classes.append(hashlib.blake2b(b, digest_size=16).digest())
                raw.append(b)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(classes, pa.binary()), pa.array(dims, pa.int32()),
                 pa.array(raw, pa.binary())], names=["vec_id", "label", "cls", "dim", "vector"])

    return rows.filter(F.col(label).isNotNull()) \
        .select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), F.col(column).alias("v")) \
        .mapInArrow(run, "vec_id bigint, label bigint, cls binary, dim int, vector binary")


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(len(column), dim)


def _learn(classes: DataFrame, sample: int) -> dict[int, Book]:
    """ACTION: a codebook per vector length (one row each) from at most ``sample`` vectors."""
    books = {}
    for r in classes.groupBy("dim").count().collect():
        picked = classes.filter(F.col("dim") == r["dim"]).select("vector", F.xxhash64("id").alias("o")).orderBy("o").limit(sample).collect()
        x = np.frombuffer(b"".join(bytes(p["vector"]) for p in picked), dtype="<f8").reshape(len(picked), r["dim"])
        cut, k = r["dim"] // 2, codewords(r["count"])
        books[r["dim"]] = Book(r["dim"], [k_means(x[:, :cut], k), k_means(x[:, cut:], k)])
    return books


def _indexed(classes: DataFrame, books: dict[int, Book]) -> DataFrame:
    """ACTION: every class with its cell; fills the books' radii and cell sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                near, far = books[dim].assign(_matrix(part.column(2), dim))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.array(c.astype(np.int32)) for c in near), *(pa.array(d) for d in far)],
                    names=["id", "dim", "vector", "label", "first", "c1", "c2", "r1", "r2"])

    index = materialize(classes.select("id", "dim", "vector", "label", "first").mapInArrow(
        run, "id bigint, dim int, vector binary, label bigint, first bigint, c1 int, c2 int, r1 double, r2 double"))
    cells = index.groupBy("dim", "c1", "c2").agg(F.count(F.lit(1)).alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2"))
    for r in cells.collect():  # at most MOST_WORDS squared per vector length
        book = books[r["dim"]]
        book.size[r["c1"], r["c2"]] = r["n"]
        book.radius[0][r["c1"]] = max(book.radius[0][r["c1"]], r["r1"])
        book.radius[1][r["c2"]] = max(book.radius[1][r["c2"]], r["r2"])
    return index


_VISITS = ("kind int, dim int, c1 int, block int, id bigint, vector binary, label bigint, cells binary, "
           "scores array<bigint>, lows array<bigint>, highs array<bigint>, visited binary, bound double")


def _visits(state: DataFrame, books: dict[int, Book], rows: int, block: int) -> DataFrame:
    """Requests (kind 1: an anchor, a block of first-codeword rows, the wanted second codewords as bits) and the anchors' new
    state (kind 2: visited cells as bits, largest bound of the others). Without a floor: the heap, until ``rows`` rows are met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                out = []
                for r in batch.slice(at, 64).to_pylist():
                    book = books[r["dim"]]
                    (h1, h2), (l1, l2) = book.bounds(np.frombuffer(r["vector"], dtype="<f8"))
                    bound = np.maximum(h1[:, None] + h2[None, :], -LIMIT)  # scores are cut, too
                    if r["visited"] is None:
                        open_cells = book.size > 0
                    else:
                        open_cells = ~np.unpackbits(np.frombuffer(r["visited"], np.uint8), count=bound.size).astype(bool).reshape(bound.shape)
                    open_cells &= bound >= r["least"]  # nothing below is wanted
                    if r["floor"] > _NO_FLOOR:
                        taken = open_cells & (bound >= r["floor"])
                    else:
                        taken, met = np.zeros_like(open_cells), 0
                        for i, j in multi_sequence(h1, h2):
                            if met >= rows:
                                break
                            if open_cells[i, j]:
                                taken[i, j] = True
                                met += int(book.size[i, j])
                    open_cells &= ~taken
                    wanted = taken & (np.minimum(l1[:, None] + l2[None, :], LIMIT) <= max(r["highs"]))
                    for i in np.flatnonzero(wanted.any(axis=1)).tolist():
                        bits = np.packbits(wanted[i]).tobytes()
                        for b in range(-(-int(book.size[i].sum()) // block)):
                            out.append((1, r["dim"], i, b, r["id"], r["vector"], r["label"], bits, r["scores"], r["lows"], r["highs"], None, None))
                    rest = float(bound[open_cells].max()) if open_cells.any() else -math.inf
                    out.append((2, r["dim"], None, None, r["id"], None, None, None, None, None, None, np.packbits(~open_cells).tobytes(), rest))
                types = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary(),
                         pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=[c.strip().split(" ")[0] for c in _VISITS.split(",")])

    return state.select("id", "dim", "vector", "label", "scores", "lows", "highs", "visited", "floor", "least").mapInArrow(run, _VISITS)


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows with whole values: by doubles where these are exact, else by Python's whole numbers."""
    if not a.size or not b.size or np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0 ** 53:
        return a @ b.T
    whole = lambda m: np.array([[int(x) for x in row] for row in m.tolist()], dtype=object)
    return np.clip(whole(a) @ whole(b).T, -LIMIT, LIMIT).astype(np.int64)


class _Rows:
    """The rows of one block."""

    def __init__(self, table: pa.Table, dim: int):
        self.x = _matrix(table["vector"], dim)
        self.id, self.label = table["id"].to_numpy(), table["label"].to_numpy()
        self.first, self.c2 = table["first"].to_numpy(), table["c2"].to_numpy()

    def best(self, part: pa.RecordBatch, dim: int, k: int, same: bool) -> pa.RecordBatch | None:
        """Per anchor and window, its ``k`` best rows in the wanted cells."""
        col = lambda name: part.column(part.schema.get_field_index(name))
        score = exact_scores(_matrix(col("vector"), dim), self.x)
        bits = np.stack([np.unpackbits(np.frombuffer(c, np.uint8)) for c in col("cells").to_pylist()]).astype(bool)
        labels = col("label").to_numpy()
        lows, highs, windows = col("lows").to_pylist(), col("highs").to_pylist(), col("scores").to_pylist()
        ok = (labels[:, None] == self.label[None, :]) == same
        ok &= bits[:, self.c2]
        ok &= (score >= np.array([min(x) for x in lows])[:, None]) & (score <= np.array([max(x) for x in highs])[:, None])
        i, j = np.nonzero(ok)
        if not len(i):
            return None
        s = score[i, j].astype(np.int64)
        order = np.lexsort((self.id[j], self.first[j], -s, i))
        i, j, s = i[order], j[order], s[order]
        picked = []
        for w in range(max(map(len, windows))):
            low = np.array([x[w] if w < len(x) else LIMIT + 1 for x in lows])
            high = np.array([x[w] if w < len(x) else -LIMIT - 1 for x in highs])
            at = np.flatnonzero((s >= low[i]) & (s <= high[i]))
            if len(at):
                begin = np.ones(len(at), dtype=bool)
                begin[1:] = i[at[1:]] != i[at[:-1]]
                n = np.arange(len(at))
                at = at[n - np.maximum.accumulate(np.where(begin, n, 0)) < k]
                name = np.array([x[w] if w < len(x) else 0 for x in windows])
                picked.append((at, name[i[at]]))
        if not picked:
            return None
        at, name = (np.concatenate(c) for c in zip(*picked))
        anchors = col("id").to_numpy()
        return pa.RecordBatch.from_arrays(
            [pa.array(anchors[i[at]]), pa.array(name.astype(np.int64)), pa.array(s[at]), pa.array(self.id[j[at]]), pa.array(self.first[j[at]])],
            names=["anchor", "window", "score", "id", "first"])


def _scored(index: DataFrame, visits: DataFrame, books: dict[int, Book], k: int, same: bool, block: int, groups: int) -> DataFrame:
    """``anchor, window, score, id, first``: the best rows of every block for the anchors that visit it."""
    sizes = [(dim, i, -(-int(n) // block)) for dim, b in books.items() for i, n in enumerate(b.size.sum(axis=1)) if n > block]
    blocks = F.lit(1)
    for dim, i, n in sizes:  # at most MOST_WORDS per vector length
        blocks = F.when((F.col("dim") == dim) & (F.col("c1") == i), n).otherwise(blocks)
    keys = ["dim", "c1", "block", "part"]
    rows = index.select(F.lit(0).alias("kind"), "dim", "c1", F.pmod(F.xxhash64("id"), blocks).cast("int").alias("block"),
                        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), "id", "vector", "label", "first", "c2")
    asked = visits.select("kind", "dim", "c1", "block", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("part"), "id", "vector",
                          "label", "cells", "scores", "lows", "highs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, rows_of = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in (*keys, "kind")]
            change = np.zeros(batch.num_rows, dtype=bool)
            for c in marks:
                change[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                now = tuple(int(c[a]) for c in marks[:-1])
                if now != key:
                    key, held, rows_of = now, [], None
                if marks[-1][a] == 0:
                    held.append(batch.slice(a, b - a))
                elif held:
                    if rows_of is None:
                        rows_of = _Rows(pa.Table.from_batches(held), key[0])
                    for at in range(a, b, CHUNK):
                        out = rows_of.best(batch.slice(at, min(CHUNK, b - at)), key[0], k, same)
                        if out is not None:
                            yield out

    together = rows.unionByName(asked, allowMissingColumns=True)
    return together.repartition(*keys).sortWithinPartitions(*keys, "kind") \
        .mapInArrow(run, "anchor bigint, window bigint, score bigint, id bigint, first bigint")


def _first(rows: DataFrame, k: int, by: list[str], order: list[Column]) -> DataFrame:
    """The first ``k`` rows of each group (limited before the shuffle, too)."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)


def _search(queries: DataFrame, index: DataFrame, books: dict[int, Book], k: int, same: bool, first_rows: int, block: int,
            groups: int) -> DataFrame:
    """ACTION. ``queries(id, dim, vector, label, windows array<struct<score, low, high>>)`` to ``anchor, window, score, id, first``: the
    ``k`` best classes of every window, certified."""
    opened = queries.select("id", "dim", "vector", "label", F.col("windows.score").alias("scores"), F.col("windows.low").alias("lows"),
                            F.col("windows.high").alias("highs"), F.array_min("windows.low").cast("double").alias("least"))
    state = opened.withColumns({"visited": F.lit(None).cast("binary"), "floor": F.lit(float(_NO_FLOOR))})
    found = None
    while True:
        visits = materialize(_visits(state, books, first_rows, block))
        new = _scored(index, visits.filter("kind = 1"), books, k, same, block, groups)
        both = new if found is None else found.unionByName(new)
        found = materialize(_first(both, k, ["anchor", "window"], [F.col("score").desc(), F.col("first"), F.col("id")]).drop("rank"))
        last = found.groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low")) \
            .filter(F.col("n") == k).select(F.col("anchor").alias("id"), "window", "low")
        # a window's floor: its k-th best score, or its lower end where fewer are known
        ends = state.select("id", F.posexplode(F.arrays_zip("scores", "lows")).alias("at", "w")) \
            .select("id", "at", F.col("w.scores").alias("window"), F.col("w.lows").alias("known")) \
            .join(last, ["id", "window"], "left").withColumn("low", F.coalesce("low", "known"))
        floors = ends.groupBy("id").agg(F.min("low").cast("double").alias("floor"),
                                        F.array_sort(F.collect_list(F.struct("at", "low"))).alias("l"))
        after = visits.filter("kind = 2").select("id", "visited", "bound")
        state = materialize(state.drop("visited", "floor", "lows").join(after, "id").join(floors, "id").filter("bound >= floor")
                            .select("id", "dim", "vector", "label", "scores", F.col("l.low").alias("lows"), "highs", "least", "visited", "floor"))
        if state.isEmpty():
            return found
        first_rows *= WIDER


def hard_negatives(rows: DataFrame, column: str = "embedding", label: str = "label", every: int = 50, positives: int = 5, negatives: int = 3,
                   low_percent: int = 50, high_percent: int = 95, scale: float = 256.0, sample: int = SAMPLE,
                   first_rows: int = FIRST_ROWS, block: int = BLOCK, past: int = PAST) -> DataFrame:
    """ACTION. ``rows(vec_id, <column>, <label>)`` to ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors: ids divisible by ``every``. Score: inner product of floor(``scale`` * component). For each of an anchor's first
    ``positives`` other rows of its label, the first ``negatives`` rows of other labels with
    low_percent * positive_score <= 100 * negative_score <= high_percent * positive_score."""
    vectors = materialize(_prepared(rows, column, label, scale).withColumn("row", F.monotonically_increasing_id()))
    keep = max(positives + 1, negatives)
    by_id = [F.col("vec_id").asc_nulls_last(), F.col("row")]
    members = _first(vectors, keep, ["cls", "label"], by_id).groupBy("cls", "label").agg(
        F.min("dim").alias("dim"), F.min("vector").alias("vector"), F.sort_array(F.collect_list(F.struct(
            F.col("vec_id").isNull().alias("last"), "vec_id", "row"))).alias("members"))
    classes = materialize(members.withColumn("id", F.monotonically_increasing_id())
                          .withColumn("first", F.coalesce(F.col("members")[0]["vec_id"], F.lit((1 << 63) - 1))))
    anchors = vectors.filter(F.col("vec_id") % every == 0).select("vec_id", "row", "cls", "label")
    queries = materialize(classes.join(anchors.select("cls", "label").distinct(), ["cls", "label"], "left_semi")
                          .select("id", "dim", "vector", "label"))
    books = _learn(classes, sample)
    index = _indexed(classes, books)
    groups = max(1, -(-queries.count() // past))
    members = classes.select("id", "members")

    def as_rows(found: DataFrame, k: int) -> DataFrame:
        """The first ``k`` rows of each window from its classes."""
        each = found.join(members, "id").select("anchor", "window", "score", F.explode("members").alias("m")) \
            .select("anchor", "window", "score", "m.vec_id", "m.row")
        return _first(each, k, ["anchor", "window"], [F.col("score").desc(), *by_id])

    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("score"), F.lit(-LIMIT - 1).cast("bigint").alias("low"),
                             F.lit(LIMIT + 1).cast("bigint").alias("high")))
    found = _search(queries.withColumn("windows", whole), index, books, positives + 1, True, first_rows, block, groups)
    near = materialize(as_rows(found, positives + 1).groupBy(F.col("anchor").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "score", "vec_id", "row"))).alias("near")))
    percent = lambda s, p: s.cast("decimal(20,0)") * F.lit(p) / F.lit(100)
    windows = F.filter(F.transform(F.array_distinct("near.score"), lambda s: F.struct(
        s.alias("score"), F.ceil(percent(s, low_percent)).cast("bigint").alias("low"),
        F.floor(percent(s, high_percent)).cast("bigint").alias("high"))), lambda w: w["low"] <= w["high"])
    second = materialize(queries.join(near.select("id", windows.alias("windows")), "id").filter(F.size("windows") > 0))
    hard = as_rows(_search(second, index, books, negatives, False, first_rows, block, groups), negatives) \
        .groupBy(F.col("anchor").alias("id"), F.col("window").alias("positive_score")).agg(
        F.array_sort(F.collect_list(F.struct("rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")))).alias("hard"))
    mined = near.join(hard.groupBy("id").agg(F.collect_list(F.struct("positive_score", "hard")).alias("mined")), "id") \
        .join(classes.select("id", "cls", "label"), "id")
    others = F.slice(F.filter("near", lambda p: p["row"] != F.col("row")), 1, positives)
    pairs = anchors.join(mined, ["cls", "label"]).select(
        F.col("vec_id").alias("anchor_id"), "mined", F.explode(others).alias("p")).select(
        "anchor_id", F.col("p.vec_id").alias("positive_id"), F.col("p.score").alias("positive_score"),
        F.get(F.filter("mined", lambda m: m["positive_score"] == F.col("p.score")), F.lit(0))["hard"].alias("hard"))
    return pairs.select("anchor_id", "positive_id", "positive_score", F.explode("hard").alias("h")).select(
        "anchor_id", "positive_id", F.col("h.rank").alias("rank"), F.col("h.negative_id").alias("negative_id"), "positive_score",
        F.col("h.negative_score").alias("negative_score"))
