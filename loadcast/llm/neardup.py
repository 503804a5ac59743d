"""Near-duplicate documents: MinHash with tensored banding, exact verification, components.

Two collections of m half keys are computed per document, each half key from ``rows`` minhashes.
Table (i, j) of the m*m tables is keyed by the pair (A_i, B_j), so 2*m*rows minhashes serve
m*m tables of 2*rows minhashes each. Rows are grouped physically on A_i only (m rows per document,
and only where a group has two members); the B half of the table key is compared inside the group.

From groups to links:

1. documents with equal shingle sets form one class (grouped by a 128-bit set digest); only
   classes go on, so copies never meet as pairs;
2. inside a group, pairs that share a table key must pass a size test and an *exact* upper bound
   of the intersection taken from set bitmaps (elements whose bit the other side lacks are surely
   missing there), so the bound never loses a link;
3. round one sends each class's most agreeing partners to verification, on the full texts;
   round two sends every remaining pair of a group whose ends are still in different components.
   So no link that could join two components is dropped, and pairs inside an already connected
   group of near copies are never written out.

Large groups are cut into blocks; block pairs are separate cells, dealt out by key.

Defined cases: NULL and empty texts and texts of separators only have an empty set and link with
nothing; fewer than ``shingle`` words make one shingle of the whole sequence; repeated rows and
equal texts fall in one class; a NULL doc_id never becomes a component id unless no other id is
in its component; extra columns are ignored by ``near_duplicates`` and kept by ``drop_near_duplicates``;
an empty table gives an empty result."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.components import connected
from loadcast.llm.scratch import materialize
from loadcast.llm.textbytes import Words, mix, slices

ROWS = 3            # minhashes per half key
MISS = 2e-5         # accepted chance that a pair exactly at the threshold shares no table key
BLOCK = 512         # members of a group compared against each other in one cell
FIRST_PARTNERS = 3  # partners per class sent to verification in round one (round two takes the rest)

_SIGNATURE = "doc_id bigint, row bigint, n_shingles bigint, set_a bigint, set_b bigint, half_keys binary, bitmap binary"


def half_key_count(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Half keys per collection so that both collections agree somewhere with chance 1 - miss at the threshold."""
    return max(2, math.ceil(math.log(miss / 2) / math.log(1 - threshold**rows)))


def _shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, concatenated, and their offsets."""
    words = Words(data, offsets, lower=True)
    grams = words.windows(shingle)
    sets = []
    for a, c in zip(words.first[:-1].tolist(), words.count.tolist()):
        if c >= shingle:
            sets.append(np.unique(grams[a:a + c - shingle + 1]))
        elif c:
            h = np.uint64(c)
            with np.errstate(over="ignore"):
                for w in words.hash[a:a + c]:
                    h = mix(np.atleast_1d(h * np.uint64(0x9E3779B97F4A7C15) + w))[0]
            sets.append(np.array([h], dtype=np.uint64))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    size = np.array([len(s) for s in sets], dtype=np.int64)
    return np.concatenate(sets), np.concatenate([[0], np.cumsum(size)])


def _set_digests(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order-free 128-bit digest (two sums of mixed hashes) of each non-empty set starting at ``at``."""
    out = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        out.append(np.add.reduceat(mix(values ^ np.uint64(salt)), at).view(np.int64))
    return out[0], out[1]


def _bitmap(values: np.ndarray) -> bytes:
    bits = max(64, 1 << int(4 * len(values) - 1).bit_length())
    flags = np.zeros(bits, dtype=bool)
    flags[(values & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def signatures(docs: DataFrame, shingle: int, m: int, rows: int = ROWS) -> DataFrame:
    """One row per document: set size, set digest, 2*m half keys (uint32) and the set bitmap."""
    rng = np.random.default_rng(41)
    salts = rng.integers(0, 1 << 63, (2 * m, rows), dtype=np.uint64)
    factors = rng.integers(0, 1 << 63, (2 * m, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows_ = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "row"))
            for a, b, data, offsets in slices(batch, "text"):
                values, at = _shingle_sets(data, offsets, shingle)
                size = np.diff(at)
                full = np.flatnonzero(size)
                keys = np.zeros((b - a, 2 * m), dtype=np.uint32)
                set_a, set_b = np.zeros(b - a, dtype=np.int64), np.zeros(b - a, dtype=np.int64)
                if len(full):
                    heads = at[full]
                    set_a[full], set_b[full] = _set_digests(values, heads)
                    for j in range(2 * m):
                        h = np.full(len(full), j, dtype=np.uint64)
                        for r in range(rows):
                            h = mix(h + np.minimum.reduceat((values ^ salts[j, r]) * factors[j, r], heads))
                        keys[full, j] = (h >> np.uint64(32)).astype(np.uint32)
                bitmaps = [_bitmap(values[x:y]) if y > x else b"" for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a).cast(pa.int64()), rows_.slice(a, b - a), pa.array(size, pa.int64()), pa.array(set_a), pa.array(set_b),
                     pa.array([k.tobytes() for k in keys], pa.binary()), pa.array(bitmaps, pa.binary())],
                    names=["doc_id", "row", "n_shingles", "set_a", "set_b", "half_keys", "bitmap"])

    return docs.select("doc_id", _row_key().alias("row"), "text").mapInArrow(run, _SIGNATURE)


def _row_key() -> Column:
    """A key by which a document's text is found again: its id, or a hash of the text where it has none."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("text"))


def _upper_bound(bits_x: np.ndarray, bits_y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Largest possible intersection of each pair of sets, given their bitmaps (rows of uint64)."""
    only_x = np.bitwise_count(bits_x & ~bits_y).sum(axis=1, dtype=np.int64)
    only_y = np.bitwise_count(bits_y & ~bits_x).sum(axis=1, dtype=np.int64)
    return np.minimum(nx - only_x, ny - only_y)


class _Cell:
    """The members of one cell (a group, or two blocks of a large group) as arrays."""

    def __init__(self, table: pa.Table, m: int):
        self.cls = table["cls"].to_numpy()
        self.size = table["n_shingles"].to_numpy()
        self.block = table["block"].to_numpy()
        self.comp = table["comp"].to_numpy()
        self.doc = table["rep"].to_numpy()
        self.keys = np.frombuffer(b"".join(table["half_keys"].to_pylist()), dtype=np.uint32).reshape(-1, 2 * m)
        raw = table["bitmap"].to_pylist()
        self.width = np.array([len(x) // 8 for x in raw])
        self.bits = [np.frombuffer(x, dtype=np.uint64) for x in raw]

    def _bits(self, rows: np.ndarray, width: int) -> np.ndarray:
        """Bitmaps folded to ``width`` words (bit positions are residues of the same hash)."""
        uniq, back = np.unique(rows, return_inverse=True)
        out = np.empty((len(uniq), width), dtype=np.uint64)
        for k, r in enumerate(uniq.tolist()):
            out[k] = np.bitwise_or.reduce(self.bits[r].reshape(-1, width), axis=0)
        return out[back]

    def pairs(self, table: int, m: int, percent: int, two_blocks: bool, tile: int = 512):
        """Pairs (x, y, agreeing half keys) that share a table key, for the first time at A_table, are in
        different components and can reach the threshold."""
        n = len(self.cls)
        xs = np.flatnonzero(self.block == self.block.min()) if two_blocks else np.arange(n)
        ys = np.flatnonzero(self.block != self.block.min()) if two_blocks else xs
        for x0 in range(0, len(xs), tile):
            x = xs[x0:x0 + tile]
            for y0 in range(0 if two_blocks else x0, len(ys), tile):
                y = ys[y0:y0 + tile]
                hi = np.maximum(self.size[x][:, None], self.size[y][None, :])
                lo = np.minimum(self.size[x][:, None], self.size[y][None, :])
                ok = (100 * lo >= percent * hi) & (self.comp[x][:, None] != self.comp[y][None, :])
                if not two_blocks and x0 == y0:
                    ok &= np.arange(len(x))[:, None] < np.arange(len(y))[None, :]
                for i in range(table):
                    ok &= self.keys[x, i][:, None] != self.keys[y, i][None, :]
                i, j = np.nonzero(ok)
                for s in range(0, len(i), 1 << 15):
                    yield from self._passing(x[i[s:s + (1 << 15)]], y[j[s:s + (1 << 15)]], m, percent)

    def _passing(self, i: np.ndarray, j: np.ndarray, m: int, percent: int):
        same = self.keys[i] == self.keys[j]
        hit = same[:, m:].any(axis=1)
        i, j, agree = i[hit], j[hit], same[hit].sum(axis=1)
        width = np.minimum(self.width[i], self.width[j])
        for w in np.unique(width).tolist():
            at = np.flatnonzero(width == w)
            step = max(1, (1 << 21) // w)
            for s in range(0, len(at), step):
                p = at[s:s + step]
                nx, ny = self.size[i[p]], self.size[j[p]]
                most = _upper_bound(self._bits(i[p], w), self._bits(j[p], w), nx, ny)
                can = 100 * most >= percent * (nx + ny - most)
                yield i[p][can], j[p][can], agree[p][can]


def _best(x: np.ndarray, y: np.ndarray, agree: np.ndarray, k: int) -> np.ndarray:
    """Indexes of pairs that are among the k most agreeing ones of either end."""
    end, other = np.concatenate([x, y]), np.tile(np.arange(len(x)), 2)
    order = np.lexsort((other, -agree[other], end))
    e = end[order]
    head = np.r_[True, e[1:] != e[:-1]]
    rank = np.arange(len(e)) - np.maximum.accumulate(np.where(head, np.arange(len(e)), 0))
    return np.unique(other[order[rank < k]])


def _cell_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys as one table; the input is sorted by the keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = tuple(c[a] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _candidates(cells: DataFrame, m: int, percent: int, partners: int | None) -> DataFrame:
    """Distinct candidate class pairs ``(x, y, doc_x, doc_y)`` from cells; ``partners``: only the most agreeing ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _cell_groups(batches, ["half", "key", "cell_a", "cell_b"]):
            if group.num_rows < 2:
                continue
            cell = _Cell(group, m)
            two = group["cell_a"][0].as_py() != group["cell_b"][0].as_py()
            if two and cell.block.min() == cell.block.max():
                continue
            parts = list(cell.pairs(group["half"][0].as_py(), m, percent, two))
            if not parts:
                continue
            x, y, agree = (np.concatenate(p) for p in zip(*parts))
            if partners is not None:
                keep = _best(x, y, agree, partners)
                x, y = x[keep], y[keep]
            swap = cell.cls[x] > cell.cls[y]
            x, y = np.where(swap, y, x), np.where(swap, x, y)
            yield pa.RecordBatch.from_arrays([pa.array(cell.cls[x]), pa.array(cell.cls[y]),
                                              pa.array(cell.doc[x]), pa.array(cell.doc[y])],
                                             names=["x", "y", "doc_x", "doc_y"])

    dealt = cells.repartition("half", "key", "cell_a", "cell_b").sortWithinPartitions("half", "key", "cell_a", "cell_b")
    return dealt.mapInArrow(run, "x bigint, y bigint, doc_x bigint, doc_y bigint").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold. Texts are joined by row key and must
    reproduce the class digest, so a repeated id with another text can not stand in."""
    texts = docs.select(_row_key().alias("row"), "text").filter("text is not null")

    def digest_and_set(text: str):
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        values, at = _shingle_sets(raw, np.array([0, len(raw)]), shingle)
        return (int(_set_digests(values, at[:1])[0][0]) if len(values) else 0), values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cached: tuple = (None, 0, None)
        for batch in batches:
            x, y = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for k in range(batch.num_rows):
                ty = batch.column(3)[k].as_py()
                if cached[0] != ty:
                    cached = (ty, *digest_and_set(ty))
                dx, sx = digest_and_set(batch.column(2)[k].as_py())
                both = len(np.intersect1d(sx, cached[2], assume_unique=True))
                if dx == x[k] and cached[1] == y[k] and 100 * both >= percent * (len(sx) + len(cached[2]) - both):
                    keep.append(k)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())),
                                              batch.column(1).take(pa.array(keep, pa.int64()))], names=["src", "dst"])

    one = pairs.join(texts.withColumnsRenamed({"row": "doc_x", "text": "text_x"}), "doc_x")
    two = one.join(texts.withColumnsRenamed({"row": "doc_y", "text": "text_y"}), "doc_y")
    return two.select("x", "y", "text_x", "text_y").mapInArrow(run, "src bigint, dst bigint")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, rows: int = ROWS, miss: float = MISS,
                    block: int = BLOCK, first_partners: int = FIRST_PARTNERS) -> DataFrame:
    """ACTION. ``docs(doc_id, text, ...)`` to ``doc_id, n_shingles, set_a, set_b, component_id, kept``, one
    row per input row. Two documents link when 100 * |intersection| >= percent * |union| of their
    distinct word shingles; component_id is the smallest doc_id reachable over links."""
    m = half_key_count(percent / 100, rows, miss)
    signed = materialize(signatures(docs, shingle, m, rows))
    ids = signed.select("doc_id", "n_shingles", "set_a", "set_b")
    classes = materialize(
        signed.filter("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles")
        .agg(F.min("doc_id").alias("low"), F.min(F.struct("row", "half_keys", "bitmap")).alias("s"))
        .select(F.col("set_a").alias("cls"), "set_b", "n_shingles", "low", F.col("s.row").alias("rep"),
                F.col("s.half_keys").alias("half_keys"), F.col("s.bitmap").alias("bitmap")))

    # half keys in little-endian bytes: 4 bytes each, the first m are the A collection
    halves = F.transform(F.sequence(F.lit(0), F.lit(m - 1)), lambda i: F.struct(
        i.alias("half"), F.substring("half_keys", i * 4 + 1, F.lit(4)).alias("raw")))
    keyed = classes.select("cls", F.explode(halves).alias("h")).select(
        "cls", F.col("h.half").alias("half"), F.conv(F.hex("h.raw"), 16, 10).cast("bigint").alias("key"))
    groups = keyed.groupBy("half", "key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    member = materialize(keyed.join(groups, ["half", "key"]))

    # large groups: blocks of about `block` members, one cell per pair of blocks
    parts = F.ceil(F.col("members") / block).cast("int")
    own = F.pmod(F.xxhash64("cls"), parts).cast("int")
    dealt = (member.withColumns({"parts": parts, "block": own})
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("cls", "half", "key", "block", F.least("block", "other").alias("cell_a"),
                     F.greatest("block", "other").alias("cell_b")))
    payload = classes.select("cls", "n_shingles", "half_keys", "bitmap", "rep")

    start = dealt.join(payload.withColumn("comp", F.col("cls")), "cls")
    first = materialize(_candidates(start, m, percent, first_partners))
    links = materialize(_verified(first, docs, shingle, percent))
    comps = connected(links)

    labelled = payload.join(comps.select(F.col("node").alias("cls"), F.col("label").alias("comp")), "cls", "left") \
        .withColumn("comp", F.coalesce("comp", "cls"))
    rest = materialize(_candidates(dealt.join(labelled, "cls"), m, percent, None)
                       .join(first.select("x", "y"), ["x", "y"], "left_anti"))
    if not rest.isEmpty():
        comps = connected(links.unionByName(_verified(rest, docs, shingle, percent)))

    named = classes.join(comps.select(F.col("node").alias("cls"), "label"), "cls", "left") \
        .select(F.col("cls").alias("set_a"), "set_b", "low", F.coalesce("label", "cls").alias("label"))
    lows = named.groupBy("label").agg(F.min("low").alias("component_low"))
    members = named.join(lows, "label").select("set_a", "set_b", "component_low")
    out = ids.join(members, ["set_a", "set_b"], "left")
    comp = F.when(F.col("n_shingles") > 0, F.col("component_low")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", "set_a", "set_b", comp.alias("component_id"),
                      F.col("doc_id").eqNullSafe(comp).alias("kept"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """ACTION: ``docs`` with one row per component, every column kept: of the rows with the smallest doc_id (with
    NULL, if no row has an id) the one with the smallest text digest, of rows equal in both any one. Texts
    without shingles are no copies of anything: their rows stay."""
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), digest.alias("c"))
    # written once: a key per row, which stands for the doc_id in the search
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("row"), order.alias("order"),
                                   F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")))
    found = near_duplicates(rows.select(F.col("row").alias("doc_id"), "doc.text"), **options) \
        .select(F.col("doc_id").alias("row"), "component_id")
    best = found.join(rows.select("row", "order"), "row").groupBy("component_id") \
        .agg(F.min(F.struct("order", "row")).alias("best")).select(F.col("best.row").alias("row"))
    return rows.join(best, "row", "left_semi").select("doc.*")
