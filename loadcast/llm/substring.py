"""Substring deduplication with fixed-block anchors.

Reference blocks are the non-overlapping half-window blocks of every document (25 words for
windows of 50): whatever the offset, each 50-word window of a document contains one of its blocks.
Every rolling 25-word window of every document probes them.

To keep the probes small, a block and a rolling window are both represented by the smallest of
their 8-word gram hashes: equal windows have equal representatives, and consecutive windows
mostly share one, so a run of windows travels as one row. The steps:

1. runs ``(key, document, from, to, holds a block)`` of all documents; per key the smallest and
   largest document id and whether a block has it (partial aggregates, no group is gathered);
2. a hit is *extended*: all windows of a shared 50-word passage have keys seen in two documents, one
   of them a block's key. Only 50-word windows inside such stretches go on, as 96-bit exact hashes;
3. per window hash the smallest document id; windows of later documents are marked, and the words
   they cover are removed. Texts with the same word sequence are one class: only its first
   document takes part in step 2, every later copy is covered entirely.

Defined cases: NULL and empty texts have no words; a NULL doc_id neither removes nor is removed;
rows that repeat a doc_id do not remove from each other (no smaller id); documents shorter than
the window stay whole; extra columns of any name are kept by ``drop_repeats``; an empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.llm.scratch import materialize
from loadcast.llm.textbytes import Words, mix, sliding_min, slices

WINDOW = 50
GRAM = 8

_RUNS = ("doc_id bigint, seq_a bigint, seq_b bigint, n_words int, "
         "runs array<struct<key:bigint,start:int,stop:int,anchor:boolean>>")


def _sequence_digests(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digest of each text's word sequence (0 for texts without words)."""
    n = len(words.count)
    out = []
    place = np.arange(len(words.hash), dtype=np.uint64) - np.repeat(words.first[:-1], words.count).astype(np.uint64)
    full = np.flatnonzero(words.count)
    for salt in (0xA4093822299F31D1, 0x082EFA98EC4E6C89):
        d = np.zeros(n, dtype=np.uint64)
        if len(full):
            d[full] = np.add.reduceat(mix(words.hash + mix(place + np.uint64(salt))), words.first[:-1][full])
        out.append(d.view(np.int64))
    return out[0], out[1]


def _runs(words: Words, window: int, gram: int):
    """Runs of rolling half windows with one representative: text, key, local from, to, holds a block."""
    half = window // 2
    text = np.repeat(np.arange(len(words.count)), words.count)
    keys = sliding_min(words.windows(gram), half - gram + 1) if len(text) >= half else np.zeros(0, np.uint64)
    n = len(keys)
    t = text[:n]
    valid = (t == text[half - 1:half - 1 + n]) & (words.count[t] >= window)
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (keys[1:] != keys[:-1]) | (t[1:] != t[:-1])
    start = np.flatnonzero(new)
    end_at = np.flatnonzero(np.r_[new, True] | np.r_[~valid, True])  # a run stops at the next run or invalid place
    stop = end_at[np.searchsorted(end_at, start, side="right")]
    base = words.first[:-1][t[start]]
    a, b = start - base, stop - base
    return t[start], keys[start].view(np.int64), a, b, -(-a // half) * half < b


def anchor_runs(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document: word count, word-sequence digest, and its runs of probe windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for a, b, data, offsets in slices(batch, "text"):
                words = Words(data, offsets, lower=False)
                seq_a, seq_b = _sequence_digests(words)
                text, key, start, stop, anchor = _runs(words, window, gram)
                cuts = np.searchsorted(text, np.arange(b - a + 1)).astype(np.int32)
                entries = pa.StructArray.from_arrays(
                    [pa.array(key), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32)), pa.array(anchor)],
                    names=["key", "start", "stop", "anchor"])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a).cast(pa.int64()), pa.array(seq_a), pa.array(seq_b),
                     pa.array(words.count.astype(np.int32)), pa.ListArray.from_arrays(pa.array(cuts), entries)],
                    names=["doc_id", "seq_a", "seq_b", "n_words", "runs"])

    return docs.select("doc_id", "text").mapInArrow(run, _RUNS)


def _covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Flags of the n places covered by [s, s + width) for any start."""
    step = np.zeros(n + 1, dtype=np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + width, n), -1)
    return np.cumsum(step[:n]) > 0


def _candidate_windows(hits: DataFrame, window: int) -> DataFrame:
    """Exact hashes of the windows whose half windows are all shared, one of them anchored."""
    half = window // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for a, b, data, offsets in slices(batch, "text"):
                words = Words(data, offsets, lower=False)
                seq_a = _sequence_digests(words)[0]
                one, two = words.windows(window), words_second(words, window)
                out_t, out_s = [], []
                for t in range(b - a):
                    if seq_a[t] != batch.column(1)[a + t].as_py():
                        continue
                    c = int(words.count[t])
                    runs = batch.column(3)[a + t].values
                    start, stop = (runs.field(k).to_numpy() for k in ("start", "stop"))
                    anchor = runs.field("anchor").to_numpy(zero_copy_only=False)
                    shared, anchored = np.zeros(c + 1, dtype=np.int64), np.zeros(c + 1, dtype=np.int64)
                    for flags, sel in ((shared, slice(None)), (anchored, anchor)):
                        step = np.zeros(c + 1, dtype=np.int64)
                        np.add.at(step, start[sel], 1)
                        np.add.at(step, stop[sel], -1)
                        flags[1:] = np.cumsum(np.cumsum(step[:c]) > 0)
                    span = window - half + 1  # half windows inside one window
                    s = np.arange(c - window + 1)
                    s = s[(shared[s + span] - shared[s] == span) & (anchored[s + span] > anchored[s])]
                    out_t.append(np.full(len(s), a + t))
                    out_s.append(s)
                if not out_t:
                    continue
                rows, s = np.concatenate(out_t), np.concatenate(out_s)
                at = words.first[rows - a] + s
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one[at].view(np.int64)), pa.array((two[at] >> np.uint64(33)).astype(np.int32)),
                     ids.take(take), batch.column(1).take(take), pa.array(s.astype(np.int32))],
                    names=["h", "g", "doc_id", "seq_a", "s"])

    return hits.select("doc_id", "seq_a", "text", "runs").mapInArrow(run, "h bigint, g int, doc_id bigint, seq_a bigint, s int")


def words_second(words: Words, k: int) -> np.ndarray:
    """A second, independent window hash (word hashes mixed again before the polynomial)."""
    other = object.__new__(Words)
    other.hash = mix(words.hash ^ np.uint64(0x452821E638D01377))
    return other.windows(k)


def repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """ACTION. Per doc_id that loses words: ``doc_id, marks`` with one mark per distinct text of that id:
    struct(seq_a, copy = the whole text repeats a smaller document's, starts = first words of marked windows)."""
    runs = materialize(anchor_runs(docs.filter("doc_id is not null"), window, gram).filter(F.col("n_words") >= window))
    classes = runs.groupBy("seq_a", "seq_b").agg(F.min("doc_id").alias("own"))
    owners = materialize(classes)
    documents = runs.select("doc_id", "seq_a", "seq_b").join(owners, ["seq_a", "seq_b"])
    copies = documents.filter("doc_id > own").select("doc_id", "seq_a").distinct()

    rows = runs.select("doc_id", "seq_a", F.explode("runs").alias("r")) \
        .select("doc_id", "seq_a", "r.key", "r.start", "r.stop")
    keys = runs.select("doc_id", F.explode("runs").alias("r")).groupBy("r.key").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.max("r.anchor").alias("anchor"))
    shared = materialize(keys.filter("lo < hi").select("key", "anchor"))
    own_runs = rows.join(shared, "key") \
        .groupBy("doc_id", "seq_a").agg(F.collect_list(F.struct("start", "stop", "anchor")).alias("runs")) \
        .join(owners.select(F.col("own").alias("doc_id"), "seq_a"), ["doc_id", "seq_a"], "left_semi")
    hits = materialize(own_runs.filter(F.exists("runs", lambda r: r["anchor"])))
    texts = docs.select("doc_id", "text").distinct() if _repeated_ids(docs) else docs.select("doc_id", "text")
    windows = materialize(_candidate_windows(texts.join(hits, "doc_id"), window))

    # written, so that the join below has plain exchanges on both sides and a hot passage can be split
    firsts = materialize(windows.groupBy("h", "g").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
                         .filter("lo < hi").select("h", "g", "lo"))
    later = windows.join(firsts, ["h", "g"]).filter("doc_id > lo")
    marked = later.groupBy("doc_id", "seq_a").agg(F.collect_list("s").alias("starts"))
    marks = copies.select("doc_id", "seq_a", F.lit(True).alias("copy"), F.array().cast("array<int>").alias("starts")) \
        .unionByName(marked.select("doc_id", "seq_a", F.lit(False).alias("copy"), "starts"))
    return materialize(marks.groupBy("doc_id").agg(F.collect_list(F.struct("seq_a", "copy", "starts")).alias("marks")))


def _repeated_ids(docs: DataFrame) -> bool:
    """ACTION: whether a doc_id occurs in two rows (ids only, grouped with partial counts)."""
    return not docs.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").isEmpty()


_RESULTS = ("kept_text", "n_words", "n_removed")


def _kept(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """ACTION. ``row`` (struct of all columns but the text), ``text``, and the three results; no input name can clash."""
    found = repeats(docs.select("doc_id", "text"), window, gram).select(F.col("doc_id").alias("key"), "marks")
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    nested = docs.select(others.alias("row"), "text")
    joined = nested.join(found, F.col("row.doc_id") == F.col("key"), "left").select("row", "text", "marks")
    schema = T.StructType([*nested.schema.fields, T.StructField("kept_text", T.StringType()),
                           T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch, "text"):
                words = Words(data, offsets, lower=False)
                marked = batch.column(2).slice(a, b - a)
                seq_a = _sequence_digests(words)[0] if marked.null_count < b - a else None
                raw = data.tobytes()
                kept, removed = [], []
                for t in range(b - a):
                    f, c = int(words.first[t]), int(words.count[t])
                    gone = np.zeros(c, dtype=bool)
                    for m in marked[t].as_py() or ():
                        if m["seq_a"] == seq_a[t]:
                            gone |= True if m["copy"] else _covered(np.array(m["starts"], dtype=np.int64), window, c)
                    stay = np.flatnonzero(~gone) + f
                    kept.append(b" ".join([raw[x:y] for x, y in zip(words.start[stay].tolist(), words.end[stay].tolist())]).decode())
                    removed.append(c - len(stay))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(kept, pa.string()), pa.array(words.count.astype(np.int64)),
                     pa.array(removed, pa.int64())], names=["row", "text", *_RESULTS])

    return joined.mapInArrow(run, schema)


def _flat(name: str) -> Column:
    return F.col("text") if name == "text" else F.col(f"row.`{name}`").alias(name)


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """ACTION. Every input row with ``kept_text`` (its kept words joined by one space), ``n_words`` and
    ``n_removed``. A word is removed when it lies in a window of ``window`` words whose word sequence also
    starts in a document with a smaller doc_id; windows are judged on the input. Extra columns stay; those named like one of
    the three results are replaced by it."""
    return _kept(docs, window, gram).select(*[_flat(c) for c in docs.columns if c.lower() not in _RESULTS], *_RESULTS)


def drop_repeats(docs: DataFrame, **options) -> DataFrame:
    """ACTION: ``docs`` with its repeated passages cut out of ``text`` (untouched texts stay byte for byte);
    documents that lose every word go; ``n_chars``, where present, follows the new text. Same columns."""
    done = _kept(docs, **{"window": WINDOW, "gram": GRAM, **options}).filter("n_removed = 0 or n_removed < n_words")
    cut = F.col("n_removed") > 0
    now = {"text": F.when(cut, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        now["n_chars"] = F.when(cut, F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return done.select(*[now[c].alias(c) if c in now else _flat(c) for c in docs.columns])
