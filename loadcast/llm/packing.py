"""Packing token ids into fixed windows: bounded-space online best fit.

Every task keeps at most ``spaces`` open windows, sorted by their free room, and takes its documents as they
come. A document fills whole windows while it has that many ids; the rest goes to the open window with the
least room that still holds it. When none does and no further window may be opened, the fullest one is
emitted: with its room left as padding when that is at most ``slack``, else after it was filled up by the head of the
document, whose tail is placed anew. So at most ``slack`` places of an emitted window are padding.

Leftovers are merged in levels: the open windows of ``FAN`` neighbouring tasks (at most ``FAN * spaces`` windows) are the
items of one packer of the next level, the fullest first, until one packer is left. What it holds at the end is
laid end to end: whole windows, then windows whose lengths are descending powers of two, which need no padding.
A window travels with its ids, so that items can still be cut; no task ever holds more than that many windows.

The numbers of windows are ``level * 2**56 + part * 2**32 + count`` (part: task or group number): unique, not dense.

Defined cases: NULL and empty texts have the end id alone; NULL and repeated doc_ids are packed like others, one
document per row; a text of any length is cut over as many windows as it takes; extra columns are ignored, whatever
their names; an empty table gives an empty result. A task that runs again packs its rows in the same order."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.bpe import WordTokenizer, _once
from loadcast.llm.scratch import materialize
from loadcast.llm.textbytes import slices

WINDOW = 4096
SPACES = 32   # open windows per packer
SLACK = 8     # places of a window that may be padded when it is emitted
FAN = 32      # tasks or groups whose leftovers meet in one packer of the next level
BATCH = 2048  # pieces per Arrow batch written
CACHE_BYTES = 96 << 20  # of words and their ids, in each of two generations of a task process

Piece = tuple[int | None, int, int, bytes]  # document, ids of it before, all its ids, ids of the piece

_PIECES = "doc_id bigint, start bigint, doc_tokens bigint, ids binary, part bigint, window bigint, offset bigint, closed boolean"
_NAMES = [c.strip().split(" ")[0] for c in _PIECES.split(",")]


def _cut(pieces: list[Piece], size: int) -> tuple[list[Piece], list[Piece]]:
    """The first ``size`` ids of a list of pieces, and the rest."""
    head = []
    for k, (doc, start, total, ids) in enumerate(pieces):
        have = len(ids) // 4
        if size < have:
            if size:
                head.append((doc, start, total, ids[:4 * size]))
            return head, [(doc, start + size, total, ids[4 * size:]), *pieces[k + 1:]]
        head.append(pieces[k])
        size -= have
    return head, []


def _size(pieces: list[Piece]) -> int:
    return sum(len(p[3]) for p in pieces) // 4


class Packer:
    """Open windows of one task. ``place`` and ``finish`` return the windows they close, as lists of pieces."""

    def __init__(self, window: int = WINDOW, spaces: int = SPACES, slack: int = SLACK):
        self.window, self.spaces, self.slack = window, spaces, slack
        self.room: list[tuple[int, int]] = []  # ascending (free places, number) of the open windows
        self.open: dict[int, list[Piece]] = {}
        self.made = 0

    def place(self, pieces: list[Piece]) -> list[list[Piece]]:
        closed, size = [], _size(pieces)
        while size >= self.window:
            head, pieces = _cut(pieces, self.window)
            closed.append(head)
            size -= self.window
        while size:
            at = bisect_left(self.room, (size, -1))
            if at < len(self.room):  # the least room that holds it
                free, number = self.room.pop(at)
                self.open[number] += pieces
                if free == size:
                    closed.append(self.open.pop(number))
                else:
                    insort(self.room, (free - size, number))
                break
            if len(self.room) < self.spaces:
                self.open[self.made] = list(pieces)
                insort(self.room, (self.window - size, self.made))
                self.made += 1
                break
            free, number = self.room.pop(0)  # the fullest
            if free > self.slack:
                head, pieces = _cut(pieces, free)
                self.open[number] += head
                size -= free
            closed.append(self.open.pop(number))
        return closed

    def leftovers(self) -> list[list[Piece]]:
        return [self.open[n] for _, n in self.room]

    def finish(self) -> list[list[Piece]]:
        """The open windows end to end: whole windows, then descending powers of two."""
        rest, closed = [p for w in self.leftovers() for p in w], []
        self.room, self.open = [], {}
        size = _size(rest)
        while size:
            head, rest = _cut(rest, min(self.window, 1 << (size.bit_length() - 1)))
            closed.append(head)
            size = _size(rest)
        return closed


class _Rows:
    """Windows as output rows."""

    def __init__(self, part: int):
        self.part, self.number, self.rows = part, 0, []

    def add(self, windows: list[list[Piece]], closed: bool) -> None:
        for window in windows:
            offset = 0
            for doc, start, total, ids in window:
                self.rows.append((doc, start, total, ids, self.part, self.number, offset, closed))
                offset += len(ids) // 4
            self.number += 1

    def table(self) -> pa.Table:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) or [()] * len(_NAMES)
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=_NAMES)


def library_words(definition: str) -> WordTokenizer:
    """The tokenizers library's model behind the file's own splitting: each distinct word is encoded once."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_str(definition).model
    return WordTokenizer(definition, lambda symbols: [t.id for t in model.tokenize(symbols)], CACHE_BYTES)


def _merged(left: DataFrame, last: bool, window: int, spaces: int, slack: int) -> DataFrame:
    """One level: the leftovers of ``FAN`` neighbouring parts packed by one packer."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        items: dict[tuple[int, int], list[Piece]] = {}
        for r in table.sort_by([("part", "ascending"), ("window", "ascending"), ("offset", "ascending")]).to_pylist():
            items.setdefault((r["part"], r["window"]), []).append((r["doc_id"], r["start"], r["doc_tokens"], r["ids"]))
        packer, out = Packer(window, spaces, slack), _Rows(key[0].as_py())
        for item in sorted(items.values(), key=_size, reverse=True):
            out.add(packer.place(item), True)
        if last:
            out.add(packer.finish(), True)
        else:
            out.add(packer.leftovers(), False)
        return out.table()

    return left.groupBy(F.floor(F.col("part") / FAN).cast("bigint").alias("group")).applyInArrow(run, _PIECES)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, window: int = WINDOW, spaces: int = SPACES,
         slack: int = SLACK) -> DataFrame:
    """ACTION. ``docs(doc_id, text)`` to pieces ``doc_id, start, doc_tokens, ids, sequence_id, offset``: the ids of each text
    (little-endian unsigned 32-bit integers) and ``end_id``, cut and laid into windows of at most ``window`` ids."""
    from pyspark import TaskContext

    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _once(hash((definition, "library")), lambda: library_words(definition))
        packer, out = Packer(window, spaces, slack), _Rows(TaskContext.get().partitionId())
        for batch in batches:
            ids = batch.column(0).cast(pa.int64()).to_pylist()
            for a, b, _, _ in slices(batch, "text"):
                for doc, text in zip(ids[a:b], batch.column(1).slice(a, b - a).to_pylist()):
                    raw = tokenizer.encode(text) + end
                    out.add(packer.place([(doc, 0, len(raw) // 4, raw)]), True)
                    if len(out.rows) >= BATCH:
                        yield from out.table().to_batches()
        out.add(packer.leftovers(), False)
        yield from out.table().to_batches()

    written = materialize(docs.select("doc_id", "text").mapInArrow(run, _PIECES))
    levels, left = [written], written.filter("not closed")
    while (most := left.agg(F.max("part")).first()[0]) is not None:  # one number a level
        merged = materialize(_merged(left, most < FAN, window, spaces, slack))
        levels.append(merged)
        left = merged.filter("not closed")
    number = F.col("level") * (1 << 56) + F.col("part") * (1 << 32) + F.col("window")
    done = [d.filter("closed").withColumn("level", F.lit(k).cast("bigint")) for k, d in enumerate(levels)]
    return reduce(DataFrame.unionAll, done).select("doc_id", "start", "doc_tokens", "ids", number.alias("sequence_id"), "offset")
