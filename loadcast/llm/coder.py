"""Token ids as compact binary blocks: an adaptive context-mixing range coder.

A block holds the ids of whole documents (a longer document gets blocks of its own), starts from
an empty model and carries checksums, so it is decoded alone and a damaged one is found.

Model, per id: an order-2 table (the id that last followed the two ids before), an order-1 table
(the id that last followed the one before), and adaptive order-0 counts. Each table entry has a
confidence; how often entries of a confidence were right in this block so far gives its share
of the probability, the order-0 counts share the rest. The mixture is an interval of 2**28
that drives a carry-less 64-bit range coder writing 16-bit words.

A block is cut into lanes that advance in lockstep as NumPy vectors, each with its own coder
state; all lanes learn one shared model step by step, so the work per id is a few vector
operations and the decoder repeats it exactly.

Defined cases: NULL and empty texts have the end id alone; NULL ids come first; rows that repeat an id stay, ordered by
their text (NULL first); a document longer than a block fills blocks of its own; extra columns are ignored; an empty table gives an empty
result. Ids are below 2**18 (others raise).

``write`` deals documents by ranges of doc_id and writes blocks in ascending order as rows
``(part, block, n_docs, n_ids, split, payload)`` of a Parquet folder; ``read`` gives back one row per document."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadcast.llm.bpe import _is_latin, _latin, _once, byte_symbols
from loadcast.llm.textbytes import slices

BLOCK_IDS = 1 << 20
LANES = 8192
SLICE_CHARS = 1 << 23  # about what is split together; temporaries stay near 15 times that
CACHED_PIECES = 300_000  # pieces remembered per task process, in each of two generations
KEY_CHARS = 64  # of a text that deal rows of one id to tasks

_MAGIC = b"CMR1"
_HEAD = struct.Struct("<4sIIIIII")  # magic, ids, documents, lanes, largest id + 1, crc of ids, crc of what follows
_TOTAL_BITS = 28
_TOTAL = 1 << _TOTAL_BITS
_BOTTOM = np.uint64(1 << 32)
_SLOTS_BITS = 18
_FINE = 20  # order-0 counts never add up to more than 2**20, and smallest order-0 shares are 2**20 wide
_ROOM = np.uint64(1 << 48)
_U = np.uint64
_U32 = np.uint32
_BLOCKS = "part bigint, block bigint, n_docs bigint, n_ids bigint, split boolean, payload binary"


_EMPTY = -8  # an entry is its guess * 8 + its trust; no guess yet: -1 with trust 0


class _Model:
    """Shared adaptive state of a block; every method works on one step of all active lanes.

    What a lane does with its shares follows from a case of 8 bits: trust of order 1 (0 where it guesses as order 2
    does), trust of order 2, whether order 1 was right, whether order 2 was. Shares are looked up by case, and one
    count of the cases teaches both tables."""

    def __init__(self, symbols: int):
        self.symbols = symbols
        self.freq = np.ones(symbols, dtype=np.int64)
        self.cum = (np.arange(symbols + 1, dtype=np.int64) << _FINE) // max(1, symbols)  # scaled to 2**20
        self.entries = [np.full(n, _EMPTY, dtype=np.int32) for n in (symbols + 1, 1 << _SLOTS_BITS)]
        self.right = np.ones((2, 8), dtype=np.int64)
        self.tried = np.full((2, 8), 2, dtype=np.int64)
        self.fresh: list[np.ndarray] = []
        self.step = 0
        self.holder: np.ndarray | None = None  # id of every unit of ``cum``; only decoding asks for it

    def predict(self, one: np.ndarray, two: np.ndarray) -> None:
        """Guesses of both orders after these ids, and interval sizes by case: order 2, order 1, what is left for order 0."""
        slot = two.astype(_U32)
        slot *= _U32(0x9E3779B1)
        slot += one.astype(_U32) * _U32(0x85EBCA6B)
        slot >>= _U32(32 - _SLOTS_BITS)
        self.at = (one, slot.astype(np.int64))
        self.e1, self.e2 = e1, e2 = self.entries[0].take(one), self.entries[1].take(self.at[1])
        share = np.minimum(_TOTAL * self.right // self.tried, _TOTAL - _TOTAL // 16)
        share[:, 0] = 0  # trust 0: no guess yet
        rest = _TOTAL - share[1]
        self.m2 = np.repeat(share[1], 8)
        m1 = (rest[:, None] * share[0] >> _TOTAL_BITS).ravel()
        self.m12 = self.m2 + m1
        self.m0 = np.repeat(rest, 8) - m1
        self.t1, self.t2 = e1 & 7, e2 & 7
        self.case = self.t1 * ((e1 ^ e2).view(_U32) > 7)
        self.case += self.t2 << 3

    def interval(self, ids: np.ndarray):
        """Start and size of each id's interval."""
        self.known = known = ids.astype(np.int32) << 3
        self.hit1, self.hit2 = (self.e1 ^ known).view(_U32) < 8, (self.e2 ^ known).view(_U32) < 8
        self.case += self.hit1.view(np.int8) * np.int32(64)
        self.case += self.hit2.view(np.int8) * np.int32(128)
        case = self.case = self.case.astype(np.int64)
        none = np.zeros(64, dtype=np.int64)
        # by case: none was right, order 1, order 2, both
        m0 = np.concatenate([self.m0, none, none, none]).take(case)
        start = np.concatenate([self.m12, self.m2, none, none]).take(case)
        size = np.concatenate([none, self.m12 - self.m2, self.m2, self.m2]).take(case)
        lo = self.cum.take(ids)
        lo *= m0
        lo >>= _FINE
        m0 *= self.cum.take(ids + 1)
        m0 >>= _FINE
        start += lo
        size += m0
        size -= lo
        return start, size

    def find(self, value: np.ndarray) -> np.ndarray:
        """The id whose interval holds each value."""
        over = value - self.m12.take(self.case)
        ids = (np.where(value < self.m2.take(self.case), self.e2, self.e1) >> 3).astype(np.int64)
        low = np.flatnonzero(over >= 0)
        if len(low):
            if self.holder is None:
                self.holder = np.repeat(np.arange(self.symbols, dtype=np.uint16 if self.symbols <= 1 << 16 else np.int32), np.diff(self.cum))
            # exact in doubles: below 2**49 over at most 2**28, and quotients below 2**20
            y = (((over.take(low) + 1) << _FINE) - 1) / self.m0.take(self.case.take(low))
            ids[low] = self.holder.take(y.astype(np.int64))
        return ids

    def learn(self, ids: np.ndarray) -> None:
        both = np.bincount(self.case, minlength=256).reshape(2, 2, 8, 8)  # right 2, right 1, trust 2, trust 1
        seen = np.stack([both[0].sum(axis=1), both.sum(axis=(1, 3))])  # order 1 was not asked where order 2 was right
        seen[:, :, 0] = 0  # no guess yet
        self.tried += seen.sum(axis=1)
        self.right += seen[:, 1]
        for k in np.flatnonzero(self.tried.max(axis=1) > 1 << 20):
            self.tried[k] = (self.tried[k] >> 1) + 2
            self.right[k] = (self.right[k] >> 1) + 1
        fresh = self.known + 1
        for k, (hit, trust, entry) in enumerate(((self.hit1, self.t1, self.e1), (self.hit2, self.t2, self.e2))):
            # right: trust grows by 1 up to 7; wrong: it is halved, or below 2 the entry replaced
            wrong = hit.view(np.int8) - np.int32(1)  # all bits where wrong, none where right
            lost = wrong & ((trust - 2) >> 31)
            told = entry + (trust < 7)
            told += ((-((trust + 1) >> 1)) - (trust < 7)) & wrong
            told ^= (told ^ fresh) & lost
            self.entries[k][self.at[k]] = told
        self.fresh.append(ids)
        self.step += 1
        if self.step < 8 or self.step % 8 == 0:
            self.freq += 24 * np.bincount(np.concatenate(self.fresh), minlength=self.symbols)
            self.fresh = []
            while int(self.freq.sum()) > 1 << 20:
                self.freq += 1
                self.freq >>= 1
            cum = np.cumsum(self.freq)
            self.cum[1:] = (cum << _FINE) / cum[-1]  # exact in doubles: at most 2**40 over at most 2**20
            self.holder = None


def _settle(low: np.ndarray, rng: np.ndarray, emit) -> None:
    """Shift out 16-bit words until every lane has room again; ``emit(lanes)`` is called before each shift."""
    lanes, a, r = None, low, rng
    while True:
        last = r - _U(1)
        last += a
        last ^= a
        same = last < _ROOM
        short = r < _BOTTOM
        short &= ~same
        if short.any():
            r = np.where(short, (_U(0) - a) & (_BOTTOM - _U(1)), r)
            same |= short
        at = np.flatnonzero(same)
        if not len(at):
            return
        lanes = at if lanes is None else lanes.take(at)
        a, r = a.take(at), r.take(at)
        emit(lanes)
        a <<= _U(16)
        r <<= _U(16)
        r[r == 0] = _U(0xFFFFFFFFFFFFFFFF)
        low[lanes], rng[lanes] = a, r


def _shape(n: int, lanes: int) -> tuple[int, int]:
    """Ids per lane and lanes that have ids."""
    steps = -(-n // max(1, lanes))
    return steps, -(-n // steps) if steps else 0


def _by_step(ids: np.ndarray, steps: int, lanes: int) -> list[np.ndarray]:
    """The ids that the lanes take in each step, side by side; in the last steps the last lane may have none."""
    full = np.ascontiguousarray(ids[:(lanes - 1) * steps].reshape(lanes - 1, steps).T)
    last = ids[(lanes - 1) * steps:]
    return [np.append(row, last[s:s + 1]) for s, row in enumerate(full)]


def encode_block(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, skips: list[int] | None = None,
                 more: bool = False, max_lanes: int = LANES) -> bytes:
    """One self-contained block. ``lengths``: ids of each document (they add up to ``len(ids)``); ``skips``: ids
    of the document in earlier blocks; ``more``: the last document goes on in the next block."""
    ids = np.asarray(ids)
    skips = skips or [0] * len(doc_ids)
    n = len(ids)
    steps, lanes = _shape(n, min(max_lanes, max(1, n // 128)))
    symbols = int(ids.max()) + 1 if n else 0
    if symbols > 1 << 18:
        raise ValueError("ids from 2**18 on are not supported")
    ids = ids.astype("<u4", copy=False)
    words, owners, turns = [], [], []
    count = np.zeros(lanes, dtype=np.int64)
    if n:
        rows = _by_step(ids, steps, lanes)
        model = _Model(symbols)
        low, rng = np.zeros(lanes, _U), np.full(lanes, 0xFFFFFFFFFFFFFFFF, _U)
        one = two = np.full(lanes, symbols, dtype=np.int64)

        def emit(at: np.ndarray) -> None:
            put(at, low.take(at) >> _U(48))

        def put(at: np.ndarray, word: np.ndarray) -> None:
            turn = count.take(at)
            owners.append(at)
            turns.append(turn)
            words.append(word.astype("<u2"))
            count[at] = turn + 1

        for now in rows:
            now, k = now.astype(np.int64), len(now)
            a, r = low[:k], rng[:k]
            model.predict(one[:k], two[:k])
            start, size = model.interval(now)
            unit = r >> _U(_TOTAL_BITS)
            a += unit * start.view(_U)
            np.multiply(unit, size.view(_U), out=r)
            _settle(a, r, emit)
            model.learn(now)
            two, one = one[:k], now
        for shift in (48, 32, 16, 0):
            put(np.arange(lanes), (low >> _U(shift)) & _U(0xFFFF))
    first = np.cumsum(count) - count
    word = np.zeros(int(count.sum()), "<u2")
    for owner, turn, some in zip(owners, turns, words):  # each lane's words side by side
        word[first.take(owner) + turn] = some
    marks = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    if more:
        marks[-1] |= 2
    body = b"".join([
        marks.tobytes(), np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(), np.array(skips, dtype="<i8").tobytes(),
        np.array(lengths, dtype="<u4").tobytes(),
        count.astype("<u4").tobytes(), word.tobytes()])
    return _HEAD.pack(_MAGIC, n, len(doc_ids), lanes, symbols, zlib.crc32(ids.tobytes()), zlib.crc32(body)) + body


def decode_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray, np.ndarray, bool]:
    """Document ids, lengths, ids, skips and ``more`` of a block; raises ValueError when a checksum does not hold."""
    magic, n, docs, lanes, symbols, ids_crc, body_crc = _HEAD.unpack_from(block)
    body = memoryview(block)[_HEAD.size:]
    if magic != _MAGIC or zlib.crc32(body) != body_crc:
        raise ValueError("damaged block")
    marks = np.frombuffer(body, np.uint8, docs)
    doc_ids = [d if k & 1 else None for k, d in zip(marks.tolist(), np.frombuffer(body, "<i8", docs, docs).tolist())]
    skips = np.frombuffer(body, "<i8", docs, 9 * docs)
    lengths = np.frombuffer(body, "<u4", docs, 17 * docs)
    counts = np.frombuffer(body, "<u4", lanes, 21 * docs).astype(np.int64)
    words = np.frombuffer(body, "<u2", -1, 21 * docs + 4 * lanes).copy()  # aligned
    ids = np.zeros(n, dtype="<u4")
    if n:
        steps = -(-n // lanes)
        model = _Model(symbols)
        at = np.concatenate([[0], np.cumsum(counts)[:-1]])
        low, rng, code = np.zeros(lanes, _U), np.full(lanes, 0xFFFFFFFFFFFFFFFF, _U), np.zeros(lanes, _U)
        for _ in range(4):
            code = (code << _U(16)) | words[at]
            at += 1

        def refill(lanes_now: np.ndarray) -> None:
            place = at.take(lanes_now)
            code[lanes_now] = (code.take(lanes_now) << _U(16)) | words.take(place)
            at[lanes_now] = place + 1

        one = two = np.full(lanes, symbols, dtype=np.int64)
        found = np.zeros((steps, lanes), dtype="<u4")
        whole = n - (lanes - 1) * steps  # steps in which the last lane has an id, too
        for s in range(steps):
            k = lanes - (s >= whole)
            a, r = low[:k], rng[:k]
            model.predict(one[:k], two[:k])
            unit = r >> _U(_TOTAL_BITS)
            value = np.minimum((code[:k] - a) // unit, _U(_TOTAL - 1)).view(np.int64)
            now = model.find(value)
            start, size = model.interval(now)
            a += unit * start.view(_U)
            np.multiply(unit, size.view(_U), out=r)
            _settle(a, r, refill)
            found[s, :k] = now
            model.learn(now)
            two, one = one[:k], now
        ids = found.T.ravel()[:n]
    if zlib.crc32(ids) != ids_crc:
        raise ValueError("ids do not match their checksum")
    return doc_ids, lengths, ids, skips, bool(docs and marks[-1] & 2)


_PACK = [struct.Struct(f"<{n}I").pack for n in range(64)]


class _Pieces(dict):
    """Piece -> little-endian ids, filled on demand by the library's model. A full generation becomes the old one, and
    pieces met again move to the new one."""

    def __init__(self, model):
        super().__init__()
        self.tokenize, self.symbols, self.old = model.tokenize, byte_symbols(), {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHED_PIECES:
            self.old = dict(self)
            self.clear()
        out = self[piece] = self.old.pop(piece, None) or self.encode(piece)
        return out

    def get_all(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces; those not met yet are encoded one after the other, while the model's tables are at hand."""
        found = list(map(self.get, pieces))
        old = self.old.pop
        new = [k for k, ids in enumerate(found) if ids is None]
        for k in new:
            found[k] = old(pieces[k], None)
        made = [k for k in new if found[k] is None]
        for k, ids in zip(made, list(map(self.encode, [pieces[k] for k in made]))):
            found[k] = ids
        if len(self) + len(new) > CACHED_PIECES:
            self.old = dict(self)
            self.clear()
        self.update([(pieces[k], found[k]) for k in new[-CACHED_PIECES:]])
        return found

    def encode(self, piece: str) -> bytes:
        symbols = self.symbols
        if piece.isascii() and piece.isprintable():  # only the space has a stand-in among these
            text = piece.replace(" ", symbols[32])
        else:
            text = "".join([symbols[b] for b in piece.encode()])
        ids = [t.id for t in self.tokenize(text)]
        return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)


class PieceTokenizer:
    """A byte-level tokenizer file: texts are split by its public pattern, each distinct piece is
    encoded once by the library's model, special strings in texts become their ids (library default)."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_str(definition)
        # Fixed text: the split pattern of byte-level pre-tokenizers, 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
        # with letters first (none starts with an apostrophe) and without needless backtracking.
        pattern = r" ?+\p{L}++| ?+\p{N}++|'(?:[stmd]|re|ve|ll)| ?+[^\s\p{L}\p{N}]++|\s+(?!\S)|\s++"
        self.find = regex.compile(pattern).findall
        self.find_latin = re.compile(_latin_pattern(pattern, _latin("Z", "\t\n\x0b\x0c\r\x85"))).findall
        self.special = {t.content: i for i, t in whole.get_added_tokens_decoder().items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split \
            if self.special else (lambda text: [text])
        self.pieces = _Pieces(whole.model)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        look, parts = self.pieces.__getitem__, []
        for k, segment in enumerate(self.cut(text)):
            if k % 2:
                parts.append(np.array([self.special[segment]], dtype="<u4").tobytes())
            elif segment:
                parts.extend(map(look, (self.find_latin if _is_latin(segment) else self.find)(segment)))
        return b"".join(parts)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """``encode`` of each text. Latin-1 texts without special strings are split together, and each of their distinct
        pieces is looked up once."""
        out, latin, at = [b""] * len(texts), [], []
        for k, text in enumerate(texts):
            if text:
                try:
                    raw = text.encode("latin-1") if len(text) <= SLICE_CHARS else None
                except UnicodeEncodeError:
                    raw = None
                if raw is None or len(self.cut(text)) > 1:
                    out[k] = self.encode(text)
                else:
                    latin.append(raw)
                    at.append(k)
        if latin:
            ends = np.cumsum([len(raw) for raw in latin])
            first = np.concatenate([[0], ends[:-1]])
            text = b"".join(latin)
            starts = _piece_starts(np.frombuffer(text, np.uint8), first)
            offsets = np.append(starts, len(text)).astype(np.int32)
            coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(text)]).dictionary_encode()
            found = self.pieces.get_all([p.decode("latin-1") for p in coded.dictionary.to_numpy(zero_copy_only=False).tolist()])
            # 32 bits hold all places: a slice has no more ids than bytes
            size = np.fromiter(map(len, found), np.int32, len(found)) >> 2
            which = coded.indices.to_numpy()
            sizes = size.take(which)
            after = np.cumsum(sizes, dtype=np.int32)
            place = np.repeat((np.cumsum(size, dtype=np.int32) - size).take(which) - (after - sizes), sizes)
            place += np.arange(len(place), dtype=np.int32)
            ids = np.frombuffer(b"".join(found), "<u4").take(place).tobytes()
            cuts = 4 * np.append((after - sizes)[np.searchsorted(starts, first)], after[-1]).astype(np.int64)
            for k, a, b in zip(at, cuts[:-1].tolist(), cuts[1:].tolist()):
                out[k] = ids[a:b]
        return out


_CLASS = np.full(256, 3, dtype=np.uint8)  # of Latin-1 characters: white, letter, digit, other
for _k, _some in enumerate((r"\t\n\x0b\x0c\r\x85" + _latin("Z"), _latin("L"), _latin("N"))):
    _CLASS[[ord(c) for c in re.findall(f"[{_some}]", "".join(map(chr, range(256))))]] = _k


def _piece_starts(text: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the pieces of texts start that lie side by side in Latin-1; ``first``: where each text (none is empty) starts.

    The pattern of ``PieceTokenizer`` by classes of characters: a piece is a run of one class. Of white space before another
    character the last one is a piece of its own, or, if a space, goes to the piece behind it. An apostrophe that
    starts a piece takes s, t, m, d, re, ve or ll with it."""
    kind = _CLASS.take(text)
    starts = np.ones(len(text), dtype=bool)
    np.not_equal(kind[1:], kind[:-1], out=starts[1:])
    begins = np.zeros(len(text) + 3, dtype=bool)  # no text goes on past the end
    begins[first] = begins[len(text):] = True
    starts |= begins[:len(text)]
    behind = np.flatnonzero((kind[1:] != 0) & (kind[:-1] == 0) & ~begins[1:len(text)])  # last white space before another character
    starts[behind] = True
    starts[behind[text.take(behind) == 32] + 1] = False
    quote = np.flatnonzero(text == 39)
    quote = quote[starts.take(quote)]
    one, two = (np.append(text, [0, 0, 0]).take(quote + k) for k in (1, 2))
    short = np.isin(one, list(b"stmd")) & ~begins.take(quote + 1)
    long = (((two == 101) & ((one == 114) | (one == 118))) | ((one == 108) & (two == 108))) & ~begins.take(quote + 1) & ~begins.take(quote + 2)
    for some, n in ((short, 2), (long, 3)):
        starts[quote[some] + 1] = False
        after = quote[some] + n
        starts[after[after < len(text)]] = True
    return np.flatnonzero(starts)


def _latin_pattern(pattern: str, white: str) -> str:
    """The pattern for Latin-1 texts, in the standard library's syntax."""
    letters, digits = _latin("L"), _latin("N")
    pattern = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{white}{letters}{digits}]")
    return (pattern.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{digits}]")
            .replace(r"\S", f"[^{white}]").replace(r"\s", f"[{white}]"))


def write(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, block_ids: int = BLOCK_IDS) -> None:
    """ACTION: encode ``docs(doc_id, text)``, append ``end_id`` to each document, and write the blocks in
    ascending doc_id order (NULL ids first; rows that repeat an id in order of their text)."""
    from pyspark import TaskContext

    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _once(hash((definition, "pieces")), lambda: PieceTokenizer(definition))
        part, block = TaskContext.get().partitionId(), 0
        names: list = []
        lengths: list[int] = []
        held: list[bytes] = []
        skips: list[int] = []
        size = 0

        def flush(more: bool = False) -> pa.RecordBatch:
            nonlocal names, lengths, held, skips, size, block
            payload = encode_block(names, lengths, np.frombuffer(b"".join(held), dtype="<u4"), skips, more)
            out = pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([block]), pa.array([len(names)]), pa.array([size]),
                 pa.array([more or skips[0] > 0]), pa.array([payload], pa.binary())],
                names=["part", "block", "n_docs", "n_ids", "split", "payload"])
            names, lengths, held, skips, size, block = [], [], [], [], 0, block + 1
            return out

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for a, b, _, _ in slices(batch, "text", SLICE_CHARS):
                for doc, raw in zip(doc_ids[a:b], tokenizer.encode_all(batch.column(1).slice(a, b - a).to_pylist())):
                    raw += end
                    if size and size + len(raw) // 4 > block_ids:
                        yield flush()
                    for at in range(0, len(raw), 4 * block_ids):  # a longer document fills blocks of its own
                        piece = raw[at:at + 4 * block_ids]
                        names.append(doc)
                        lengths.append(len(piece) // 4)
                        held.append(piece)
                        skips.append(at // 4)
                        size += len(piece) // 4
                        if size >= block_ids:
                            yield flush(at + len(piece) < len(raw))
        if names:
            yield flush()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", F.substring("text", 1, KEY_CHARS)) \
        .sortWithinPartitions("doc_id", "text")
    blocks = ordered.mapInArrow(run, _BLOCKS)
    blocks.write.option("compression", "none").parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the folder: ``doc_id, start`` (ids of all documents before it), ``n_ids`` and
    ``ids`` (little-endian unsigned 32-bit integers). A document in several blocks is put together again."""
    blocks = spark.read.schema(_BLOCKS).parquet(folder)
    # where each part starts: one row per part; where each block starts: inside its part
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("part_at"))
    inside = blocks.select("part", "block", (F.sum("n_ids").over(Window.partitionBy("part").orderBy("block")) - F.col("n_ids"))
                           .alias("block_at"))
    offsets = inside.join(before, "part").select("part", "block", (F.col("part_at") + F.col("block_at")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                doc_ids, lengths, ids, skips, more = decode_block(row["payload"])
                raw = ids.astype("<u4").tobytes()
                ends = np.cumsum(lengths.astype(np.int64))
                starts = ends - lengths
                n = len(doc_ids)
                split = skips > 0
                if more:
                    split[-1] = True
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(starts + row["at"] - skips), pa.array(skips), pa.array(split),
                     pa.array(lengths.astype(np.int64)),
                     pa.array([raw[4 * x:4 * y] for x, y in zip(starts.tolist(), ends.tolist())], pa.binary())],
                    names=["doc_id", "start", "skip", "split", "n_ids", "ids"])

    def pieces(some: DataFrame) -> DataFrame:
        return some.select("part", "block", "payload").join(offsets, ["part", "block"]) \
            .select("part", "block", "at", "payload") \
            .mapInArrow(run, "doc_id bigint, start bigint, skip bigint, split boolean, n_ids bigint, ids binary")

    whole = pieces(blocks).filter("not split").select("doc_id", "start", "n_ids", "ids")
    # only the blocks that share a document with another one are decoded again for it
    joined = pieces(blocks.filter("split")).filter("split").groupBy("doc_id", "start").agg(
        F.sum("n_ids").alias("n_ids"), F.array_sort(F.collect_list(F.struct("skip", "ids"))).alias("p"))
    ids = F.reduce("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return whole.unionByName(joined.select("doc_id", "start", "n_ids", ids.alias("ids")))
