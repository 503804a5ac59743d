"""BPE encoding and decoding with an automaton over tokens.

``MergeAutomaton`` is built by applying one gadget per merge, in merge order, to the automaton that
accepts every sequence of base symbols. The gadget of merge (u, v) -> w redirects the arcs labelled u
to a copy of their target without its v arc, and adds an arc w, beside each u arc, into the target of v.
All arcs with one label end in one state, so the state after a token stands for the token itself,
and a state is stored as what its gadgets removed: ``cut[u, v]`` = number of the gadget. A copy inherits
the removals made before it was taken: the state after w = (u, v) starts as that of v, an arc w
starts as that of u. So arc y leaves the state of x unless, along the right parts of x and the left parts of
y, a gadget cut that pair while both parts were still the ends. That test is tabulated as pairs occur.

The final automaton accepts exactly one token sequence per word. It is found left to right; every
prefix of a word has one accepted sequence, so each place of a word is entered at most once, and a
transition is one look-up. Texts are normalised by the tokenizer file's own normaliser, special strings are
cut out first, and words are split by the file's pattern. Decoding emits the arcs' labels.

The tokenizer file is read by the driver and sent to the tasks (a vocabulary, bounded by its file).

Defined cases: NULL and empty texts have no ids and decode to an empty text; equal texts have equal
ids; unknown symbols (none in a byte-level vocabulary) are left out; extra columns are kept."""

from __future__ import annotations

import gc
import json
import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loadcast.llm.textbytes import slices

CACHE_BYTES = 32 << 20  # of words and their ids remembered per task process, in each of two generations
CACHED_ARCS = 120_000   # tabulated arc tests per task process (bounds on memory; results do not depend on them)


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself for visible Latin-1
    characters, else the next free code point from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, free = [""] * 256, 256
    for b in range(256):
        if b in visible:
            out[b] = chr(b)
        else:
            out[b], free = chr(free), free + 1
    return out


class MergeAutomaton:
    """Deterministic automaton over token ids for one ranked merge list."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.suffix = suffix
        born: dict[int, int] = {}
        left: dict[int, int] = {}
        right: dict[int, int] = {}
        self.cut: dict[tuple[int, int], int] = {}
        self.born, self.left, self.right = born, left, right
        self.steps: dict[int, bool] = {}
        for n, (a, b) in enumerate(merges):
            u, v = vocab[a], vocab[b]
            w = vocab[a + b]
            if (u, v) in self.cut or w in born or not self._arc(u, v):
                continue  # the pair never meets, or the token exists already: the gadget has nothing to redirect
            self.cut[u, v] = n
            born[w], left[w], right[w] = n, u, v
        made = set(born)
        parts = {x for pair in self.cut for x in pair}
        # arcs: every built token and every base symbol (those are in the vocabulary but made by no merge)
        whole = {a + b for a, b in merges}
        arcs = {t: i for t, i in vocab.items() if i in made or i in parts or t not in whole}
        self.last = {t.removesuffix(suffix): i for t, i in arcs.items() if t.endswith(suffix)}
        self.inner = {t: i for t, i in arcs.items() if not (suffix and t.endswith(suffix))}
        self.reach: dict[str, int] = {}  # longest label that begins with these two symbols
        for t in (*self.last, *self.inner):
            self.reach[t[:2]] = max(self.reach.get(t[:2], 1), len(t))

    def _arc(self, x: int, y: int) -> bool:
        """Whether an arc y leaves the state after x."""
        cut, x_until = self.cut, 1 << 60
        while True:
            part, y_until = y, 1 << 60
            while True:
                n = cut.get((x, part))
                if n is not None and n < x_until and n <= y_until:
                    return False
                if part not in self.left:
                    break
                part, y_until = self.left[part], self.born[part]
            if x not in self.right:
                return True
            x, x_until = self.right[x], self.born[x]

    def encode(self, symbols: str) -> list[int]:
        """The accepted token sequence of one word, given as byte symbols (the last one carries the suffix).

        Arcs are tried longest label first. A prefix has one accepted sequence, so a place that was
        reached and left without success is never entered again."""
        whole = self.last.get(symbols)
        if whole is not None:
            return [whole]
        n = len(symbols)
        last, inner, steps, reach = self.last, self.inner, self.steps, self.reach
        out: list[int] = []
        at: list[int] = []  # where each chosen token starts
        dead: set[int] = set()
        i, x = 0, -1
        j = min(n - 1, reach.get(symbols[:2], 1))
        while True:
            while j > i:
                if j == n:
                    y = last.get(symbols[i:])
                elif j in dead:
                    y = None
                else:
                    y = inner.get(symbols[i:j])
                if y is not None:
                    if x < 0:
                        break
                    ok = steps.get(x << 32 | y)
                    if ok is None:
                        if len(steps) >= CACHED_ARCS:
                            steps.clear()
                        ok = steps[x << 32 | y] = self._arc(x, y)
                    if ok:
                        break
                j -= 1
            if j > i:
                out.append(y)
                if j == n:
                    return out
                at.append(i)
                i, x = j, y
                j = min(n, i + reach.get(symbols[i:i + 2], 1))
            else:
                if not out:
                    return []
                dead.add(i)
                j = i - 1
                out.pop()
                i = at.pop()
                x = out[-1] if out else -1


class _Words(dict):
    """Word -> little-endian ids, filled on demand by ``encode_symbols``. Two generations of bounded bytes: a full
    one becomes the old one, and words met again move to the new one."""

    def __init__(self, encode_symbols: Callable[[str], Sequence[int]], cache_bytes: int):
        super().__init__()
        self.encode_symbols, self.symbols, self.old = encode_symbols, byte_symbols(), {}
        self.room = self.bytes = cache_bytes

    def __missing__(self, word: str) -> bytes:
        out = self.old.pop(word, None)
        if out is None:
            symbols = self.symbols
            out = np.array(self.encode_symbols("".join([symbols[b] for b in word.encode()])), dtype="<u4").tobytes()
        self.room -= 200 + 4 * len(word) + len(out)  # about what Python keeps for them
        if self.room < 0:
            self.old, self.room = dict(self), self.bytes
            self.clear()
        self[word] = out
        return out


def _latin(category: str, more: str = "") -> str:
    """The Latin-1 characters of a Unicode category, for use inside a character class."""
    return re.escape("".join(c for c in map(chr, range(256)) if unicodedata.category(c).startswith(category)) + more)


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class WordTokenizer:
    """Normalise, cut out special strings, split, and encode word by word: by the automaton, or by
    ``encode_symbols`` (byte symbols of a word to its ids)."""

    def __init__(self, definition: str, encode_symbols: Callable[[str], Sequence[int]] | None = None, cache_bytes: int = CACHE_BYTES):
        from tokenizers import Tokenizer

        spec = json.loads(definition)
        if encode_symbols is None:
            model = spec["model"]
            merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
            encode_symbols = MergeAutomaton(model["vocab"], merges, model["end_of_word_suffix"] or "").encode
        self.words = _Words(encode_symbols, cache_bytes)
        bare = spec | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": [], "post_processor": None}
        self.normalise = Tokenizer.from_str(json.dumps(bare)).normalizer.normalize_str
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"]
        self.find = regex.compile(pattern).findall
        # Latin-1 texts are in composed form and lower-case char by char, and white space is never in a
        # word: for them the standard library does the same work in a third of the time
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        self.plain = steps == ["NFC", "Replace", "Lowercase"]
        self.find_latin = re.compile(pattern.replace(r"\p{L}", _latin("L")).replace(r"\p{N}", _latin("N"))
                                     .replace(r"\s", _latin("Z", "\t\n\x0b\x0c\r\x85"))).findall
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        look = self.words.__getitem__
        parts = []
        for k, piece in enumerate(self.cut(text)):
            if k % 2:
                parts.append(np.array([self.special[piece]], dtype="<u4").tobytes())
            elif piece:
                if self.plain and _is_latin(piece):
                    words = self.find_latin(piece.lower())
                else:
                    words = self.find(self.normalise(piece))
                parts.extend(map(look, words))
        return b"".join(parts)


_built: dict[int, object] = {}


def _once(key: int, make):
    """One built object per task process and definition."""
    if key not in _built:
        _built.clear()
        gc.collect()
        _built[key] = make()
    return _built[key]


def _definition(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _labels(definition: str) -> np.ndarray:
    """The label of every id."""
    spec = json.loads(definition)
    if spec["decoder"] is not None:
        raise ValueError("only tokenizer files without a decoder step are supported")
    found = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    table = np.full(max(found.values()) + 1, "", dtype=object)
    for t, i in found.items():
        table[i] = t
    return table


def _decoded(table: np.ndarray, raw: bytes | None) -> str:
    return " ".join(table[np.frombuffer(raw or b"", dtype="<u4")].tolist())


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with ``out``: ids of ``text`` as little-endian unsigned 32-bit integers. ``path``: tokenizer file. With ``decoded``,
    that column holds the ids' labels again, from the same pass (one Python worker per task in place of two)."""
    definition = _definition(path)
    names = [c for c in docs.columns if c not in (out, decoded)]
    more = [T.StructField(out, T.BinaryType())] + ([T.StructField(decoded, T.StringType())] if decoded else [])
    schema = T.StructType([*(docs.schema[c] for c in names), *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, table = _once(hash((definition, "encode", bool(decoded))), lambda: (
            WordTokenizer(definition), _labels(definition) if decoded else None))
        for batch in batches:
            for a, b, _, _ in slices(batch, text):
                part = batch.slice(a, b - a)
                ids = [tokenizer.encode(t) for t in part.column(part.schema.get_field_index(text)).to_pylist()]
                made = [pa.array(ids, pa.binary())] + ([pa.array([_decoded(table, r) for r in ids], pa.string())] if decoded else [])
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in names), *made],
                                                 names=schema.fieldNames())

    return docs.select(*names).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with ``out``: the labels of the ids in order, special ones too, joined by a space
    (the tokenizer file has no decoder of its own)."""
    definition = _definition(path)
    names = [c for c in encoded.columns if c != out]
    schema = T.StructType([*(encoded.schema[c] for c in names), T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _once(hash((definition, "decode")), lambda: _labels(definition))
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [_decoded(table, r) for r in part.column(part.schema.get_field_index(ids)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(c)) for c in names), pa.array(texts, pa.string())],
                    names=[*names, out])

    return encoded.select(*names).mapInArrow(run, schema)
