"""Bounded-space packing: every id once, the library's ids, gapless windows, little padding, odd rows."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from loadcast.llm import packing, queries
from loadcast.llm.packing import Packer

PATH = P.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(PATH)
    tok.no_truncation()
    tok.no_padding()
    return lambda t: [*tok.encode(t or "", add_special_tokens=False).ids, 2]


def ids_of(raw):
    return np.frombuffer(raw, dtype="<u4").tolist()


def check(rows, texts, library, window, slack):
    """``rows``: pieces; ``texts``: (doc_id, text) rows. Returns the number of padded places."""
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_window[r.sequence_id].append(r)
    wanted = defaultdict(list)
    for doc, text in texts:
        wanted[doc].append(tuple(library(text)))
    assert set(by_doc) == set(wanted)
    for doc, pieces in by_doc.items():
        if len(wanted[doc]) == 1:
            pieces = sorted(pieces, key=lambda r: r.start)
            whole = wanted[doc][0]
            assert all(p.doc_tokens == len(whole) for p in pieces)
            assert tuple(i for p in pieces for i in ids_of(p.ids)) == whole
            at = 0
            for p in pieces:
                assert p.start == at
                at += len(p.ids) // 4
        else:  # rows that repeat an id: each id of each text lies in one piece
            assert sorted(i for p in pieces for i in ids_of(p.ids)) == sorted(i for w in wanted[doc] for i in w)
    padded = 0
    for pieces in by_window.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r.offset):
            assert p.offset == at and len(p.ids) > 0
            at += len(p.ids) // 4
        assert at <= window
        room = 0 if at & (at - 1) == 0 else window - at
        assert room <= slack
        padded += room
    return padded


TEXTS = [(1, "one two three"), (2, None), (3, ""), (4, "hello world " * 400), (5, "İstanbul 日本 <|endoftext|> it's"),
         (6, "x" * 5000), (7, "same"), (7, "same"), (7, "other text of that id"), (None, "no id"), (None, None)] + [
    (100 + k, " ".join(random.Random(k).choice(["river", "stone", "of", "the", "42"]) for _ in range(k * 7 % 90))) for k in range(60)]


@pytest.mark.parametrize("window,spaces,slack", [(64, 3, 2), (64, 1, 0), (4096, 32, 8)])
def test_pack_against_library(spark, library, monkeypatch, window, spaces, slack):
    monkeypatch.setattr(packing, "FAN", 2)  # several levels
    docs = spark.createDataFrame([(d, t, 1, 2, 3, True) for d, t in TEXTS],
                                 "doc_id bigint, text string, part int, window int, level int, closed boolean").repartition(5)
    rows = packing.pack(docs, PATH, 2, window, spaces, slack).collect()
    check(rows, TEXTS, library, window, slack)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack(docs, PATH, 2).count() == 0


def test_packer_keeps_its_bound():
    r = random.Random(3)
    packer, sizes, closed = Packer(100, 4, 5), [r.randint(1, 250) for _ in range(500)], []
    for k, n in enumerate(sizes):
        closed += packer.place([(k, 0, n, bytes(4 * n))])
        assert len(packer.room) <= 4 and sum(len(v) for v in packer.open.values()) <= 400
    assert all(95 <= packing._size(w) <= 100 for w in closed)
    closed += packer.finish()
    assert sum(packing._size(w) for w in closed) == sum(sizes)


def test_best_fit_and_fullest():
    packer = Packer(10, 2, 1)
    doc = lambda k, n: [(k, 0, n, bytes(4 * n))]
    assert packer.place(doc(1, 6)) == [] and packer.place(doc(2, 8)) == []
    assert packer.place(doc(3, 2)) == [doc(2, 8) + doc(3, 2)]  # the least room that holds it, now full
    assert packer.place(doc(4, 9)) == []
    (window,) = packer.place(doc(5, 5))  # none fits: the fullest goes with one place of padding, the rest opens a new one
    assert window == doc(4, 9)


def test_registered_query(spark, library):
    got = queries.QUERIES["op13_bounded_space_packing"](spark, SF).collect()
    texts = {r.doc_id: library(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    seen, fill = defaultdict(int), defaultdict(int)
    for r in got:
        part = texts[r.doc_id][r.start:r.start + r.length]
        assert r.length == len(part) and r.doc_tokens == len(texts[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, dtype="<u4").tobytes())
        seen[r.doc_id] += r.length
        fill[r.sequence_id] += r.length
    assert seen == {d: len(t) for d, t in texts.items()}
    padded = sum(0 if n & (n - 1) == 0 else 4096 - n for n in fill.values())
    assert padded < 0.005 * sum(fill.values())
