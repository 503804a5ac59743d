"""The training-data operators against brute force, on small fixtures with the odd cases."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from loadcast.llm import bpe, chat, coder, components, embeddings, iblt, mixing, neardup, quality, queries, substring, warc
from loadcast.llm.scratch import folder, materialize

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"
WORDS = "the of and in re ti ed er on an th st en es or wh".split()
rng = random.Random(5)


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(WORDS) + r.choice(WORDS) for _ in range(n))


BASE = prose(300, 1)
PASSAGE = prose(70, 2)
TEXTS = [
    (1, BASE), (2, BASE), (3, BASE + " more words here"), (4, BASE.replace("the", "THE", 3)), (5, None), (6, ""), (7, " \n\t "),
    (8, "one"), (9, "one"), (10, "one two"), (11, prose(120, 3) + "\n" + PASSAGE + "\n" + prose(40, 4)),
    (12, prose(90, 6) + " " + PASSAGE), (13, PASSAGE), (14, "é ñ ß 日本 İstanbul <|endoftext|> it's 42!"), (15, "a" * 3000),
    (16, (prose(5, 7) + ".\n") * 400), (17, prose(49, 8)), (18, prose(49, 8)), (19, prose(50, 9)), (20, prose(50, 9) + " tail"),
    (20, "same id, other text"), (20, "same id, other text"), (None, BASE), (None, None), (21, "\x00 control \x1f \\ <| <\\| |"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if k % 7 == 0 else "en", None if k % 5 == 0 else f"src{k % 3}", len(t or "")) for k, (i, t) in enumerate(TEXTS)]
    return materialize(spark.createDataFrame(rows, DOCS))


@pytest.fixture(scope="module")
def unique_docs(docs):
    return docs.filter("doc_id is not null and doc_id <> 20")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words_of(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text, k):
    w = words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def next_texts(df):
    return iblt.with_next(df).select("doc_id", "text", F.col("next.text").alias("next_text"))


def brute_components(items, linked):
    root = {i: i for i in items}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in itertools.combinations(sorted(items), 2):
        if linked(a, b):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in items}


# ------------------------------------------------------------------ shared helpers

def test_components_path_star_and_null_ends(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r.node: r.label for r in components.connected(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}
    assert components.connected(spark.createDataFrame([], "src bigint, dst bigint")).isEmpty()


# ------------------------------------------------------------------ 1 fingerprints

def test_fingerprints_against_sets(docs, empty):
    rows = next_texts(docs).withColumn("ed", iblt.edited(F.col("text"), F.col("next_text")))
    exact = rows.select(iblt.digests(F.col("text")).alias("a"), iblt.digests(F.col("ed")).alias("e"), iblt.digests(F.col("next_text")).alias("x"))
    exact = exact.select("*", iblt.sketch("a").alias("ta"), iblt.sketch("e").alias("te"), iblt.sketch("x").alias("tx"))
    for r in exact.select("a", "e", "x", iblt.likeness("a", "e", "ta", "te").alias("ne"), iblt.likeness("a", "x", "ta", "tx").alias("nx")).collect():
        for other, got in ((r.e, r.ne), (r.x, r.nx)):
            union = set(r.a) | set(other)
            assert got == pytest.approx(len(set(r.a) & set(other)) / len(union) if union else 1.0)
    out = iblt.fingerprints(docs).collect()
    assert len(out) == len(TEXTS)
    by_id = {r.doc_id: r for r in out}
    assert by_id[1].fingerprint == by_id[2].fingerprint != by_id[11].fingerprint
    assert by_id[1].near_next == 1.0
    k = len(BASE) // 4
    assert by_id[1].edited_sha256 == hashlib.sha256((BASE[:len(BASE) - k] + BASE[:k]).encode()).hexdigest()
    assert iblt.fingerprints(empty).isEmpty()


def test_pieces_grow_with_every_text(spark):
    """Texts without sentence ends, without spaces, and short lines of sentences: an edit leaves pieces in common."""
    r = random.Random(12)
    han = "".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(1200))
    sentences = [prose(5, 300 + k) + "." for k in range(40)]
    texts = [prose(900, 13), han, "a" * 3000, " ".join(sentences[:3]), " ".join(sentences), "😀é" * 400]
    rows = [(2 * k + j, t) for k, t in enumerate(texts) for j, t in enumerate((t, prose(900, 400 + k)))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    near = {x.doc_id: x.near_edited for x in iblt.fingerprints(df).collect()}
    assert all(near[2 * k] > 0 for k in range(len(texts)))
    assert near[0] > 0.4 and near[2] > 0.4 and near[8] > 0.4
    n = {x.doc_id: x.n for x in df.select("doc_id", F.size(iblt.digests(F.col("text"))).alias("n")).collect()}
    assert n[0] > 40 and n[2] > 50 and 2 <= n[6] <= 3 and n[8] == 40
    # a line's length does not change how its sentences count
    one = {x.t: x.d for x in spark.createDataFrame([(" ".join(sentences[:k]),) for k in (1, 2, 9)], "t string")
           .select("t", iblt.digests(F.col("t")).alias("d")).collect()}
    a, b, c = (set(one[" ".join(sentences[:k])]) for k in (1, 2, 9))
    assert a < b < c


def test_sketch_retries_larger_when_tables_overflow(spark):
    a, b = list(range(0, 900)), list(range(450, 1600))
    df = spark.createDataFrame([(a, b)], "a array<bigint>, b array<bigint>").select(
        F.transform("a", lambda v: F.xxhash64(v)).alias("a"), F.transform("b", lambda v: F.xxhash64(v)).alias("b"))
    got = df.select("*", iblt.sketch("a").alias("ta"), iblt.sketch("b").alias("tb")).select(iblt.likeness("a", "b", "ta", "tb").alias("v"))
    assert got.first().v == pytest.approx(450 / 1600)


def test_next_row_crosses_buckets_and_wraps(spark):
    ids = [-300, -1, 0, 63, 64, 5000, 5001, 10**9, 10**14]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id bigint, text string")
    got = {r.doc_id: r.next_text for r in next_texts(df).collect()}
    assert got == {a: f"t{b}" for a, b in zip(ids, ids[1:] + ids[:1])}


@pytest.mark.parametrize("kind", ["sparse", "null", "repeated"])
def test_next_row_ranges_do_not_depend_on_ids(spark, kind):
    r = random.Random(3)
    ids = {"sparse": [r.randrange(-2**63, 2**63) for _ in range(2000)], "null": [None] * 2000, "repeated": [7] * 1990 + list(range(10))}[kind]
    df = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "doc_id bigint, text string")
    got = {x.text: x.next_text for x in next_texts(df).collect()}
    digest = {x.text: x.d for x in df.select("text", F.xxhash64("text").alias("d")).collect()}
    order = [t for _, _, t in sorted((-(2**64) if i is None else i, digest[f"t{k}"], f"t{k}") for k, i in enumerate(ids))]
    assert got == dict(zip(order, order[1:] + order[:1]))
    # ranges of about SPAN rows whatever the ids, and no table of one row per document behind the unpartitioned window
    per = [x["count"] for x in iblt.ranged(df).groupBy("b").count().collect()]
    assert max(per) <= 4 * iblt.SPAN and len(per) <= 2 * len(ids) / iblt.SPAN


# ------------------------------------------------------------------ 2 range coder

@pytest.mark.parametrize("n", [0, 1, 2, 129, 5000, 40000])
def test_block_round_trip(n):
    for ids in (np.zeros(n, int), np.random.default_rng(n).integers(0, 50257, n), np.arange(n) % 7):
        names, lengths, out, skips, more = coder.decode_block(coder.encode_block([None, 4], [0, n], ids, [0, 9], True))
        assert names == [None, 4] and lengths.tolist() == [0, n] and (out == ids).all() and skips.tolist() == [0, 9] and more


def test_damaged_block_is_found():
    block = bytearray(coder.encode_block([1], [500], np.arange(500) % 50))
    block[-3] ^= 1
    with pytest.raises(ValueError):
        coder.decode_block(bytes(block))


def test_predictable_ids_are_small():
    assert len(coder.encode_block([1], [60000], np.tile(np.arange(20), 3000))) < 12000


def test_block_bytes_stay():
    """The bytes of blocks written before the steps were rewritten: skewed ids, a last lane with fewer ids."""
    r = random.Random(4)
    ids = np.array([int(r.paretovariate(0.6)) % 50257 for _ in range(70001)])
    block = coder.encode_block([1], [len(ids)], ids)
    assert (len(block), hashlib.sha256(block).hexdigest()[:16]) == (52733, "8a0870be142ef8ae")
    assert (coder.decode_block(block)[2] == ids).all()


def test_pieces_split_together_as_the_library_does():
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        tokenizer = coder.PieceTokenizer(f.read())
    r = random.Random(8)
    some = ["'", "s", "ve", "ll", "re", "r", "e", " ", "  ", "\n", "\t", "\x85", "\xa0", "\x1c", "é", "ª", "Z", "1", "½", "!", "_", "'s", " don't", "\x00"]
    rare = ["日", "<|endoftext|>"]
    texts = [None, "", *("".join(r.choice(some + rare * (k % 9 == 0)) for _ in range(r.randint(0, 14))) for k in range(900))]
    got = [np.frombuffer(raw, "<u4").tolist() for raw in tokenizer.encode_all(texts)]
    assert got == [lib.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert tokenizer.encode_all([]) == [] and tokenizer.encode_all([None]) == [b""]


def test_pieces_met_again_are_kept(monkeypatch):
    """A full cache drops the pieces that were not met again, not all of them."""
    monkeypatch.setattr(coder, "CACHED_PIECES", 8)
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        tokenizer = coder.PieceTokenizer(f.read())
    asked, tokenize = [], tokenizer.pieces.tokenize
    tokenizer.pieces.tokenize = lambda text: asked.append(text) or tokenize(text)
    for k in range(40):
        one = tokenizer.encode(f" word a{chr(97 + k % 26)}z{'x' * (k // 26)}")
        assert one == tokenizer.encode_all([f" word a{chr(97 + k % 26)}z{'x' * (k // 26)}"])[0]
    assert len(asked) == 41 and len(tokenizer.pieces) <= 8


@pytest.mark.parametrize("block_ids", [64, 1 << 20])
def test_files_round_trip(spark, docs, empty, block_ids):
    path = P.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    place = folder(spark)
    coder.write(docs, place, path, 0, block_ids)
    got = sorted((r.start, r.doc_id, r.n_ids, zlib.crc32(r.ids)) for r in coder.read(spark, place).collect())
    assert len(got) == len(TEXTS)
    expected, at = [], 0
    for i, t in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [0]
        expected.append((at, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == expected
    place = folder(spark)
    coder.write(empty, place, path, 0)
    assert coder.read(spark, place).isEmpty()


# ------------------------------------------------------------------ 3 quality

def test_quality_separates_held_out_and_handles_odd_rows(spark, docs, empty):
    r = random.Random(3)
    rows, labels = [], []
    for i in range(600):
        good = r.random() < 0.7
        t = prose(80, i) if good else (r.choice(WORDS).upper() + "!! ") * 80
        rows.append((i, t, "en", "s", len(t)))
        labels.append((i, int(good), 0))
    d, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels + [(3, None, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.train(d, lab)
    out = {x.doc_id: x for x in quality.score(d.withColumn("score", F.lit("clash")), model).withColumn("h", quality.held_out()).collect()}
    assert all(x.h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, x in out.items())
    right = [out[i].predicted == q for i, q, _ in labels if out[i].h]
    assert np.mean(right) > 0.97
    odd = quality.score(docs, model).collect()
    assert len(odd) == len(TEXTS) and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in odd)
    assert quality.score(empty, model).isEmpty()
    none = quality.score(docs, quality.train(docs, lab.filter("false"))).collect()
    assert {x.score for x in none} == {0.5}


# ------------------------------------------------------------------ 4 near-duplicates

@pytest.mark.parametrize("shingle,percent", [(3, 85), (5, 80)])
def test_near_duplicates_against_all_pairs(docs, empty, shingle, percent):
    got = neardup.near_duplicates(docs, shingle, percent).collect()
    assert len(got) == len(TEXTS)
    with_id = [(k, i, t) for k, (i, t) in enumerate(TEXTS)]
    sets = {k: shingle_set(t, shingle) for k, _, t in with_id}
    ids = {k: i for k, i, _ in with_id}
    comp = brute_components(sets, lambda a, b: bool(sets[a] and sets[b])
                            and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]))
    low = {}
    for k, c in comp.items():
        low[c] = min([x for x in (low.get(c), ids[k]) if x is not None], default=None)
    expected = sorted((str(ids[k]), len(sets[k]), str(low[comp[k]] if sets[k] else ids[k])) for k in sets)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == expected
    assert neardup.near_duplicates(empty, shingle, percent).isEmpty()


def test_drop_keeps_one_row_per_component_with_null_and_repeated_ids(spark):
    other = prose(200, 21)
    rows = [(None, ""), (None, BASE), (None, BASE + " tail"), (4, BASE), (None, other), (None, other + " tail"), (None, other),
            (7, prose(150, 22)), (7, prose(150, 22) + " tail"), (7, prose(150, 23)), (9, prose(150, 23)), (5, None), (6, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    sets = {k: shingle_set(t, 5) for k, (_, t) in enumerate(rows)}
    comp = brute_components(sets, lambda a, b: bool(sets[a] and sets[b])
                            and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    best = {}
    for k, (i, t) in enumerate(rows):
        o = (i is None, i or 0, hashlib.sha256((t or "").encode()).hexdigest(), str((i, t)))
        best[comp[k]] = min(best.get(comp[k], o), o)
    got = neardup.drop_near_duplicates(df, shingle=5, percent=80)
    assert got.columns == df.columns
    assert sorted(str((x.doc_id, x.text)) for x in got.collect()) == sorted(o[3] for o in best.values())


def test_chain_of_near_copies_in_small_blocks(spark):
    """Neighbours link, ends do not: the second round must find every join, also across blocks."""
    w = prose(400, 11).split()
    rows = [(k, " ".join(w[6 * k:6 * k + 200]), "en", "s", 0) for k in range(30)]
    d = spark.createDataFrame(rows, DOCS)
    got = neardup.near_duplicates(d, 3, 85, block=4, first_partners=1).collect()
    sets = {i: shingle_set(t, 3) for i, t, *_ in rows}
    comp = brute_components(sets, lambda a, b: 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]))
    assert {r.doc_id: r.component_id for r in got} == comp


# ------------------------------------------------------------------ 5 WARC

def test_archive_round_trip(spark):
    rows = [(3, "http://a", "x" * 50), (1, "http://b", "x" * 50), (2, None, None), (9, "u", ""), (4, "u\r\nv", "é\r\n\r\nWARC/1.1"),
            (None, "n", "only"), (3, "http://a", "x" * 50)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    place = folder(spark)
    warc.write(pages, place)
    assert spark.read.parquet(f"{place}/payloads").count() == 4
    got = warc.parse(warc.records(spark, place)).collect()
    import base64
    first = {}
    for i, _, h in rows:
        key = (h or "").encode()
        first[key] = min(x for x in (first.get(key, i), i) if x is not None) if (i is not None or key in first) else None
    expected = []
    for i, _, h in rows:
        b = (h or "").encode()
        own = first[b] == i
        expected.append(str((i, "response" if own else "revisit", base64.b32encode(hashlib.sha1(b).digest()).decode(), None if own else first[b], len(b), b)))
    assert sorted(str((r.page_id, r.record_type, r.payload_digest, r.refers_to, r.payload_bytes, bytes(r.payload))) for r in got) == sorted(expected)
    big = folder(spark)
    warc.write(pages, big, min_shared_bytes=10)
    assert {(r.page_id, r.record_type) for r in warc.parse(warc.records(spark, big)).collect()} >= {(9, "response"), (2, "response")}
    none = folder(spark)
    warc.write(pages.filter("false"), none)
    assert warc.records(spark, none).isEmpty()


def test_wrong_payload_is_found(spark):
    place = folder(spark)
    warc.write(spark.createDataFrame([(1, "u", "text")], "page_id bigint, url string, html string"), place)
    spark.createDataFrame([(hashlib.sha256(b"text").hexdigest(), 4, bytearray(b"tex!"))], "address string, n_bytes int, payload binary") \
        .write.mode("overwrite").parquet(f"{place}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        warc.records(spark, place).collect()


# ------------------------------------------------------------------ 6 BPE

def test_automaton_equals_library(docs, spark, empty):
    path = P.path("word_bpe_49k.json")
    lib, own = Tokenizer.from_file(path), bpe.WordTokenizer(open(path).read())
    alphabet = "aaaabcdeeéıİßΣς 'st'sllxx00½𝔸́日本 \n\t\x1c\x1f\x85\xa0.,!?-_<|"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) for _ in range(1500)]
    texts += ["a" * k for k in range(30)] + ["es" * k for k in range(20)] + ["<|startoftext|>x<|endoftext|>"]
    for t in texts:
        assert np.frombuffer(own.encode(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)
    out = bpe.decode(bpe.encode(docs.withColumn("ids", F.lit("clash")), path), path).collect()
    assert len(out) == len(TEXTS)
    for r in out:
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids and r.decoded == lib.decode(ids, skip_special_tokens=False)
    assert bpe.encode(empty, path).isEmpty()


def test_gadgets_on_a_small_merge_list():
    """Every word over two letters: the automaton finds what merging in rank order gives."""
    vocab, merges = {"a": 0, "b": 1}, []
    for pair in (("a", "a"), ("aa", "b"), ("b", "a"), ("aa", "aa"), ("ba", "b"), ("a", "b")):
        merges.append(pair)
        vocab[pair[0] + pair[1]] = len(vocab)
    auto = bpe.MergeAutomaton(vocab, merges, "")
    for n in range(1, 11):
        for word in map("".join, itertools.product("ab", repeat=n)):
            parts = list(word)
            while True:
                ranked = [(merges.index(p), k) for k, p in enumerate(zip(parts, parts[1:])) if p in merges]
                if not ranked:
                    break
                k = min(ranked)[1]
                parts[k:k + 2] = [parts[k] + parts[k + 1]]
            assert auto.encode(word) == [vocab[p] for p in parts], word


# ------------------------------------------------------------------ 7 mixing

def brute_fill(budget, children):
    """Water filling by repeated sharing: (weight, capacity) list to budgets."""
    got = [0.0] * len(children)
    open_ = [k for k, (w, c) in enumerate(children) if w > 0]
    while open_ and budget > 1e-9:
        total = sum(children[k][0] for k in open_)
        level = min((children[k][1] - got[k]) / children[k][0] for k in open_)
        step = min(level, budget / total)
        for k in open_:
            got[k] += step * children[k][0]
        budget -= step * total
        open_ = [k for k in open_ if children[k][1] - got[k] > 1e-9]
    return got


def test_budgets_against_repeated_sharing(spark):
    leaves = [("a", "en", "x", 100), ("a", "en", "y", 10), ("a", "de", "x", 500), ("b", "en", "z", 40), (None, "en", "q", 70)]
    weights = {"domain": {"a": 1.0, "b": 3.0}, "lang": {"de": 2.0}, "source": {}}
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, supply bigint")
    for budget in (50, 300, 1000, 10**6):
        got = {(r.domain, r.lang, r.source): r.target for r in mixing.leaf_budgets(df, budget, weights, 2).collect()}
        cap = {x[:3]: 2.0 * x[3] for x in leaves}

        def down(prefix, amount):
            if len(prefix) == 3:
                return {prefix: amount}
            kids = sorted({x[:len(prefix) + 1] for x in cap if x[:len(prefix)] == prefix}, key=str)
            level = mixing.LEVELS[len(prefix)]
            sizes = [(weights[level].get(k[-1], 1.0), sum(c for x, c in cap.items() if x[:len(k)] == k)) for k in kids]
            return {leaf: v for k, b in zip(kids, brute_fill(amount, sizes)) for leaf, v in down(k, b).items()}
        expected = down((), min(budget, sum(cap.values())))
        assert {k: v for k, v in got.items()} == {k: int(v + 1e-6) for k, v in expected.items()}, budget


@pytest.mark.parametrize("fraction,epochs", [(0.3, 1), (0.9, 1), (2.5, 3)])
def test_prefixes_fill_each_leaf(docs, empty, fraction, epochs):
    out = mixing.mix(docs, F.lit("d"), fraction, {}, epochs, seed=3).collect()
    assert len(out) == len(TEXTS)
    leaves = {}
    for r in out:
        leaves.setdefault((r.lang, r.source), []).append(r)
        assert 0 <= r.taken <= r.n_tokens * epochs and r.n_tokens == len(words_of(r.text))
    for rows in leaves.values():
        assert sum(r.taken for r in rows) == rows[0].target
        cut = [r for r in rows if r.epochs * r.n_tokens < r.taken < (r.epochs + 1) * r.n_tokens]
        assert len(cut) <= 1
    kept = mixing.keep_mixed(docs, domain=F.lit("d"), fraction=fraction, weights={}, max_epochs=epochs)
    assert kept.columns == docs.columns
    assert mixing.mix(empty, F.lit("d"), fraction, {}, epochs).isEmpty()


# ------------------------------------------------------------------ 8 chat

def test_chat_is_reversible(spark):
    texts = ["", None, "<|end|>", "<\\|", "\\", "\\\\<|", "a<|next|>b\\", "</s>[INST] ok [/INST]", "<<||", "日本 <|"]
    rows = [(c, t, r, x) for c in (1, 2, None) for t, (r, x) in enumerate(itertools.product(["user", "assistant", "a<|b\\", None], texts))]
    rows += [(1, 0, "user", "tie"), (1, None, "assistant", "first"), (1, 0, "user", "tie")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for r in chat.read_back(chat.format_conversations(df)).collect():
        mine = sorted(((t is not None, t or 0, a or "", x or "") for c, t, a, x in rows if c == r.conv_id))
        assert [(t.role, t.text) for t in r.turns] == [(a, x) for _, _, a, x in mine]
        assert r.loss_texts == [x for _, _, a, x in mine if a == "assistant"]
        changes = 1 + sum(a[2] != b[2] for a, b in zip(mine, mine[1:]))
        assert r.formatted.count(chat.END) == changes
    assert chat.read_back(chat.format_conversations(df.filter("false"))).isEmpty()


# ------------------------------------------------------------------ 9 repeated passages

def brute_repeats(rows):
    starts = {}
    for i, t in rows:
        w = words_of(t)
        for s in range(len(w) - 49):
            if i is not None:
                key = tuple(w[s:s + 50])
                starts[key] = min(starts.get(key, i), i)
    out = []
    for i, t in rows:
        w = words_of(t)
        gone = set()
        for s in range(len(w) - 49):
            if i is not None and starts[tuple(w[s:s + 50])] < i:
                gone.update(range(s, s + 50))
        out.append((str(i), len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


def test_repeats_against_all_windows(docs, empty):
    got = substring.remove_repeats(docs.withColumn("h", F.lit(1))).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in got) == brute_repeats(TEXTS)
    assert substring.remove_repeats(empty).isEmpty()
    kept = {r.doc_id: r for r in substring.drop_repeats(docs.filter("doc_id <> 20")).collect()}
    assert kept[11].text == TEXTS[10][1] and 13 not in kept and kept[12].n_chars == len(kept[12].text)


def test_repeats_at_every_offset(spark):
    rows = [(k, " ".join([prose(k, 50 + k), PASSAGE if k % 2 else prose(49, 2), prose(13, 90 + k)]).strip()) for k in range(1, 40)]
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in got) == brute_repeats(rows)


# ------------------------------------------------------------------ 10 embeddings

def test_embeddings_against_all_pairs(spark):
    g = np.random.default_rng(4)
    base = g.normal(size=(60, 16))
    rows = [(k, (base[k % 60] + g.normal(size=16) * g.choice([0.05, 0.2, 0.35])).tolist()) for k in range(400)]
    rows += [(1000 + k, rows[k][1]) for k in range(5)] + [(2000, (2 * np.array(rows[0][1])).tolist()), (2001, None), (2002, [0.0] * 16),
             (2003, [float("nan")] * 16), (2004, [float("inf")] + [0.0] * 15), (2005, [None] + [1.0] * 15), (2006, [1.0, 2.0]), (2007, [2.0, 4.0]), (3, rows[3][1]), (2008, [])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id bigint, embedding array<double>, label int")
    got = embeddings.near_duplicates(df, miss=1e-4, block=16).collect()
    ok = {k: np.array(v) for k, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and np.any(v)}

    def near(a, b):
        return a in ok and b in ok and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] / np.linalg.norm(ok[a]) / np.linalg.norm(ok[b]) >= 0.95
    comp = brute_components(range(len(rows)), near)
    low = {}
    for k, c in comp.items():
        low[c] = min(low.get(c, rows[k][0]), rows[k][0])
    expected = sorted((rows[k][0], sum(near(k, j) for j in range(len(rows)) if j != k), low[comp[k]]) for k in range(len(rows)))
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == expected
    assert embeddings.near_duplicates(df.filter("false")).isEmpty()


def _at_threshold(g, vectors):
    """A partner of each vector at a cosine of 0.9505, in a random direction."""
    a = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    u = g.normal(size=a.shape)
    u -= (u * a).sum(axis=1, keepdims=True) * a
    return 0.9505 * a + np.sqrt(1 - 0.9505**2) * u / np.linalg.norm(u, axis=1, keepdims=True)


def _embedding_sets():
    g = np.random.default_rng(8)
    offset = g.normal(size=(700, 32)) / np.sqrt(32) + 2 * np.eye(32)[0]  # mean of norm about 0.9
    crowd = g.normal(size=(1, 32)) + 0.2 * g.normal(size=(900, 32))
    return {"offset": np.concatenate([offset, _at_threshold(g, offset)]),
            "dominating": np.concatenate([crowd, g.normal(size=(50, 32)), _at_threshold(g, crowd[:50])]),
            "two": np.concatenate([offset[:1], _at_threshold(g, offset[:1])])}


@pytest.mark.parametrize("name", ["offset", "dominating", "two"])
def test_embeddings_recall_at_production_miss(spark, name):
    x = _embedding_sets()[name]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(df).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (u @ u.T >= 0.95).sum(axis=1) - 1
    assert all(got[k] <= links[k] for k in range(len(x)))
    assert sum(got.values()) >= 0.99 * links.sum() > 0


# ------------------------------------------------------------------ pipeline and registration

def test_pipeline_stages_on_odd_rows_and_empty_input(spark, docs, empty):
    for start in (docs, empty):
        d = start
        for name, stage in corpus_pipeline.STAGES:
            out = materialize(stage(spark, d, SF))
            if name != "tokens":
                assert out.columns == docs.columns
            d = out
    assert d.isEmpty()


def test_every_operator_is_registered():
    names = queries.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "substring_dedup", "source_mix", "tokens"]


def test_columns_of_clashing_names_survive(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, passage + " one"), (2, "two " + passage), (3, passage + " one"), (4, None), (None, passage + " one")]
    extra = {"n_words": 7, "n_removed": 8, "kept_text": "own", "marks": 9, "key": 10, "row": 11, "order": 12, "_row": 13, "_order": 14,
             "doc": 15, "label": 16, "cls": 17, "_marks": 18, "_marked_id": 19, "a.b": 20, "n_chars": 0}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(v) for c, v in extra.items()})
    got = {r.doc_id: r for r in substring.drop_repeats(docs).collect()}
    assert {k: r.text for k, r in got.items()} == {1: passage + " one", 2: "two", 4: None, None: passage + " one"}
    assert all(r[c] == v for r in got.values() for c, v in extra.items() if c != "n_chars")
    assert got[2].n_chars == 3 and got[1].n_chars == 0
    out = substring.remove_repeats(docs)
    assert out.columns == [c for c in docs.columns if c not in ("kept_text", "n_words", "n_removed")] + ["kept_text", "n_words", "n_removed"]
    assert {r.doc_id: (r.n_words, r.n_removed, r.key) for r in out.collect()} == {
        1: (61, 0, 10), 2: (61, 60, 10), 3: (61, 61, 10), 4: (0, 0, 10), None: (61, 0, 10)}
    kept = neardup.drop_near_duplicates(docs, shingle=5, percent=80)
    assert kept.columns == docs.columns
    got = {r.doc_id: r for r in kept.collect()}
    assert set(got) == {1, 4} and all(r[c] == v for r in got.values() for c, v in extra.items())
