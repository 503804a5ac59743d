"""Periodic runs against the definition, on random words over small alphabets and on odd rows."""

import random
from fractions import Fraction

import numpy as np
import pytest

from loadcast.llm import queries, runs
from loadcast.llm.textbytes import Words


def brute(w, min_length, exponent):
    """Maximal stretches of every period, kept when no smaller period holds in them."""
    found, n = [], len(w)
    for q in range(1, n):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            smaller = any(all(w[k] == w[k + d] for k in range(i, i + length - d)) for d in range(1, q))
            if length >= max(min_length, exponent * q) and not smaller:
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def found_in(texts, min_length=6, exponent=4):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return runs.find_runs(Words(np.frombuffer(b"".join(raw), np.uint8), offsets, lower=False), min_length, exponent)


def samples(seed):
    r = random.Random(seed)
    out = []
    for _ in range(60):
        kind = r.random()
        if kind < 0.4:
            w = [r.choice("ab") for _ in range(r.randint(0, 60))]
        elif kind < 0.7:
            part = [r.choice("abc") for _ in range(r.randint(1, 6))]
            w = [r.choice("abc") for _ in range(r.randint(0, 8))] + part * r.randint(2, 9) + [r.choice("abc") for _ in range(r.randint(0, 8))]
        else:
            part = ["a", "b"] * 3 + ["c"]
            w = part * r.randint(1, 7) + ["a"] * r.randint(0, 12)
        out.append(w)
    return out


@pytest.mark.parametrize("min_length,exponent", [(6, 4), (1, 2), (4, 2), (10, 3), (2, 5)])
def test_runs_by_definition(min_length, exponent):
    for seed in range(6):
        words = samples(seed)
        got = found_in([" ".join(w) for w in words], min_length, exponent)
        assert got == [brute(w, min_length, exponent) for w in words]


def test_long_periodic_texts():
    assert found_in(["a " * 30_000, "x " + "b c d " * 9_000]) == [[(0, 30_000, 1)], [(1, 27_000, 3)]]


def test_union_reports_new_neighbours_only():
    r = random.Random(1)
    for _ in range(300):
        values = r.sample(range(60), r.randint(2, 30))
        cut = r.randint(1, len(values) - 1)
        a, b = sorted(values[:cut]), sorted(values[cut:])
        small, large = (a, b) if len(a) <= len(b) else (b, a)
        mine, both = set(small), sorted(values)
        wanted = [(i, j) for i, j in zip(both, both[1:]) if (i in mine) != (j in mine)]
        assert sorted(runs.united(small, large)) == wanted and large == both


ROWS = [(1, "a a a a a a a b"), (2, None), (3, ""), (4, " \n\t "), (5, "one"), (5, "one"), (None, "x y x y x y x y x"), (6, "É é x " * 5),
        (7, "A a A a A a A a"), (8, "to be " * 3), (9, "日本 語 " * 9 + "end"), (10, "w " * 6000)]


def test_rows_and_collapsed(spark):
    docs = spark.createDataFrame([(i, t, 1, "c") for i, t in ROWS], "doc_id bigint, text string, runs int, collapsed string")
    got = runs.periodic_runs(docs).collect()
    assert len(got) == len(ROWS)
    wanted = []
    import re
    for i, t in ROWS:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        found = brute(w, 6, 4) if len(w) < 1000 else [(0, 6000, 1)]
        gone = {k for s, n, q in found for k in range(s + q, s + n)}
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        wanted.append((i, len(w), found, best, " ".join(x for k, x in enumerate(w) if k not in gone)))
    key = lambda r: (r[0] is not None, r[0] or 0, r[4])
    have = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.strongest and tuple(r.strongest), r.collapsed) for r in got]
    assert sorted(have, key=key) == sorted(wanted, key=key)
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_exponent_is_checked(spark):
    with pytest.raises(ValueError):
        runs.periodic_runs(spark.createDataFrame([], "doc_id bigint, text string"), exponent=1)


def test_ties_take_the_smallest_start_then_period():
    assert runs.strongest([(0, 8, 2), (3, 12, 3), (9, 5, 1)]) == (9, 5, 1)
    assert runs.strongest([(0, 8, 2), (3, 4, 1), (3, 12, 3)]) == (0, 8, 2)


def test_tiled_texts_and_odd_ids(spark, tmp_path):
    """The query's own edit, on NULL texts and ids, against the contract's words."""
    import zlib
    docs = [(k, " ".join(f"w{j % 13}" for j in range(k % 40))) for k in range(80)] + [(None, "a b c"), (5, None)]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.collapsed_sha256): r.n_runs for r in queries.QUERIES["op11_descending_lcp_runs"](spark, str(tmp_path)).collect()}
    import hashlib
    for i, t in docs:
        w = (t or "").split()
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[x if x < a else a + (x - a) % p] for x in range(n)]
        found = brute(w, 6, 4)
        gone = {k for s, n, q in found for k in range(s + q, s + n)}
        text = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert got[i, hashlib.sha256(text.encode()).hexdigest()] == len(found)
