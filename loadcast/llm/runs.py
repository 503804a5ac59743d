"""Periodic runs of words: descending-LCP Kruskal over suffix classes.

A run is a stretch of words with smallest period p (words p apart are equal) and at least ``exponent`` times p
words that no neighbouring word extends. The suffixes of a batch of texts are sorted by rank doubling; every
word code belongs to one text, so suffixes of different texts share nothing. The common prefixes (LCP) of
neighbours in that order are the edges of a path; taken by decreasing LCP, each unites two classes of suffixes
(union-find), whose positions are kept as ordered sets, the smaller one merged into the larger.

When the edge of LCP l unites two classes, positions i < j that become neighbours in the united set have exactly l
words in common. If j - i <= l they seed a run: the words from i to j + l repeat with period j - i. That period is the
smallest one, since a smaller one would put a position between i and j into the class earlier; and every run is found, since
its first word i and i + p are such neighbours at l = length - p. So the seeds whose preceding words differ are
the runs, each met once. Edges below the least l of a wanted run are never taken.

Collapsing drops the words of every run after its first p words. The work per text is sorting and small-to-large
merging; a text is handled by one task, in slices of about a megabyte of texts (a longer text is a slice of its own).

Defined cases: NULL and empty texts and texts of separators have no words, no runs and an empty collapsed text; repeated
rows and NULL ids are rows like others; extra columns are ignored; an empty table gives an empty result. Words are
told apart by 64-bit hashes inside one text."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loadcast.llm.textbytes import Words, mix, slices

MIN_LENGTH = 6
EXPONENT = 4

Run = tuple[int, int, int]  # first word, words, period

_RUN = "struct<start: bigint, length: bigint, period: bigint>"
_SCHEMA = f"doc_id bigint, n_words bigint, runs array<{_RUN}>, strongest {_RUN}, collapsed string"
_RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def least_lcp(min_length: int, exponent: int) -> int:
    """Smallest LCP that can seed a wanted run."""
    return min(max(min_length - p, (exponent - 1) * p) for p in range(1, max(2, min_length)))


def suffix_order(code: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sorted suffixes and, for every k = 1, 2, 4, ..., the class of the k codes from each position on (one more
    entry for the end). A class is numbered by its first place in the order, so a class of one is final."""
    n = len(code)
    rank = np.full(n + 1, -1, dtype=np.int64)
    order = np.argsort(code, kind="stable")
    new = np.ones(n, dtype=bool)
    new[1:] = code[order[1:]] != code[order[:-1]]
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, k, pos = [rank.astype(np.int32)], 1, order
    while True:
        held = rank[pos]
        tied = np.zeros(len(pos), dtype=bool)
        tied[1:] = held[1:] == held[:-1]
        tied[:-1] |= tied[1:]
        pos = pos[tied]  # in order of their classes
        if not len(pos):
            return np.argsort(rank[:n], kind="stable"), levels
        key = rank[pos] * (n + 2) + rank[np.minimum(pos + k, n)] + 1
        o = np.argsort(key, kind="stable")
        pos, key = pos[o], key[o]
        held = rank[pos]
        at = np.arange(len(pos))
        first = np.ones(len(pos), dtype=bool)
        first[1:] = held[1:] != held[:-1]
        slot = held + at - np.maximum.accumulate(np.where(first, at, 0))
        fresh = np.ones(len(pos), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        rank[pos] = slot[np.maximum.accumulate(np.where(fresh, at, 0))]
        levels.append(rank.astype(np.int32))
        k *= 2


def common_prefixes(a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Number of equal codes from positions ``a`` and ``b`` on, from the longest class to the shortest."""
    l = np.zeros(len(a), dtype=np.int64)
    for k in reversed(range(len(levels))):
        l += (levels[k][a + l] == levels[k][b + l]).astype(np.int64) << k
    return l


def united(small: list[int], large: list[int]) -> list[tuple[int, int]]:
    """Merge the ordered list ``small`` into ``large``; pairs that are neighbours now, one from each."""
    pairs = []
    if 8 * len(small) > len(large) and len(small) > 1:
        mine = set(small)
        large += small
        large.sort()
        return [(i, j) for i, j in zip(large, large[1:]) if (i in mine) != (j in mine)]
    for k, q in enumerate(small):
        at = bisect_left(large, q)
        if at and not (k and large[at - 1] == small[k - 1]):
            pairs.append((large[at - 1], q))
        if at < len(large) and not (k + 1 < len(small) and small[k + 1] < large[at]):
            pairs.append((q, large[at]))
        large.insert(at, q)
    return pairs


def kruskal(sa: np.ndarray, slots: np.ndarray, lcp: np.ndarray, code: np.ndarray, min_length: int, exponent: int) -> list[Run]:
    """Runs from the edges ``(sa[slot], sa[slot + 1])`` with their LCPs, in positions of ``code``."""
    used = np.unique(np.concatenate([slots, slots + 1]))
    left = np.searchsorted(used, slots)
    members = [[p] for p in sa[used].tolist()]
    root = list(range(len(used)))
    found = []
    order = np.argsort(-lcp, kind="stable")
    for l, x in zip(lcp[order].tolist(), left[order].tolist()):
        y = x + 1  # neighbours in the order stay neighbours in ``used``
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        while root[y] != y:
            root[y] = root[root[y]]
            y = root[y]
        if len(members[x]) < len(members[y]):
            x, y = y, x
        root[y] = x
        for i, j in united(members[y], members[x]):
            p = j - i
            if p <= l and (exponent - 1) * p <= l and l + p >= min_length and (i == 0 or code[i - 1] != code[j - 1]):
                found.append((i, l + p, p))
        members[y] = []
    return found


def find_runs(words: Words, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> list[list[Run]]:
    """Runs of each text, by first word and period."""
    texts = len(words.count)
    out: list[list[Run]] = [[] for _ in range(texts)]
    least = least_lcp(min_length, exponent)
    text = np.repeat(np.arange(texts), words.count)
    # only texts that repeat some ``least`` words can have a run
    window = words.windows(least)
    inside = np.flatnonzero(text[:len(window)] == text[len(text) - len(window):])
    key = mix(window[inside] + mix(text[inside].astype(np.uint64)))
    key.sort()
    again = np.unique(key[1:][key[1:] == key[:-1]])
    if not len(again):
        return out
    key = mix(window[inside] + mix(text[inside].astype(np.uint64)))
    chosen = np.zeros(texts, dtype=bool)
    chosen[text[inside][np.isin(key, again)]] = True
    at = np.flatnonzero(chosen[text])
    owner, value = text[at], words.hash[at]
    order = np.lexsort((value, owner))
    new = np.ones(len(at), dtype=bool)
    new[1:] = (value[order[1:]] != value[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
    code = np.empty(len(at), dtype=np.int64)
    code[order] = np.cumsum(new)
    sa, levels = suffix_order(code)
    level = levels[min(len(levels), least.bit_length()) - 1]  # classes of at most ``least`` codes
    slots = np.flatnonzero(level[sa[1:]] == level[sa[:-1]])
    lcp = common_prefixes(sa[slots], sa[slots + 1], levels)
    slots, lcp = slots[lcp >= least], lcp[lcp >= least]
    begin = np.flatnonzero(np.diff(owner, prepend=-1))  # of each chosen text in ``at``
    starts = dict(zip(owner[begin].tolist(), begin.tolist()))
    for i, length, period in kruskal(sa, slots, lcp, code, min_length, exponent):
        t = int(owner[i])
        out[t].append((i - starts[t], length, period))
    for r in out:
        r.sort(key=lambda x: (x[0], x[2]))
    return out


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Marks of the words that no run drops (a run keeps its first period)."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length / period, compared exactly; ties: smallest start, then period."""
    best = None
    for r in runs:  # by start, then period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def _record(run: Run | None) -> dict | None:
    return None if run is None else {"start": run[0], "length": run[1], "period": run[2]}


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """``docs(doc_id, text)`` to ``doc_id, n_words, runs, strongest, collapsed``, one row per input row: runs of at least
    ``max(min_length, exponent * period)`` words by first word and period, the one of greatest length / period, and the
    kept words joined by one space. ``exponent`` is a whole number from 2 on."""
    if exponent < 2 or exponent != int(exponent):
        raise ValueError("exponent must be a whole number from 2 on")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            for a, b, data, offsets in slices(batch, "text"):
                words = Words(data, offsets, lower=False)
                found = find_runs(words, min_length, exponent)
                raw, bounds, texts = data.tobytes(), offsets.tolist(), []
                for k, runs in enumerate(found):
                    parts = raw[bounds[k]:bounds[k + 1]].split()  # at 0x20 and 0x09 to 0x0D
                    texts.append(b" ".join(compress(parts, kept_words(len(parts), runs).tolist()) if runs else parts))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(words.count.astype(np.int64)),
                     pa.array([[_record(r) for r in runs] for runs in found], pa.list_(_RUN_TYPE)),
                     pa.array([_record(strongest(runs)) for runs in found], _RUN_TYPE),
                     pa.array(texts, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "strongest", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(run, _SCHEMA)
