"""Periodic runs of words by block convolution.

A run is a stretch of words with smallest period q and at least
``max(6, 4 q)`` words that no neighbour extends.  Periods are searched by
dyadic scales: at scale b (1, 2, 4, ...) periods of b to 2 b - 1 words.  A run
of such a period holds an aligned block of b words that comes again q words
later, so

1. each aligned block is laid against the 2 b - 1 words after it, and the
   sums of squared differences of the word numbers at all b distances come
   from one cyclic convolution of 2 b integers, by a number-theoretic
   transform modulo a prime;
2. a distance of sum zero is an occurrence; as a run is four periods long, at
   least two neighbouring blocks must agree on the distance;
3. such chains seed the extension: the words themselves are compared from one
   block before the chain to one block after it.  This comparison decides, so
   a sum that is only a multiple of the prime does no harm.

Chains inside a run of a shorter period that divides theirs are the same
stretch again and are left out.  The work is n log^2 n steps for n words.
Texts are handled where Spark reads them: nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, TIMES = 6, 4                          # a run has max(LEAST, TIMES * period) words

_P = 3 * 2 ** 30 + 1                         # prime; 5 generates its units, so lengths up to 2^30 have a root of unity
_G = 5
_U = np.uint64(_P)
_CELLS = 1 << 16                             # integers transformed at once (0.5 MB)
_GROUP = 1 << 17                             # words of short texts handled together
_ROOTS: dict[tuple[int, bool], np.ndarray] = {}


def _roots(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of the root of unity of order 2 * half."""
    key = (half, inverse)
    if key not in _ROOTS:
        w = pow(_G, (_P - 1) // (2 * half), _P)
        w = pow(w, -1, _P) if inverse else w
        out = np.ones(1, np.uint64)
        while len(out) < half:               # doubling: powers k and k + len
            out = np.concatenate([out, out * np.uint64(pow(w, len(out), _P)) % _U])
        _ROOTS[key] = out[:half]
    return _ROOTS[key]


def ntt(a: np.ndarray) -> np.ndarray:
    """Transform along the first axis (length a power of two); the result stands in bit-reversed order."""
    n, m = a.shape
    half = n // 2
    while half:
        a = a.reshape(-1, 2, half, m)
        u, v = a[:, 0], a[:, 1]
        out, s, d = np.empty_like(a), u + v, u + (_U - v)
        np.minimum(s, s - _U, out=out[:, 0])            # unsigned: s - p is huge where s < p
        np.minimum(d, d - _U, out=d)
        np.remainder(d * _roots(half, False)[:, None], _U, out=out[:, 1])
        a, half = out, half // 2
    return a.reshape(n, m)


def inverse_ntt(a: np.ndarray) -> np.ndarray:
    """Back from the bit-reversed order of :func:`ntt`."""
    n, m = a.shape
    half = 1
    while half < n:
        a = a.reshape(-1, 2, half, m)
        u, v = a[:, 0], a[:, 1] * _roots(half, True)[:, None] % _U
        out, s, d = np.empty_like(a), u + v, u + (_U - v)
        np.minimum(s, s - _U, out=out[:, 0])
        np.minimum(d, d - _U, out=out[:, 1])
        a, half = out, 2 * half
    return a.reshape(n, m) * np.uint64(pow(n, -1, _P)) % _U


def _occurrences(x: np.ndarray, squares: np.ndarray, starts: np.ndarray, room: np.ndarray, b: int):
    """(block, distance) pairs where the block of ``b`` words at ``starts`` comes again ``b`` to ``2 b - 1`` words on.

    ``squares`` are the running sums of the squared numbers modulo p, and
    ``room`` the largest distance that stays within the text.
    """
    step, wide = max(1, _CELLS // (2 * b)), np.arange(2 * b - 1)
    for lo in range(0, len(starts), step):
        s, r = starts[lo:lo + step], room[lo:lo + step]
        at = np.minimum(s + b + wide[:, None], len(x) - 1)          # past the end: only distances without room
        window = np.zeros((2 * b, len(s)), np.uint64)
        window[:-1] = x[at]
        block = np.zeros_like(window)
        block[0] = x[s]
        block[:b:-1] = x[s + np.arange(1, b)[:, None]]              # reversed, so the product correlates
        cross = inverse_ntt(ntt(block) * ntt(window) % _U)[:b]
        far = np.minimum(s + b + np.arange(b)[:, None], len(x) - 1)
        own = (squares[s + b] + _U - squares[s]) % _U
        there = (squares[np.minimum(far + b, len(x))] + _U - squares[far]) % _U
        sums = (own + there + np.uint64(2) * (_U - cross)) % _U
        d, k = np.nonzero((sums == 0) & (np.arange(b, 2 * b)[:, None] <= r))
        yield lo + k, d + b


class _Known:
    """Runs found so far, by period, as sorted starts and ends over the joined texts."""

    def __init__(self):
        self.by: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, runs: list[tuple[int, int, int]]) -> None:
        new: dict[int, list] = {}
        for start, end, q in runs:
            new.setdefault(q, []).append((start, end))
        self.by |= {q: tuple(np.array(sorted(v)).T) for q, v in new.items()}

    def covers(self, start: np.ndarray, end: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Which stretches lie in a run whose period divides ``d``."""
        hit = np.zeros(len(start), bool)
        for q, (starts, ends) in self.by.items():
            k = np.searchsorted(starts, start, "right") - 1
            hit |= (k >= 0) & (ends[k] >= end) & (d % q == 0)
        return hit


def joined_runs(x: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs in texts laid end to end; ``bounds`` are where texts begin, and the end."""
    first, n = bounds[:-1].astype(np.int64), np.diff(bounds).astype(np.int64)
    x64 = x.astype(np.uint64)
    squares = np.concatenate([[np.uint64(0)], np.cumsum(x64 * x64 % _U, dtype=np.uint64) % _U])
    known, runs, b = _Known(), [], 1
    while True:
        long = n >= max(LEAST, TIMES * b)
        if not long.any():
            return runs
        blocks = (n[long] - 2 * b) // b + 1
        ends = np.repeat((first + n)[long], blocks)
        nth = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        starts = np.repeat(first[long], blocks) + nth * b
        begin = np.repeat(first[long], blocks)
        seeds = list(_occurrences(x64, squares, starts, ends - starts - b, b))
        k, d = (np.concatenate(c) for c in zip(*seeds))
        order = np.lexsort((k, d))
        k, d = k[order], d[order]
        # chains: neighbouring blocks of one text at one distance
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1] + 1) | (d[1:] != d[:-1]) | (begin[k[1:]] != begin[k[:-1]])
        at = np.flatnonzero(new)
        if len(at):
            count = np.diff(np.append(at, len(k)))
            s, dist, e = starts[k[at]], d[at], starts[k[at]] + count * b
            enough = (count + 2) * b - 2 >= np.maximum(LEAST, TIMES * dist) - dist
            enough[enough] &= ~known.covers(s[enough], (e + dist)[enough], dist[enough])
            found = set()
            for j in np.flatnonzero(enough):
                found.update(_extend(x, int(s[j]), int(e[j]), int(dist[j]), b, int(begin[k[at[j]]]), int(ends[k[at[j]]])))
            fresh = [r for r, c in zip(found, _inside(known, found)) if not c]
            known.add(fresh)
            runs += fresh
        b *= 2


def _inside(known: _Known, found: set) -> np.ndarray:
    if not found:
        return np.zeros(0, bool)
    start, end, q = np.array(list(found)).T
    return known.covers(start, end, q)


def _extend(x: np.ndarray, start: int, end: int, d: int, b: int, lo: int, hi: int) -> list[tuple[int, int, int]]:
    """Stretches of period ``d`` around a chain of blocks, by comparing the words one block beyond it on both sides."""
    left, right = max(lo, start - b), min(hi - d, end + b)
    same = np.concatenate([[0], (x[left:right] == x[left + d:right + d]).view(np.int8), [0]])
    turn = np.flatnonzero(np.diff(same))
    return [(left + i, left + j + d, d) for i, j in zip(turn[::2].tolist(), turn[1::2].tolist())
            if j - i + d >= max(LEAST, TIMES * d)]


def _groups(texts: Iterable[bytes | None]) -> Iterator[list[list[bytes]]]:
    """The words of texts in order, in groups of about ``_GROUP`` words."""
    group, total = [], 0
    for t in texts:
        words = t.split() if t else []                  # bytes.split: exactly [\x20\x09-\x0D]
        if group and total + len(words) > _GROUP:
            yield group
            group, total = [], 0
        group.append(words)
        total += len(words)
    if group:
        yield group


def _runs_of(group: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text of the group, by start, then period."""
    flat = list(chain.from_iterable(group))
    number = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    x = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    bounds = np.cumsum([0, *map(len, group)])
    out: list[list] = [[] for _ in group]
    for start, end, q in sorted(joined_runs(x, bounds), key=lambda r: (r[0], r[2])):
        k = int(np.searchsorted(bounds, start, "right")) - 1
        out[k].append((start - int(bounds[k]), end - start, q))
    return out


def _collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside of what runs repeat after their first period."""
    if runs:
        drop = np.zeros(len(words), bool)
        for start, length, q in runs:
            drop[start + q:start + length] = True
        words = [w for w, out in zip(words, drop.tolist()) if not out]
    return b" ".join(words)


def _search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, kept, flat, offsets = [], [], [], [0]
        for group in _groups(batch.column(1).to_pylist()):
            for words, runs in zip(group, _runs_of(group)):
                n_words.append(len(words))
                kept.append(_collapse(words, runs))
                flat += runs
                offsets.append(len(flat))
        parts = pa.StructArray.from_arrays(
            [pa.array([r[i] for r in flat], pa.int64()) for i in range(3)], names=["start", "length", "period"])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), parts), pa.array(kept, pa.binary())],
            names=["doc_id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, runs (start, length, period of each, by start, then period), collapsed.

    ``collapsed`` is the text without the words that a run holds after its
    first period, the kept words joined by one space.  Null, empty and white
    texts have no words, no runs and an empty ``collapsed``.  Rows are handled
    one by one: ids may be null or repeated, equal texts give equal results,
    an empty table gives no rows and other columns are not read.  A text is
    held whole by its task with some 50 bytes a word; short texts go together
    in groups of about 130,000 words.
    """
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
            .mapInArrow(_search, "doc_id long, n_words long, "
                                 "runs array<struct<start: long, length: long, period: long>>, collapsed binary"))
