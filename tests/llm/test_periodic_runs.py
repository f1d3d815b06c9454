import random

import numpy as np
import pytest

from blotter.llm import periodic_runs
from blotter.llm.periodic_runs import find_runs, inverse_ntt, joined_runs, ntt

SCHEMA = "doc_id long, text string"


def brute(words):
    """All runs, by comparing words at every distance."""
    out, n = set(), len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and not any(s <= i and j + q <= s + ln and q % p == 0 for s, ln, p in out):
                out.add((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {i for s, ln, q in runs for i in range(s + q, s + ln)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def noisy(rng, n, letters):
    words = []
    while len(words) < n:
        part = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
        words += part * rng.choice([1, 1, 2, 5, 9])
    return words[:n]


def test_transform_is_exact():
    rng = np.random.default_rng(1)
    for n in (1, 2, 8, 64):
        a, b = (rng.integers(0, periodic_runs._P, (n, 3)).astype(np.uint64) for _ in range(2))
        assert (inverse_ntt(ntt(a)) == a).all()
        got = inverse_ntt(ntt(a) * ntt(b) % np.uint64(periodic_runs._P))
        for c in range(3):
            want = [sum(int(a[i, c]) * int(b[(t - i) % n, c]) for i in range(n)) % periodic_runs._P for t in range(n)]
            assert got[:, c].tolist() == want


def test_random_texts_against_brute_force(monkeypatch):
    monkeypatch.setattr(periodic_runs, "_CELLS", 64)
    rng = random.Random(2)
    for _ in range(150):
        texts = [noisy(rng, rng.choice([0, 1, 5, 6, 7, 30, 90]), "ab" if rng.random() < 0.5 else "abcdef") for _ in range(4)]
        flat = [ord(w) for t in texts for w in t]
        bounds = np.cumsum([0, *map(len, texts)])
        got = sorted(joined_runs(np.array(flat, np.int64), bounds))
        want = sorted((s + int(b), s + ln + int(b), q) for b, t in zip(bounds, texts) for s, ln, q in brute(t))
        assert got == want


@pytest.mark.parametrize("word", ["a", "ab", "abc d", "x y z w v u t"])
def test_whole_text_is_one_run(spark, word):
    unit = word.split()
    row = find_runs(spark.createDataFrame([(1, " ".join(unit * 5000))], SCHEMA)).first()
    least = 6 if len(unit) == 1 else 0
    assert [tuple(r) for r in row.runs] == [(0, 5000 * len(unit), len(unit))] and least <= row.n_words
    assert bytes(row.collapsed).decode() == " ".join(unit)


def test_rows(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "_GROUP", 40)
    rng = random.Random(4)
    texts = [None, "", " \t\n", "a a a a a", "a a a a a a", "é é " * 7, "p q  p\tq p q p q r"]
    texts += [" ".join(noisy(rng, rng.randint(0, 120), "abcd")) for _ in range(60)]
    rows = [(None if k % 9 == 0 else k % 20, t) for k, t in enumerate(texts + texts[:5])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS runs", "2 AS n_words", "3 AS collapsed").repartition(3)
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], bytes(r.collapsed).decode())
                  for r in find_runs(df).collect()), key=str)
    want = []
    for i, t in rows:
        words = [w for w in (t or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
        runs = brute(words)
        want.append((i, len(words), runs, collapse(words, runs)))
    assert got == sorted(want, key=str)
    assert find_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_period_and_very_long_text():
    rng = np.random.default_rng(6)
    unit = rng.integers(0, 1000, 3001)
    x = np.concatenate([rng.integers(0, 50_000, 77_777), np.tile(unit, 5)[:4 * 3001 + 17], rng.integers(0, 50_000, 30_000)])
    runs = joined_runs(x, np.array([0, len(x)]))
    assert [r for r in runs if r[2] > 1] == [(77_777, 77_777 + 4 * 3001 + 17, 3001)]
    assert all(e - s >= 6 for s, e, q in runs if q == 1)
