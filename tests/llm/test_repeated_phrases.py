import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from blotter.llm.repeated_phrases import _Powers, contexts, remove_repeats

SCHEMA = "doc_id long, text string"


def brute(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = {p for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for p in range(i, i + window)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    passages = [[f"p{k}_{rng.randrange(40)}" for _ in range(rng.randint(4, 40))] for k in range(6)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(rng.randint(0, 5)):
            if rng.random() < 0.5:
                p = rng.choice(passages)
                a = rng.randint(0, len(p) // 2)
                words += p[a:rng.randint(a, len(p))]
            else:
                words += [f"w{rng.randrange(10 if rng.random() < 0.2 else 5000)}" for _ in range(rng.randint(0, 30))]
        rows.append((i, " ".join(words)))
    rows += [(200, rows[3][1]), (201, rows[3][1] + " tail"), (202, "z " * 100), (203, None), (204, " \t\n"), (205, "")]
    return rows


@pytest.mark.parametrize("window,gram,chunk,block", [(35, 8, 1000, 20_000), (8, 3, 5, 6), (5, 5, 1, 3), (6, 1, 1000, 2)])
def test_against_brute_force(spark, window, gram, chunk, block):
    rows = corpus(window)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = remove_repeats(df, window, gram, chunk=chunk, block=block).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, window)


def test_repeated_rows_null_ids_and_clashes(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (None, text + " end"), (None, None), (2, "short text"), (3, "long " * 100_000)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", start int, key int")
    assert sorted(map(tuple, remove_repeats(df).collect()), key=str) == brute(rows, 35)
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_contexts_partition_the_windows():
    rng = random.Random(5)
    words = [b"w%d" % rng.randrange(30) for _ in range(500)]
    key, ctx, start, count = contexts(words, 35, 8, _Powers())
    assert start[0] == 0 and np.array_equal(start[1:], (start + count)[:-1]) and count.sum() == 466
    again = contexts([b"x"] * 3 + words[100:300], 35, 8, _Powers())
    assert len(np.intersect1d(ctx, again[1])) > 5
