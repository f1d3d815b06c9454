import hashlib
import random

import pytest
from pyspark.sql import functions as F

from blotter.llm import merkle_manifest
from blotter.llm.merkle_manifest import build_manifest, check_leaves

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(values):
    s = b"".join(b"-" if v is None else b"%d:%s" % (len(str(v).encode()), str(v).encode()) for v in values)
    return hashlib.sha256(s).hexdigest()


def joined(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(level, k):
    """(siblings with their side, top) of place k in a list of digests."""
    path = []
    while len(level) > 1:
        run = level[k - k % 2:k - k % 2 + 2]
        path.append((k % 2, run[1 - k % 2] if len(run) > 1 else None))
        level, k = [joined(level[j:j + 2]) for j in range(0, len(level), 2)], k // 2
    return path, level[0]


def brute(rows, tamper):
    order = lambda v: (v is not None, "" if v is None else v.encode())
    langs = sorted({r[2] for r in rows}, key=order)
    trees = {g: sorted((r for r in rows if r[2] == g), key=lambda r: ((r[0] is not None, r[0] or 0), digest(r))) for g in langs}
    subroots = [climb([digest(r) for r in trees[g]], 0)[1] for g in langs]
    out = []
    for t, g in enumerate(langs):
        leaves = [digest(r) for r in trees[g]]
        for k, r in enumerate(trees[g]):
            low, sub = climb(leaves, k)
            high, root = climb(subroots, t)
            path, now = low + high, digest(tamper(r))
            for right, sibling in path:
                now = joined([x for x in ((sibling, now) if right else (now, sibling)) if x])
            out.append((r[0], leaves[k], sub, root, joined([s for _, s in path if s]), now, now == root))
    return sorted(out, key=str)


def ours(df, **kw):
    m = check_leaves(build_manifest(df, **kw))
    return sorted(((r.id, r.leaf, r.subroot, r.root, joined(r.siblings), r.folded_root, r.verified) for r in m.collect()),
                  key=str)


def added(r):
    return (*r[:3], r[3] + 1 if r[3] is not None and r[0] is not None and r[0] % 7 == 0 else r[3], r[4])


def add():
    return {"n_chars": F.when(F.col("doc_id") % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}


@pytest.mark.parametrize("sizes", [[1], [2], [1, 1], [3, 1, 1], [5, 2, 9, 1, 17]])
def test_small_trees(spark, sizes):
    rows = [(10 * i + t, "s", f"l{t}", i, f"t {i}") for t, n in enumerate(sizes) for i in range(n)]
    assert ours(spark.createDataFrame(rows, SCHEMA), presented=add()) == brute(rows, added)


@pytest.mark.parametrize("tile,block", [(1, 1), (2, 3), (10, 14)])
def test_nulls_ties_repeats(spark, tile, block, monkeypatch):
    monkeypatch.setattr(merkle_manifest, "_TILE", tile)
    monkeypatch.setattr(merkle_manifest, "_BLOCK", block)
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, "", "a"]), rng.choice([None, "", "de", "én", "zh"]),
             rng.choice([None, 3, 70]), rng.choice([None, "", "é", "x" * 100_000])) for _ in range(150)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert ours(df, presented=add()) == brute(rows, added)


def test_empty_extra_columns_and_one_hot_row(spark):
    assert check_leaves(build_manifest(spark.createDataFrame([], SCHEMA))).count() == 0
    rows = [(7, "s", "en", 2, "same")] * 300 + [(8, "s", "en", 2, "other"), (7, None, None, 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS no", "2 AS id", "3 AS digest", "4 AS tree", "5 AS link")
    assert ours(df, presented=add()) == brute(rows, added)


def test_row_limit_is_put_back(spark):
    key, rows = merkle_manifest._ROWS_LIMIT, [(i, "s", "en", i, "t") for i in range(9)]
    before = spark.conf.get(key, None)
    check_leaves(build_manifest(spark.createDataFrame(rows, SCHEMA))).collect()
    assert spark.conf.get(key, None) == before
