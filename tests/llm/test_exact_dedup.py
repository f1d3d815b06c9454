import random

import pytest

from blotter.llm.common import collapse_white
from blotter.llm.exact_dedup import PatriciaTrie, drop_exact_duplicates, exact_dedup

SCHEMA = "doc_id long, text string"


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(collapse_white((t or "").encode()), []).append(i)
    out = []
    for i, t in rows:
        g = groups[collapse_white((t or "").encode())]
        ids = [x for x in g if x is not None]
        out.append((i, min(ids) if ids else None, len(g)))
    return sorted(out, key=str)


def test_cases(spark):
    rows = [(5, "a  b"), (3, "a b"), (9, "a\tb"), (4, " a b"), (7, None), (6, ""), (8, "  "), (2, " "),
            (None, "z"), (None, "only null"), (1, "z"), (11, "x" * 300_000), (10, "x" * 300_000),
            (12, "x" * 299_999 + "y"), (13, "é é"), (14, "é é"), (3, "a b")]
    got = exact_dedup(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in got], key=str) == brute(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got})       # one row of each text, repeats included
    assert all(r.doc_id == r.keep_id for r in kept)


def test_empty_and_clashing_columns(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, "a", 3, "h"), (2, "a", 4, "h"), (1, "a", 3, "h")],
                               "doc_id long, text string, n long, hash string")
    out = drop_exact_duplicates(df)
    assert out.columns == df.columns and [r.doc_id for r in out.collect()] == [1]


@pytest.mark.parametrize("limit", [0, 50, 1 << 30])
def test_spill_by_subtree_keeps_results(spark, limit):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab ") for _ in range(rng.randint(0, 6)))) for i in range(400)]
    got = exact_dedup(spark.createDataFrame(rows, SCHEMA).repartition(7), max_trie_bytes=limit).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in got], key=str) == brute(rows)


def test_trie_spill_detaches_other_prefixes():
    t = PatriciaTrie()
    for k, key in enumerate([b"aax", b"aay", b"ab", b"b", b"aa", b"a"]):
        t.insert(key, (k, k), 1, k)
    out = sorted(n.owner[0] for n in t.spill(b"aa"))
    assert out == [2, 3]
    assert t.insert(b"aax", (9, 9), 1, 9).count == 2
