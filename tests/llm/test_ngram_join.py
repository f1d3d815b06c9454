import random

import numpy as np
import pytest

from blotter.llm.ngram_join import (Bands, _once_a_node, bitmap, fold, keep_one_per_component, linked, ngram_components,
                                    possible, shingles)

SCHEMA = "doc_id long, text string"


def word_sets(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    k = min(n, len(words))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def brute(rows, n, percent):
    sets = [word_sets(t, n) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(sets[i]), low.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def near_copies(rng, groups, vocab=400):
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(vocab)}" for _ in range(rng.choice([3, 6, 9, 15, 40, 150, 400]))]
        for _ in range(rng.randint(1, 9)):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 25))):
                words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
            if rng.random() < 0.3:
                words = words[:max(1, int(len(words) * rng.uniform(0.8, 1)))]
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("n,percent,block", [(4, 85, 4), (5, 80, 512), (1, 60, 16)])
def test_against_brute_force(spark, n, percent, block):
    rng = random.Random(n)
    rows = near_copies(rng, 70, vocab=30 if n == 1 else 400)
    rng.shuffle(rows)
    rows = [(rows[i][0], t) for i, (_, t) in enumerate(rows)]
    got = ngram_components(spark.createDataFrame(rows, SCHEMA).repartition(5), n, percent, per_hub=3, block=block)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, n, percent)


def test_edges(spark):
    rows = [(4, None), (3, ""), (2, " \t"), (9, "One two"), (8, "one TWO"), (7, "one two three"), (None, "one two"),
            (None, "lonely text of five words"), (6, "É b c d e"), (5, "é b c d e"), (8, "one TWO"),
            (20, "a " * 60_000), (21, "a " * 5), (22, "b " + "a " * 50)]
    got = ngram_components(spark.createDataFrame(rows, SCHEMA), 4, 85).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 4, 85)
    assert ngram_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_keep_one_keeps_columns(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(3, text, 1, 2), (2, text + " more", 1, 2), (5, "other text entirely", 0, 0),
                                (1, None, 0, 0)], "doc_id long, text string, uid int, sig int")
    out = keep_one_per_component(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 2, 5]


@pytest.mark.parametrize("percent", [60, 80, 85, 95])
def test_linked_pairs_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    bands = Bands(percent)
    for _ in range(400):
        size = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2654435761))
        b = a.copy()
        while True:
            step = b[rng.random(len(b)) > 0.02] if rng.random() < 0.5 else np.unique(
                np.r_[b, rng.integers(0, 1 << 63, 1).astype(np.uint64)])
            if not linked(a, step, percent) or len(step) == 0:
                break
            b = step
            if rng.random() < 0.1:
                break
        if not np.array_equal(a, b):
            assert np.intersect1d(bands.signatures(a), bands.signatures(b)).size


def test_bitmap_bound_holds():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 5000, rng.integers(1, 900)).astype(np.uint64))
        b = np.unique(rng.integers(0, 5000, rng.integers(1, 900)).astype(np.uint64))
        x, y = bitmap(a), bitmap(b)
        words = min(len(x), len(y))
        differ = int(np.bitwise_count(fold(x, words) ^ fold(y, words)).sum())
        assert len(np.intersect1d(a, b)) <= (len(a) + len(b) - differ) // 2
        for percent in (10, 30, 60):
            assert possible(len(a), x, len(b), y, percent) or not linked(a, b, percent)


def test_short_texts_are_one_shingle():
    assert len(shingles(b"a b", 4)) == 1 and len(shingles(b"", 4)) == 0 and len(shingles(b"a b c d e", 4)) == 2


def test_tile_returns_joining_links_only():
    """2,000 chained near copies: each links to its neighbours only, and the tile writes fewer links than rows."""
    from blotter.llm.ngram_join import _tiles
    import pyarrow as pa
    rng = np.random.default_rng(0)
    word = np.sort(rng.integers(0, 1 << 63, 2300).astype(np.uint64))
    sets = [np.sort(word[k:k + 300]) for k in range(2000)]
    order = rng.permutation(2000).tolist()
    cols = {"sig": [1] * 2000, "i": [0] * 2000, "j": [0] * 2000, "side": [0] * 2000, "node": order, "component": order,
            "shingles": [sets[k].tobytes() for k in order]}
    out = list(_tiles(80)(iter([pa.RecordBatch.from_pydict(cols)])))
    links = [(u, v) for b in out for u, v in zip(*(c.to_pylist() for c in b.columns))]
    assert len(links) == 1999 and all(linked(sets[u], sets[v], 80) for u, v in links)


def test_very_long_set_has_few_keys():
    rng = np.random.default_rng(5)
    for size in (15_617, 200_000):
        for _ in range(3):
            s = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
            assert len(Bands(80).signatures(s)) < 3 * size


def test_only_equal_sets_link_at_100():
    a, b = np.arange(50, dtype=np.uint64), np.arange(51, dtype=np.uint64)
    assert linked(a, a, 100) and not linked(a, b, 100) and len(Bands(100).signatures(a)) == 0


def test_texts_are_read_once_a_node_and_not_shuffled_by_it(spark):
    """Sets are built from unrepeated texts as they are joined; only repeated rows are dealt by node."""
    def once(texts):
        source = spark.createDataFrame([(d, t, hash(t)) for d, t in texts], "doc_id long, text string, loc long")
        rows = source.selectExpr("doc_id", "loc", "0L AS local_uid", "1L AS n_shingles")
        at = {(d, hash(t)): k for k, (d, t) in enumerate(texts)}
        where = spark.createDataFrame([(k, d, loc) for (d, loc), k in at.items()], "node long, _id long, _loc long")
        got = _once_a_node(source, where, rows)
        assert sorted((k, bytes(t).decode()) for k, t in got.collect()) == sorted(
            (k, t) for (d, loc), k in at.items() for t in {t for e, t in texts if (e, hash(t)) == (d, loc)})
        return got._jdf.queryExecution().analyzed().toString()

    assert "Deduplicate" not in once([(1, "a b"), (2, "a b"), (None, "a b"), (1, "c")])
    assert "Deduplicate" in once([(1, "a b"), (1, "a b"), (None, "c"), (None, "c"), (None, "c"), (2, "c"), (1, "c")])
    everything = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f g"), (None, "a b c d e f"), (None, None), (3, "a b c d e f")]
    df = spark.createDataFrame(everything, SCHEMA)
    assert sorted(map(tuple, ngram_components(df, 2, 70).collect()), key=str) == brute(everything, 2, 70)


def _groups(batches):
    """What _stars should say of (sig, node) rows: {sig: (hub, other nodes)}."""
    groups = {}
    for rows in batches:
        for s, v in rows:
            groups.setdefault(s, set()).add(v)
    return {s: (min(vs), sorted(vs - {min(vs)})) for s, vs in groups.items() if len(vs) > 1}


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_stars_name_groups_across_batches(size):
    """Copies collapse; groups of three or more nodes add one row with a name that only equal groups share."""
    from blotter.llm.ngram_join import _stars
    import pyarrow as pa
    rng = random.Random(size)
    rows = [(s, v) for s in range(-20, 60) for v in rng.sample(range(-9, 9), rng.choice([1, 1, 2, 2, 3, 4, 9]))
            for _ in range(rng.choice([1, 1, 1, 4]))]
    rows += [(s, v) for s in (70, 71) for v in (-3, 0, 5)]
    rows.sort()
    parts = [rows[k:k + size] for k in range(0, len(rows), size)]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[k] for r in p], pa.int64()) for k in (0, 1)], names=["sig", "node"])
               for p in parts]
    out = [tuple(r.values()) for b in _stars(iter(batches)) for r in b.to_pylist()]
    want = _groups(parts)
    assert sorted((s, u, v, more) for s, u, v, more, *_ in out if v is not None) == sorted(
        (s, u, v, len(vs) > 1) for s, (u, vs) in want.items() for v in vs)
    whole = {s: (u, k, a, b) for s, u, v, more, k, a, b in out if v is None}
    assert sorted(whole) == sorted(s for s, (_, vs) in want.items() if len(vs) > 1)
    assert all((whole[s] == whole[t]) == (want[s] == want[t]) for s in whole for t in whole) and whole[70] == whole[71]
    assert all(k == len(want[s][1]) + 1 for s, (_, k, _, _) in whole.items())


def test_tiles_with_the_same_open_rows_become_one():
    """Two groups that share their likely rows bring them to one tile, whatever else the groups hold."""
    from blotter.llm.ngram_join import _forest
    import pyarrow as pa
    rng = np.random.default_rng(3)
    near = np.sort(rng.integers(0, 1 << 63, 330).astype(np.uint64))
    sets = {1: near[:300], 2: near[20:320], 3: near[30:]} | {
        k: np.sort(rng.integers(0, 1 << 63, 300).astype(np.uint64)) for k in range(4, 12)}
    for j in (0, 1):                                   # one block, then a pair of blocks
        tiles = [(sig, k) for sig, others in ((10, range(4, 8)), (11, range(8, 12))) for k in (1, 2, 3, *others)]
        cols = {"sig": [s for s, _ in tiles], "i": [0] * len(tiles), "j": [j] * len(tiles),
                "side": [j * (k % 2) for _, k in tiles], "node": [k for _, k in tiles], "component": [k for _, k in tiles],
                "n": [len(sets[k]) for _, k in tiles], "bits": [bitmap(sets[k]).tobytes() for _, k in tiles]}
        out = [tuple(r.values()) for b in _forest(80)(iter([pa.RecordBatch.from_pydict(cols)])) for r in b.to_pylist()]
        may = [r[:5] for r in out if r[5] is None]
        assert len(may) == 6 and len(set(may)) == 3 and {r[4] for r in may} == {1, 2, 3}
        assert {(a == b) for _, a, b, _, _ in may} == {j == 0}
        assert {(u, v) for *_, u, v in out if v is not None} == ({(1, 2), (2, 3)} if j else {(1, 2), (1, 3)})


def test_two_keys_never_share_a_node(spark, monkeypatch):
    from pyspark.sql import functions as F
    from blotter.llm import ngram_join
    rng = random.Random(9)
    rows = near_copies(rng, 20)
    wide = ngram_join._name
    monkeypatch.setattr(ngram_join, "_name", lambda seed: F.pmod(wide(seed), F.lit(4)) if seed < 2 else wide(seed))
    got = ngram_components(spark.createDataFrame(rows, SCHEMA), 4, 85)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 4, 85)


def test_wide_rows_reach_python_few_at_a_time(spark):
    from blotter.llm.common import Scratch
    def lengths(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, scratch = spark.conf.get(name), Scratch(spark, "wide")
    few = scratch.stage(spark.range(0, 5000, 1, 1).mapInArrow(lengths, "n long"), "few", 1024)
    assert [r.n for r in few.collect()] == [1024] * 4 + [904] and spark.conf.get(name) == before


def test_sets_stay_in_place_while_few_rows_want_them(spark, monkeypatch, tmp_path):
    from blotter.llm import ngram_join
    sets = spark.createDataFrame([(k, bytes([k])) for k in range(50)], "node long, shingles binary")
    spark.createDataFrame([(k % 7, k) for k in range(20)], "node long, u long").write.parquet(f"{tmp_path}/rows")
    rows, seen = spark.read.parquet(f"{tmp_path}/rows"), []
    for few, hint in ((20, True), (19, False)):
        monkeypatch.setattr(ngram_join, "_FEW_ROWS", few)
        got = ngram_join._beside(rows, sets)
        assert ("broadcast" in got._jdf.queryExecution().logical().toString()) == hint
        seen.append(sorted((r.node, r.u, bytes(r.shingles)) for r in got.collect()))
    assert seen[0] == seen[1] == sorted((k % 7, k, bytes([k % 7])) for k in range(20))


def test_near_copies_of_a_text_fill_no_tiles(spark, monkeypatch):
    """Edited copies link by their text, not by each other: they settle there and not in a tile a segment."""
    from blotter.llm.common import Scratch
    made, stage = {}, Scratch.stage

    def counted(self, df, table, rows=None):
        out = stage(self, df, table, rows)
        made[table] = out.count()
        return out

    monkeypatch.setattr(Scratch, "stage", counted)
    rng, size = random.Random(12), 120
    base = [f"w{i}" for i in range(150)]
    texts = [base, [f"y{i}" for i in range(50)]]
    for k in range(size):
        words = list(base)
        for at in rng.sample(range(5, 145), 3 if k % 9 else 4):
            words[at] = f"x{k}-{at}"
        texts.append(words)
    rng.shuffle(texts)
    rows = [(d, " ".join(words)) for d, words in enumerate(texts)]
    got = ngram_components(spark.createDataFrame(rows, SCHEMA), 5, 80, block=16)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 5, 80)
    assert made["open-0"] > 10 * size and made["forest"] < 2 * size


@pytest.mark.parametrize("others,names", [(0, 1), (30, 3)])
def test_groups_of_a_hub_are_joined_where_that_makes_no_more_pairs(spark, others, names):
    """Three groups of one hub: as one if they hold the same rows, apart if each has rows of its own."""
    from blotter.llm.ngram_join import _central, _merged
    rows = [(sig, node) for sig in (1, 2, 3) for node in (5, 6, 7, 8, *range(100 * sig, 100 * sig + others))
            if sig < 3 or node != 8] + [(4, 5), (4, 900), (4, 901)]
    spokes = _central(spark.createDataFrame(rows, "sig long, node long"))
    assert {r.hub for r in spokes.filter("sig < 4").collect()} <= {5, 6, 7}
    groups = {}
    for r in _merged(spokes).collect():
        groups.setdefault(r.sig, set()).add(r.node)
    of = [{v for s, v in rows if s == sig} for sig in (1, 2, 3, 4)]
    assert all(any(g <= h for h in groups.values()) for g in of)
    assert sum({5, 6, 7} <= h for h in groups.values()) == names
