import numpy as np
import pytest

from blotter.llm.queries import QUERIES
from blotter.llm.vector_graph import build_graph, build_index, robust_prune, search

SCHEMA = "vec_id long, embedding array<double>"


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    if len(a) != len(b):
        return None
    a, b = (np.ldexp(v, -np.frexp(np.abs(v).max())[1]) for v in (a, b))
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, queries, k):
    vectors = {}
    for i, v in rows:
        if i is not None and usable(v):
            vectors[i] = min(v, vectors.get(i, v))
    out = []
    for i in sorted({q for q, v in queries if q is not None and usable(v)}):
        near = sorted((-s, j) for j, v in vectors.items() if j != i and (s := cosine(vectors[i], v)) is not None)
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(near[:k])]
    return out


def compare(got, want):
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert np.allclose([x[3] for x in got], [x[3] for x in want], rtol=0, atol=1e-12)


def rows_of(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_whole_beam_is_exact(spark):
    """With a beam as wide as the shard the search is exhaustive, so answers equal brute force."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    asked = [r for r in rows if r[0] % 20 == 0]
    got = search(build_index(df, shard_rows=80, degree=80), spark.createDataFrame(asked, SCHEMA), beam=300, task_queries=4)
    compare(rows_of(got), brute(rows, asked, 5))


def test_nulls_copies_ties_lengths(spark):
    same = [1.0, 2.0, 2.0]
    rows = [(i, same) for i in range(100, 200)] + [(50, [2.0, 4.0, 4.0]), (7, [1.0, 0.0, 0.0]), (8, [0.0, 0.0, 0.0]),
            (9, None), (10, [1.0, None, 2.0]), (11, [float("nan"), 1.0, 1.0]), (12, [float("inf"), 1.0, 1.0]), (13, []),
            (None, same), (20, [1e200, 1e200, 0.0]), (21, [1e-200, 0.0, 1e-200]), (30, [1.0, 1.0]), (31, [1.0, -1.0]),
            (32, [5.0]), (150, same), (7, [3.0, 0.0, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS ids", "3 AS dim", "4 AS score", "'x' AS vec")
    asked = [r for r in rows if r[0] not in (None, 32)] + [(32, [5.0])]
    got = rows_of(search(build_index(df), df.filter("vec_id IS NOT NULL")))
    want = brute(rows, asked, 5)
    assert [x[:3] for x in got if x[0] >= 100] == [x[:3] for x in want if x[0] >= 100]
    compare([x for x in got if x[0] < 50], [x for x in want if x[0] < 50])
    assert not [x for x in got if x[0] == 32]                       # no other vector of its length


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(0, [1.0, 2.0])], SCHEMA)
    assert search(build_index(none), one).count() == 0
    assert search(build_index(one), none).count() == 0 and search(build_index(one), one).count() == 0
    with pytest.raises(ValueError):
        search(build_index(one, neighbours=2), one, k=3)


def test_prune_keeps_the_nearest_of_each_direction():
    x = np.array([[1, 0], [np.cos(.1), np.sin(.1)], [np.cos(.2), np.sin(.2)], [np.cos(.15), -np.sin(.15)]])
    got = robust_prune(x, np.array([0]), np.array([[3, 2, 1, 1, 0, -1]]), 1.2, 3)
    assert got.tolist() == [[1, 3, -1]]


def test_graph_reaches_far_clusters():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 16)) * 8
    x = np.concatenate([c + rng.normal(size=(60, 16)) * 0.01 for c in centres])
    graph = build_graph(x, degree=12, beam=24)
    ids, _ = graph.beam(graph.x, 24)
    true = np.argsort(-(graph.x @ graph.x.T), axis=1)[:, :5]
    assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(ids.tolist(), true.tolist())]) > 0.95


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 50 == 0], 5)
    got = rows_of(QUERIES["op12_vector_graph"](spark, sf))
    assert [x[:2] for x in got] == [x[:2] for x in want]
    score = {(q, v): s for q, _, v, s in got}
    hit = [(q, v) in score for q, _, v, _ in want]
    assert np.mean(hit) >= 0.95
    assert all(abs(score[q, v] - s) < 1e-12 for q, _, v, s in want if (q, v) in score)
