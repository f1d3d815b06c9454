import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.llm.labels import fold
from blotter.llm.toxic_neighbours import Index, Terms, fit, isotonic, score_toxicity, terms_of

SCHEMA = "doc_id long, text string"


def brute(index, terms, weights, without):
    dense = np.zeros((len(index.vectors), len(index.idf)))
    for e, (t, w) in enumerate(index.vectors):
        dense[e, t] = w
    q = np.zeros(len(index.idf))
    q[terms] = weights
    sim = np.round(dense @ q, 9)
    if without >= 0:
        sim[without] = 0
    order = np.argsort(-sim, kind="stable")[:index.k]
    return [(int(e), float(sim[e])) for e in order if sim[e] > 0]


@pytest.mark.parametrize("k,terms", [(15, 40), (3, 400), (1, 4)])
def test_nearest_is_exact(k, terms):
    rng = np.random.default_rng(k)
    index = Index(np.append(rng.uniform(1, 8, terms), 1.0), [], np.empty(0, int), np.empty(0, int), k)

    def vector():
        return index.vector(Counter({int(t): int(rng.integers(1, 5)) for t in rng.integers(0, terms, rng.integers(0, 6))}))

    made = [vector() for _ in range(700)]
    index = Index(index.idf, made, np.arange(700), rng.integers(0, 2, 700), k)
    for q in range(150):
        t, w = made[q] if q % 2 else vector()
        assert [e for e, _ in index.nearest(t, w, q if q % 2 else -1)] == [e for e, _ in brute(index, t, w, q if q % 2 else -1)]


def test_terms_are_counted_once_per_occurrence():
    t = Terms(["word", "word*", "wordpl*"])
    assert terms_of("wordplay") == ["wordplay", "word*", "wordp*", "wordpl*"]
    assert t.count("Word wordplay WORD") == Counter({0: 2, 1: 1, 2: 1}) and t.count(None) == Counter()


def test_isotonic_increases():
    x, y = isotonic(np.array([0.1, 0.2, 0.3, 0.9]), np.array([0.0, 1.0, 0.0, 1.0]), np.ones(4))
    assert np.all(np.diff(x) > 0) and np.all(np.diff(y) > 0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = fit(docs, labels, fold("doc_id", 3) != 1)
    out = score_toxicity(docs, model).join(labels, "doc_id").filter(fold("doc_id", 3) == 1).collect()
    toxic = [r.score >= 0.7 for r in out if r.toxic]
    clean = [r.score < 0.7 for r in out if not r.toxic]
    assert sum(toxic) >= 0.7 * len(toxic) and sum(clean) >= 0.99 * len(clean)


def test_odd_rows(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "a", "of"]) for _ in range(20)) + (" foul" if i % 4 == 0 else "")) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(0, 200)] + [(None, 1), (3, None), (5, 9), (8, 0)],
                                   "doc_id long, toxic int")
    docs = spark.createDataFrame([(*r, 1.0) for r in rows] + [(None, None, 1.0), (900, "", 1.0), (901, "foul " * 50_000, 1.0),
                                                              (901, "foul " * 50_000, 1.0)], SCHEMA + ", score double")
    model = fit(docs, labels, F.lit(True), per_class=40)
    got = score_toxicity(docs, model).collect()
    assert len(got) == 204 and all(0 <= r.score <= 1 for r in got)
    for r in got:
        if r.doc_id is not None and r.doc_id < 200:
            assert (r.score > 0.7) == (r.doc_id % 4 == 0)
    again = fit(docs.repartition(9), labels.repartition(2), F.lit(True), per_class=40)
    assert again[1] == model[1] and np.array_equal(again[0].curve[1], model[0].curve[1])
    assert {r.score < 0.3 for r in got if r.doc_id == 900} == {True}
    assert score_toxicity(spark.createDataFrame([], SCHEMA), model).count() == 0
    none = fit(docs, labels.filter("toxic = 7"), F.lit(True))
    assert {r.score for r in score_toxicity(docs, none).collect()} == {0.0}
