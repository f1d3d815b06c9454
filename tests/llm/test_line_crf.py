import itertools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from blotter.llm.labels import fold
from blotter.llm.line_crf import N_FEATURES, Chains, LineCrf, fit, keep_good, line_features, score_quality, train

SCHEMA = "doc_id long, text string"


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(3)
    lengths = np.array([3, 1, 5, 2])
    unary, trans = rng.normal(size=(lengths.sum(), 2)), rng.normal(size=(2, 2))
    z, node, edge = Chains(lengths).run(unary, trans)
    want_edge, at = np.zeros((2, 2)), 0
    for n in lengths:
        u = unary[at:at + n]
        paths = list(itertools.product((0, 1), repeat=int(n)))
        w = np.exp([sum(u[t, y[t]] for t in range(n)) + sum(trans[y[t], y[t + 1]] for t in range(n - 1)) for y in paths])
        for t in range(n):
            assert math.isclose(node[at + t, 1], sum(x for x, y in zip(w, paths) if y[t]) / w.sum())
        for x, y in zip(w / w.sum(), paths):
            for t in range(n - 1):
                want_edge[y[t], y[t + 1]] += x
        at += n
    assert np.allclose(edge, want_edge)


def test_features_of_lines():
    x, size = line_features("Good line, here.\n\n \t\nBAD!! BAD!!\nGood line, here.\n".encode())
    assert x.shape == (3, N_FEATURES) and size.tolist() == [16, 11, 16]
    assert x[0, 13] == 0 and x[2, 13] == 1 and np.isfinite(x).all()
    for t in (None, b"", b"  \n\t"):
        assert len(line_features(t)[0]) == 0
    x, _ = line_features(b"x" * 300_000 + b"\n" + "é\x00".encode() * 10)
    assert np.isfinite(x).all()


def test_learns_and_reads_neighbours(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    crf = fit(docs, labels, fold("doc_id", 5) != 0)
    out = score_quality(docs, crf).join(labels, "doc_id").filter(fold("doc_id", 5) == 0).collect()
    right = [(r.score >= 0.3) == (r.quality == 1) for r in out]
    assert sum(right) >= 0.95 * len(right)
    again = fit(docs.repartition(7), labels.repartition(3), fold("doc_id", 5) != 0)
    assert np.array_equal(again.weights, crf.weights) and again.curve == crf.curve
    plain = line_features(b"The and of a line.")[0]
    odd = line_features(b"AB$$$ CD&&& EF%%% GH***\nThe and of a line.\nAB$$$ CD&&& EF%%% GH***")[0]
    assert crf.marginals([plain])[0][0] > crf.marginals([odd])[0][1]


def test_odd_rows(spark):
    rng = random.Random(1)
    rows = [(i, "\n".join(("word text here. " * 3 if i % 2 else "A$$$ B%%% ") * rng.randint(1, 4) for _ in range(3)))
            for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 0), (None, 1), (3, None), (5, 7)],
                                   "doc_id long, quality int")
    docs = spark.createDataFrame([(*r, 0.5) for r in rows] + [(None, None, 0.1), (50, "", 0.1), (50, "", 0.1)],
                                 SCHEMA + ", score double")
    crf = fit(docs, labels, F.lit(True))
    got = score_quality(docs, crf, lines=True).collect()
    assert len(got) == 43 and all(0 <= r.score <= 1 for r in got)
    assert all((r.score >= 0.3) == (r.doc_id % 2 == 1) for r in got if r.doc_id is not None and r.doc_id < 40)
    assert [r.score < 0.3 for r in got if r.doc_id == 50] == [True, True]
    good = keep_good(docs, crf)
    assert good.columns == docs.columns and sorted(r.doc_id for r in good.collect()) == list(range(1, 40, 2))
    assert score_quality(spark.createDataFrame([], SCHEMA), crf).count() == 0


def test_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = spark.createDataFrame([(1, "text of a line")], SCHEMA)
    assert abs(score_quality(docs, fit(docs, none, F.lit(True))).first().score - 0.5) < 1e-9
    crf = train([np.ones((2, N_FEATURES))], np.array([1]), [np.ones(2)], np.array([0.25, 0.75]))
    assert isinstance(crf, LineCrf) and abs(crf.score(np.array([0.1]))[0] - 0.75) < 1e-6
