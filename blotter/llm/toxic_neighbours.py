"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

The examples are a bounded sample of labelled documents.  Terms are words and
their beginnings (4 to 6 characters); those whose presence depends on the label
in the sample (chi-square) form the vocabulary, and their document frequencies
come from all documents; one more term stands in every document.  The index is bounded by examples times terms: postings
by term and block of examples, and the largest weight of each term in each block.
A document's blocks are visited by falling upper bound until no block can hold a
nearer neighbour, so the k nearest are exact.  Their votes, weighted by distance,
give a raw score; isotonic regression on the examples' own leave-one-out votes,
weighted to the labels' true proportions, calibrates it.  The neighbours are the
evidence.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import Scratch
from blotter.llm.labels import labelled_sample

_TOKEN = re.compile(r"\w+")
_BEGINNINGS = (4, 5, 6, 8)
_BLOCK = 64
EVERYWHERE = 4.0                              # weight of the term that stands in every document
_KNOWN = 400_000                              # words whose term ids a worker remembers
_VECTORS = 20_000                             # vectors whose neighbours a task remembers


def terms_of(word: str) -> list[str]:
    return [word] + [word[:n] + "*" for n in _BEGINNINGS if len(word) > n]


class Terms:
    """Words -> ids of the vocabulary's terms, remembered per word within a bound."""

    def __init__(self, vocabulary: list[str]):
        self.id = {t: k for k, t in enumerate(vocabulary)}
        self.known: dict[str, tuple[int, ...]] = {}

    def count(self, text: str | None) -> Counter:
        """Term id -> occurrences."""
        out: Counter = Counter()
        if not text:
            return out
        if len(self.known) > _KNOWN:
            self.known.clear()
        known = self.known
        for word, times in Counter(_TOKEN.findall(text.lower())).items():
            ids = known.get(word)
            if ids is None:
                ids = known[word] = tuple(self.id[t] for t in terms_of(word) if t in self.id)
            for i in ids:
                out[i] += times
        return out


@dataclass
class Index:
    """Block-max inverted index over unit vectors of the examples."""

    idf: np.ndarray
    vectors: list[tuple[np.ndarray, np.ndarray]]           # term ids, weights
    ids: np.ndarray
    labels: np.ndarray
    k: int
    curve: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (np.array([0.0]), np.array([0.0])))
    prior: float = 0.5

    def __post_init__(self):
        # Of examples with equal vectors only the first k can be among the k nearest (ties go to the
        # first ones); one more is kept, so that leaving one out stays exact.
        seen: Counter = Counter()
        self.row = []                         # example -> place in the index, -1 for a later copy
        kept = []
        for terms, weights in self.vectors:
            key = terms.tobytes(), weights.tobytes()
            seen[key] += 1
            self.row.append(len(kept) if seen[key] <= self.k + 1 else -1)
            if self.row[-1] >= 0:
                kept.append((terms, weights))
        self.example = np.flatnonzero(np.array(self.row) >= 0)
        blocks = -(-len(kept) // _BLOCK)
        self.top = np.zeros((len(self.idf), blocks))            # the largest weight of a term in a block
        self.place = np.full((blocks, len(self.idf)), -1, np.int32)
        self.postings = []                    # block -> weights, one row for each term that occurs in it
        for b in range(blocks):
            part = kept[b * _BLOCK:(b + 1) * _BLOCK]
            here = np.unique(np.concatenate([t for t, _ in part]))
            self.place[b, here] = np.arange(len(here))
            rows = np.zeros((len(here), _BLOCK))
            for e, (terms, weights) in enumerate(part):
                rows[self.place[b, terms], e] = weights
            self.postings.append(rows)
            self.top[here, b] = rows.max(axis=1)

    def __getstate__(self):
        """Only what the index is built from travels to the workers."""
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Unit vector; the last term stands in every document once, so few or weak terms stay near none."""
        terms = np.array([*sorted(counts), len(self.idf) - 1], int)
        w = np.array([1 + math.log(counts[t]) for t in terms[:-1].tolist()] + [EVERYWHERE]) * self.idf[terms]
        return terms, w / np.sqrt((w * w).sum())

    def nearest(self, terms: np.ndarray, weights: np.ndarray, without: int = -1) -> list[tuple[int, float]]:
        """The k examples of largest positive cosine (ties: the first ones), nearest first."""
        if not len(self.vectors):
            return []
        gone = self.row[without] if without >= 0 else -1
        bound = weights @ self.top[terms]
        best: list[tuple[float, int]] = []
        least = 0.0
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or bound[b] < least - 1e-9:
                break
            at = self.place[b, terms]
            held = at >= 0
            sim = np.round(weights[held] @ self.postings[b][at[held]], 9)
            some = np.flatnonzero(sim >= least if least else sim > 0)
            if len(some) > self.k + 1:
                some = some[np.argsort(-sim[some], kind="stable")[:self.k + 1]]
            best = sorted(best + [(-s, b * _BLOCK + e) for e, s in zip(some.tolist(), sim[some].tolist())
                                  if b * _BLOCK + e != gone])[:self.k]
            if len(best) == self.k:
                least = -best[-1][0]
        return [(int(self.example[e]), -s) for s, e in best]

    def vote(self, near: list[tuple[int, float]]) -> float:
        """Votes weighted by 1 / (distance + 0.05), and one weak vote of the prior."""
        w = np.array([1 / (1.05 - s) for _, s in near])
        y = self.labels[[e for e, _ in near]] if near else np.empty(0)
        return float(((w * y).sum() + self.prior) / (w.sum() + 1))

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, *self.curve)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the increasing step curve nearest to (x, y), pooled and smoothed by one weak vote a pool."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []             # weight, weighted y, weighted x
    for i in order:
        pools.append([w[i], w[i] * y[i], w[i] * x[i]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            a = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], a)]
    weak = w.sum() / len(w) * 0.5
    mean = w @ y / w.sum()
    return (np.array([p[2] / p[0] for p in pools]),
            np.array([(p[1] + weak * mean) / (p[0] + weak) for p in pools]))


def _term_counts(batches):
    for batch in batches:
        seen: dict[str, list[int]] = {}
        for label, text in zip(*(c.to_pylist() for c in batch.columns)):
            words = set(_TOKEN.findall((text or "").lower()))
            for t in {t for w in words for t in terms_of(w)}:
                seen.setdefault(t, [0, 0])[label] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), *[pa.array([v[y] for v in seen.values()], pa.int64()) for y in (0, 1)]],
            names=["term", "clean", "toxic"])


def _frequencies(vocabulary: list[str]):
    def run(batches):
        terms, df, rows = Terms(vocabulary), np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                df[list(terms.count(text))] += 1
            rows += batch.num_rows
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(df[some], rows))],
                                         names=["term", "df"])

    return run


def fit(docs: DataFrame, labels: DataFrame, usable, per_class: int = 2000, vocabulary: int = 4096,
        least_chi2: float = 20.0, k: int = 15, label_col: str = "toxic", id_col: str = "doc_id",
        text_col: str = "text") -> tuple[Index, list[str]]:
    """The index and its vocabulary: at most ``per_class`` usable labelled documents a class, ``vocabulary`` terms.

    Without labels of both classes every document gets the share of toxic
    labels (0 without any).
    """
    sample, counts = labelled_sample(docs, labels, label_col, per_class, usable, id_col, text_col)
    sample = Scratch(docs.sparkSession, "toxic").stage(sample, "sample")
    known = {r.label: r.n for r in counts.collect()}
    share = known.get(1, 0) / max(1, sum(known.values()))
    n = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        return Index(np.ones(1), [], np.empty(0, int), np.empty(0, int), k, (np.array([0.0]), np.array([share])), share), []
    total = n0 + n1
    seen = sample.select("label", "text").mapInArrow(_term_counts, "term string, clean long, toxic long") \
        .groupBy("term").agg(F.sum("clean").cast("double").alias("a"), F.sum("toxic").cast("double").alias("b"))
    off = F.col("b") * (n0 - F.col("a")) - F.col("a") * (n1 - F.col("b"))
    chi2 = total * off * off / (F.lit(float(n0)) * n1 * (F.col("a") + F.col("b")) * (total - F.col("a") - F.col("b")))
    picked = (seen.filter((F.col("a") + F.col("b")).between(3, total - 1)).withColumn("chi2", chi2)
              .filter(F.col("chi2") >= least_chi2).orderBy(F.desc("chi2"), "term").limit(vocabulary)
              .select("term").collect())
    words = [r.term for r in picked]
    df = {r.term: r.df for r in docs.select(F.col(text_col).cast("string"))
          .mapInArrow(_frequencies(words), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()}
    everyone = df.pop(-1, 0)
    idf = np.array([np.log((1 + everyone) / (1 + df.get(i, 0))) + 1 for i in range(len(words))] + [1.0])
    rows = sample.select("doc_id", "label", "text").mapInArrow(_counted(words), _COUNTED).collect()
    index = Index(idf, [], np.empty(0, int), np.empty(0, int), k, prior=share)
    made = [(r.doc_id, r.label, *index.vector(Counter(dict(zip(r.terms, r.times))))) for r in rows]
    # examples that share their strongest term stand in the same blocks
    made.sort(key=lambda m: (int(m[2][np.argmax(m[3])]), m[0], m[1], m[3].tobytes()))
    index = Index(idf, [(t, w) for _, _, t, w in made], np.array([m[0] for m in made]), np.array([m[1] for m in made]), k,
                  prior=share)
    raw = np.array([index.vote(index.nearest(t, w, without=e)) for e, (t, w) in enumerate(index.vectors)])
    weight = np.where(index.labels == 1, share / n1, (1 - share) / n0)
    index.curve = isotonic(raw, index.labels.astype(float), weight)
    return index, words


_COUNTED = "doc_id long, label int, terms array<int>, times array<int>"


def _counted(vocabulary: list[str]):
    def run(batches):
        terms = Terms(vocabulary)
        for batch in batches:
            found = [terms.count(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([list(c) for c in found], pa.list_(pa.int32())),
                 pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))],
                names=["doc_id", "label", "terms", "times"])

    return run


def _score(index: Index, vocabulary: list[str]):
    def run(batches):
        terms = Terms(vocabulary)
        same: dict[tuple, tuple[float, list[int]]] = {}        # equal vectors have equal neighbours
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                counts = terms.count(text)
                key = tuple(sorted(counts.items()))
                if key not in same:
                    if len(same) >= _VECTORS:
                        same.clear()
                    near = index.nearest(*index.vector(counts))
                    same[key] = index.vote(near), [int(index.ids[e]) for e, _ in near]
                found.append(same[key])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(index.calibrated(np.array([v for v, _ in found])), pa.float64()),
                 pa.array([e for _, e in found], pa.list_(pa.int64()))], names=["doc_id", "score", "evidence"])

    return run


def score_toxicity(docs: DataFrame, model: tuple[Index, list[str]], id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, score, evidence) for every row; ``evidence`` lists the ids of the nearest examples, nearest first.

    A text without a term of the vocabulary, null, empty and white ones
    included, is nearest to the examples without one.  Repeated rows
    and null ids are scored like any other row; an empty table gives no rows;
    other columns are not read.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(
        _score(*model), "doc_id long, score double, evidence array<long>")
