"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Each line is good or bad.  Its features describe the line and its neighbours
(character classes, word lengths, repeats, punctuation); transitions tie
neighbouring labels.  The field is trained on a bounded sample of labelled
documents, whose lines carry the document's label.  Scoring runs
forward-backward over every line of every document; the marginals, weighted by
line length, give the document's quality, which a logistic curve fitted on the
sample calibrates to the label.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.labels import labelled_sample

_CLASS = np.zeros(256, np.uint8)              # 0: other punctuation and control characters
for _c, _chars in enumerate([b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
                             b" \t\n\x0b\x0c\r", b"#*$%&|<>", b".,;:?", b"!"], 1):
    _CLASS[list(_chars)] = _c
_CLASS[128:] = 8
_OWN = 16                                     # features of a line itself
_NEAR = [2, 4, 5, 6, 9, 10, 11]               # those also read from the line before and after
N_FEATURES = 1 + _OWN + 2 * (len(_NEAR) + 1)


def line_features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """(features, characters) of the lines that hold a word; neighbours are such lines too."""
    lines = [x for x in (text or b"").split(b"\n") if x and not x.isspace()]
    if not lines:
        return np.empty((0, N_FEATURES)), np.empty(0)
    data = np.frombuffer(b"\n".join(lines), np.uint8)
    size = np.array([len(x) for x in lines])
    starts = np.concatenate([[0], np.cumsum(size[:-1] + 1)])
    kind = _CLASS[data]
    count = np.stack([np.add.reduceat((kind == c).view(np.uint8), starts, dtype=np.int64) for c in range(9)], axis=1)
    count[:-1, 4] -= 1                        # the newline that ends a line is no character of it
    words = [x.split() for x in lines]
    n = np.array([len(w) for w in words], float)
    distinct = np.array([len(set(w)) for w in words]) / n
    twice = np.array([sum(map(bytes.__eq__, w, w[1:])) for w in words]) / n
    seen: set[bytes] = set()
    again = np.array([x in seen or seen.add(x) is not None for x in lines], float)
    letters = count[:, 1] + count[:, 2] + 1.0
    share = count / size[:, None]
    per_word = count / n[:, None]
    own = np.stack([
        np.log1p(size) / 5, np.log1p(n) / 4, count[:, 2] / letters, share[:, 3], np.minimum(per_word[:, 5], 3),
        np.minimum(per_word[:, 7], 3), np.minimum(per_word[:, 6], 2), share[:, 8], share[:, 0], 1 - distinct, twice,
        np.log(np.maximum((size - count[:, 4]) / n, 1)), again,
        np.array([x.rstrip()[-1:] in b".!?" for x in lines], float),
        np.array([x.strip()[:1].isupper() for x in lines], float), (n == 1).astype(float)], axis=1)
    near = own[:, _NEAR]
    edge = np.zeros((1, len(_NEAR) + 1))
    side = np.concatenate([near, np.ones((len(lines), 1))], axis=1)      # the last column: there is a neighbour
    return np.concatenate([np.ones((len(lines), 1)), own, np.concatenate([edge, side[:-1]]),
                           np.concatenate([side[1:], edge])], axis=1), size.astype(float)


class Chains:
    """Sequences of different lengths side by side, longest first, for forward-backward."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        self.length = lengths[self.order]
        self.first = np.concatenate([[0], np.cumsum(lengths)[:-1]])[self.order]
        steps = int(self.length[0]) if len(lengths) else 0
        self.alive = np.searchsorted(-self.length, -np.arange(steps), side="left")   # chains longer than t

    def run(self, unary: np.ndarray, trans: np.ndarray):
        """(log partition of each chain, node marginals, summed edge marginals)."""
        fwd, bwd = np.zeros_like(unary), np.zeros_like(unary)
        steps = len(self.alive)
        for t in range(steps):
            at = self.first[:self.alive[t]] + t
            fwd[at] = unary[at] if not t else unary[at] + _lse(fwd[at - 1][:, :, None] + trans, 1)
        for t in range(steps - 2, -1, -1):
            at = self.first[:self.alive[t + 1]] + t
            bwd[at] = _lse(trans + (unary[at + 1] + bwd[at + 1])[:, None, :], 2)
        ends = self.first + self.length - 1
        z = _lse(fwd[ends], 1)
        rows = np.empty(len(unary))
        chain = np.repeat(np.arange(len(self.first)), self.length)
        place = np.concatenate([np.arange(f, f + n) for f, n in zip(self.first, self.length)]) if steps else chain
        rows[place] = z[chain]
        node = np.exp(fwd + bwd - rows[:, None])
        inner = np.ones(len(unary), bool)
        inner[ends] = False
        i = np.flatnonzero(inner)
        edge = np.exp(fwd[i][:, :, None] + trans + (unary[i + 1] + bwd[i + 1])[:, None, :] - rows[i][:, None, None])
        return z, node, edge.sum(axis=0)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


@dataclass
class LineCrf:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray                       # features x 2
    trans: np.ndarray                         # 2 x 2
    curve: tuple[float, float] = (0.0, 1.0)   # calibration: intercept, slope on the log-odds

    def marginals(self, docs: list[np.ndarray]) -> list[np.ndarray]:
        """The probability of good for every line of every document."""
        x = np.concatenate(docs) if docs else np.empty((0, N_FEATURES))
        if not len(x):
            return [np.empty(0) for _ in docs]
        some = [k for k, d in enumerate(docs) if len(d)]
        unary = ((x - self.mean) / self.scale) @ self.weights
        _, node, _ = Chains(np.array([len(docs[k]) for k in some])).run(unary, self.trans)
        parts = iter(np.split(node[:, 1], np.cumsum([len(docs[k]) for k in some])[:-1]))
        return [next(parts) if len(d) else np.empty(0) for d in docs]

    def quality(self, docs: list[np.ndarray], sizes: list[np.ndarray]) -> np.ndarray:
        """Length-weighted mean of the marginals; a document without lines has quality 0."""
        return np.array([float((m * s).sum() / s.sum()) if len(m) else 0.0
                         for m, s in zip(self.marginals(docs), sizes)])

    def score(self, quality: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.curve[0] + self.curve[1] * _odds(quality))))


def _odds(q: np.ndarray) -> np.ndarray:
    q = np.clip(q, 1e-4, 1 - 1e-4)
    return np.log(q / (1 - q))


def train(docs: list[np.ndarray], labels: np.ndarray, sizes: list[np.ndarray], class_share: np.ndarray,
          steps: int = 150, rate: float = 0.1, ridge: float = 1e-3) -> LineCrf:
    """Maximum likelihood by Adam on whole documents; each class has half of the weight.

    ``class_share`` (the labels' true proportions) weights the calibration.
    """
    keep = [k for k, d in enumerate(docs) if len(d)]
    docs, sizes, labels = [docs[k] for k in keep], [sizes[k] for k in keep], labels[keep]
    if not docs or len(set(labels.tolist())) < 2:
        q = float(class_share[1])
        return LineCrf(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros((N_FEATURES, 2)), np.zeros((2, 2)),
                       (float(_odds(np.array([q]))[0]), 0.0))
    x = np.concatenate(docs)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[0], scale[scale < 1e-9] = 0.0, 1.0
    x = (x - mean) / scale
    lengths = np.array([len(d) for d in docs])
    y = np.repeat(labels, lengths)
    balance = 0.5 / np.array([(labels == c).mean() for c in (0, 1)])
    doc_w = balance[labels] / len(docs)
    row_w = np.repeat(doc_w / lengths, lengths)        # a document counts once, however long
    gold = np.eye(2)[y]
    chains, theta = Chains(lengths), np.zeros(2 * N_FEATURES + 4)
    m = v = np.zeros_like(theta)
    edge_gold = np.diag([(doc_w * (lengths - 1) / lengths)[labels == c].sum() for c in (0, 1)])
    edge_total = edge_gold.sum()
    for t in range(1, steps + 1):
        w, trans = theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2)
        _, node, edge = chains.run(x @ w, trans)
        grad_w = x.T @ ((gold - node) * row_w[:, None]) - ridge * w
        grad_t = edge_gold - edge * edge_total / max(edge.sum(), 1e-12) - ridge * trans
        g = np.concatenate([grad_w.ravel(), grad_t.ravel()])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta + rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    crf = LineCrf(mean, scale, theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2))
    odds = _odds(crf.quality(docs, sizes))
    true_w = (class_share / np.array([(labels == c).sum() for c in (0, 1)]))[labels]
    a, b = 0.0, 1.0
    for _ in range(50):                                # Newton steps of a ridged logistic curve
        p = 1 / (1 + np.exp(-(a + b * odds)))
        g = np.array([(true_w * (labels - p)).sum(), (true_w * (labels - p) * odds).sum() - 1e-3 * (b - 1)])
        s = true_w * p * (1 - p)
        h = np.array([[s.sum() + 1e-6, (s * odds).sum()], [(s * odds).sum(), (s * odds * odds).sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
    crf.curve = (float(a), float(max(b, 1e-3)))
    return crf


def _features(batches):
    for batch in batches:
        found = [line_features(t) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([x.astype(np.float32).tobytes() for x, _ in found], pa.binary()),
             pa.array([s.astype(np.float32).tobytes() for _, s in found], pa.binary())],
            names=["doc_id", "label", "x", "sizes"])


def fit(docs: DataFrame, labels: DataFrame, usable, per_class: int = 1500, label_col: str = "quality",
        id_col: str = "doc_id", text_col: str = "text") -> LineCrf:
    """Train on at most ``per_class`` usable labelled documents a class (whole texts).

    Their line features come to the driver: a bounded amount, about 200 bytes
    a line.  Without labels of both classes the model scores everything with
    the share of good labels (0.5 without any).
    """
    sample, counts = labelled_sample(docs, labels, label_col, per_class, usable, id_col, text_col)
    rows = (sample.select("doc_id", "label", F.col("text").cast("binary"))
            .mapInArrow(_features, "doc_id long, label int, x binary, sizes binary").collect())
    rows.sort(key=lambda r: (r.doc_id, bytes(r.x)))
    n = {r.label: r.n for r in counts.collect()}
    share = np.array([n.get(0, 0), n.get(1, 0)], float)
    share = share / share.sum() if share.sum() else np.array([0.5, 0.5])
    x = [np.frombuffer(r.x, np.float32).reshape(-1, N_FEATURES).astype(float) for r in rows]
    sizes = [np.frombuffer(r.sizes, np.float32).astype(float) for r in rows]
    return train(x, np.array([r.label for r in rows], int), sizes, share)


def _score(crf: LineCrf, lines: bool):
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                some = batch.slice(lo, 512)
                found = [line_features(t) for t in some.column(1).to_pylist()]
                xs, sizes = [x for x, _ in found], [s for _, s in found]
                good = crf.marginals(xs) if lines else None
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(crf.score(crf.quality(xs, sizes)), pa.float64()),
                     pa.array([g.tolist() for g in good] if lines else [None] * len(xs), pa.list_(pa.float64()))],
                    names=["doc_id", "score", "line_good"])

    return run


def score_quality(docs: DataFrame, crf: LineCrf, id_col: str = "doc_id", text_col: str = "text",
                  lines: bool = False) -> DataFrame:
    """(doc_id, score, line_good) for every row; ``line_good`` (marginals of the lines with a word) on request.

    Null, empty and white texts have no line and get the score of quality 0.
    Repeated rows and null ids are scored like any other row; an empty table
    gives no rows; other columns are not read.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary")).mapInArrow(
        _score(crf, lines), "doc_id long, score double, line_good array<double>")


def keep_good(docs: DataFrame, crf: LineCrf, least: float = 0.3, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of at least ``least``, all columns unchanged.  One pass, no shuffle."""
    at, width = docs.columns.index(text_col), len(docs.columns)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                some = batch.slice(lo, 512)
                found = [line_features(t.encode() if t else t) for t in some.column(at).to_pylist()]
                score = crf.score(crf.quality([x for x, _ in found], [s for _, s in found]))
                yield some.filter(pa.array(score >= least)).select(list(range(width)))

    return docs.mapInArrow(run, docs.schema)
