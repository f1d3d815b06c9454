"""Substring dedup with repeated-phrase automata.

Every window of ``window`` consecutive words belongs to its anchor, the
smallest ``gram``-word hash in it (the rightmost of equal ones), so equal
windows always have equal anchors.  The windows of one anchor occurrence are
consecutive; their words are its context.

1. One pass finds the anchors.  Rows meet by anchor hash, sorted by context.
   Equal contexts settle each other, so long copies cost one narrow row per
   anchor and no text; repeats within an Arrow batch never leave it.
2. Only contexts that share an anchor but differ (the edges of passages) are
   fetched as text, dealt by anchor into shards.  A shard confirms the
   windows that recur, compiles them into Aho-Corasick automata and streams
   its contexts through them, which locates every occurrence exactly.
   An anchor with more than ``block`` different contexts is handled in blocks,
   whose windows meet afterwards by digest.
3. The located spans are cut out of the documents.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import Scratch, mix64

_BASE = 0x9E3779B97F4A7C15 | 1
_POS_BITS = np.uint64(26)
SETTLED, OPEN, PARTNER = 0, 1, 2


class _Powers:
    """Powers of the polynomial base and of its inverse, modulo 2**64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            steps = np.full((2, size), _BASE, np.uint64)
            steps[1] = pow(_BASE, -1, 1 << 64)
            steps[:, 0] = 1
            self.up, self.down = steps.cumprod(axis=1, dtype=np.uint64)
        return self.up[:n], self.down[:n]


def _sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    have = 1
    m = a
    while have * 2 <= width:
        m = np.minimum(m[:len(m) - have], m[have:])
        have *= 2
    rest = width - have
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


def contexts(words: list[bytes], window: int, gram: int, powers: _Powers):
    """Arrays (anchor hash, context hash, first window start, windows), one entry per anchor occurrence."""
    n = len(words)
    x = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    up, down = powers.get(n + 1)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * up[:n], dtype=np.uint64)])

    def span(lo, hi):
        return mix64((prefix[hi] - prefix[lo]) * down[lo])

    at = np.arange(n - gram + 1)
    g = span(at, at + gram)
    far = np.uint64((1 << int(_POS_BITS)) - 1)
    order = ((g >> _POS_BITS) << _POS_BITS) | (far - (at.astype(np.uint64) & far))
    least = _sliding_min(order, window - gram + 1)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    count = np.diff(np.append(first, len(least)))
    back = (far - (least[first] & far)).astype(np.int64)
    anchor = first + ((back - first) & int(far))          # its position, from the low bits
    ctx = span(first, first + count + window - 1) + mix64(
        (anchor - first).astype(np.uint64) * np.uint64(1 << 32) + count.astype(np.uint64))
    return g[anchor], ctx, first, count


def _anchors(window: int, gram: int):
    def run(batches):
        powers = _Powers()
        for batch in batches:
            ids, locs, texts = (c.to_pylist() for c in batch.columns)
            parts, owner = [], []
            for k, text in enumerate(texts):
                words = text.split() if text else []
                if len(words) >= window:
                    parts.append(contexts(words, window, gram, powers))
                    owner.append(np.full(len(parts[-1][0]), k))
            if not parts:
                continue
            key, ctx, start, count = (np.concatenate([p[i] for p in parts]) for i in range(4))
            own = np.concatenate(owner)
            order = np.lexsort((ctx, key))
            k, c = key[order], ctx[order]
            again = np.concatenate([[False], (k[1:] == k[:-1]) & (c[1:] == c[:-1])])
            # 1: stands for others of this batch; 2: settled here, needs no meeting
            flag = np.where(again, 2, np.append(again[1:], False)).astype(np.int8)
            own, start, count = own[order], start[order], count[order]
            k[again] = mix64(k[again] + np.flatnonzero(again).astype(np.uint64))
            for lo in range(0, len(k), 50_000):
                s = slice(lo, lo + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k[s].view(np.int64)), pa.array(c[s].view(np.int64)),
                     pa.array([ids[i] for i in own[s]], pa.int64()), pa.array([locs[i] for i in own[s]], pa.int64()),
                     pa.array(start[s].astype(np.int32)), pa.array(count[s].astype(np.int32)), pa.array(flag[s])],
                    names=["key", "ctx", "doc_id", "loc", "start", "count", "flag"])

    return run


def _settle(batches):
    """Rows sorted by (flag = 2, key, ctx) -> rows that are settled or need a closer look, with their state.

    A row is judged by its neighbours alone, so a group of any size streams
    through; the last row of each batch waits for the next one.
    """
    held, key0, ctx0, seen = None, None, None, None

    def judge(t: pa.Table, final: bool):
        nonlocal key0, ctx0, seen
        key, ctx, flag = (t.column(c).to_numpy() for c in ("key", "ctx", "flag"))
        dup = flag == 2
        n = len(key) if final else len(key) - 1
        if n <= 0:
            return None
        new_key = np.concatenate([[True], (key[1:] != key[:-1]) | (dup[1:] != dup[:-1])])
        if seen is not None and not dup[0] and key0 == key[0]:
            new_key[0] = False
        new_ctx = new_key | np.concatenate([[True], ctx[1:] != ctx[:-1]])
        if not new_key[0] and ctx0 == ctx[0]:
            new_ctx[0] = False
        at = np.maximum.accumulate(np.where(new_key, np.arange(len(key)), -1))
        first_ctx = np.where(at >= 0, ctx[at], seen if seen is not None else 0)
        next_same_key = np.append(~new_key[1:], False)
        ends = np.append(new_ctx[1:], True)               # last row of its context
        several = (first_ctx != ctx) | (next_same_key & ends)
        settled = dup | ~ends | ~new_ctx | (flag == 1)
        state = np.where(dup | ~ends, SETTLED, np.where(settled, np.where(several, PARTNER, SETTLED),
                                                        np.where(several, OPEN, -1)))[:n]
        key0, ctx0 = key[n - 1], ctx[n - 1]
        seen = first_ctx[n - 1] if not dup[n - 1] else None
        keep = np.flatnonzero(state >= 0)
        part = t.slice(0, n).take(pa.array(keep))
        return part.select(["key", "doc_id", "loc", "start", "count"]).append_column(
            "state", pa.array(state[keep].astype(np.int8)))

    for batch in batches:
        t = pa.Table.from_batches([batch])
        if held is not None:
            t = pa.concat_tables([held, t])
        if t.num_rows:
            out = judge(t, False)
            held = t.slice(t.num_rows - 1)
            if out is not None:
                yield from out.combine_chunks().to_batches()
    if held is not None:
        out = judge(held, True)
        if out is not None:
            yield from out.combine_chunks().to_batches()


def _snippets(window: int):
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                rows = []
                for i, loc, text, marks in zip(*(c.to_pylist() for c in batch.slice(lo, 64).columns)):
                    words = text.split()
                    rows += [(m["key"], i, loc, m["start"], m["state"],
                              b" ".join(words[m["start"]:m["start"] + m["count"] + window - 1])) for m in marks]
                cols = list(zip(*rows)) if rows else [()] * 6
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int8(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 names=["key", "doc_id", "loc", "start", "state", "words"])

    return run


def _locate(window: int, chunk: int, block: int):
    """Contexts sorted by anchor -> spans located by an automaton for each chunk of anchors.

    Rows (doc_id, loc, start, count, digest, times): a located run of windows
    has no digest; blocks of one anchor report each of their windows with its
    digest and the times it was seen, for the meeting of blocks.
    """
    def flush(rows: list, split: bool):
        ids: dict[bytes, int] = {}
        seqs = [tuple(ids.setdefault(w, len(ids)) for w in r[5].split(b" ")) for r in rows]
        seen: Counter = Counter()
        for s in seqs:
            seen.update(s[o:o + window] for o in range(len(s) - window + 1))
        recurring = [p for p, times in seen.items() if times > 1]
        if recurring:
            auto = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
            for k, p in enumerate(recurring):
                auto.add_word(p, k)
            auto.make_automaton()
            for r, s in zip(rows, seqs):
                if r[4] == OPEN:
                    for start, count in _runs(end - window + 1 for end, _ in auto.iter(s)):
                        yield r[1], r[2], r[3] + start, count, None, None
        if split:
            for r, s in zip(rows, seqs):
                words = r[5].split(b" ")
                for o in range(len(s) - window + 1):
                    times = seen[s[o:o + window]]
                    if times == 1 or r[4] == PARTNER:
                        digest = hashlib.blake2b(b" ".join(words[o:o + window]), digest_size=16).digest()
                        yield r[1], r[2], r[3] + o, 1 if r[4] == OPEN else 0, digest, times + (r[4] == PARTNER)
            for p in recurring:
                back = {v: w for w, v in ids.items()}
                digest = hashlib.blake2b(b" ".join(back[v] for v in p), digest_size=16).digest()
                yield None, None, 0, 0, digest, 2

    def batch_of(rows):
        cols = list(zip(*rows)) if rows else [()] * 6
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                          names=["doc_id", "loc", "start", "count", "digest", "times"])

    def run(batches: Iterator[pa.RecordBatch]):
        rows, group, key, split = [], 0, None, False      # group: where the current anchor starts in rows
        for batch in batches:
            out = []
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if r[0] != key:
                    if split or len(rows) >= chunk:
                        out += flush(rows, split)
                        rows = []
                    key, group, split = r[0], len(rows), False
                elif len(rows) - group >= block:
                    out += flush(rows[:group], False)
                    out += flush(rows[group:], True)
                    rows, group, split = [], 0, True
                rows.append(r)
            yield batch_of(out)
        yield batch_of(list(flush(rows, split)))

    return run


def _runs(starts) -> Iterator[tuple[int, int]]:
    first = last = None
    for s in sorted(starts):
        if last is not None and s <= last + 1:
            last = s
            continue
        if first is not None:
            yield first, last - first + 1
        first = last = s
    if first is not None:
        yield first, last - first + 1


def _cut(window: int, with_text: bool):
    def run(batches):
        for batch in batches:
            n_words, n_removed, shas, kept_texts = [], [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = text.split() if text else []
                kept = words
                if spans:
                    edge = np.zeros(len(words) + 1, np.int32)
                    s = np.array(spans, np.int64)
                    np.add.at(edge, s >> 32, 1)
                    np.add.at(edge, (s >> 32) + (s & 0xFFFFFFFF) + window - 1, -1)
                    covered = np.cumsum(edge[:-1]) > 0
                    kept = [w for w, c in zip(words, covered.tolist()) if not c]
                whole = b" ".join(kept)
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                shas.append(hashlib.sha256(whole).hexdigest())
                kept_texts.append(whole.decode("utf-8", "replace") if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(shas), pa.array(kept_texts, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return run


def remove_repeats(docs: DataFrame, window: int = 35, gram: int = 8, id_col: str = "doc_id",
                   text_col: str = "text", with_text: bool = True, chunk: int = 1000,
                   block: int = 20_000) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256, kept_text (null unless asked for).

    A word goes when a window that covers it also starts at another place of
    any document, its own included.  Null, empty and white texts have no
    words; texts shorter than the window keep all.  Repeated rows count as
    documents, so they remove each other's windows; ids may be null or
    repeated.  An empty table gives no rows; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                         F.xxhash64(text_col).alias("loc"))
    found = (source.select("doc_id", "loc", F.col("text").cast("binary"))
             .mapInArrow(_anchors(window, gram), "key long, ctx long, doc_id long, loc long, "
                                                 "start int, count int, flag byte"))
    marks = scratch.stage(
        found.withColumn("dup", F.col("flag") == 2).repartition("key").sortWithinPartitions("dup", "key", "ctx")
             .drop("dup").mapInArrow(_settle, "key long, doc_id long, loc long, start int, count int, state byte"),
        "marks")
    near = (marks.filter(F.col("state") != SETTLED)
            .groupBy(F.col("doc_id").alias("_id"), F.col("loc").alias("_loc"))
            .agg(F.collect_set(F.struct("key", "start", "count", "state")).alias("marks")))
    texts = (source.join(near, source.doc_id.eqNullSafe(near._id) & (source["loc"] == near._loc))
             .select("doc_id", "loc", F.col("text").cast("binary"), "marks")
             .mapInArrow(_snippets(window), "key long, doc_id long, loc long, start int, state byte, words binary"))
    spans = scratch.stage(
        texts.repartition("key").sortWithinPartitions("key")
             .mapInArrow(_locate(window, chunk, block),
                         "doc_id long, loc long, start int, count int, digest binary, times int"), "spans")
    parted = spans.filter("digest is not null")
    meet = parted.groupBy("digest").agg(F.sum("times").alias("seen")).filter("seen > 1")
    across = parted.filter("count > 0").join(meet, "digest", "left_semi")
    fields = ["doc_id", "loc", "start", "count"]
    every = (marks.filter(F.col("state") != OPEN).select(*fields)
             .union(spans.filter("digest is null").select(*fields)).union(across.select(*fields)))
    gone = (every.groupBy(F.col("doc_id").alias("_id"), F.col("loc").alias("_loc"))
            .agg(F.collect_set(F.expr("shiftleft(cast(start as long), 32) + count")).alias("spans")))
    return (source.join(gone, source.doc_id.eqNullSafe(gone._id) & (source["loc"] == gone._loc), "left")
            .select("doc_id", F.col("text").cast("binary"), "spans")
            .mapInArrow(_cut(window, with_text),
                        "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"))
