"""N-gram Jaccard self-join over size-banded tiles with hashed bitmap signatures.

A document's set holds its distinct word n-grams as 64-bit hashes in a sorted
array.  Two documents link when 100 * |A & B| >= percent * |A | B|.

* **Candidates.**  Sizes fall into geometric bands.  In a band that sizes
  below ``hi`` may join, a linked pair differs in at most d elements, so of
  d + 1 hash segments at least one holds the same elements in both (pigeonhole,
  no link is lost).  Each band has a few segments more than d + 1, so that
  segments empty in both never use up the guarantee; a document with more
  empty segments than that adds one key for each (empty segment, prefix
  element) pair.  A document meets its own band and the next one above that
  the threshold allows.  A frequent n-gram alone never makes a candidate.
* **Hubs.**  Documents with an equal segment form a group (a tile).  Each is
  first tested against the group's smallest row, by bit counts and then
  exactly, which is linear in the group and settles most groups of true near
  copies.  Groups that still hold several components, one of those with the
  same rows, are tested against their row that stands beside most rows in all
  of them (of a text and its edited copies: the text).
* **Tiles.**  What is still open is joined by that row, as near copies share
  most of their segments and would meet in a tile for each (groups stay apart
  where joining them makes more pairs), and cut into blocks of bounded rows and bytes; in each block pair,
  the bit counts of hashed bitmaps bound the overlap from above:
  |A & B| <= (|A| + |B| - popcount(a ^ b)) / 2.  Of the pairs left, each tile
  first names a spanning forest of its components, which is tested on the sorted
  arrays, and its rows that may link to another component; tiles with the same
  such rows become one.  Those that still may bring their arrays to the tile;
  pairs are tested there unless their components have met, and only links that
  join two components leave it.
* Equal sets have one name, a hash of their elements (checked to be theirs
  alone), so they are represented once and groups of copies are never expanded.

A tile returns fewer links than it has rows, and no pair list of a group is ever written; hubs are salted by the number
of their partners, blocks bound each tile.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import Scratch, few_rows, free_names, mix64
from blotter.llm.components import connected_components

_RATIO = 1.3
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3],
                np.uint64)
_LOW = np.uint64(32)
_FEW = 1 << 20                               # wanted texts that are found without shuffling all texts
_TILE_ELEMENTS = 2 << 20                     # of the sets of a block (16 MB)
_FEW_ROWS = 1 << 18                          # rows that are sent to the sets rather than the sets to them
_WIDE = 1024                                 # rows with a text, set or bitmap that Python gets in a batch


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams (A-Z lower-cased); fewer words: one for all."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(n, len(words))
    count = len(words) - k + 1
    acc = np.full(count, k, np.uint64)
    for i in range(k):
        acc += mix64(h[i:i + count] * _ODD[i % 8] + np.uint64(i))
    return np.unique(mix64(acc))


class Bands:
    """Size bands: boundaries, the number of segments and the allowed empty ones."""

    def __init__(self, percent: int):
        self.p = percent
        # smaller sets link only when equal
        self.lo = [-(-(100 + percent) // (2 * (100 - percent))) if percent < 100 else 1 << 40]
        while self.lo[-1] < 1 << 40:
            self.lo.append(max(self.lo[-1] + 1, int(self.lo[-1] * _RATIO)))
        self.plan = [self._segments(lo, hi) for lo, hi in zip(self.lo, self.lo[1:])]

    def _segments(self, lo: int, hi: int) -> tuple[int, int]:
        """(segments, slack) of a band: the slack covers the empty segments that the smallest set
        which meets the band is likely to have (their mean and two standard deviations, more in
        large bands, where a set beyond the slack would need very many keys)."""
        need, slack = 2 * (hi - 1) * (100 - self.p) // (100 + self.p) + 1, 0
        spread = max(2, need.bit_length() - 6)
        for _ in range(8 if need >= 16 else 0):
            empty = (need + slack) * math.exp(-self.p * lo / 100 / (need + slack))
            slack = int(empty + spread * math.sqrt(empty) + 1)
        return need + slack, slack

    def of(self, n: int) -> Iterator[tuple[int, int, int]]:
        """(band, segments, slack) of each band that a set of n elements meets."""
        for k in range(len(self.lo) - 1):
            if self.lo[k] * self.p > 100 * n:
                return
            if n < self.lo[k + 1]:
                yield k, *self.plan[k]

    def signatures(self, s: np.ndarray) -> np.ndarray:
        out = []
        mixed = None
        for k, m, slack in self.of(len(s)):
            if mixed is None:
                mixed = mix64(s ^ _ODD[0])
            band = mix64(np.array([k + 1], np.uint64) * _ODD[2])
            seg = ((s >> _LOW) * np.uint64(m)) >> _LOW
            at = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
            out.append(mix64(np.add.reduceat(mixed, at) + seg[at] * _ODD[1] + band))
            if m - len(at) > slack:
                empty = np.setdiff1d(np.arange(m, dtype=np.uint64), seg[at])
                prefix = mixed[:len(s) - -(-self.p * len(s) // 100) + 1]
                out.append(mix64((mix64(prefix * _ODD[3])[None, :] + empty[:, None] * _ODD[4] + band).ravel()))
        return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)


def _sets(n: int, percent: int):
    def run(batches):
        bands, uid = Bands(percent), TaskContext.get().partitionId() << 33
        for batch in batches:
            seen: dict[bytes, int] = {}
            low: dict[int, int | None] = {}
            rows = []
            for i, loc, text in zip(*(c.to_pylist() for c in batch.columns)):
                s = shingles(text, n)
                local, key, sigs = uid, None, None
                if len(s):
                    k = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    local = seen.setdefault(k, uid)
                    if local == uid:
                        key, sigs, low[uid] = k, bands.signatures(s).tobytes(), i
                    elif i is not None and (low[local] is None or i < low[local]):
                        low[local] = i
                rows.append((i, loc, uid, local, len(s), key, sigs))
                uid += 1
            cols = list(zip(*rows)) if rows else [()] * 7
            types = [pa.int64()] * 5 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)]
                + [pa.array([low.get(u) for u in cols[2]], pa.int64())],
                names=["doc_id", "loc", "uid", "local_uid", "n_shingles", "key", "sigs", "low_id"])

    return run


def _entries(batches):
    for batch in few_rows(batches, 4096):
        nodes = batch.column(0).to_numpy()
        sigs = [np.frombuffer(b, np.int64) for b in batch.column(1).to_pylist()]
        for lo in range(0, len(sigs), 256):
            part = sigs[lo:lo + 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(part)),
                 pa.array(np.repeat(nodes[lo:lo + 256], [len(x) for x in part]))], names=["sig", "node"])


_STAR = [("sig", pa.int64()), ("hub", pa.int64()), ("node", pa.int64()), ("more", pa.bool_()), ("k", pa.int64()),
         ("h0", pa.int64()), ("h1", pa.int64())]


def _star_rows(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _STAR)], names=[x for x, _ in _STAR])


def _stars(batches):
    """Sorted (sig, node) rows -> (sig, hub, node, more) for every node but the first of its group.

    ``more`` marks groups of three nodes or more; each of them adds one row
    without a node, with its size and two sums that name its set of nodes.
    """
    sig0 = hub0 = node0 = held = None             # the open group, its hub, its last node, its second one until a third comes
    k0, h0 = 0, np.zeros(2, np.uint64)            # its size and sums

    def closed():
        if held is not None:
            return [(sig0, hub0, held, False, None, None, None)]
        return [(sig0, hub0, None, True, k0, *h0.view(np.int64).tolist())] if k0 > 2 else []

    for batch in batches:
        sig, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(sig):
            continue
        fresh = np.r_[sig[0] != sig0 or node[0] != node0, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])]
        sig, node = sig[fresh], node[fresh]       # copies go
        if not len(sig):
            continue
        at = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        here = np.diff(np.r_[at, len(sig)])
        hub, size = node[at], here.copy()
        sums = np.stack([mix64(node.view(np.uint64) ^ x) for x in _ODD[5:7]])
        h = np.add.reduceat(sums, at, axis=1)
        keep = np.ones(len(sig), bool)
        if sig[0] == sig0:
            rows = [(sig0, hub0, held, True, None, None, None)] if held is not None else []
            hub[0] = hub0
            size[0] += k0
            h[:, 0] += h0
            keep[at[1:]] = False
        else:
            rows = closed()
            keep[at] = False
        held = None
        if size[-1] == 2:
            held, keep[-1] = int(node[-1]), False
        if rows:
            yield _star_rows(rows)
        group = np.repeat(np.arange(len(at)), here)[keep]
        big = np.flatnonzero(size[:-1] > 2)
        of = np.r_[group, big]
        if len(of):
            row, whole = np.arange(len(of)) >= len(group), [size, *h.view(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(sig[at][of]), pa.array(hub[of]), pa.array(np.r_[node[keep], hub[big]], mask=row), pa.array(size[of] > 2),
                 *(pa.array(x[of], mask=~row) for x in whole)], names=[x for x, _ in _STAR])
        sig0, hub0, node0, k0, h0 = int(sig[-1]), int(hub[-1]), int(node[-1]), int(size[-1]), h[:, -1].copy()
    if rows := closed():
        yield _star_rows(rows)


def _payload(n: int):
    def run(batches):
        for batch in few_rows(batches):
            sets = [shingles(t, n).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())],
                                             names=["node", "shingles"])

    return run


def _exact(percent: int):
    """Rows sorted by tile with the hub first -> links (u, v) of the hub."""
    def run(batches):
        hub, of = None, None
        for batch in few_rows(batches):
            out = []
            for x, salt, role, node, raw in zip(*(c.to_pylist() for c in batch.columns)):
                s = np.frombuffer(raw, np.uint64)
                if role == 0:
                    hub, of = s, (x, salt)
                elif of == (x, salt) and linked(hub, s, percent):
                    out.append((x, node))
            yield _pairs(out)

    return run


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test on two sorted arrays of distinct elements."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large) or not len(small):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _pairs(rows) -> pa.RecordBatch:
    u, v = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def bitmap(s: np.ndarray) -> np.ndarray:
    """Hashed bitmap of a set: the next power of two above 4 bits an element, as 64-bit words."""
    words = max(1, 1 << (4 * len(s) - 1).bit_length() >> 6)
    out = np.zeros(words * 64, np.uint8)
    out[(s & np.uint64(words * 64 - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").view(np.uint64)


def fold(b: np.ndarray, words: int) -> np.ndarray:
    while len(b) > words:
        b = b[:len(b) // 2] | b[len(b) // 2:]
    return b


def _bitmaps(batches):
    for batch in few_rows(batches):
        sets = [np.frombuffer(b, np.uint64) for b in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([bitmap(s).tobytes() for s in sets], pa.binary())], names=["node", "n", "bits"])


def _likely(i: int, n: np.ndarray, bits: np.ndarray, open_: np.ndarray, percent: int) -> list[int]:
    """Rows after i, of those marked open, that the bit counts do not rule out; the most alike first."""
    at = i + 1 + np.flatnonzero(open_[i + 1:])
    total = n[i] + n[at]
    differ = np.bitwise_count(bits[i] ^ bits[at]).sum(axis=1, dtype=np.int64)
    overlap = np.minimum((total - differ) // 2, np.minimum(n[i], n[at]))
    order = np.argsort(differ, kind="stable")
    return at[order[(100 * overlap >= percent * (total - overlap))[order]]].tolist()


def _stacked(maps: list[np.ndarray]) -> np.ndarray:
    words = min(len(m) for m in maps)
    return np.stack([fold(m, words) for m in maps])


def _by_tile(batches, work, schema: list[tuple]):
    """Rows sorted by their first three columns (sig, i, j): one batch of ``work(key, rows)`` a batch or tile."""
    def out(rows):
        cols = list(zip(*rows)) if rows else [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, schema)], names=[x for x, _ in schema])

    at, tile = None, []
    for batch in few_rows(batches):
        rows = []
        for sig, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if at != (sig, i, j):
                if len(tile) > 1:
                    rows += work(at, tile)
                at, tile = (sig, i, j), []
            tile.append(row)
        yield out(rows)
    if len(tile) > 1:
        yield out(list(work(at, tile)))


_LINK = [("u", pa.int64()), ("v", pa.int64())]
_TILE_ROW = [("sig", pa.int64()), ("i", pa.int64()), ("j", pa.int64()), ("side", pa.int32()), ("node", pa.int64()),
             ("other", pa.int64())]
_TILE_KEY = "sig long, i long, j long, side int, node long, other long"


def _columns(tile: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.array([r[k] for r in tile], np.int64) for k in (0, 1, 2))


def _forest(percent: int):
    """Tiles of (side, node, component, n, bits) -> with an ``other`` node: pairs that the bit counts allow, a spanning
    forest of the components; without: the rows that may link to a row of another component, in a tile named by them."""
    def work(key, tile):
        side, node, comp = _columns(tile)
        n, bits = np.array([r[3] for r in tile], np.int64), _stacked([np.frombuffer(r[4], np.uint64) for r in tile])
        now, may = comp.copy(), np.zeros(len(tile), bool)
        one = key[1] == key[2]
        for i in range(len(tile) - 1):
            js = _likely(i, n, bits, (comp != comp[i]) & (one | (side != side[i])), percent)
            may[js] = True
            may[i] |= bool(js)
            for j in js:
                if now[j] != now[i]:
                    now[now == now[j]] = now[i]
                    yield (*key, None, *sorted((int(node[i]), int(node[j]))))
        rows = np.flatnonzero(may)
        part = np.zeros(len(rows), np.int64) if one else (side[rows] != side.min()).astype(np.int64)
        mixed = mix64(node[rows].view(np.uint64) ^ _ODD[5]) + part.view(np.uint64)
        name, of = (int(mix64(mixed * x).sum().view(np.int64)) for x in _ODD[:2])
        for k, p in zip(rows, part):
            yield name, of, of if one else ~of, int(p), int(node[k]), None

    return lambda batches: _by_tile(batches, work, _TILE_ROW)


def _tiles(percent: int):
    """Tiles of (side, node, component, shingles) -> links that join two components of the tile."""
    def work(key, tile):
        side, node, comp = _columns(tile)
        sets = [np.frombuffer(r[3], np.uint64) for r in tile]
        n, bits = np.array([len(s) for s in sets], np.int64), _stacked([bitmap(s) for s in sets])
        for i in range(len(tile) - 1):
            for j in _likely(i, n, bits, (comp != comp[i]) & ((key[1] == key[2]) | (side != side[i])), percent):
                if comp[j] != comp[i] and linked(sets[i], sets[j], percent):
                    comp[comp == comp[j]] = comp[i]
                    yield tuple(sorted((int(node[i]), int(node[j]))))

    return lambda batches: _by_tile(batches, work, _LINK)


def possible(n: int, a: np.ndarray, m: int, b: np.ndarray, percent: int) -> bool:
    """Whether the bit counts leave room for a link of sets with n and m elements."""
    words = min(len(a), len(b))
    differ = int(np.bitwise_count(fold(a, words) ^ fold(b, words)).sum())
    overlap = min((n + m - differ) // 2, n, m)
    return 100 * overlap >= percent * (n + m - overlap)


def _bounded(percent: int):
    def run(batches):
        for batch in few_rows(batches):
            yield _pairs([(u, v) for u, v, n, a, m, b in zip(*(c.to_pylist() for c in batch.columns))
                          if possible(n, np.frombuffer(a, np.uint64), m, np.frombuffer(b, np.uint64), percent)])

    return run


def _bound(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that the bit counts do not rule out: only they carry whole sets to the exact test."""
    left = bits.select(F.col("node").alias("u"), F.col("n").alias("nu"), F.col("bits").alias("bu"))
    right = bits.select(F.col("node").alias("v"), F.col("n").alias("nv"), F.col("bits").alias("bv"))
    return (pairs.select("u", "v").join(left, "u").join(right, "v").select("u", "v", "nu", "bu", "nv", "bv")
            .mapInArrow(_bounded(percent), "u long, v long"))


def _beside(rows: DataFrame, wide: DataFrame) -> DataFrame:
    """The rows (a written table) with the wide columns of their node; few rows go to the wide ones, which stay in place."""
    return wide.join(F.broadcast(rows) if rows.count() <= _FEW_ROWS else rows, "node")


def _verify(pairs: DataFrame, payload: DataFrame, percent: int, per_hub: int, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (u, v) whose sets link.  Each hub u meets at most about ``per_hub`` partners a task."""
    salts = pairs.groupBy("u").agg(F.ceil(F.count("*") / per_hub).cast("int").alias("salts"))
    partner = (pairs.join(salts, "u").withColumn("salt", F.pmod(F.hash("v"), "salts"))
               .select("u", "salt", F.lit(1).alias("role"), F.col("v").alias("node")))
    hub = salts.select("u", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                       F.lit(0).alias("role"), F.col("u").alias("node"))
    dealt = _beside(scratch.stage(hub.union(partner), name), payload)
    return (dealt.select("u", "salt", "role", "node", "shingles")
            .repartition("u", "salt").sortWithinPartitions("u", "salt", "role", "node")
            .mapInArrow(_exact(percent), "u long, v long"))


def ngram_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                     text_col: str = "text", per_hub: int = 256, block: int = 512,
                     scratch: Scratch | None = None) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    ``component_id`` is the smallest id that links reach, the row's own
    included.  A document with fewer than ``n`` words has its whole word
    sequence as its one element; null, empty and white texts have no element
    and link with nothing (component_id = own id).  Rows with equal sets are
    in one component, repeated rows too.  A null id never becomes a
    component_id, unless its component has no other.  An empty table gives no
    rows; other columns are not read.
    """
    scratch = scratch or Scratch(docs.sparkSession, "ngram-join")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                         F.xxhash64(text_col).alias("loc"))
    sets = scratch.stage(source.select("doc_id", "loc", F.col("text").cast("binary"))
                         .mapInArrow(_sets(n, percent),
                                     "doc_id long, loc long, uid long, local_uid long, n_shingles long, "
                                     "key binary, sigs binary, low_id long"), "sets")
    rows = scratch.stage(sets.select("doc_id", "loc", "local_uid", "n_shingles"), "rows")
    nodes, named = _named(sets, scratch)
    stars = scratch.stage(
        named.filter("length(sigs) > 0").select("node", "sigs")
             .mapInArrow(_entries, "sig long, node long")
             .repartition("sig").sortWithinPartitions("sig", "node")
             .mapInArrow(_stars, "sig long, hub long, node long, more boolean, k long, h0 long, h1 long"), "stars")
    scratch.drop("sets")                     # the signatures are no longer needed
    scratch.release()
    hubs = scratch.stage(stars.filter("node is not null").select(F.col("hub").alias("u"), F.col("node").alias("v")).distinct(),
                         "hubs")
    scratch.release()
    wanted = hubs.select(F.col("u").alias("node")).union(hubs.select("v")).distinct()
    where = scratch.stage(nodes.join(wanted, "node", "left_semi").groupBy("node")
                          .agg(F.max("doc_id").alias("_id"), F.coalesce(F.max_by("loc", "doc_id"), F.max("loc")).alias("_loc")),
                          "where")
    payload = scratch.stage(_once_a_node(source, where, rows).mapInArrow(_payload(n), "node long, shingles binary"), "payload", _WIDE)
    scratch.drop("where")
    scratch.release()
    bits = scratch.stage(payload.mapInArrow(_bitmaps, "node long, n long, bits binary"), "bits", _WIDE)
    near = scratch.stage(_bound(hubs, bits, percent), "near", _WIDE)
    scratch.release()
    links = scratch.stage(_verify(near, payload, percent, per_hub, scratch, "meet-0"), "links-0", _WIDE)
    scratch.release()
    known = scratch.stage(connected_components(links, scratch, "known"), "known")
    scratch.release()
    spokes = scratch.stage(_central(scratch.stage(_open_rows(stars, hubs, known), "open-0")), "spokes")
    scratch.release()
    again = scratch.stage(_bound(_apart(spokes, known), bits, percent), "again", _WIDE)
    links = scratch.stage(links.union(_verify(again, payload, percent, per_hub, scratch, "meet-1")), "links-1", _WIDE)
    scratch.release()
    known = scratch.stage(connected_components(links, scratch, "met"), "met")
    scratch.release()
    open_ = scratch.stage(_several(_in_components(_merged(spokes), known)), "open-1")
    scratch.release()
    first = scratch.stage(_tiled(open_, bits, block).mapInArrow(_forest(percent), _TILE_KEY), "forest", _WIDE)
    scratch.release()
    likely = first.filter("other is not null").select(F.col("node").alias("u"), F.col("other").alias("v")).distinct()
    more = scratch.stage(links.union(_verify(likely, payload, percent, per_hub, scratch, "meet-2")), "links-2", _WIDE)
    scratch.release()
    known = scratch.stage(connected_components(more, scratch, "grown"), "grown")
    scratch.release()
    may = first.filter("other is null").drop("other").distinct()      # components only grow: no other row can be open
    rest = (_in_components(may, known).join(bits, "node").select("sig", "i", "j", "side", "node", "component", "n", "bits")
            .repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j").mapInArrow(_forest(percent), _TILE_KEY))
    rest = scratch.stage(rest.filter("other is null").drop("other").distinct(), "open-2", _WIDE)
    scratch.release()
    last = (_beside(scratch.stage(_in_components(rest, known), "last"), payload)
            .select("sig", "i", "j", "side", "node", "component", "shingles")
            .repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j").mapInArrow(_tiles(percent), "u long, v long"))
    star = known.select(F.col("node").alias("u"), F.col("component").alias("v")).filter("u <> v")
    more = scratch.stage(star.union(last), "links-3", _WIDE)
    comp = connected_components(more, scratch, "all")
    member = nodes.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = member.groupBy("component").agg(F.min("low_id").alias("component_id"))
    by_row = member.join(least, "component").select(F.col("uid").alias("local_uid"), "component_id")
    return (rows.join(by_row, "local_uid", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
                    .alias("component_id")))


def _name(seed: int):
    return F.xxhash64("key", F.lit(seed))


def _named(sets: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(uid, node, low_id, doc_id, loc) of each set of a batch, and the sets with their node: a 64-bit hash of the
    128-bit key, taken anew with another seed should two keys ever share one."""
    seed = 0
    while True:
        named = sets.filter("key is not null").withColumn("node", _name(seed))
        nodes = scratch.stage(named.select("uid", "node", "low_id", "doc_id", "loc", F.xxhash64("key", F.lit(-1)).alias("check")),
                              f"nodes-{seed}")
        if nodes.groupBy("node").agg(F.min("check").alias("a"), F.max("check").alias("b")).filter("a <> b").isEmpty():
            return nodes.drop("check"), named
        scratch.drop(f"nodes-{seed}")
        seed += 1


def _once_a_node(source: DataFrame, where: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, text as bytes), one row a node; only texts of repeated rows (same id and text) are dealt by node."""
    few = where.count() <= _FEW

    def texts(at: DataFrame) -> DataFrame:
        at = F.broadcast(at) if few else at
        return (source.join(at, source.doc_id.eqNullSafe(at._id) & (source["loc"] == at._loc))
                .select("node", F.col("text").cast("binary").alias("text")))

    twice = (rows.filter("n_shingles > 0").groupBy(F.col("doc_id").alias("_d"), F.col("loc").alias("_l"))
             .count().filter("count > 1").drop("count"))
    if twice.isEmpty():
        return texts(where)
    repeated = where._id.eqNullSafe(twice._d) & (where._loc == twice._l)
    return (texts(where.join(twice, repeated, "left_anti"))
            .union(texts(where.join(twice, repeated, "left_semi")).dropDuplicates(["node"])))


def _in_components(rows: DataFrame, known: DataFrame) -> DataFrame:
    return rows.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _open_rows(stars: DataFrame, hubs: DataFrame, known: DataFrame) -> DataFrame:
    """(sig, node) of the groups of three or more nodes that hold several components, one of those with the same nodes."""
    ends = known.select(F.col("node").alias("u"), F.col("component").alias("_cu")), known.select(
        F.col("node").alias("v"), F.col("component").alias("_cv"))
    apart = (hubs.join(ends[0], "u", "left").join(ends[1], "v", "left")
             .filter(F.coalesce("_cu", "u") != F.coalesce("_cv", "v")).select(F.col("u").alias("hub"), F.col("v").alias("node")))
    many = stars.filter("more and node is not null").select("sig", "hub", "node")
    several = many.join(apart, ["hub", "node"], "left_semi").select("sig").distinct()
    groups = (stars.filter("k is not null").join(several, "sig", "left_semi")
              .groupBy("hub", "k", "h0", "h1").agg(F.min("sig").alias("sig")).select("sig", "hub"))
    return (many.join(groups.select("sig"), "sig", "left_semi").select("sig", "node")
            .union(groups.select("sig", F.col("hub").alias("node"))))


def _central(rows: DataFrame) -> DataFrame:
    """(sig, node) -> the same with ``hub``, the group's row that stands beside most rows in all groups, and ``k``, its size."""
    sized = rows.join(rows.groupBy("sig").agg(F.count("*").alias("k")), "sig")
    beside = sized.groupBy("node").agg(F.sum("k").alias("_beside"))
    top = sized.join(beside, "node").groupBy("sig").agg(F.max(F.struct("_beside", "node"))["node"].alias("hub"), F.max("k").alias("k"))
    return rows.join(top, "sig")


def _apart(spokes: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs (u, v) of a hub and a row of another component."""
    pairs = spokes.select(F.col("hub").alias("u"), "node").distinct()
    ends = known.select(F.col("node").alias("u"), F.col("component").alias("_cu"))
    return (_in_components(pairs, known).join(ends, "u", "left").filter(F.coalesce("_cu", "u") != F.col("component"))
            .select("u", F.col("node").alias("v")))


def _merged(spokes: DataFrame) -> DataFrame:
    """(sig, node): the groups of a hub become one, named by it, unless that has more pairs than they have together."""
    groups = spokes.select("sig", "hub", "k").distinct()
    apart = groups.groupBy("hub").agg(F.sum(F.col("k") * F.col("k")).alias("_apart"))
    union = spokes.select("hub", "node").distinct().groupBy("hub").agg(F.count("*").alias("_all"))
    name = F.when(F.col("_all") * F.col("_all") <= F.col("_apart"), F.xxhash64("hub")).otherwise(F.col("sig"))
    names = groups.join(apart.join(union, "hub"), "hub").select("sig", name.alias("_name"))
    return spokes.join(names, "sig").select(F.col("_name").alias("sig"), "node").distinct()


def _several(rows: DataFrame) -> DataFrame:
    """The rows (sig, node, component) of the groups that hold several components."""
    several = rows.groupBy("sig").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b")
    return rows.join(several.select("sig"), "sig", "left_semi")


def _tiled(rows: DataFrame, bits: DataFrame, block: int) -> DataFrame:
    """The rows with their bitmaps, dealt to pairs of blocks of their group and sorted by tile."""
    sized = rows.join(bits.select("node", F.col("n").alias("_n")), "node")
    blocks = sized.groupBy("sig").agg(F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("_n") / _TILE_ELEMENTS))
                                      .cast("int").alias("blocks"))
    dealt = (sized.join(blocks, "sig").withColumn("b", F.pmod(F.hash("node"), "blocks"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("sig", F.least("b", "o").cast("long").alias("i"), F.greatest("b", "o").cast("long").alias("j"),
                     F.col("b").alias("side"), "node", "component").join(bits, "node")
             .select("sig", "i", "j", "side", "node", "component", "n", "bits"))
    return dealt.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")


def keep_one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id is its component's smallest; all columns unchanged, whatever their names.

    Every row of that id stays, so exact dedup runs before; a null id stays
    only if its component has no other id.
    """
    scratch = Scratch(docs.sparkSession, "ngram-join")
    comp = ngram_components(docs, n, percent, id_col, text_col, scratch=scratch)
    kept = free_names(docs, "_keep")[0]
    keep = scratch.stage(comp.filter("doc_id <=> component_id").select(F.col("doc_id").alias(kept)).distinct(), "keep")
    for written in ("rows", "nodes-0", "stars", "hubs", "payload", "bits", "near", "meet-0", "links-0", "known", "open-0",
                    "spokes", "again", "meet-1", "links-1", "met", "open-1", "forest", "meet-2", "links-2", "grown", "open-2",
                    "last", "links-3"):
        scratch.drop(written)
    return docs.join(keep, docs[id_col].cast("long").eqNullSafe(F.col(kept)), "left_semi")
