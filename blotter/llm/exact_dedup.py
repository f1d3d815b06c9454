"""Exact dedup with Patricia-trie owners.

Texts are equal when they are identical after each run of ``[\\x20\\x09-\\x0D]``
became one space.  The work is two-level, so a group of copies that holds a
third of all rows never meets in one task:

1. Every Arrow batch inserts its full byte strings into a compressed radix
   trie; a terminal node stores the smallest identifier and a count.  Only
   these local owners carry their text onwards.
2. Local owners are dealt by (length, content hash) and arrive sorted by that
   pair.  Each partition inserts them into one trie below a (length, hash)
   prefix.  Beyond ``max_trie_bytes`` the trie spills by subtree: subtrees of
   other prefixes are complete, so their terminals leave as result rows.
3. Narrow rows (no text) pick up the owner through their local owner.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import Scratch, collapse_white, free_names

_NO_ID = (1 << 63) - 1


class Node:
    __slots__ = ("label", "children", "owner", "count", "members")

    def __init__(self, label: bytes):
        self.label = label
        self.children: dict[int, Node] = {}
        self.owner = None                   # smallest (id, row uid) of the text that ends here
        self.count = 0
        self.members: list[int] = []


class PatriciaTrie:
    """A compressed radix trie over whole byte strings."""

    def __init__(self):
        self.root = Node(b"")
        self.held = 0

    def insert(self, key: bytes, owner: tuple, count: int, member: int) -> Node:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                self.held += len(child.label)
                node, at = child, len(key)
                break
            label = child.label
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            k = _common(label, key, at)
            upper = Node(label[:k])         # split the edge where the strings part
            upper.children[label[k]] = child
            child.label = label[k:]
            node.children[key[at]] = upper
            node, at = upper, at + k
        if node.owner is None or owner < node.owner:
            node.owner = owner
        node.count += count
        node.members.append(member)
        return node

    def spill(self, keep: bytes) -> Iterator[Node]:
        """Detach every subtree that a key starting with ``keep`` cannot reach; yield its terminals."""
        node, at = self.root, 0
        while True:
            step = keep[at] if at < len(keep) else None
            for first in [c for c in node.children if at < len(keep) and c != step]:
                yield from _terminals(node.children.pop(first))
            child = node.children.get(step) if step is not None else None
            if child is None:
                break
            if not keep.startswith(child.label, at) and not child.label.startswith(keep[at:]):
                yield from _terminals(node.children.pop(step))
                break
            node, at = child, at + len(child.label)
        self.held = sum(len(n.label) for n in _nodes(self.root))


def _common(label: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of ``label`` and ``key[at:]`` (they differ somewhere)."""
    lo, hi = 0, min(len(label), len(key) - at)
    while lo < hi:                          # binary search over slice comparisons
        mid = (lo + hi + 1) // 2
        if label[:mid] == key[at:at + mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _nodes(node: Node) -> Iterator[Node]:
    stack = [node]
    while stack:
        n = stack.pop()
        yield n
        stack.extend(n.children.values())


def _terminals(node: Node) -> Iterator[Node]:
    return (n for n in _nodes(node) if n.owner is not None)


_LOCAL = ("doc_id long, uid long, local_uid long, text_sha256 string, "
          "length long, hash long, text binary, n long")


def _local_owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    uid = TaskContext.get().partitionId() << 33
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        trie, ends, keys, uids = PatriciaTrie(), [], [], []
        for i, raw in zip(ids, texts):
            key = collapse_white(raw)
            ends.append(trie.insert(key, (_NO_ID if i is None else i, uid), 1, uid))
            keys.append(key)
            uids.append(uid)
            uid += 1
        shas = [hashlib.sha256(k) for k in keys]
        own = [e.owner[1] == u for e, u in zip(ends, uids)]
        yield pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array(uids, pa.int64()),
            pa.array([e.owner[1] for e in ends], pa.int64()),
            pa.array([s.hexdigest() for s in shas], pa.string()),
            pa.array([len(k) for k in keys], pa.int64()),
            pa.array([int.from_bytes(s.digest()[:8], "big", signed=True) for s in shas], pa.int64()),
            pa.array([k if o else None for k, o in zip(keys, own)], pa.binary()),
            pa.array([e.count if o else None for e, o in zip(ends, own)], pa.int64()),
        ], names=["doc_id", "uid", "local_uid", "text_sha256", "length", "hash", "text", "n"])


def _merge(max_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie()

        def rows(nodes) -> pa.RecordBatch:
            out = [(m, n.owner[0], n.owner[1], n.count) for n in nodes for m in n.members]
            cols = list(zip(*out)) if out else [(), (), (), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols],
                names=["local_uid", "keep_id", "keep_uid", "group_size"])

        for batch in batches:
            for i, uid, n, length, digest, text in zip(*(c.to_pylist() for c in batch.columns)):
                prefix = length.to_bytes(8, "big") + digest.to_bytes(8, "big", signed=True)
                if trie.held > max_bytes:
                    yield rows(trie.spill(prefix))
                trie.insert(prefix + text, (_NO_ID if i is None else i, uid), n, uid)
        yield rows(_terminals(trie.root))

    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_trie_bytes: int = 64 << 20, scratch: Scratch | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, and empty texts form a group like any other.
    Of equal texts the row with the smallest id stays (a null id sorts last
    and gives a null keep_id only if the whole group has none); of rows
    repeated under that id exactly one stays.  An empty table gives no rows;
    other columns are not read.  The result reads the written table ``local``
    of ``scratch``.
    """
    scratch = scratch or Scratch(docs.sparkSession, "exact-dedup")
    local = scratch.stage(
        docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary"))
            .mapInArrow(_local_owners, _LOCAL), "local")
    merged = (local.filter("text is not null")
              .select("doc_id", "uid", "n", "length", "hash", "text")
              .repartition("length", "hash").sortWithinPartitions("length", "hash")
              .mapInArrow(_merge(max_trie_bytes),
                          "local_uid long, keep_id long, keep_uid long, group_size long"))
    return (local.select("doc_id", "uid", "local_uid", "text_sha256").join(merged, "local_uid")
            .select("doc_id",
                    F.when(F.col("keep_id") != _NO_ID, F.col("keep_id")).alias("keep_id"),
                    "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"), "text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, all their columns unchanged, whatever their names.

    Of rows repeated under one id and text, null ids included, one stays.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    kept_id, kept_sha, sha, place = free_names(docs, "_kept_id", "_kept_sha", "_sha", "_row")
    kept = scratch.stage(exact_dedup(docs, id_col, text_col, scratch=scratch).filter("kept")
                         .select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_sha)), "kept")
    scratch.drop("local")
    white = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    same = F.col(id_col).cast("long").eqNullSafe(F.col(kept_id)) & (F.col(sha) == F.col(kept_sha))
    first = Window.partitionBy(id_col, sha).orderBy(F.lit(1))
    return (docs.withColumn(sha, F.sha2(white.cast("binary"), 256))
            .join(kept, same, "left_semi")
            .withColumn(place, F.row_number().over(first)).filter(F.col(place) == 1)
            .select(*docs.columns))
