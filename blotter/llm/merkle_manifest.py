"""Merkle manifest of a table, climbed by a recursive query.

Every row is a leaf (a digest of its fields); the leaves of each group (here:
language) are hashed pairwise up to a subroot, and the subroots up to one
root.  :func:`build_manifest` orders the leaves by range partitions, hashes
the levels in tiles of 1,024 positions and stores every inner node as a row
that names its parent.  :func:`check_leaves` climbs from every leaf to the
root with ``WITH RECURSIVE``: each step joins the node above, appends the
sibling and folds the presented digest.

No task gets more than a tile of leaves or, while climbing, the rows of one
node for a block of 2^14 leaves: a node is listed once for every block
beneath it, so the rows that meet the root are spread like all others.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import Scratch

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_TILE, _BLOCK = 10, 14                       # bits: positions hashed by one row, leaves that share a copy of a node
_TOP = 64                                    # the tree over the subroots numbers its levels from here
_ROWS_LIMIT = "spark.sql.cteRecursionRowLimit"

_PLACE = ["tree", "size", "start", "pos", "first", "last"]
_LEVELS = ", ".join(f"{c} long" for c in _PLACE) + ", digest binary, id long, link long, left binary, right binary"

_CLIMB = """
WITH RECURSIVE climb AS (
  SELECT no, link, presented AS digest, CAST(NULL AS BINARY) AS sibling, 0 AS step FROM {leaves}
  UNION ALL
  SELECT c.no, n.link,
         unhex(sha2(CAST(CASE WHEN c.link % 2 = 1 THEN concat(lower(hex(n.left)), lower(hex(c.digest)))
                              WHEN n.right IS NULL THEN lower(hex(c.digest))
                              ELSE concat(lower(hex(c.digest)), lower(hex(n.right))) END AS BINARY), 256)),
         IF(c.link % 2 = 1, n.left, n.right), c.step + 1
  FROM climb c JOIN {nodes} n ON n.id = shiftright(c.link, 1) AND n.block = shiftright(c.no, {block}))
SELECT no, step, sibling, CASE WHEN link IS NULL THEN digest END AS top FROM climb
"""


@dataclass
class Manifest:
    """Written tables of a built manifest.

    ``leaves``: no (place among all leaves), id, digest, presented, link
    (parent node and side), tree; ``nodes``: id, block, link, left, right,
    bucketed by (id, block); ``trees``: tree, subroot; ``root``: one row, none
    for an empty table.
    """

    scratch: Scratch
    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    root: DataFrame


def field_digest(values: Sequence[Column]) -> Column:
    """Binary sha256 of the values: ``-`` if null, else UTF-8 byte count, ``:``, value."""
    parts = []
    for v in values:
        s = v.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def to_hex(digest) -> Column:
    return F.lower(F.hex(digest))


def _ranked(df: DataFrame, keys: Sequence[str], scratch: Scratch, name: str) -> DataFrame:
    """``df`` with ``no``, the place of each row in the order of ``keys`` (nulls first).

    Range partitions, a running number in each, and one narrow row a partition
    for what lies before it; equal keys are dealt out by their row number.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    order = [F.col(k).asc_nulls_first() for k in [*keys, "_tie"]]
    seq = scratch.stage(tied.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie")
                        .withColumn("_seq", F.monotonically_increasing_id()), name)
    sizes = seq.groupBy(F.shiftright("_seq", 33).alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    # one row a partition of the sort: bounded by the number of partitions
    return (seq.withColumn("_part", F.shiftright("_seq", 33)).join(F.broadcast(before), "_part")
            .withColumn("no", F.col("_before") + F.col("_seq").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_part", "_before", "_seq"))


def _height(size: int) -> int:
    return (size - 1).bit_length()


def _node_id(base: int, tree: int, start: int, height: int, level: int, pos: int) -> int:
    """Number of a node from its first leaf and level; a subroot is a leaf of the tree over the subroots."""
    if base == 0 and level == height:
        return (tree << 7) | _TOP
    return ((start + (pos << level)) << 7) | (base + level)


def _link(base: int, tree: int, start: int, height: int, level: int, pos: int, trees: int) -> int | None:
    """Twice the parent's number, plus 1 for a right child; None for the root."""
    if base == 0 and level == height:
        base, start, height, level, pos = _TOP, 0, _height(trees), 0, tree
    if base and level == height:
        return None
    return (_node_id(base, tree, start, height, level + 1, pos >> 1) << 1) | (pos & 1)


def _hash_tiles(base: int, level: int, trees: int):
    """(tree, size, start, tile, sorted rows of it) -> its nodes, and the digests that go on to the next tile."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for tree, size, start, tile, items in zip(*(c.to_pylist() for c in batch.columns)):
                height, pos, at = _height(size), tile << _TILE, level
                row = [(x["first"], x["last"], x["digest"]) for x in items]
                while at < min(height, level + _TILE):
                    above, pos, at = [], pos >> 1, at + 1
                    for k in range(0, len(row), 2):
                        pair, here = row[k:k + 2], pos + k // 2
                        left, right = pair[0][2], pair[1][2] if len(pair) > 1 else None
                        out.append((tree, size, start, here, pair[0][0], pair[-1][1], None,
                                    _node_id(base, tree, start, height, at, here),
                                    _link(base, tree, start, height, at, here, trees), left, right))
                        text = left.hex() + (right.hex() if right else "")
                        above.append((pair[0][0], pair[-1][1], hashlib.sha256(text.encode()).digest()))
                    row = above
                out += [(tree, size, start, pos + k, *x, None, None, None, None) for k, x in enumerate(row)]
            cols = list(zip(*out)) if out else [()] * 11
            kinds = [pa.int64()] * 6 + [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             names=[x.split()[0] for x in _LEVELS.split(", ")])

    return run


def _levels(rows: DataFrame, base: int, trees: int, longest: int, scratch: Scratch, name: str):
    """Nodes of all levels above ``rows``, and the digest on top of each tree."""
    nodes, tops, level = [], [], 0
    while True:
        tiles = (rows.groupBy("tree", "size", "start", F.shiftright("pos", _TILE).alias("tile"))
                 .agg(F.sort_array(F.collect_list(F.struct("pos", "first", "last", "digest"))).alias("items")))
        made = scratch.stage(tiles.mapInArrow(_hash_tiles(base, level, trees), _LEVELS), f"{name}-{level}")
        nodes.append(made.filter("id is not null").select("id", "link", "first", "last", "left", "right"))
        above, level = made.filter("id is null").select(*_PLACE, "digest"), level + _TILE
        tops.append(above.filter(F.col("size") <= 1 << level))
        if longest <= 1 << level:
            return nodes, reduce(DataFrame.union, tops)
        rows = above.filter(F.col("size") > 1 << level)


def build_manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, tree_col: str = "lang", id_col: str = "doc_id",
                   presented: Mapping[str, Column] | None = None) -> Manifest:
    """Hash the rows of ``docs`` into one tree a value of ``tree_col`` and a tree over those.

    Leaves ascend by ``id_col`` within a tree (nulls first; rows of one id by
    digest, so repeated rows change no result), trees by ``tree_col`` (null
    first, bytewise).  A null field has its own mark, so it differs from an
    empty text.  ``presented`` replaces columns by what is later shown for
    verification; by default the rows themselves.  Texts are hashed where they
    are read and go no further, however long.  An empty table has no root.
    Other columns are not read.
    """
    spark = docs.sparkSession
    scratch, shown = Scratch(spark, "merkle"), dict(presented or {})
    found = scratch.stage(docs.select(
        F.col(id_col).alias("id"), F.col(tree_col).cast("string").alias("group"),
        field_digest([F.col(f) for f in fields]).alias("digest"),
        field_digest([shown.get(f, F.col(f)) for f in fields]).alias("presented")), "found")
    placed = _ranked(found, ["group", "id", "digest"], scratch, "sorted")
    groups = placed.groupBy("group").agg(F.min("no").alias("start"), F.count("*").alias("size"))
    groups = scratch.stage(groups, "groups")
    groups = scratch.stage(_ranked(groups, ["start"], scratch, "groups-sorted").withColumnRenamed("no", "tree"), "trees")
    trees, longest = groups.agg(F.count("*"), F.coalesce(F.max("size"), F.lit(1))).first()
    pos = F.col("no") - F.col("start")
    parent = (F.when(F.col("size") == 1, F.lit(None) if trees < 2 else _top_link(F.col("tree")))
              .when(F.col("size") == 2, (F.col("tree") * 128 + _TOP) * 2 + pos % 2)
              .otherwise(((F.col("no") - pos % 2) * 128 + 1) * 2 + pos % 2))
    leaves = scratch.stage(
        placed.join(groups.withColumnRenamed("group", "_group"), F.col("group").eqNullSafe(F.col("_group")))
              .select("no", "id", "digest", "presented", "tree", "size", "start", pos.alias("pos"),
                      parent.cast("long").alias("link")), "leaves")
    rows = leaves.select("tree", "size", "start", "pos", F.col("no").alias("first"), F.col("no").alias("last"), "digest")
    low, subroots = _levels(rows, 0, trees, longest, scratch, "low")
    subroots = scratch.stage(subroots, "subroots")
    one = subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(trees).cast("long").alias("size"),
                          F.lit(0).cast("long").alias("start"), F.col("tree").alias("pos"), "first", "last", "digest")
    high, root = _levels(one, _TOP, trees, trees, scratch, "high")
    nodes = reduce(DataFrame.union, [*low, *high]).select(
        "id", F.explode(F.sequence(F.shiftright("first", _BLOCK), F.shiftright("last", _BLOCK))).alias("block"),
        "link", "left", "right")
    # bucketed once, so that no step of the climb shuffles the nodes again
    name, buckets = f"merkle_nodes_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    (nodes.repartition(buckets, "id", "block").write.bucketBy(buckets, "id", "block")
     .option("path", f"{scratch.path}/nodes").saveAsTable(name))
    return Manifest(scratch, leaves, spark.table(name), subroots.select("tree", F.col("digest").alias("subroot")),
                    root.select(F.col("digest").alias("root")))


def _top_link(tree: Column) -> Column:
    return ((tree - tree % 2) * 128 + _TOP + 1) * 2 + tree % 2


def check_leaves(manifest: Manifest) -> DataFrame:
    """One row per leaf: no, id, tree, leaf, subroot, root, siblings, folded_root, verified.

    ``siblings`` are those met on the way up, lowest first; ``folded_root`` is
    what the presented digest folds to with them, and ``verified`` whether
    that is the root.  Digests are lower-case hex text.
    """
    spark, scratch = manifest.scratch.spark, manifest.scratch
    limit = spark.conf.get(_ROWS_LIMIT, None)
    spark.conf.set(_ROWS_LIMIT, "-1")         # rows = leaves x depth, by design more than the default million
    try:
        steps = spark.sql(_CLIMB, leaves=manifest.leaves, nodes=manifest.nodes, block=_BLOCK)
        climbed = scratch.stage(
            steps.repartition("no").groupBy("no").agg(
                F.sort_array(F.collect_list(F.when(F.col("sibling").isNotNull(), F.struct("step", "sibling")))).alias("s"),
                F.max("top").alias("top"))
            .select("no", F.transform("s", lambda x: to_hex(x["sibling"])).alias("siblings"),
                    to_hex("top").alias("folded_root")), "climbed")
    finally:
        spark.conf.unset(_ROWS_LIMIT) if limit is None else spark.conf.set(_ROWS_LIMIT, limit)
    return (manifest.leaves.select("no", "id", "tree", to_hex("digest").alias("leaf")).join(climbed, "no")
            .join(manifest.trees.select("tree", to_hex("subroot").alias("subroot")), "tree")
            .withColumn("root", manifest.root.select(to_hex("root")).scalar())
            .select("no", "id", "tree", "leaf", "subroot", "root", "siblings", "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified")))
