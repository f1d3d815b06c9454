"""Scaling of count series (SCL1-SCL4, CLP1, RSH4).

Series are long ``(key, category, value)`` tables.  Column-wise scaling in
the wide picture is a window partitioned by category; row-wise scaling
(scaling the transpose) is the same window partitioned by the row key, so
no transpose is ever materialised.  The windows run over aggregated series
(days x categories), never over raw records.  Division is ``try_divide``:
a constant series gives NULL rather than an ANSI divide-by-zero error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.schema import CLUSTERS
from blotter.session import materialize


def _std(col: Column, ddof: int) -> Column:
    return F.stddev_samp(col) if ddof == 1 else F.stddev_pop(col)


def zscore(df: DataFrame, value: str, over: str | Sequence[str], ddof: int = 1,
           out: str = "z") -> DataFrame:
    """SCL1: ``(v - mean) / std`` within each group of ``over``.

    ``ddof=1`` is the sample deviation (used by the exploratory profiles),
    ``ddof=0`` the population deviation (used before regression).
    """
    w = Window.partitionBy(*([over] if isinstance(over, str) else over))
    v = F.col(value).cast("double")
    return df.withColumn(out, F.try_divide(v - F.avg(v).over(w), _std(v, ddof).over(w)))


def minmax(df: DataFrame, value: str, over: str | Sequence[str], out: str = "scaled") -> DataFrame:
    """SCL2: ``(v - min) / (max - min)`` within each group of ``over``."""
    w = Window.partitionBy(*([over] if isinstance(over, str) else over))
    v = F.col(value).cast("double")
    return df.withColumn(out, F.try_divide(v - F.min(v).over(w), F.max(v).over(w) - F.min(v).over(w)))


def clip_symmetric(df: DataFrame, value: str, out: str | None = None) -> DataFrame:
    """CLP1: clip to ``[-cap, cap]`` with ``cap = min(max(v), |min(v)|)``.

    The cap is one scalar over the whole table, computed as a scalar
    subquery (a separate tiny aggregate job), not an unpartitioned window.
    """
    bounds = df.agg(F.least(F.max(value), F.abs(F.min(value))).alias("cap"))
    cap = bounds.scalar()
    v = F.col(value)
    return df.withColumn(out or value, F.greatest(F.least(v, cap), -cap))


def row_zscore_clip(long: DataFrame, row: str, value: str, out: str = "z") -> DataFrame:
    """SCL3: z-score each row across its categories (sample std), then clip."""
    return clip_symmetric(zscore(long, value, row, ddof=1, out=out), out)


def _ward(an, a, bn, b, dims: int) -> Column:
    """Growth of the within-cluster sum of squares when two clusters (size, mean vector) merge."""
    apart = sum(((a[j] - b[j]) * (a[j] - b[j]) for j in range(dims)), F.lit(0.0))
    return an * bn / (an + bn) * apart


def _mean(an, a, bn, b) -> Column:
    return F.zip_with(a, b, lambda x, y: (an * x + bn * y) / (an + bn))


def _pairs(c: DataFrame, blocks: int, dims: int) -> DataFrame:
    """Every pair of clusters once, as (a_*, b_*, d), by an equi-join on pairs of hash blocks."""
    block, each = F.pmod(F.xxhash64("id"), F.lit(blocks)), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = c.select(*[F.col(x).alias(f"a_{x}") for x in c.columns], block.alias("_i"), each.alias("_j"))
    right = c.select(*[F.col(x).alias(f"b_{x}") for x in c.columns], each.alias("_i"), block.alias("_j"))
    d = _ward(F.col("a_n"), F.col("a_c"), F.col("b_n"), F.col("b_c"), dims)
    return left.join(right, ["_i", "_j"]).filter("a_id < b_id").drop("_i", "_j").withColumn("d", d)


def _merge_round(c: DataFrame, live: int, k: int, dims: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Merge clusters that are each other's nearest: (clusters, merges).

    Of the pairs found, the ``k - 1`` farthest wait: each of the others then
    has ``k - 1`` merges above it still to come, so it lies below the cut into
    ``k`` clusters, whatever the order of merging.
    """
    blocks = max(1, -(-live // block_rows))
    ends = lambda df, *more: df.select(F.explode(F.array("a_id", "b_id")).alias("id"), *more)
    nearest = ends(_pairs(c, blocks, dims), "d").groupBy("id").agg(F.min("d").alias("m"))
    both = _pairs(c.join(nearest, "id"), blocks, dims).filter("d = a_m and d = b_m")
    key = F.struct("d", "a_id", "b_id")
    # equal distances: a pair merges if it is the first at both of its ends
    first = ends(both, key.alias("_k")).groupBy("id").agg(F.min("_k").alias("_k"))
    for end in ("a", "b"):
        mine = first.select(F.col("id").alias(f"{end}_id"), F.col("_k").alias("_first"))
        both = both.join(mine, f"{end}_id").filter(key == F.col("_first")).drop("_first")
    both = materialize(both)
    if both.count() > k - 1:
        wait = both.orderBy(F.desc("d"), F.desc("a_id"), F.desc("b_id")).limit(k - 1).select("a_id")
        merges = both.join(wait, "a_id", "left_anti")
    else:
        merges = both.orderBy("d", "a_id", "b_id").limit(1)
    n = F.col("a_n") + F.col("b_n")
    made = merges.select(F.col("a_id").alias("id"), n.alias("n"), _mean(F.col("a_n"), F.col("a_c"), F.col("b_n"), F.col("b_c")).alias("c"))
    gone = merges.select(F.col("a_id").alias("to"), F.col("b_id").alias("id"))
    return materialize(c.join(ends(merges), "id", "left_anti").unionByName(made)), gone


def _merge_rest(c: DataFrame, k: int, dims: int) -> DataFrame:
    """Greedy merging of few clusters down to ``k`` within one row: (id, to)."""
    # clusters of one array; ``ids`` are those merged into it, smallest first
    every = c.agg(F.sort_array(F.collect_list(F.struct("id", "n", "c", F.array("id").alias("ids")))).alias("live"))

    def best(live):
        return F.array_min(F.flatten(F.transform(live, lambda x: F.transform(
            F.filter(live, lambda y: y["id"] > x["id"]), lambda y: F.struct(
                _ward(x["n"], x["c"], y["n"], y["c"], dims).alias("d"), x["id"].alias("a"), y["id"].alias("b"))))))

    def merged(x, y):
        return F.struct(x["id"].alias("id"), (x["n"] + y["n"]).alias("n"), _mean(x["n"], x["c"], y["n"], y["c"]).alias("c"),
                        F.concat(x["ids"], y["ids"]).alias("ids"))

    def step(live, _):
        def apply(p):
            rest = F.filter(live, lambda x: (x["id"] != p["a"]) & (x["id"] != p["b"]))
            pick = lambda i: F.get(F.filter(live, lambda x: x["id"] == i), F.lit(0))
            return F.array_append(rest, merged(pick(p["a"]), pick(p["b"])))
        return F.get(F.transform(F.array(best(live)), apply), F.lit(0))       # one-element array: computed once

    size = F.size("live")
    steps = F.when(size > k, F.sequence(F.lit(1), size - k)).otherwise(F.array().cast("array<int>"))
    done = every.select(F.explode(F.aggregate(steps, F.col("live"), step)).alias("x"))
    return done.select(F.explode("x.ids").alias("id"), F.col("x.id").alias("to"))


def ward_clusters(long: DataFrame, row: str, category: str, value: str, categories: Sequence[str],
                  k: int = CLUSTERS, last: int = 48, block_rows: int = 1024) -> DataFrame:
    """SCL4: Ward agglomeration of the row vectors into ``k`` clusters: ``(row, cluster)``.

    A merge costs n_a n_b / (n_a + n_b) times the squared distance of the
    means, the closed form of the Lance-Williams update.  Rounds merge all
    pairs that are each other's nearest, the distances of a round by an
    equi-join on pairs of blocks of ``block_rows`` rows and map-side minima (no
    distance table is kept); since Ward's cost is reducible these are merges
    of the greedy order as well.  The ``last`` clusters are merged greedily in
    one row.  Equal costs: the pair with the smallest rows first; a cluster is
    named by its smallest row, and clusters are numbered in that order.  A
    missing value counts as 0, a null row key takes no part; with at most
    ``k`` rows each is a cluster.
    """
    dims, limit = len(categories), max(last, k)
    wide = long.filter(F.col(row).isNotNull()).groupBy(row).pivot(category, list(categories)).agg(F.first(value))
    vector = F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in categories])
    c = materialize(wide.select(F.col(row).alias("id"), F.lit(1.0).alias("n"), vector.alias("c")))
    members, live = c.select(F.col("id").alias("_row"), "id"), c.count()
    while live > limit:
        c, gone = _merge_round(c, live, k, dims, block_rows)
        members = members.join(gone, "id", "left").select("_row", F.coalesce("to", "id").alias("id"))
        live = c.count()
    members = members.join(_merge_rest(c, k, dims), "id").select("_row", F.col("to").alias("id"))
    names = members.select("id").distinct().withColumn("cluster", F.row_number().over(Window.orderBy("id")) - 1)   # k rows
    return members.join(names, "id").select(F.col("_row").alias(row), F.col("cluster").cast("int").alias("cluster"))


def cluster_rows(long: DataFrame, row: str, category: str, value: str, categories: Sequence[str],
                 k: int = CLUSTERS, **options) -> DataFrame:
    """SCL4 + SRT1: the rows of :func:`ward_clusters` ordered by cluster, then row."""
    return ward_clusters(long, row, category, value, categories, k, **options).orderBy("cluster", row)
