"""Bounded samples of labelled documents, for the operators that learn."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold(id_col, folds: int):
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int, usable,
                    id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, text, label) of at most ``per_class`` usable labelled rows a class, and the usable label counts.

    The rows with the smallest hash of their id are taken, so the sample does
    not depend on partitioning.  Labels other than 0 and 1, null ids and
    repeated or contradicting labels of one id are left out.
    """
    known = (labels.filter(usable & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
             .groupBy(F.col(id_col).cast("long").alias("doc_id"))
             .agg(F.min(label_col).alias("label"), F.max(label_col).alias("other"))
             .filter("label = other").select("doc_id", F.col("label").cast("int").alias("label")))
    counts = known.groupBy("label").agg(F.count("*").alias("n"))
    pick = reduce(DataFrame.union, [
        known.filter(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)])
    # the sample has at most 2 * per_class narrow rows: bounded, so it may be broadcast
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return text.join(F.broadcast(pick), "doc_id"), counts
