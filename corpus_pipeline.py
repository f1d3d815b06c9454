"""The corpus pipeline: from raw documents to packed training sequences.

Five stages, each on all that the one before kept; its result is written to
the session's shared folder as Parquet and read again as the next one's input,
which also cuts the lineage.  Every stage but the last returns the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import Scratch, table
from blotter.llm.exact_dedup import drop_exact_duplicates
from blotter.llm.labels import fold
from blotter.llm.line_crf import fit, keep_good
from blotter.llm.ngram_join import keep_one_per_component
from blotter.llm.packing import pack
from blotter.llm.sanitise import sanitise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field scores at least 0.3; a fifth of the labels stays unseen."""
    crf = fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return keep_good(docs, crf, least=0.3)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal text (white space collapsed): the smallest doc_id."""
    return drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 of their 5-word shingles: the smallest doc_id."""
    return keep_one_per_component(docs, n=5, percent=80)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents; personal data and the terms that disclose it are generalised or removed."""
    clean = sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of at most 2048 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048)


STAGES = [("quality", quality), ("exact_dedup", exact_duplicates), ("ngram_join", near_duplicates),
          ("sanitise", private_data), ("packing", packing)]

#: Quality scores and token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; a stage's input goes once its result is written."""
    scratch = Scratch(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = scratch.stage(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs
