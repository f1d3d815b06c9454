"""Helpers shared by the operators: written intermediate tables and byte-level text rules."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from blotter.session import checkpoint_dir

WHITE = b" \t\n\x0b\x0c\r"
_WHITE_RUN = re.compile(rb"[\x20\x09-\x0D]+")
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's path (same path on each node, or --py-files)."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in known:
        env["PYTHONPATH"] = ":".join([root, *known])


class Scratch:
    """A folder of written intermediate tables in the session's shared checkpoint folder.

    ``stage`` writes a frame as Parquet and reads it back, which cuts the
    lineage: a lost executor costs the tasks it ran, not the scans before.
    ``drop`` removes a table once nothing reads it any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        base = checkpoint_dir(spark)
        if base is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        self.spark = spark
        self.path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def stage(self, df: DataFrame, table: str, rows: int | None = None) -> DataFrame:
        """``rows``: Python gets at most so many rows in a batch, for rows with wide values."""
        name = "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = self.spark.conf.get(name)
        if rows:
            self.spark.conf.set(name, str(rows))
        try:
            df.write.parquet(f"{self.path}/{table}")
        finally:
            if rows:
                self.spark.conf.set(name, before)
        return self.spark.read.parquet(f"{self.path}/{table}")

    def drop(self, table: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        path.getFileSystem(conf).delete(path, True)

    def release(self) -> None:
        """Let Spark's cleaner delete the shuffle files of finished jobs now; it waits for the driver's garbage collection."""
        self.spark._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder, with the session made ready for this package's Python functions."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def few_rows(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, so that wide values become Python objects a few at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores in front until no column of ``df`` has it (case does not count)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def collapse_white(text: bytes | None) -> bytes:
    """Each run of ASCII white space becomes one space (null: empty)."""
    if not text:
        return b""
    core = b" ".join(text.split())          # bytes.split: exactly [\\x20\\x09-\\x0D]
    if not core:
        return b" "
    return (b" " if text[0] in WHITE else b"") + core + (b" " if text[-1] in WHITE else b"")


def mix64(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (bijective), vectorised."""
    h = h ^ (h >> _S33)
    h = h * _M1
    h = h ^ (h >> _S33)
    h = h * _M2
    return h ^ (h >> _S33)
