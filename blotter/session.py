"""Session helpers: a tuned local session for tests/bench, and lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "blotter") -> SparkSession:
    """Session for tests and the local benchmark (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder of this session.

    A cluster names it in ``spark.checkpoint.dir``; that setting is used as
    is.  Only a local session without one gets a private folder (tests and
    the local benchmark); a cluster session without one gets ``None``.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="blotter-ckpt-"))
        return sc.getCheckpointDir()
    return None


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small intermediate that several jobs reuse.

    Writes a reliable checkpoint to the session's shared checkpoint folder,
    so a lost executor does not force a recomputation from the raw scans.
    A cluster session has to name that folder (``spark.checkpoint.dir``);
    there is no other behaviour to fall back to.
    """
    if checkpoint_dir(df.sparkSession) is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return df.checkpoint(eager=True)


def recommended_conf(input_bytes: int, executors: int, cores_per_executor: int,
                     target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run, sized from the input volume.

    * scan splits of ~512 MB (JSON/parquet decode is CPU bound; fewer, larger
      splits keep per-task overhead low on a 100 TB scan);
    * the initial shuffle partition count covers the *unaggregated* worst
      case (one ~256 MB partition per 256 MB of input, at least 2 waves of
      all cores); AQE then coalesces the small post-aggregation shuffles
      down to the advisory size and splits skewed partitions;
    * broadcast threshold left at a fixed 64 MB: dimension-sized sides only.
    """
    slots = max(1, executors * cores_per_executor)
    shuffle = max(2 * slots, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.parquet.filterPushdown": "true",
    }
