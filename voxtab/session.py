"""Session helpers: a local session for tests and lineage cutting that only
ever writes to the cluster's shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench: local mode, AQE on, UI off."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("voxtab")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("VOXTAB_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only a local-mode session
    without one (tests) gets a fresh scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a shared folder: iterative operators "
            "cut lineage there"
        )
    scratch = tempfile.mkdtemp(prefix="voxtab-ckpt-", dir="/tmp")
    sc.setCheckpointDir(scratch)
    return scratch


def cut_lineage(df: DataFrame, part_rows: int | None = None) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives
    executor loss), never a local one. The input is persisted only while the
    checkpoint is written, so it is computed once instead of twice (once for
    the action, once for the file write). A cached plan keeps all shuffle
    partitions, however few rows it has; with ``part_rows`` the checkpoint has
    one file for so many rows, and later stages as many tasks."""
    from pyspark import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        held = df if part_rows is None else df.coalesce(max(1, -(-df.count() // part_rows)))
        return held.checkpoint(eager=True)
    finally:
        df.unpersist()


def bounded_table(df: DataFrame, most: int):
    """``df`` as an Arrow table on the driver, for models whose size is
    bounded by their parameters (pivots, shells): more than ``most`` rows fail
    the job, so what grows with the data cannot come here."""
    table = df.limit(most + 1).toArrow()
    if table.num_rows > most:
        raise RuntimeError(f"more than {most} rows in a table that should be bounded")
    return table
