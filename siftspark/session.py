"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", name: str = "siftspark", **conf: str) -> SparkSession:
    """A session for one machine; on a cluster, pass your own session to the operators."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SIFTSPARK_DRIVER_MEMORY", "8g"))
    )
    for k, v in ({"spark.sql.shuffle.partitions": "8"} | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the folder that the cluster names. Only a local master gets one where none is set: on a cluster, a folder
    of the driver's machine is out of the executors' reach."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="siftspark-"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and go on from there.

    The files outlive executors, and Spark drops them with the last reference
    when ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    ensure_checkpoint_dir(df.sparkSession)
    find_package(df.sparkSession)
    return df.checkpoint(eager=True)


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package where they share the driver's file system but not its path.

    Elsewhere, install it on the executors or send it with ``--py-files``.
    """
    home = str(Path(__file__).resolve().parents[1])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
