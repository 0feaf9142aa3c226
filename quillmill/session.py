"""Session settings shared by the bench, the tests and ad-hoc use."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benches; on a cluster the caller's own session is used as it is."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quillmill")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("QUILLMILL_DRIVER_MEMORY", memory))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. A local session without one gets a temporary folder; a cluster without one is an error."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    have = conf or spark.sparkContext.getCheckpointDir()
    if have:
        return have.rstrip("/")
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="quillmill-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its partitions as they are now, in the session's checkpoint folder: later passes see the same rows in the same
    places, also after executors are lost."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()
