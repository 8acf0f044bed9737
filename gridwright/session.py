"""Session construction and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings of a local test session.  A cluster's own settings always win: they are only
#: applied when this module builds the session itself.
LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A ``local[cores]`` session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("gridwright").config("spark.sql.shuffle.partitions", str(shuffle_partitions)).config("spark.driver.memory", memory)
    for key, value in {**LOCAL_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share.

    It is the session's ``spark.checkpoint.dir``.  Only where that is unset in local mode
    (tests) is a folder of this machine used, and then it is recorded in the session; on a
    cluster other machines couldn't read it, so there the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = spark.conf.get("gridwright.local.dir", None)
        if not folder:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="gridwright-")
            spark.conf.set("gridwright.local.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{os.getpid()}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet into the shared folder and read it back."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """A scan for a costly Python step: dealt out anew if it has fewer partitions than there
    are cores, as a table of one small file has.  A large table has more, and stays as it is."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a test-data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
