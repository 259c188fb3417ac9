"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Tables laid out by household meet on (household, date) and the like without another shuffle.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Parts of a union that are laid out alike stay separate tasks; one task for all of them would hold the sorts of all.
    "spark.sql.unionOutputPartitioning": "false",
}


def build(app: str = "loadshift", cores: str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    # Wide plans are built from many small Python calls; call-site capture would dominate their set-up.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false").config("spark.driver.memory", "12g")
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Hash by key into the session's full number of partitions, which are not merged because they are small: hours that fan out, or fits,
    are costly per byte. Windows and sums over these keys or more then need no shuffle, and what came before has its own tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Writes a table that several parts of a plan read, and reads it again: one pass over its inputs, and a lost executor costs no more
    than its own tasks."""
    path = f"{scratch_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below the cluster's shared checkpoint folder. Where none is set, a session inside one process gets a local one;
    a cluster, whose machines would not see each other's files, gets an error."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/loadshift-{uuid.uuid4().hex}"
    if not re.match(r"local(\[[^\]]*\])?$", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
    return tempfile.mkdtemp(prefix="loadshift-")
