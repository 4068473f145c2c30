"""Sessions, table access and durable intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; on a cluster the submitter brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lamplight").config("spark.driver.memory", memory)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions)).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, a Parquet file or directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which every executor shares.

    Only a local session without the setting gets a folder of its own; on a cluster its absence is an error,
    since a machine-local folder would lose data with the machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="lamplight-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", f"file://{folder}")
    return f"file://{folder}"


#: A join side is broadcast by broadcast_if_small() up to this size.
BROADCAST_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """df marked for broadcast if its estimated size, an upper bound when it comes from written tables, is at most `most` bytes; else df as it is."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= most else df


def materialize(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: lineage ends here, and a lost executor costs no recomputation."""
    path = f"{shared_folder(df.sparkSession)}/lamplight-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
