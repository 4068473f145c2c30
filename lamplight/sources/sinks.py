"""Writers: staged overwrite, resumable append, logs and small lists."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamplight.functions import text as T


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def overwrite_staged(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Write df to a folder beside path, then swap it in by renames: df may read path itself, and a failed write leaves path as it was."""
    spark = df.sparkSession
    staged, old = f"{path}.staged-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    writer = df.write.format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(staged)
    fs, target = _fs(spark, path)
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    had = fs.exists(target)
    if had and not fs.rename(target, make(old)):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(make(staged), target):
        if had:
            fs.rename(make(old), target)
        raise OSError(f"cannot move the new {path} in")
    if had:
        fs.delete(make(old), True)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


class AlreadyRunning(RuntimeError):
    """Another run holds the lock."""


@contextmanager
def run_lock(spark: SparkSession, path: str, stale_seconds: float = 86_400) -> Iterator[None]:
    """Let one run at a time through: the lock is a file at path, made by an atomic create and removed at the end.

    A lock older than stale_seconds was left by a run that died, and is taken over. Otherwise AlreadyRunning is raised.
    """
    fs, p = _fs(spark, path)
    if fs.exists(p) and time.time() - fs.getFileStatus(p).getModificationTime() / 1000 > stale_seconds:
        fs.delete(p, False)
    if not fs.createNewFile(p):
        raise AlreadyRunning(path)
    try:
        yield
    finally:
        fs.delete(p, False)


def append_version(df: DataFrame, path: str, version: int) -> bool:
    """Write df as the folder version=N of path, which appears by one rename; False, and nothing written, if it's there."""
    spark = df.sparkSession
    target = f"{path}/version={version}"
    if exists(spark, target):
        return False
    fs, staged = _fs(spark, f"{path}.staged-{uuid.uuid4().hex}")
    df.write.parquet(staged.toString())
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(staged, to):
        fs.delete(staged, True)
        raise OSError(f"cannot move {target} in")
    return True


def append_missing(df: DataFrame, path: str, key: str, fmt: str = "json") -> None:
    """Append the rows whose key isn't in the folder yet, so that a run can be resumed."""
    spark = df.sparkSession
    if exists(spark, path):
        have = spark.read.format(fmt).load(path)
        df = df.join(have.select(key).distinct(), key, "left_anti") if key in have.columns else df
    df.write.mode("append").format(fmt).save(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json_lines(df: DataFrame, path: str, append: bool = False) -> None:
    """One JSON object a line; nulls are left out."""
    df.write.mode("append" if append else "overwrite").json(path)


def write_list(df: DataFrame, column: str, path: str) -> None:
    """The sorted distinct values of a column, one a line."""
    df.select(F.col(column).cast("string").alias("value")).where("value is not null").distinct().orderBy("value").write.mode("overwrite").text(path)


def write_index(df: DataFrame, path: str, buckets: int | None = None, key: str | None = None, table: str | None = None, append: bool = False) -> None:
    """The chunk index as Parquet, replaced or appended to; with a table name it's bucketed and sorted by key, so that later joins on it don't shuffle it."""
    writer = df.write.mode("append" if append else "overwrite")
    if table and buckets and key:
        writer.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    else:
        writer.parquet(path)


def write_texts(df: DataFrame, key: str, text: str, path: str, buckets: int = 64) -> None:
    """Texts by key, the newest a key: a Parquet folder in place of one file each. A key that's there is replaced by a later write.

    Rows go to version folders by write; read_keyed() takes of each key the newest. Null keys are left out.
    """
    spark = df.sparkSession
    version = 1 + max([int(s.getPath().getName().split("=")[1]) for s in _fs(spark, path)[0].listStatus(_fs(spark, path)[1]) if "=" in s.getPath().getName()], default=0) if exists(spark, path) else 1
    append_version(df.select(key, text).where(F.col(key).isNotNull()).dropDuplicates([key]).repartition(min(buckets, 64)), path, version)


def read_keyed(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The newest row of each key that write_texts() wrote."""
    rows = spark.read.parquet(path)
    return rows.groupBy(key).agg(F.max_by(F.struct(*(c for c in rows.columns if c not in (key, "version"))), "version").alias("r")).select(key, "r.*")


def create_if_absent(spark: SparkSession, path: str, schema: str) -> bool:
    """An empty Parquet table of that schema at path, unless there's one; whether it was made."""
    if exists(spark, path):
        return False
    spark.createDataFrame([], schema).write.parquet(path)
    return True


def write_samples(rows: DataFrame, path: str) -> None:
    """Text dumps of a sample, with a manifest: rows(sample_idx, source, text, error) to path/texts and path/manifest.

    The manifest has sample_idx, source, out, chars and error; a row with an error has an empty out and no characters.
    """
    name = F.concat(F.lpad(F.col("sample_idx").cast("string"), 3, "0"), F.lit("__"), T.stem(F.col("source")))
    ok = F.col("error").isNull() & F.col("text").isNotNull()
    named = rows.withColumn("out", F.when(ok, name).otherwise(""))
    named.where("out <> ''").select("out", "text").write.mode("overwrite").parquet(f"{path}/texts")
    named.select("sample_idx", "source", "out", F.when(ok, F.length("text")).otherwise(0).alias("chars"), "error").coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
