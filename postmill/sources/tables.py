"""Reading the given tables and keeping intermediate ones."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table `name` of a data folder; Spark prunes columns and pushes filters to it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders that this process made for intermediate tables, by session.
_MADE: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """A new folder below `spark.checkpoint.dir`, which all executors share.

    Where the setting is absent, a local session (tests on one machine) takes a
    folder of the machine's temporary directory, which then is its checkpoint
    directory; on a cluster that is an error, as the executors would each write
    to a disk of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(base)
    at = os.path.join(base, f"postmill-{uuid.uuid4().hex}")
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(at)
    return at


def remove_stored(spark: SparkSession) -> int:
    """Delete the intermediate tables of this session, once no result that reads them is needed any more; the number of folders."""
    made = _MADE.pop(spark.sparkContext.applicationId, [])
    for at in made:
        removed(spark, at)
    return len(made)


def stored(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """`df` written to `path` and read again: its lineage ends there."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a stored table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def spread(df: DataFrame, least: int = 4) -> DataFrame:
    """`df` over all cores where its input is so small that Spark reads it in fewer than `least` tasks.

    For steps that compute much on few bytes. Inputs of more splits, as any
    large table has, pass unchanged and unshuffled.
    """
    if df.rdd.getNumPartitions() >= least:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def sifted(df: DataFrame, ids: DataFrame, column: str, log_bits: int = 26) -> DataFrame:
    """The rows of `df` whose `column` is in `ids`, and a few of the others: what a join with `ids` has to shuffle.

    A bitmap of hashes is broadcast, sixteen bits an id and 2 ** log_bits (8 MB)
    at most; with more ids than that serves, more of the other rows stay, but
    no row of `ids` is ever lost.
    """
    place = lambda n: F.expr(f"xxhash64(`{column}`) & {n - 1}L")
    words = ids.select(place(1 << log_bits).alias("h")).groupBy(F.shiftright("h", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(h & 63 as int)))").alias("b")).collect()
    w, b = (np.array([r[i] for r in words], np.int64) for i in (0, 1))
    size = 1 << min(log_bits, max(10, (16 * len(words)).bit_length()))
    bits = np.zeros(size // 64, np.int64)
    np.bitwise_or.at(bits, w & (size // 64 - 1), b)
    one = df.sparkSession.createDataFrame([(bits.tolist(),)], "sieve array<long>")
    hit = F.expr("getbit(sieve[cast(shiftright(h, 6) as int)], cast(h & 63 as int)) = 1")
    return df.withColumn("h", place(size)).crossJoin(F.broadcast(one)).where(hit).drop("h", "sieve")


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder at `path`, on whatever file system it names?"""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put the finished folder `new` in the place of `path`: readers see the old tables or the new ones, never a mixture."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    old = f"{path}.old"
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(hadoop(old), True)
    if fs.exists(hadoop(path)):
        fs.rename(hadoop(path), hadoop(old))
    fs.rename(hadoop(new), hadoop(path))
    fs.delete(hadoop(old), True)
