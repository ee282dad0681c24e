"""Tables between the stages of one job, in the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Paths this driver has written and not deleted.
_written: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the cluster names; where none is named, in a folder of our own in local mode, else an error."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("on a cluster spark.checkpoint.dir must name a folder that all machines share")
        root = "file://" + tempfile.mkdtemp(prefix="halyard-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: the plan begins anew there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch(spark, name)
    _written.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df for work that takes long for each row: dealt to as many tasks as the session runs at once, if it comes in fewer, as from one small file."""
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def delete(spark: SparkSession, path: str) -> None:
    """Delete a path through Hadoop's file system API, whatever store holds it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clear(spark: SparkSession) -> None:
    """Delete the stored tables of this driver, once no result is read any more."""
    while _written:
        delete(spark, _written.pop())
