"""Session helpers: tables, checkpoint folder, local sessions for tests and bench."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, memory: str = "12g", app: str = "examloom") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only in local runs (tests), an error where a cluster names none."""
    found = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + os.path.join(tempfile.gettempdir(), "examloom-checkpoints")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_WRITTEN: set[str] = set()


def _delete(spark: SparkSession, folder: str) -> None:
    """Deletes what an application has written, at its end; one that is killed leaves its folder, named by the application's id."""
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001 the context may be gone
        pass


def scratch(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder, named in full. What is written there is kept until the driver ends."""
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    if folder not in _WRITTEN:
        _WRITTEN.add(folder)
        atexit.register(_delete, spark, folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}-{uuid.uuid4().hex}")
    full = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub(r"^file:/+", "file:///", full)


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write df once to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Spreads an input of few splits over the cores, for work that is heavy per row; one of enough splits stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
