"""Session settings every job relies on, and the shared folder for intermediate tables."""
from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "*", app: str = "panelwise", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster the submitter owns these settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_FOLDERS: set[str] = set()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's checkpoint folder, unique to this call. It is deleted when the driver ends.

    The folder comes from ``spark.checkpoint.dir`` or, where that is unset, lies in the warehouse, which is shared too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{root.rstrip('/')}/panelwise/{spark.sparkContext.applicationId}"
    if folder not in _FOLDERS:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _FOLDERS.add(folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def write_and_read(df, name: str):
    """Store ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
