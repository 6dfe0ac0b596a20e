"""Session for tests and the bench, and the shared folder for tables a job writes on the way."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession, functions as F


def local_session(cores: str | int = 8, app: str = "cohortlens", **conf: str) -> SparkSession:
    """A local session; on a cluster the caller passes in its own instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores if cores != "*" else os.cpu_count()))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("COHORTLENS_DRIVER_MEMORY", "12g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor can reach.

    All folders of one application lie below one folder, which may be deleted when the application ends.
    Only a local session that names none (tests) gets a temporary one; on a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="cohortlens-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/cohortlens-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def written(df, label: str = "step", partition_by: str | None = None):
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives executor loss."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}"
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


PARTITION_ROWS = 1 << 16  # rows of a training set in one partition


def spread(df, rows: int, key: str | None = None, partition_rows: int = PARTITION_ROWS):
    """Deal the ``rows`` rows to partitions by a hash of ``key`` (all columns without one), in key order within each.

    Fits that draw per partition then depend on the data alone, not on files or cores. The number of partitions grows with the rows.
    """
    by = [key] if key else df.columns
    return df.repartition(max(1, -(-rows // partition_rows)), F.xxhash64(*by)).sortWithinPartitions(F.xxhash64(*by), *([key] if key else []))
