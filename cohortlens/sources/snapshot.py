"""Which files make up a table now: replay of its JSON transaction log, or a listing by age."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

LOG = "_delta_log"
FILE_ACTION = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("partitionValues", T.MapType(T.StringType(), T.StringType())),
    ]
)
ACTIONS = T.StructType([T.StructField("add", FILE_ACTION), T.StructField("remove", FILE_ACTION)])


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _version(kind: str):
    # commit and checkpoint files are named by a 20-digit version; other names give no version
    return F.regexp_extract(F.col("_metadata.file_path"), rf"/(\d{{20}})\.{kind}[^/]*(?:/[^/]*)?$", 1).try_cast("long")


def log_actions(spark: SparkSession, path: str) -> DataFrame | None:
    """``version, add, remove`` of every commit after the last checkpoint, and of that checkpoint."""
    log = f"{path.rstrip('/')}/{LOG}"
    commits = checkpoint = None
    try:
        # compacted files repeat what the commits say, under names of two versions
        commits = spark.read.schema(ACTIONS).json(f"{log}/*.json").select(_version("json").alias("version"), "add", "remove")
        commits = commits.where("version is not null")
    except AnalysisException as e:
        if not _missing(e):
            raise
    try:
        whole = spark.read.schema(ACTIONS).parquet(f"{log}/*.checkpoint*.parquet")
        whole = whole.select(_version("checkpoint").alias("version"), "add", "remove")
        last = whole.agg(F.max("version")).first()[0]
        checkpoint = whole.where(F.col("version") == last)
        if commits is not None:
            commits = commits.where(F.col("version") > last)
    except AnalysisException as e:
        if not _missing(e):
            raise
    if commits is None:
        return checkpoint
    return commits if checkpoint is None else checkpoint.unionByName(commits)


def active_paths(
    spark: SparkSession, path: str, year: str | int | None = None, partition: str = "year"
) -> DataFrame | None:
    """``path`` (relative) of the files whose last action is an add; None when there is no log."""
    actions = log_actions(spark, path)
    if actions is None:
        return None
    touched = actions.where("add is not null or remove is not null").select(
        "version",
        F.coalesce("add.path", "remove.path").alias("path"),
        F.col("add").isNotNull().alias("added"),
        F.col("add.partitionValues").alias("values"),
    )
    # within one commit a path that is both removed and added stays
    last = touched.groupBy("path").agg(F.max_by(F.struct("added", "values"), F.struct("version", "added")).alias("s"))
    live = last.where("s.added")
    if year:
        live = live.where(F.try_element_at("s.values", F.lit(partition)) == F.lit(str(year)))
    # paths in the log are percent-encoded; a plus sign stands for itself
    return live.select(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))).alias("path"))


def active_files(
    spark: SparkSession, path: str, year: str | int | None = None, partition: str = "year"
) -> list[str] | None:
    """Full paths of the active files in path order. The list is table metadata, not data."""
    live = active_paths(spark, path, year, partition)
    if live is None:
        return None
    base = path.rstrip("/")
    return [p if "://" in p or p.startswith("/") else f"{base}/{p}" for (p,) in live.orderBy("path").collect()]


def file_listing(spark: SparkSession, path: str, suffix: str = ".parquet") -> DataFrame:
    """``file, modified`` of the data files below ``path``, newest first, equal times by name; no file content is read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
        .load(path)
        .select(F.col("path").alias("file"), F.col("modificationTime").alias("modified"))
    )
    return files.where(~F.col("file").contains(f"/{LOG}/")).orderBy(F.desc("modified"), F.desc("file"))


def recent_files(spark: SparkSession, path: str, year: str | int | None = None, partition: str = "year") -> list[str]:
    where = f"{path.rstrip('/')}/{partition}={year}" if year else path
    try:
        return [r["file"] for r in file_listing(spark, where).select("file").collect()]
    except AnalysisException as e:
        if not _missing(e):
            raise
        return []
