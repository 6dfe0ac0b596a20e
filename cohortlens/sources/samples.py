"""Samples that are drawn once and then read again."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from cohortlens.operators.splits import class_balanced_sample
from cohortlens.functions.seeded import take_lowest
from cohortlens.sources.tables import Lake, default_year, load


def sample_path(
    folder: str, table: str, year: str | int | None, n: int, seed: int, tag: str = "sample", source: str = "", key: str = "", balance_on: str | None = None
) -> str:
    """A name made from all that decides the rows."""
    origin = hashlib.md5(f"{source}|{key}".encode()).hexdigest()[:10]
    return f"{folder.rstrip('/')}/{tag}_{table}_{origin}_year{year or 'all'}_n{n}_seed{seed}_by_{balance_on or 'none'}.parquet"


def stored_sample(
    spark: SparkSession,
    lake: Lake,
    folder: str,
    table: str | None = None,
    n: int | None = None,
    year: str | int | None = None,
    seed: int = 42,
    balance_on: str | None = "y",
    tag: str = "sample",
) -> DataFrame:
    """A seeded sample of ``n`` rows (all rows without a number) written under a path made from its own definition; the next call reads that path."""
    table = table or lake.modeling
    year = default_year() if year is None else year
    path = sample_path(folder, table, year, n, seed, tag, lake.path(table), lake.row_key, balance_on)
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    rows = load(spark, lake, table, year)
    if n is None:
        sample = rows
    elif balance_on and balance_on in rows.columns:
        sample = class_balanced_sample(rows, n, lake.row_key, balance_on, seed)
    else:
        sample = take_lowest(rows, n, lake.row_key, seed)
    sample.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
