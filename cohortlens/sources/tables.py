"""Reading registered tables: partition and column pruning, snapshots, sampling by policy."""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.functions.columns import clean_floats
from cohortlens.functions.seeded import take_lowest
from cohortlens.operators.profile import column_stats
from cohortlens.sources.snapshot import active_files, recent_files

YEAR_VARIABLE = "COHORTLENS_YEAR"


@dataclass(frozen=True)
class Lake:
    """The tables a job may read. Fact tables are sampled for profiling, context tables are read whole."""

    root: str
    facts: tuple[str, ...] = ("unit_features", "unit_analytic")
    context: tuple[str, ...] = ("group_context", "group_indicator", "state_indicator")
    modeling: str = "unit_analytic"
    partition: str = "year"
    row_key: str = "row_id"
    paths: dict[str, str] = field(default_factory=dict)

    @property
    def tables(self) -> tuple[str, ...]:
        return self.facts + self.context

    def path(self, table: str) -> str:
        if table not in self.tables:
            raise ValueError(f"unknown table '{table}', expected one of {self.tables}")
        return self.paths.get(table, f"{self.root.rstrip('/')}/{table}")


def default_year() -> str | None:
    """The year that the environment names for calls without one; all years otherwise."""
    return os.environ.get(YEAR_VARIABLE, "").strip() or None


def read_partition(
    spark: SparkSession, path: str, year: str | int | None = None, partition: str = "year"
) -> DataFrame:
    """A table partitioned by year. With a year only that partition's files are listed and their footers read."""
    year = default_year() if year is None else year
    if not year:
        return spark.read.option("mergeSchema", "true").parquet(path)
    only = F.col(partition) == F.lit(int(year))
    try:
        return spark.read.option("mergeSchema", "true").option("basePath", path).parquet(f"{path.rstrip('/')}/{partition}={int(year)}").where(only)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.read.parquet(path).where(only)


def list_files(spark: SparkSession, path: str, year: str | int | None = None, partition: str = "year") -> list[str]:
    """Data files of the current snapshot in path order, or, without a log, newest first."""
    files = active_files(spark, path, year, partition)
    return recent_files(spark, path, year, partition) if files is None else files


def load(
    spark: SparkSession,
    lake: Lake,
    table: str | None = None,
    year: str | int | None = None,
    columns: Sequence[str] | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """The current files of a table, joined by column name, with only ``columns`` read."""
    table = table or lake.modeling
    path = lake.path(table)
    year = default_year() if year is None else year
    files = list_files(spark, path, year, lake.partition)
    if not files:
        raise FileNotFoundError(f"no Parquet files for table '{table}', {lake.partition}={year or 'all'} under {path}")
    files = files if max_files is None else files[:max_files]
    reader = spark.read.option("mergeSchema", "true")
    if all(f"{path.rstrip('/')}/" in f for f in files):
        # keeps the partition column although single files are read
        reader = reader.option("basePath", path)
    df = reader.parquet(*files)
    df = df if columns is None else df.select(*columns)
    return clean_floats(df)


def union_by_name(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts; a column that a part lacks is NULL there."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def peek(spark: SparkSession, lake: Lake, table: str, n: int, seed: int = 42, **how) -> DataFrame:
    return take_lowest(load(spark, lake, table, **how), n, lake.row_key, seed)


def load_for_profiling(
    spark: SparkSession,
    lake: Lake,
    table: str,
    n: int | None = None,
    year: str | int | None = None,
    seed: int = 42,
    folder: str | None = None,
) -> DataFrame:
    """Facts as a seeded sample of ``n`` rows (all rows when ``n`` is None), context tables whole.

    With ``folder`` the sample is stored there and read again by the next call.
    """
    if table in lake.context or n is None:
        return load(spark, lake, table, year)
    if folder:
        from cohortlens.sources.samples import stored_sample

        return stored_sample(spark, lake, folder, table, n, year, seed, balance_on=None, tag="eda")
    return peek(spark, lake, table, n, seed, year=year)


def load_tables(
    spark: SparkSession, lake: Lake, n: int | None = None, year: str | int | None = None, folder: str | None = None
) -> dict[str, DataFrame]:
    return {t: load_for_profiling(spark, lake, t, n, year, folder=folder) for t in lake.tables}


def modeling_table(tables: dict[str, DataFrame], lake: Lake) -> DataFrame:
    """The modeling table, or the other fact table, without its all-null columns."""
    name = lake.modeling if lake.modeling in tables else lake.facts[0]
    if name not in tables:
        raise KeyError(f"table '{name}' is not among {sorted(tables)}")
    df = tables[name]
    return df.drop(*[c for c, s in column_stats(df).items() if s.non_null == 0])
