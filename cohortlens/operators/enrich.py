"""Preparing a raw unit table: prior-year indicators, weighted rates and table contracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cohortlens.functions.columns import longer, ratio
from cohortlens.operators.attach import attach


def yearly_counts(df: DataFrame, keys: Sequence[str], target: str = "y", year: str = "year") -> DataFrame:
    """``n, positives`` per key and year: one pass over the rows, all rates below come from it."""
    return df.groupBy(*keys, year).agg(
        F.count("*").alias("n"), F.sum(F.col(target).cast("double")).alias("positives")
    )


def yearly_rates(counts: DataFrame, keys: Sequence[str], name: str, year: str = "year") -> DataFrame:
    """Percent of positives per key and year (and the rows behind it), from counts of the same or finer keys."""
    sums = counts.groupBy(*keys, year).agg(F.sum("n").alias("n"), F.sum("positives").alias("positives"))
    return sums.select(*keys, year, "n", (ratio(F.col("positives"), F.col("n")) * 100).alias(name))


def prior_year(rates: DataFrame, keys: Sequence[str], columns: Sequence[str], year: str = "year") -> DataFrame:
    """``lag1_<c>`` of year N is ``c`` of year N-1 and NULL when that year is absent (not ``lag``: years have gaps)."""
    before = rates.select(*keys, (F.col(year) + 1).alias(year), *[F.col(c).alias(f"lag1_{c}") for c in columns])
    return rates.join(before, [*keys, year], "left")


def add_prior_year(
    rows: DataFrame, rates: DataFrame, keys: Sequence[str], name: str, row_key: str = "row_id", year: str = "year"
) -> DataFrame:
    """Rows with last year's rate of their key; keys with many rows are split over many tasks."""
    before = rates.select(*keys, (F.col(year) + 1).alias(year), F.col(name).alias(f"lag1_{name}"))
    return attach(rows, before, [*keys, year], row_key, sizes=rates.select(*keys, year, F.col("n").alias("_n")))


def grain_breaks(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def match_coverage(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.avg(F.col(column).isNotNull().cast("double")).alias("coverage"))


def missingness_breaks(df: DataFrame, limits: dict[str, float]) -> DataFrame:
    """``column, pct_missing, allowed, ok`` for a contract of allowed percentages."""
    one = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in limits])
    rows = longer(one, [(c, {"pct_missing": F.col(c), "allowed": F.lit(float(v))}) for c, v in limits.items()])
    return rows.withColumn("ok", F.col("pct_missing") <= F.col("allowed"))


def weighted_rate(df: DataFrame, key: str, target: str = "y", weight: str = "weight") -> DataFrame:
    y, w = F.col(target).cast("double"), F.col(weight).cast("double")
    out = df.groupBy(key).agg(F.sum(w).alias("total_weight"), F.sum(w * y).alias("weighted_positives"))
    return out.withColumn("weighted_rate", ratio(F.col("weighted_positives"), F.col("total_weight")))


def drop_invalid(df: DataFrame, column: str, invalid: Sequence[str]) -> DataFrame:
    return df.where(F.col(column).isNull() | ~F.col(column).isin(*invalid))
