"""Looking at a table: shape, types, first and last rows by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(F.asc(key)).limit(n)


def tail(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(F.desc(key)).limit(n).orderBy(F.asc(key))


def dtypes(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "column string, dtype string")
