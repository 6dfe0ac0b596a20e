"""Small column expressions: missing values, safe ratios, correlation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

NULL_KEY = "__NULL__"


def is_number(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def clean_floats(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every float column, so one missing value is left to reason about."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.select(
        *[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns]
    )


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, NULL where ``den`` is 0 (plain division raises under ANSI)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio0(num: Column, den: Column) -> Column:
    return F.coalesce(ratio(num, den), F.lit(0.0))


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson correlation over the complete pairs, NULL where a side is constant.

    The built-in ``corr`` raises DIVIDE_BY_ZERO on a constant column; the outer min/max test also
    covers constants whose deviation comes out as a rounding residue instead of 0.
    """
    x = F.when(b.isNotNull(), a).cast("double")
    y = F.when(a.isNotNull(), b).cast("double")
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return F.when((F.min(x) < F.max(x)) & (F.min(y) < F.max(y)), r)


def group_text(key: str | Column) -> Column:
    """Group key as text with missing keys gathered under one explicit name."""
    return F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(NULL_KEY))


def longer(one_row: DataFrame, entries: list[tuple[str, dict[str, Column]]], name: str = "column") -> DataFrame:
    """Turn a one-row frame of many aggregates into one row per entry."""
    structs = [
        F.struct(F.lit(label).alias(name), *[col.alias(alias) for alias, col in fields.items()])
        for label, fields in entries
    ]
    return one_row.select(F.inline(F.array(*structs)))
