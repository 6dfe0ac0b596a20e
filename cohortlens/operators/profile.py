"""Profiling of wide tables: missing values, cardinality, correlations, rates, histograms."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.functions.columns import is_number, longer, safe_corr
from cohortlens.operators.gram import pair_correlations
from cohortlens.operators.ordering import exact_quantiles


@dataclass(frozen=True)
class ColumnStats:
    name: str
    rows: int
    non_null: int
    constant: bool


def column_stats(df: DataFrame) -> dict[str, ColumnStats]:
    """One aggregate over all columns; its single row decides which columns exist further on."""
    if not df.columns:
        return {}
    per_column = []
    for c in df.columns:
        same = F.count(c) == 0
        same = same | (F.min(c) == F.max(c))
        per_column.append(
            F.struct(
                F.lit(c).alias("name"),
                F.count("*").alias("rows"),
                F.count(c).alias("non_null"),
                F.coalesce(same, F.lit(True)).alias("constant"),
            )
        )
    row = df.agg(F.array(*per_column).alias("s")).first()["s"]
    return {r["name"]: ColumnStats(**r.asDict()) for r in row}


def _as_text(df: DataFrame, c: str) -> Column:
    dtype = dict(df.dtypes)[c]
    # -0.0 and 0.0 are one value
    return (F.col(c) + F.lit(0.0)).cast("string") if dtype in ("double", "float") else F.col(c).cast("string")


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, n_unique``: exact distinct non-missing values, counted in one shuffle for all columns."""
    columns = list(columns or df.columns)
    long = df.select(*[_as_text(df, c).alias(c) for c in columns]).unpivot([], columns, "column", "value")
    # missing values are kept as one value here, so that a column without any other still has its row
    pairs = long.distinct()
    return pairs.groupBy("column").agg(F.count("value").alias("n_unique"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, n_rows, non_null`` from one aggregate."""
    columns = list(columns or df.columns)
    one = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in columns])
    return longer(one, [(c, {"n_rows": F.col("_rows"), "non_null": F.col(c)}) for c in columns])


def profile(df: DataFrame) -> DataFrame:
    """``column, dtype, non_null, pct_missing, n_unique``, most missing first."""
    types = F.create_map(*[F.lit(x) for c, t in df.dtypes for x in (c, t)])
    share = F.try_divide(F.col("n_rows") - F.col("non_null"), F.col("n_rows").cast("double")) * 100
    return (
        null_counts(df)
        .join(distinct_counts(df), "column")
        .select("column", types[F.col("column")].alias("dtype"), "non_null", F.bround(share, 2).alias("pct_missing"), "n_unique")
        .orderBy(F.desc_nulls_last("pct_missing"), "column")
    )


def overview(tables: dict[str, DataFrame], top: int = 5) -> DataFrame:
    """Per table its rows, columns and most incomplete columns, as one tagged union."""
    out = None
    for name, df in tables.items():
        counts = null_counts(df).select(
            F.lit(name).alias("table"),
            "n_rows",
            F.lit(len(df.columns)).alias("n_columns"),
            "column",
            F.bround(F.try_divide((F.col("n_rows") - F.col("non_null")) * 100.0, F.col("n_rows").cast("double")), 2).alias("pct_missing"),
        )
        counts = counts.orderBy(F.desc_nulls_last("pct_missing"), "column").limit(top)
        out = counts if out is None else out.unionByName(counts)
    return out


def target_balance(df: DataFrame, target: str = "y") -> DataFrame:
    """``class, count, proportion`` with missing as a class, largest first."""
    if target not in df.columns:
        raise KeyError(f"target '{target}' is not a column")
    counts = df.groupBy(F.col(target).alias("class")).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("proportion", F.bround(F.col("count") / total, 4)).orderBy(
        F.desc("count"), F.asc_nulls_last("class")
    )


def number_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if is_number(f)]


def correlations(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """``column, r`` for each column against the target, constants as NULL: one aggregate, no shuffle of rows."""
    one = df.agg(*[safe_corr(F.col(c), F.col(target)).alias(c) for c in columns])
    return longer(one, [(c, {"r": F.col(c)}) for c in columns])


def correlation_with_target(
    df: DataFrame, target: str = "y", columns: Sequence[str] | None = None, top: int = 15
) -> DataFrame:
    """The ``top`` numeric columns by absolute correlation; undefined ones are left out."""
    columns = [c for c in (columns or number_columns(df)) if c != target and not c.startswith("_")]
    return (
        correlations(df, target, columns)
        .where("r is not null")
        .orderBy(F.desc(F.abs("r")), "column")
        .limit(top)
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``col_a, col_b, r`` for every pair of columns; missing values (NULL, NaN) count only for their own pairs."""
    columns = list(columns)
    upper = pair_correlations(df, columns)
    both = upper.unionByName(upper.where("a < b").select(F.col("b").alias("a"), F.col("a").alias("b"), "r"))
    names = F.array(*[F.lit(c) for c in columns]) if columns else F.array(F.lit(""))
    return both.select(F.get(names, F.col("a")).alias("col_a"), F.get(names, F.col("b")).alias("col_b"), "r")


def heatmap(df: DataFrame, target: str = "y", top: int = 12, columns: Sequence[str] | None = None) -> DataFrame:
    """Correlation matrix of the columns most correlated with the target, and the target itself."""
    ranked = [r["column"] for r in correlation_with_target(df, target, columns, top).collect()]  # at most `top` names
    return correlation_matrix(df, [*ranked, target])


def family_correlations(df: DataFrame, prefix: str, target: str = "y", digits: int = 3) -> DataFrame:
    names = [c for c in number_columns(df) if c.startswith(prefix) and c != target]
    return correlations(df, target, names).withColumn("r", F.bround("r", digits)).orderBy("column")


def rate_by_category(
    df: DataFrame, column: str, target: str = "y", top: int | None = 12, keep_missing: bool = True
) -> DataFrame:
    """``category, n, rate``, highest rate first."""
    rows = df if keep_missing else df.where(F.col(column).isNotNull())
    out = (
        rows.groupBy(F.col(column).cast("string").alias("category"))
        .agg(F.count("*").alias("n"), F.avg(F.col(target).cast("double")).alias("rate"))
        .orderBy(F.desc_nulls_last("rate"), F.asc_nulls_last("category"))
    )
    return out if top is None else out.limit(top)


def describe(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 2) -> DataFrame:
    """Count, mean, std, min, exact quartiles and max of each numeric column."""
    columns = list(columns or number_columns(df))
    one = df.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(F.col(c).cast("double")).alias("mean"),
                F.stddev_samp(F.col(c).cast("double")).alias("std"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    fields = ("count", "mean", "std", "min", "max")
    base = longer(one, [(c, {f: F.col(c)[f] for f in fields}) for c in columns])
    q = exact_quantiles(df, columns, (0.25, 0.5, 0.75))
    quart = q.groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))]
    )
    rounded = [F.bround(c, digits).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]
    return base.join(quart, "column", "left").select("column", "count", *rounded)


def sorted_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("value")).where("value is not null").distinct().orderBy("value")


def null_rates(df: DataFrame, prefix: str, digits: int = 1) -> DataFrame:
    """``column, pct_missing`` over a family of columns."""
    names = [c for c in df.columns if c.startswith(prefix)]
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in names])
    return longer(one, [(c, {"pct_missing": F.bround(F.col(c) * 100, digits)}) for c in names])


def null_cells(df: DataFrame) -> DataFrame:
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    total = F.lit(0).cast("long")
    for c in df.columns:
        total = total + F.col(c)
    return one.select(total.alias("null_cells"))


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return null_counts(df, columns)


def grain_check(df: DataFrame, group: str, column: str) -> DataFrame:
    """The most distinct values of ``column`` in one group; 1 means a group-level attribute."""
    per_group = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count_distinct(column).alias("n"))
    return per_group.agg(F.max("n").alias("max_distinct"))


def histogram(df: DataFrame, column: str, bins: int = 15) -> DataFrame:
    """``bin, low, high, n``: equal-width bins, the last one closed, empty ones kept."""
    v = F.col(column).cast("double")
    span = df.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"))).scalar()
    lo, hi = span["lo"], span["hi"]
    # one value only: a unit-wide range around it
    low = F.when(lo == hi, lo - 0.5).otherwise(lo)
    width = F.when(lo == hi, F.lit(1.0)).otherwise(hi - lo) / bins
    counts = (
        df.where(v.isNotNull())
        .select(F.least(F.floor((v - low) / width), F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
    )
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("low"),
        (low + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def ordered_indicator(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.select(key, value).dropna(subset=[value]).orderBy(F.desc(value), key)
