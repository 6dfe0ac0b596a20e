"""From a wide table to a model frame: which columns exist, which role each has, derived columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.functions.columns import group_text, is_number, longer
from cohortlens.operators.profile import column_stats, distinct_counts

MAX_LEVELS = 30  # non-numeric columns with more distinct values are not features


@dataclass(frozen=True)
class Schema:
    """Names of the columns that play a role; every list may name columns a table does not have."""

    row_id: str = "row_id"
    group: str = "group_id"
    target: str = "y"
    ids: tuple[str, ...] = ("row_id",)
    metadata: tuple[str, ...] = ("_loaded_at", "_batch", "_join_match")
    never_features: tuple[str, ...] = ("weight", "group_name", "same_year_level")
    context: tuple[str, ...] = ("goal_t1", "same_year_level")
    redundant: tuple[str, ...] = ("grade", "state_name")
    categorical: tuple[str, ...] = ("network", "region", "state")
    numeric: tuple[str, ...] = ("lag1_rate", "lag1_state_rate", "goal_t", "acctbal", "goal_gap")
    goal: str = "goal_t"
    lag_rate: str = "lag1_rate"

    @property
    def leakage(self) -> tuple[str, ...]:
        return self.ids + self.metadata


@dataclass(frozen=True)
class Roles:
    numeric: list[str]
    categorical: list[str]
    high_card: list[str] = field(default_factory=list)

    @property
    def features(self) -> list[str]:
        return self.numeric + self.categorical + self.high_card


def add_goal_gap(df: DataFrame, schema: Schema = Schema()) -> DataFrame:
    if {schema.goal, schema.lag_rate} <= set(df.columns):
        return df.withColumn("goal_gap", F.col(schema.goal) - F.col(schema.lag_rate))
    return df


def drop_all_null(df: DataFrame) -> DataFrame:
    stats = column_stats(df)
    return df.drop(*[c for c, s in stats.items() if s.non_null == 0])


def surviving_columns(df: DataFrame) -> DataFrame:
    """The columns with at least one value, as rows."""
    one = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return longer(one, [(c, {"non_null": F.col(c)}) for c in df.columns]).where("non_null > 0")


def constant_columns(df: DataFrame, schema: Schema = Schema(), exclude: Iterable[str] = ()) -> list[str]:
    skip = set(schema.leakage) | {schema.target, schema.group} | set(exclude)
    return [c for c, s in column_stats(df).items() if s.constant and c not in skip]


def constant_column_rows(df: DataFrame, schema: Schema = Schema()) -> DataFrame:
    """The constant columns as rows, decided inside the job."""
    skip = set(schema.leakage) | {schema.target, schema.group}
    names = [c for c in df.columns if c not in skip]
    one = df.agg(
        *[((F.count(c) == 0) | F.coalesce(F.min(c) == F.max(c), F.lit(True))).alias(c) for c in names]
    )
    return longer(one, [(c, {"constant": F.col(c)}) for c in names]).where("constant").select("column")


def build_model_frame(df: DataFrame, schema: Schema = Schema(), screen_on: DataFrame | None = None) -> DataFrame:
    """Drop all-null columns, add the gap, drop constant and redundant columns, target to int.

    One aggregate decides everything: the gap's own statistics are taken in the same pass. Pass
    ``screen_on`` (the training rows) to keep test rows out of that decision.
    """
    if schema.target not in df.columns:
        raise KeyError(f"target '{schema.target}' is not a column")
    stats = column_stats(add_goal_gap(df if screen_on is None else screen_on, schema))
    if stats[schema.target].non_null < stats[schema.target].rows:
        raise ValueError(f"target '{schema.target}' has missing values")
    empty = [c for c, s in stats.items() if s.non_null == 0]
    kept = df.drop(*[c for c in empty if c in df.columns])
    skip = set(schema.leakage) | {schema.target, schema.group}
    out = add_goal_gap(kept, schema)
    constants = [c for c in out.columns if c not in skip and stats[c].constant]
    return out.drop(*schema.redundant, *constants).withColumn(schema.target, F.col(schema.target).cast("int"))


def feature_roles(df: DataFrame, schema: Schema = Schema(), max_levels: int = MAX_LEVELS) -> Roles:
    """Numeric and categorical features; here a boolean counts as numeric."""
    out = set(schema.leakage) | set(schema.never_features) | set(schema.context) | {schema.target, schema.group}
    usable = [f for f in df.schema if f.name not in out and not f.name.startswith("_")]
    names = [f.name for f in usable]
    numeric_like = {f.name for f in usable if is_number(f) or f.dataType.typeName() == "boolean"}
    numeric = [c for c in schema.numeric if c in names]
    numeric += [c for c in names if c not in numeric and c not in schema.categorical and c in numeric_like]
    categorical = [c for c in schema.categorical if c in names]
    rest = [c for c in names if c not in numeric and c not in categorical and c not in numeric_like]
    if rest:
        rough = df.agg(*[F.approx_count_distinct(c).alias(c) for c in rest]).first().asDict()
        close = [c for c in rest if rough[c] <= 2 * max_levels]
        if close:
            exact = {r["column"]: r["n_unique"] for r in distinct_counts(df, close).collect()}  # one row per column
            categorical += [c for c in close if exact.get(c, 0) <= max_levels]
    return Roles(numeric, categorical)


def eda_features(df: DataFrame, schema: Schema = Schema()) -> list[str]:
    """Feature candidates for profiling: only ids, metadata and the target are left out."""
    out = set(schema.leakage) | {schema.target}
    return [c for c in df.columns if c not in out and not c.startswith("_")]


def split_by_type(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[list[str], list[str]]:
    """(numeric, categorical) for profiling; here a boolean counts as categorical."""
    columns = list(columns if columns is not None else eda_features(df))
    numeric = [f.name for f in df.schema if f.name in set(columns) and is_number(f)]
    return numeric, [c for c in columns if c not in numeric]


def by_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def model_rows(df: DataFrame, roles: Roles, schema: Schema = Schema(), context: Sequence[str] = ()) -> DataFrame:
    """One frame with row id, group as text, target, features and context: nothing to re-align later."""
    if schema.group not in df.columns:
        raise KeyError(f"group column '{schema.group}' is required")
    return df.select(
        schema.row_id,
        group_text(schema.group).alias(schema.group),
        F.col(schema.target).cast("int").alias(schema.target),
        *roles.features,
        *[c for c in context if c in df.columns and c not in roles.features],
    )


def log_clipped(c: str) -> Column:
    """``log1p`` of the value clipped at 0; missing stays missing (``greatest`` would turn it into 0)."""
    return F.when(F.col(c).isNotNull(), F.log1p(F.greatest(F.col(c).cast("double"), F.lit(0.0))))


def min_max_score(df: DataFrame, raw: str, name: str = "score") -> DataFrame:
    """A decision value scaled to [0, 1] by the range over all rows."""
    span = df.agg(F.struct(F.min(raw).alias("lo"), F.max(raw).alias("hi"))).scalar()
    return df.withColumn(name, (F.col(raw) - span["lo"]) / (span["hi"] - span["lo"] + F.lit(1e-9)))


def apply_threshold(df: DataFrame, threshold: float = 0.5, score: str = "score", name: str = "predicted") -> DataFrame:
    return df.withColumn(name, (F.col(score) >= F.lit(threshold)).cast("int"))


def complete_cases(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).dropna()


def odds(df: DataFrame, coef: str = "coef") -> DataFrame:
    return df.withColumn("odds_ratio", F.exp(coef)).withColumn("abs_coef", F.abs(coef))
