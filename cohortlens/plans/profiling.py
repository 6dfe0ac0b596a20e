"""The profiling job: the tables behind an exploratory report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortlens.operators import frame, profile
from cohortlens.sources import sinks
from cohortlens.sources.tables import Lake, modeling_table


def feature_summary(df: DataFrame, schema: frame.Schema = frame.Schema(), grain_column: str = "lag1_rate") -> DataFrame:
    """One row on what a model may use: constant columns, features per role, cardinalities, grain, lags, goals."""
    constants = frame.constant_columns(df, schema)
    roles = frame.feature_roles(frame.build_model_frame(df, schema), schema)
    facts = {
        "constant_columns": F.array(*[F.lit(c) for c in constants]).cast("array<string>"),
        "n_numeric": F.lit(len(roles.numeric)),
        "n_categorical": F.lit(len(roles.categorical)),
        "n_high_card": F.lit(len(roles.high_card)),
    }
    categories = [c for c in schema.categorical if c in df.columns]
    if categories:
        counts = profile.distinct_counts(df, categories)
        listed = F.map_from_entries(F.array_sort(F.collect_list(F.struct("column", "n_unique"))))
        facts["cardinality"] = counts.agg(listed).scalar()
    if grain_column in df.columns:
        facts["max_values_per_group"] = profile.grain_check(df, schema.group, grain_column).scalar()
    for name, prefix, table, value in (
        ("lag_missing", "lag1_", profile.null_rates, "pct_missing"),
        ("goal_corr", "goal_", profile.family_correlations, "r"),
    ):
        found = frame.by_prefix(df, prefix)
        if found:
            rows = table(df, prefix)
            facts[name] = rows.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("column", value))))).scalar()
    return df.sparkSession.range(1).select(*[c.alias(n) for n, c in facts.items()])


def run(
    tables: dict[str, DataFrame],
    lake: Lake = Lake(root=""),
    schema: frame.Schema = frame.Schema(),
    out: str | None = None,
) -> dict[str, DataFrame]:
    """All profiling tables by name; with ``out`` each is written as Parquet below it.

    The tables are read several times: pass stored tables or stored samples, not long computations.
    """
    df = modeling_table(tables, lake)
    numeric, categorical = frame.split_by_type(df, frame.eda_features(df, schema))
    found = {
        "overview": profile.overview(tables),
        "profile": profile.profile(df),
        "target_balance": profile.target_balance(df, schema.target),
        "correlation_with_target": profile.correlation_with_target(df, schema.target, numeric),
        "heatmap": profile.heatmap(df, schema.target, columns=numeric),
        "describe": profile.describe(df, numeric),
        "feature_types": df.sparkSession.createDataFrame(
            [(c, "numeric") for c in numeric] + [(c, "categorical") for c in categorical], "feature string, kind string"
        ),
        "feature_summary": feature_summary(df, schema),
        "null_cells": profile.null_cells(df),
    }
    for c in numeric:
        found[f"histogram_{c}"] = profile.histogram(df, c)
    for c in schema.categorical:
        if c in df.columns:
            found[f"rate_by_{c}"] = profile.rate_by_category(df, c, schema.target)
    if out:
        sinks.save_tables(found, out, fmt="parquet")
    return found
