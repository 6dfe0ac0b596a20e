"""Decision tables from scored units: group risk, region profile, cluster profile, crosstab."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from cohortlens.operators.ordering import RANGE_ROWS, global_rank

CONTEXT = ("state", "region", "network", "goal_t", "goal_t1", "lag1_rate", "lag1_state_rate", "acctbal")


def group_rates(scored: DataFrame, group: str, context: Sequence[str], row_key: str) -> DataFrame:
    """Per group: size, observed and predicted rate, first known context values. One partial aggregate."""
    known = [c for c in context if c in scored.columns]
    return (
        scored.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(
            F.count("*").alias("n_units"),
            F.avg(F.col("y").cast("double")).alias("observed_rate"),
            F.avg(F.col("score").cast("double")).alias("predicted_rate"),
            *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(row_key))).alias(c) for c in known],
        )
    )


def add_goal_flags(rates: DataFrame, goals: Sequence[str] = ("goal_t", "goal_t1")) -> DataFrame:
    """Risk, and for each goal (percent) the gap and whether it is missed; no goal means not missed."""
    out = rates.withColumn("risk", 1 - F.col("predicted_rate"))
    for g in goals:
        if g in rates.columns:
            gap = F.col("predicted_rate") * 100 - F.col(g)
            out = out.withColumn(f"gap_{g}", gap).withColumn(f"misses_{g}", F.coalesce(gap < 0, F.lit(False)))
    return out


def group_risk(
    scored: DataFrame,
    group: str = "group_id",
    context: Sequence[str] = CONTEXT,
    goals: Sequence[str] = ("goal_t", "goal_t1"),
    row_key: str = "row_id",
    seed: int | str = 42,
    digits: int = 9,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """The risk table, ranked with the riskiest group first.

    Sums of doubles differ in their last bits with the order of addition; risk is ranked at ``digits``
    decimals so that a retried task cannot swap two groups of equal risk.
    """
    table = add_goal_flags(group_rates(scored, group, context, row_key), goals)
    keyed = table.withColumn("_r", F.round("risk", digits))
    return global_rank(
        keyed, "_r", group, name="rank", descending=True, seed=seed, range_rows=range_rows
    ).drop("_r")


def region_profile(risk: DataFrame, group: str = "group_id") -> DataFrame:
    """Unweighted mean rate and risk over the groups of a region (of a state when there is no region)."""
    key = next((c for c in ("region", "state") if c in risk.columns), None)
    if key is None:
        return risk.limit(0).select()
    return (
        risk.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count_distinct(group).alias("n_groups"),
            F.avg("predicted_rate").alias("mean_predicted_rate"),
            F.avg("risk").alias("mean_risk"),
            F.sum("n_units").alias("n_units"),
        )
        .orderBy(F.desc("mean_risk"), key)
    )


def top_risk(risk: DataFrame, n: int = 10) -> DataFrame:
    return risk.orderBy("rank").limit(n)


def dominant_category(df: DataFrame, cluster: str = "cluster", category: str = "region") -> DataFrame:
    """Per cluster its most frequent category and that category's share among the known ones."""
    counts = df.where(F.col(category).isNotNull()).groupBy(cluster, category).agg(F.count("*").alias("n"))
    # most frequent, then first in alphabet
    return counts.groupBy(cluster).agg(
        F.min_by(category, F.struct(-F.col("n"), F.col(category))).alias(f"main_{category}"),
        F.bround(F.max("n") / F.sum("n"), 4).alias(f"main_{category}_share"),
    )


def cluster_profile(
    df: DataFrame, features: Sequence[str], cluster: str = "cluster", category: str = "region"
) -> DataFrame:
    """Size and raw means per cluster, lowest predicted rate first."""
    rows = df.where(F.col(cluster).isNotNull())
    out = rows.groupBy(cluster).agg(
        F.count("*").alias("n_groups"), *[F.avg(F.col(f).cast("double")).alias(f) for f in features]
    )
    if category in df.columns:
        out = out.join(dominant_category(rows, cluster, category), cluster, "left")
    first = "predicted_rate" if "predicted_rate" in features else cluster
    return out.orderBy(F.asc_nulls_last(first), cluster)


def region_cluster_crosstab(df: DataFrame, clusters: Sequence[int] | None = None) -> DataFrame:
    """Row shares of each cluster within a region, columns ``cluster_<k>``."""
    rows = df.dropna(subset=["cluster", "region"])
    if clusters is None:
        # labels count from 0; one number is collected
        top = rows.agg(F.max("cluster")).first()[0]
        clusters = range(0 if top is None else int(top) + 1)
    total = F.count("*")
    cells = [
        F.bround(F.count_if(F.col("cluster") == k) / total, 4).alias(f"cluster_{int(k)}") for k in clusters
    ]
    return rows.groupBy("region").agg(*cells) if cells else rows.select("region").limit(0)


def crosstab_long(crosstab: DataFrame) -> DataFrame:
    """The crosstab as ``region, cluster, share`` rows (stacked bars)."""
    names = [c for c in crosstab.columns if c.startswith("cluster_")]
    return crosstab.unpivot(["region"], names, "cluster", "share")


def cluster_scatter(df: DataFrame, x: Sequence[str] = ("acctbal", "lag1_rate")) -> DataFrame:
    """Points behind the cluster picture: the first of the candidate x columns that exists."""
    name = next(c for c in x if c in df.columns)
    return df.where(F.col("cluster").isNotNull()).select("group_id", F.col(name).alias("x"), "predicted_rate", "cluster")


def share_of_total(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    return df.withColumn("share", F.col(value) / F.sum(value).over(W.partitionBy(*by)))
