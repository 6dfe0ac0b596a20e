"""Holdouts, folds and samples chosen by seeded tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.functions.seeded import lowest_mask, seeded_tag, take_lowest, unit_interval
from cohortlens.operators.attach import attach
from cohortlens.operators.ordering import global_rank


def grouped_holdout(df: DataFrame, group: str = "group_id", share: float = 0.2, seed: int | str = 42) -> DataFrame:
    """Add ``is_test``: exactly ceil(share x groups) whole groups are test. The data rows are not shuffled."""
    # rows without a group are one group
    named = df.withColumn("_group", F.coalesce(F.col(group).cast("string"), F.lit("")))
    keys = named.select("_group").distinct()
    mask = lowest_mask(keys, seed, "_group", F.ceil(F.lit(float(share)) * F.col("total")))
    return named.withColumn("is_test", mask).drop("_group")


def grouped_holdout_approx(df: DataFrame, group: str = "group_id", share: float = 0.2, seed: int | str = 42) -> DataFrame:
    """As above with the share only met on average, in one pass over the rows."""
    return df.withColumn("is_test", unit_interval(seeded_tag(seed, group)) < F.lit(float(share)))


def random_holdout(
    df: DataFrame, row_key: str = "row_id", target: str = "y", share: float = 0.2, seed: int | str = 42
) -> DataFrame:
    """Add ``is_test``: round(share x rows) rows of each class, regardless of groups (the leaky baseline)."""
    keys = df.select(row_key, target)
    mask = lowest_mask(keys, seed, row_key, F.round(F.lit(float(share)) * F.col("total")), by=target)
    return df.withColumn("is_test", mask)


def group_folds(
    df: DataFrame, k: int = 5, group: str = "group_id", target: str = "y", seed: int | str = 42
) -> DataFrame:
    """``group, n, n_pos, fold``: whole groups dealt to folds back and forth, by size, then by rate.

    Neighbours in that order are alike, so each round of k groups gives every fold one of the kind.
    """
    per_group = df.groupBy(group).agg(F.count("*").alias("n"), F.sum(F.col(target).cast("long")).alias("n_pos"))
    # increasing in n, then in the number of positives: the order "size desc, rate desc"; groups of one size above 2**26 rows
    # may tie, and then go by their tags
    sized = per_group.withColumn("_w", F.col("n") + (F.col("n_pos") + 1.0) / (F.col("n") + 2.0))
    ranked = global_rank(sized, "_w", group, name="_i", descending=True, seed=seed)
    place = F.pmod(F.col("_i") - 1, F.lit(2 * k))
    fold = F.when(place < k, place).otherwise(2 * k - 1 - place).cast("int")
    return ranked.select(group, "n", "n_pos", fold.alias("fold"))


def with_folds(
    df: DataFrame, k: int = 5, group: str = "group_id", target: str = "y", row_key: str = "row_id", seed: int | str = 42
) -> DataFrame:
    """Rows with their group's ``fold`` 0..k-1; large groups do not pile up in one task."""
    folds = group_folds(df, k, group, target, seed)
    return attach(df, folds.select(group, "fold"), [group], row_key, sizes=folds.select(group, F.col("n").alias("_n")))


def check_folds(df: DataFrame, k: int) -> None:
    """Every fold must hold rows, or a fold would train on everything and test on nothing."""
    found = {r["fold"] for r in df.select("fold").distinct().limit(k + 1).collect()}
    if found != set(range(k)):
        raise ValueError(f"expected folds 0..{k - 1}, found {sorted(found, key=str)}")


def row_cap(df: DataFrame, cap: int | None, row_key: str = "row_id", seed: int | str = 42) -> DataFrame:
    """A seeded sample of at most ``cap`` rows, or all rows when ``cap`` is None."""
    return df if cap is None else take_lowest(df, cap, row_key, seed)


def class_balanced_sample(
    df: DataFrame, n: int, row_key: str = "row_id", target: str = "y", seed: int | str = 42, max_gap: float = 0.08
) -> DataFrame:
    """At most ``n`` rows; when the class shares differ by more than ``max_gap`` the classes get n/classes each."""
    sample = take_lowest(df, n, row_key, seed)
    counts = sample.groupBy(target).agg(F.count("*").alias("c"))
    known = F.col(target).isNotNull()
    facts = counts.agg(
        F.struct(
            F.sum("c").alias("rows"),
            F.count_if(known).alias("classes"),
            F.sum(F.when(known, F.col("c"))).alias("known_rows"),
            F.max(F.when(known, F.col("c"))).alias("most"),
            F.min(F.when(known, F.col("c"))).alias("least"),
        )
    ).scalar()
    gap = F.try_divide((facts["most"] - facts["least"]).cast("double"), facts["known_rows"])
    uneven = (facts["classes"] > 1) & (gap > F.lit(max_gap)) & (facts["rows"] >= F.lit(n))
    per_class = F.floor(F.lit(n) / facts["classes"])
    quota: Column = F.least(F.col("total"), per_class)
    mask = lowest_mask(sample.select(row_key, target), f"{seed}:class", row_key, quota, by=target)
    return sample.where(~F.coalesce(uneven, F.lit(False)) | mask)


def group_counts(df: DataFrame, group: str = "group_id") -> DataFrame:
    """Groups and rows on each side of a holdout."""
    return df.groupBy("is_test").agg(F.count_distinct(group).alias("n_groups"), F.count("*").alias("n_rows"))
