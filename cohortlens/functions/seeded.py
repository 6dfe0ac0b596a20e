"""Seeded choices that do not depend on row order, partitioning or retries.

Every random choice is "the lowest md5 of seed and key". The cut between chosen and not chosen is found
by counting md5 prefixes, so no data row is sorted, shuffled or brought to one task: one pass counts
prefixes, one ranks the keys of the single prefix on the boundary, and the choice itself is a filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

PREFIX_HEX = 5  # 16**5 prefixes: about a million counters at most, whatever the number of rows


def seeded_tag(seed: int | str, *keys: str | Column) -> Column:
    """md5 of ``seed:key[:key...]``; the same text gives the same tag in any engine."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def unit_interval(tag: Column) -> Column:
    """The first 13 hex digits of a tag as a number in [0, 1)."""
    return F.conv(F.substring(tag, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def given(key: str) -> Column:
    """The key; a missing one is an error."""
    return F.coalesce(F.col(key), F.raise_error(F.lit(f"'{key}' is missing in some rows")))


def lowest_mask(
    keys: DataFrame,
    seed: int | str,
    key: str,
    quota: Column,
    by: str | None = None,
) -> Column:
    """Predicate over rows that hold ``key`` (and ``by``): is the key among the ``quota`` lowest tags?

    ``keys`` has one row per distinct key; a missing key is an error, as no tag could choose it. ``quota`` is an expression over ``total`` (keys in the stratum)
    and ``strata`` (number of strata). ``by`` has few distinct values (classes); one cut is held per value.
    """
    part = F.coalesce(F.col(by).cast("string"), F.lit("")) if by else F.lit("")
    named = F.coalesce(F.col(key).cast("string"), F.raise_error(F.lit(f"'{key}' is missing in some rows")))
    base = keys.select(
        part.alias("_part"), F.concat(seeded_tag(seed, key), named).alias("_tag")
    ).withColumn("_pre", F.substring("_tag", 1, PREFIX_HEX))
    counts = base.groupBy("_part", "_pre").agg(F.count("*").alias("_n"))
    sizes = (
        counts.groupBy("_part")
        .agg(F.sum("_n").alias("total"))
        .withColumn("strata", F.count("*").over(W.partitionBy()))
        .withColumn("_want", quota.cast("long"))
    )
    # At most 16**5 rows per stratum reach this window, whatever the size of `keys`.
    upto = F.sum("_n").over(W.partitionBy("_part").orderBy("_pre"))
    cuts = (
        counts.withColumn("_upto", upto)
        .join(F.broadcast(sizes), "_part")  # one row per class
        .where(F.col("_want") < F.col("total"))
        .where((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_n") < F.col("_want")))
        .select("_part", "_pre", (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_need"))
    )
    # One boundary prefix per stratum: the broadcast side has one row per class.
    edge = base.join(F.broadcast(cuts), ["_part", "_pre"])
    nth = F.row_number().over(W.partitionBy("_part", "_pre").orderBy("_tag"))
    found = edge.withColumn("_i", nth).where(F.col("_i") == F.col("_need")).select("_part", "_tag")
    # "~" sorts after every tag: a stratum whose quota covers it is taken whole
    whole = sizes.where(F.col("_want") >= F.col("total")).select("_part", F.lit("~").alias("_tag"))
    cut_of = found.unionByName(whole).agg(F.map_from_entries(F.collect_list(F.struct("_part", "_tag")))).scalar()
    tag = F.concat(seeded_tag(seed, key), F.col(key).cast("string"))
    return F.coalesce(tag <= F.try_element_at(cut_of, part), F.lit(False))


def take_lowest(df: DataFrame, n: int, key: str, seed: int | str = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows of a frame with unique ``key``, uniform over rows."""
    return df.where(lowest_mask(df.select(key), seed, key, F.lit(int(n))))
