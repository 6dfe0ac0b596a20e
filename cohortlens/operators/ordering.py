"""Running totals, ranks and exact quantiles over one total order, without a one-task sort.

A window without ``partitionBy`` brings every row to one task. Here a large table is first cut into
value ranges by approximate percentiles; each range is summed and ordered on its own and shifted by the
totals of the ranges before it. The cuts only decide how the work is spread: the results are exact for
any cuts, and the cuts are literals, so a retried task places its rows as the first try did.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortlens.functions.seeded import seeded_tag, unit_interval
from cohortlens.session import written

RANGE_ROWS = 1_000_000  # rows aimed at per value range
FEWEST = 8  # value ranges, over all strata; their number grows with the rows
RANGE_STEP = 65_536  # room between two ranges for the pieces of a heavy tie


def _cuts(df: DataFrame, value: str, by: Sequence[str], range_rows: int) -> list[float]:
    """Sorted cut values for all strata together.

    One small row per stratum comes to the driver; strata are columns, variants or folds, never data keys.
    """
    rows = df.count()
    wanted = max(FEWEST, rows // range_rows)
    found = (
        df.groupBy((F.struct(*by) if by else F.lit(0)).alias("_s"))
        .agg(F.percentile_approx(F.col(value).cast("double"), [i / wanted for i in range(1, wanted)], 20 * wanted).alias("_cuts"))
        .collect()
    )
    # each stratum gives its share of the cuts, and at least 8 of them
    step = max(1, wanted // max(8, wanted // max(1, len(found))))
    return sorted(c for r in found for c in (r["_cuts"] or [])[step - 1 :: step])


def _in_ranges(df: DataFrame, value: str, spread: Column | None, cuts: list[float]) -> DataFrame:
    """Add ``_range``, a number that never falls as ``value`` (then ``spread``) grows.

    A value that fills several cuts is a heavy tie: its rows go to as many ranges, by ``spread`` in [0, 1).
    """
    edges = sorted({c for c in cuts if math.isfinite(c)})
    splits = [float("-inf"), *edges, float("inf")]
    if len(edges) == 0:
        return df.withColumn("_range", F.lit(0).cast("long"))
    # binary search on the JVM; value NULL or NaN does not occur here
    cut = Bucketizer(splits=splits, inputCol="_bv", outputCol="_bucket", handleInvalid="keep")
    placed = cut.transform(df.withColumn("_bv", F.col(value).cast("double")))
    place = F.col("_bucket").cast("int")
    number = place.cast("long") * RANGE_STEP
    times = Counter(cuts)
    if spread is not None and max(times.values()) > 1:
        at = F.try_element_at(F.array(*[F.lit(e) for e in edges]), place)
        n = F.try_element_at(F.array(*[F.lit(times[e]) for e in edges]), place)
        inside = F.when(F.col("_bv") == at, F.floor(spread * n).cast("int")).otherwise(n)
        number = F.when((place > 0) & (n > 1), number + inside).otherwise(number)
    return placed.withColumn("_range", number).drop("_bv", "_bucket")


def running_totals(
    df: DataFrame,
    value: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    prefix: str = "cum_",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Add ``cum_<s>``: the sum of ``s`` over all rows up to and including this one in ``value`` order.

    ``value`` is numeric and unique per stratum (aggregate by it first), so ties cannot be torn apart.
    """
    by = list(by)
    # read for the cuts and for the totals: written once, so that what lies before it runs once
    df = written(df, "to_total")
    order = F.desc(value) if descending else F.asc(value)
    cuts = _cuts(df, value, by, range_rows)
    parts = _in_ranges(df, value, None, cuts)
    totals = parts.groupBy(*by, "_range").agg(*[F.sum(s).alias("_t_" + s) for s in sums])
    step = F.desc("_range") if descending else F.asc("_range")
    before = W.partitionBy(*by).orderBy(step).rowsBetween(W.unboundedPreceding, -1)
    # one row per range and stratum, a millionth of the rows; Spark sends it around if it is small
    offsets = totals.select(
        *by, "_range", *[F.coalesce(F.sum("_t_" + s).over(before), F.lit(0)).alias("_o_" + s) for s in sums]
    )
    w = W.partitionBy(*by, "_range").orderBy(order)
    local = parts.select("*", *[F.sum(s).over(w).alias("_l_" + s) for s in sums])
    return local.join(offsets, [*by, "_range"]).select(
        *df.columns, *[(F.col("_l_" + s) + F.col("_o_" + s)).alias(prefix + s) for s in sums]
    )


def global_rank(
    df: DataFrame,
    value: str,
    key: str,
    name: str = "rank",
    descending: bool = False,
    seed: int | str = 42,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Ranks 1..n by ``value``, missing values last, ties by the seeded tag of the unique ``key``.

    The tag spreads evenly, so a heavy tie (many rows with one value) is cut into several ranges too.
    """
    v = F.col(value).cast("double")
    tag = F.concat(seeded_tag(seed, key), F.col(key).cast("string"))
    df = written(df, "to_rank")
    keyed = df.withColumn("_v", -v if descending else v).withColumn("_tie", tag)
    valued = keyed.where("_v is not null")
    parts = _in_ranges(valued, "_v", unit_interval(F.col("_tie")), _cuts(valued, "_v", (), range_rows))
    # missing values: ranges of their own behind all others, by the tag, as many as their number takes
    missing = keyed.where("_v is null")
    n = max(FEWEST, missing.count() // range_rows)
    behind = F.floor(unit_interval(F.col("_tie")) * n).cast("long") + F.lit(1 << 50)
    parts = parts.withColumn("_range", F.col("_range").cast("long")).unionByName(missing.withColumn("_range", behind))
    sizes = parts.groupBy("_range").agg(F.count("*").alias("_n"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    # one row per range
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    w = W.partitionBy("_range").orderBy("_v", "_tie")
    return (
        parts.withColumn("_i", F.row_number().over(w))
        .join(offsets, "_range")
        .select(*df.columns, (F.col("_i") + F.col("_o")).cast("long").alias(name))
    )


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], range_rows: int = RANGE_ROWS
) -> DataFrame:
    """``column, prob, value``: linear-interpolated quantiles over the non-missing values.

    The built-in ``percentile`` keeps every distinct value of a column in one buffer; this counts the
    distinct values in parallel and picks the two neighbours of each target position.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    counted = long.where("value is not null and not isnan(value)").groupBy("column", "value").agg(
        F.count("*").alias("n")
    )
    run = running_totals(counted, "value", ["n"], by=["column"], range_rows=range_rows)
    total = run.groupBy("column").agg((F.sum("n") - 1).alias("last"))
    # `total` has one row per column
    at = (
        run.join(F.broadcast(total), "column")
        .withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("pos", F.col("prob") * F.col("last"))
        .withColumn("first", F.col("cum_n") - F.col("n"))
        .withColumn("has_low", (F.floor("pos") >= F.col("first")) & (F.floor("pos") < F.col("cum_n")))
        .withColumn("has_high", (F.ceil("pos") >= F.col("first")) & (F.ceil("pos") < F.col("cum_n")))
        .where("has_low or has_high")
    )
    low = F.max(F.when(F.col("has_low"), F.col("value")))
    high = F.max(F.when(F.col("has_high"), F.col("value")))
    frac = F.max(F.col("pos") - F.floor("pos"))
    return at.groupBy("column", "prob").agg((low + (high - low) * frac).alias("value"))
