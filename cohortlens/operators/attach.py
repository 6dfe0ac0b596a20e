"""Give rows the attributes of their group, when one group may hold a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

SPLITS = 256  # no piece of a group is larger than about 1/SPLITS of the rows


def attach(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    row_key: str,
    splits: int = SPLITS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Left join of ``rows`` with ``table`` (one row per ``keys``), with heavy keys split over many tasks.

    A key with more than ``1/splits`` of the rows is heavy, so there are fewer than ``splits`` of them and
    the list is safe to broadcast. Its rows are dealt to numbered pieces by a hash of ``row_key`` and its
    one row of ``table`` is repeated once per piece. Rows with a missing key match nothing and are dealt
    out the same way. ``sizes`` (``keys, _n``: the rows per key) saves counting them here. ``table`` itself is never broadcast by a hint: Spark decides by its measured size.
    """
    keys = list(keys)
    if sizes is None:
        sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = sizes.agg(F.sum("_n")).scalar()
    heavy = sizes.where(F.col("_n") * splits > total).select(
        *keys, F.ceil(F.col("_n") * splits / total).cast("int").alias("_pieces")
    )
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    pieces = F.when(missing, F.lit(splits)).otherwise(F.coalesce("_pieces", F.lit(1)))
    dealt = (
        rows.join(F.broadcast(heavy), keys, "left")
        .withColumn("_piece", F.pmod(F.xxhash64(row_key), pieces).cast("int"))
        .drop("_pieces")
    )
    repeated = (
        table.join(F.broadcast(heavy), keys, "left")
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)))
        .drop("_pieces")
    )
    return dealt.join(repeated, [*keys, "_piece"], "left").drop("_piece")


def first_known(df: DataFrame, key: str, columns: Sequence[str], row_key: str) -> DataFrame:
    """Per group the first non-missing value of each column, first by ``row_key``: one partial aggregate."""
    return df.groupBy(key).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(row_key))).alias(c) for c in columns]
    )


def lookup_first(rows: DataFrame, source: DataFrame, key: str, columns: Sequence[str], row_key: str) -> DataFrame:
    """Attach the first known value per group for those ``columns`` that ``rows`` does not have yet."""
    absent = [c for c in columns if c in source.columns and c not in rows.columns]
    if not absent:
        return rows
    return attach(rows, first_known(source, key, absent, row_key), [key], row_key)


def label_lookup(table: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Left join of a small summary with another summary of the same grain."""
    return table.join(labels, key, "left")


def shared_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: how many distinct keys occur on both sides."""
    both = a.select(F.col(key).cast("string").alias(key)).intersect(b.select(F.col(key).cast("string").alias(key)))
    return both.agg(F.count("*").alias("overlap"))
