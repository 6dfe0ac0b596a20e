"""Correlations of all pairs of columns from masked product sums: one pass with sums of one size, whatever the number of columns."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from cohortlens.session import written

SUMS = ("n", "sa", "sb", "saa", "sbb", "sab")
ENDS = ("low_a", "high_a", "low_b", "high_b")

# the functions below travel with the task: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class PairSums:
    """Sums over the rows in which both columns of a pair are known, of deviations from given centres."""

    def __init__(self, centres: np.ndarray) -> None:
        self.centres, k = centres, len(centres)
        # how often b is known where a is, and sums of a, a*a over those rows: [a, b]
        self.n, self.s, self.ss, self.p = (np.zeros((k, k)) for _ in range(4))
        self.low, self.high = np.full((k, k), np.inf), np.full((k, k), -np.inf)

    def add(self, values: np.ndarray) -> None:
        known = ~np.isnan(values)
        mask, x = known.astype(float), np.where(known, values - self.centres, 0.0)
        self.n += mask.T @ mask
        self.s += x.T @ mask
        self.ss += (x * x).T @ mask
        self.p += x.T @ x
        for b in range(len(self.centres)):
            rows = values[known[:, b]]
            if len(rows):
                own = known[known[:, b]]
                self.low[:, b] = np.minimum(self.low[:, b], np.where(own, rows, np.inf).min(axis=0))
                self.high[:, b] = np.maximum(self.high[:, b], np.where(own, rows, -np.inf).max(axis=0))

    def rows(self) -> pa.RecordBatch:
        a, b = np.triu_indices(len(self.centres))
        values = (self.n[a, b], self.s[a, b], self.s[b, a], self.ss[a, b], self.ss[b, a], self.p[a, b], self.low[a, b], self.high[a, b], self.low[b, a], self.high[b, a])
        columns = [pa.array(x.astype(np.int32)) for x in (a, b)] + [pa.array(v) for v in values]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", *SUMS, *ENDS])


def _sums(centres: np.ndarray):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = PairSums(centres)
        for batch in batches:
            sums.add(batch["x"].flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, len(centres)))
        yield sums.rows()

    return go


def pair_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``a, b, r`` for each pair of column numbers, ``a <= b``: Pearson over the rows in which both are known, NULL where a side is constant."""
    columns = list(columns)
    if not columns:
        return df.sparkSession.createDataFrame([], "a int, b int, r double")
    rows = written(df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]), "numbers")
    # deviations from the means lose no digits where a column is far from 0
    means = rows.agg(*[F.avg(F.nanvl(F.col(c), F.lit(None).cast("double"))).alias(c) for c in rows.columns]).first()
    centres = np.array([m if m is not None else 0.0 for m in means], float)
    schema = "a int, b int, " + ", ".join(f"{c} double" for c in (*SUMS, *ENDS))
    parts = rows.select(F.array(*rows.columns).alias("x")).mapInArrow(_sums(centres), schema)
    total = parts.groupBy("a", "b").agg(
        *[F.sum(c).alias(c) for c in SUMS], *[(F.min if c.startswith("low") else F.max)(c).alias(c) for c in ENDS]
    )
    covar = F.col("sab") - F.try_divide(F.col("sa") * F.col("sb"), "n")
    va, vb = (F.col(f"s{c}{c}") - F.try_divide(F.col(f"s{c}") * F.col(f"s{c}"), "n") for c in "ab")
    varies = (F.col("low_a") < F.col("high_a")) & (F.col("low_b") < F.col("high_b"))
    return total.select("a", "b", F.when(varies, F.try_divide(covar, F.sqrt(va) * F.sqrt(vb))).alias("r"))
