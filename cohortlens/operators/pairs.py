"""All-pairs work between two sets of vectors, without sending pairs through a shuffle.

Both sides are dealt to blocks by a hash of their id; each (chunk, block) group holds a bounded number of
vectors, its distances are worked out in numpy tiles and only the reduced result leaves the task.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql import types as T

BLOCK_ROWS = 65_536  # the most vectors of one side in a task
CHUNK_ROWS = 512  # left chunks are not cut smaller than this for the sake of more tasks
TILE_ROWS = 32
QUERY_TILE = 256  # vectors whose nearest ones are looked for together
COLUMN_TILE = 4_096
WIDE = 8  # dimensions from which products are cheaper than sums of gaps
LARGE = 1e15  # beyond that nothing is estimated
TOGETHER = 3  # gaps of codes that are added up in one byte
LEVELS = 255 // TOGETHER  # steps of a code
FEW = 0.02  # codes are used where they leave at most this share of the pairs open
SAMPLED = (32, 1_024)  # rows of both sides on which that is tried

# the functions below travel with the task: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def block_pairs(
    left: DataFrame,
    right: DataFrame,
    fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``fn(left chunk, right block)`` for every chunk and block; both frames have a unique ``id``."""
    n_left = left.count()
    n_right = n_left if right is left else right.count()
    tasks = 4 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, math.ceil(n_right / block_rows))
    # each side is copied once for every part of the other, so there are no more chunks than the tasks need
    chunks = max(1, math.ceil(n_left / block_rows), min(math.ceil(tasks / blocks), math.ceil(n_left / CHUNK_ROWS)))

    def deal(df: DataFrame, prefix: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        # names of their own on each side: Spark mixes up the columns when a frame meets itself in a cogroup
        named = df.select(*[F.col(c).alias(prefix + c) for c in df.columns])
        return named.withColumn(own, F.pmod(F.xxhash64(f"{prefix}id"), F.lit(n_own)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        )

    def both(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return fn(a.rename(columns=lambda c: c.removeprefix("l_")), b.rename(columns=lambda c: c.removeprefix("r_")))

    a = deal(left, "l_", "_chunk", chunks, "_block", blocks).groupBy("_chunk", "_block")
    b = deal(right, "r_", "_block", blocks, "_chunk", chunks).groupBy("_chunk", "_block")
    return a.cogroup(b).applyInPandas(both, schema)


def matrix(pdf: pd.DataFrame) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in pdf["v"]]) if len(pdf) else np.zeros((0, 0))


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distances of every row of ``a`` to every row of ``b``, one dimension at a time: no cancellation."""
    out, gap = np.zeros((len(a), len(b))), np.empty((len(a), len(b)))
    for left, right in zip(a.T, np.ascontiguousarray(b.T)):
        np.subtract(left[:, None], right, out=gap)
        if metric == "manhattan":
            np.abs(gap, out=gap)
        else:
            np.multiply(gap, gap, out=gap)
        out += gap
    return out if metric == "manhattan" else np.sqrt(out, out=out)


class Estimates:
    """Distances to the rows of ``b`` that are off by no more than a known error, and much cheaper than ``distances``."""

    def __init__(self, b: np.ndarray, metric: str) -> None:
        self.b, self.metric = b, metric
        self.coded = False
        self.plain = not len(b) or b.shape[1] < WIDE or not np.abs(b).max() < LARGE
        if self.plain:
            return
        if metric == "manhattan":
            self.far = np.abs(b).sum(axis=1).max()
            self.short = b.astype(np.float32)
            self.columns = np.ascontiguousarray(self.short.T)
            self.coded = self._code()
        else:
            self.centre = b.mean(axis=0)
            self.moved = b - self.centre
            self.square = (self.moved * self.moved).sum(axis=1)

    def _code(self) -> bool:
        """One byte for each number, on one scale for all columns; whether that tells enough pairs apart."""
        b = self.b
        self.low, self.step = b.min(), (b.max() - b.min()) / LEVELS
        if not self.step > 0 or LEVELS * b.shape[1] >= 1 << 16:
            return False
        codes, off = self._codes(b)
        self.bytes, self.off = np.ascontiguousarray(codes.T), off.max()
        few, more = (np.unique(np.linspace(0, len(b) - 1, n).astype(np.int64)) for n in SAMPLED)
        found = distances(b[few], b[more], self.metric)
        found[few[:, None] == more] = np.inf
        guess = distances(codes[few].astype(float), codes[more].astype(float), self.metric) * self.step
        return bool((guess <= found.min(axis=1, keepdims=True) + 2 * self.off).mean() <= FEW)

    def _codes(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The codes, and how far the numbers of each row are from what their codes stand for, in all."""
        codes = np.clip(np.rint((rows - self.low) / self.step), 0, LEVELS)
        return codes.astype(np.int8), np.abs(rows - (self.low + codes * self.step)).sum(axis=1)

    def _by_codes(self, codes: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """The sums of the gaps between codes."""
        out = np.zeros((len(codes), hi - lo), np.uint16)
        for s in range(0, len(codes), TILE_ROWS):
            part, rows = out[s : s + TILE_ROWS], codes[s : s + TILE_ROWS]
            gap, some = np.empty(part.shape, np.int8), np.empty(part.shape, np.uint8)
            for j in range(0, codes.shape[1], TOGETHER):
                np.subtract(rows[:, j, None], self.bytes[j, None, lo:hi], out=gap)
                np.abs(gap, out=some.view(np.int8))
                for i in range(j + 1, min(j + TOGETHER, codes.shape[1])):
                    np.subtract(rows[:, i, None], self.bytes[i, None, lo:hi], out=gap)
                    np.abs(gap, out=gap)
                    some += gap.view(np.uint8)
                part += some
        return out

    def closer(self, a: np.ndarray, row: np.ndarray, col: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Better estimates for some pairs that codes leave open, and the error for each row of ``a``."""
        out, rows = np.empty(len(row), np.float32), a.astype(np.float32)
        for s in range(0, len(row), COLUMN_TILE):
            part = slice(s, s + COLUMN_TILE)
            gap = rows[row[part]]
            gap -= self.short[col[part]]
            out[part] = np.abs(gap, out=gap).sum(axis=1)
        return out, self._short_error(a)

    def _short_error(self, a: np.ndarray) -> np.ndarray:
        return (a.shape[1] + 4) * 2.0**-22 * (np.abs(a).sum(axis=1) + self.far)

    def __call__(self, a: np.ndarray, lo: int, hi: int, closely: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Estimates of the distances (euclidean: of their squares) of ``a`` to rows ``lo`` to ``hi``, and the error for each row of ``a``."""
        if self.plain or not np.abs(a).max(initial=0) < LARGE:
            with np.errstate(over="ignore", invalid="ignore"):
                out = distances(a, self.b[lo:hi], self.metric)
                out = out if self.metric == "manhattan" else out * out
                out[~np.isfinite(out)] = np.inf
                top = np.where(np.isfinite(out), out, 0).max(axis=1, initial=0)
            return out, 1e-14 * top
        if self.coded and not closely:
            codes, off = self._codes(a)
            # rows far from all that the codes stand for are left to numbers
            if off.max(initial=0) <= 2 * self.off:
                out = np.multiply(self._by_codes(codes, lo, hi), np.float32(self.step), dtype=np.float32)
                return out, off + self.off + 1e-6 * LEVELS * a.shape[1] * self.step
        if self.metric == "manhattan":
            out, rows = np.empty((len(a), hi - lo), np.float32), a.astype(np.float32)
            for s in range(0, len(a), TILE_ROWS):
                # small enough for a core's own cache
                part = out[s : s + TILE_ROWS]
                part[:] = 0
                gap = np.empty_like(part)
                for j in range(a.shape[1]):
                    np.subtract(rows[s : s + TILE_ROWS, j, None], self.columns[j, None, lo:hi], out=gap)
                    np.abs(gap, out=gap)
                    part += gap
            return out, self._short_error(a)
        moved = a - self.centre
        square = (moved * moved).sum(axis=1)
        out = moved @ self.moved[lo:hi].T
        out *= -2
        out += square[:, None]
        out += self.square[None, lo:hi]
        return out, 1e-13 * a.shape[1] * (square + self.square.max() + 1e-300)


def exact(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distances of rows of ``a`` to the rows of ``b`` beside them, added up as in ``distances``."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        gap = np.abs(a[:, j] - b[:, j])
        out += gap if metric == "manhattan" else gap * gap
    return out if metric == "manhattan" else np.sqrt(out)


class Best:
    """The ``k`` nearest rows of some vectors so far: only what an estimate leaves within the k-th distance is worked out."""

    def __init__(self, a: np.ndarray, mine: np.ndarray | None, ids: np.ndarray, estimates: Estimates, k: int, limit: np.ndarray | None = None) -> None:
        self.a, self.mine, self.ids, self.estimates, self.k = a, mine, ids, estimates, k
        self.limit = np.full(len(a), np.inf) if limit is None else limit.copy()
        self.row, self.col, self.distance = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def add(self, lo: int, hi: int, rows: np.ndarray | None = None) -> None:
        """Rows ``lo`` to ``hi`` of the other side, for all vectors or those named."""
        for start in range(lo, hi, COLUMN_TILE):
            self._tile(start, min(hi, start + COLUMN_TILE), np.arange(len(self.a)) if rows is None else rows)

    def _tile(self, lo: int, hi: int, rows: np.ndarray) -> None:
        euclidean = self.estimates.metric != "manhattan"
        with np.errstate(over="ignore", invalid="ignore"):
            limit = self.limit[rows] * (1 + 1e-9)
            limit = limit * limit if euclidean else limit
            open_, need = np.isinf(limit), self.k + (self.mine is not None)
            # the first limits come from close estimates
            closely = bool(open_.any())
            guess, error = self.estimates(self.a[rows], lo, hi, closely)
            if open_.any() and need <= hi - lo:
                # so many are not farther than this, whatever the estimates are off
                limit[open_] = np.partition(guess[open_], need - 1, axis=1)[:, need - 1] * (1 + 1e-6) + 2 * error[open_]
            row, col = np.nonzero(guess <= (limit + error)[:, None])
            if self.estimates.coded and not closely and len(row):
                guess, error = self.estimates.closer(self.a[rows], row, col + lo)
                left = guess <= (limit + error)[row]
                row, col = row[left], col[left]
        row, col = rows[row], col + lo
        if self.mine is not None:
            other = self.mine[row] != self.ids[col]
            row, col = row[other], col[other]
        if not len(row):
            return
        with np.errstate(over="ignore", invalid="ignore"):
            found = exact(self.a[row], self.estimates.b[col], self.estimates.metric)
        good = np.isfinite(found) & (found <= self.limit[row])
        row, col, found = (np.concatenate(x) for x in ((self.row, row[good]), (self.col, col[good]), (self.distance, found[good])))
        order = np.lexsort((self.ids[col], found, row))
        row, col, found = row[order], col[order], found[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        last = place == self.k - 1
        self.limit[row[last]] = np.minimum(self.limit[row[last]], found[last])
        kept = place < self.k
        self.row, self.col, self.distance = row[kept], col[kept], found[kept]


def nearest(
    queries: DataFrame,
    base: DataFrame,
    k: int,
    metric: str = "euclidean",
    skip_same_id: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``id, rank, neighbor, y, distance``: the exact k nearest rows of ``base`` for each query.

    ``queries`` has ``id, v`` and ``base`` has ``id, v, y``; ``v`` is an array of numbers. Ties go to the
    lower neighbor id. Each block answers with its own k best, so k rows per query and block are merged.
    """
    id_type, base_type = queries.schema["id"].dataType, base.schema["id"].dataType
    schema = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("neighbor", base_type),
            T.StructField("y", T.DoubleType()),
            T.StructField("distance", T.DoubleType()),
        ]
    )

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"id": [], "neighbor": [], "y": [], "distance": []})
        if left.empty or right.empty:
            return empty
        right = right.sort_values("id", kind="stable").reset_index(drop=True)
        b, y, ids = matrix(right), right["y"].to_numpy(dtype=float), right["id"].to_numpy()
        a, mine = matrix(left), left["id"].to_numpy()
        estimates, place, out = Estimates(b, metric), np.arange(len(right)), []
        # rows of `right` are in id order, so their places settle ties
        codes = ids if ids.dtype.kind in "iuf" else place
        for start in range(0, len(left), QUERY_TILE):
            owners = mine[start : start + QUERY_TILE]
            own = None
            if skip_same_id:
                own = owners if codes is ids else pd.Index(ids).get_indexer(owners)
            best_ = Best(a[start : start + QUERY_TILE], own, codes, estimates, k)
            best_.add(0, len(right))
            out.append(pd.DataFrame({"id": owners[best_.row], "neighbor": ids[best_.col], "y": y[best_.col], "distance": best_.distance}))
        return pd.concat(out, ignore_index=True)

    part = block_pairs(queries.select("id", "v"), base.select("id", "v", "y"), best, schema, block_rows)
    w = W.partitionBy("id").orderBy("distance", "neighbor")
    return part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def vote(neighbors: DataFrame, k: int, weights: str = "uniform") -> DataFrame:
    """``id, score``: the share of positives among the k nearest, by count or by inverse distance."""
    near = neighbors.where(F.col("rank") <= k)
    if weights == "uniform":
        return near.groupBy("id").agg(F.avg("y").alias("score"))
    touching = F.col("distance") == 0
    inverse = F.try_divide(F.lit(1.0), F.col("distance"))
    return near.groupBy("id").agg(
        F.coalesce(
            # a query that lies on some of its neighbors listens to those alone
            F.avg(F.when(touching, F.col("y"))),
            F.sum(inverse * F.col("y")) / F.sum(inverse),
        ).alias("score")
    )


def silhouette_values(points: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``id, cluster, silhouette`` for ``id, v, cluster``: exact mean Euclidean distances."""
    schema = T.StructType(
        [
            T.StructField("id", points.schema["id"].dataType),
            T.StructField("cluster", T.IntegerType()),
            T.StructField("other", T.IntegerType()),
            T.StructField("total", T.DoubleType()),
            T.StructField("n", T.LongType()),
        ]
    )

    def sums(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({f.name: [] for f in schema})
        a, b = matrix(left), matrix(right)
        labels, place = np.unique(right["cluster"].to_numpy(), return_inverse=True)
        member = np.eye(len(labels))[place]
        total = np.vstack(
            [distances(a[s : s + TILE_ROWS], b, "euclidean") @ member for s in range(0, len(a), TILE_ROWS)]
        )
        n = member.sum(axis=0).astype(int)
        return pd.DataFrame(
            {
                "id": np.repeat(left["id"].to_numpy(), len(labels)),
                "cluster": np.repeat(left["cluster"].to_numpy(), len(labels)),
                "other": np.tile(labels, len(left)),
                "total": total.ravel(),
                "n": np.tile(n, len(left)),
            }
        )

    rows = points.select("id", "v", F.col("cluster").cast("int").alias("cluster"))
    merged = (
        block_pairs(rows, rows, sums, schema, block_rows)
        .groupBy("id", "cluster", "other")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    )
    own = F.col("other") == F.col("cluster")
    per_point = merged.groupBy("id", "cluster").agg(
        F.max(F.when(own, F.try_divide(F.col("total"), (F.col("n") - 1).cast("double")))).alias("a"),
        F.max(F.when(own, F.col("n"))).alias("size"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
    )
    value = F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b"))
    return per_point.select(
        "id", "cluster", F.when(F.col("size") == 1, F.lit(0.0)).otherwise(F.coalesce(value, F.lit(0.0))).alias("silhouette")
    )
