"""Exact nearest neighbors by cells around pivots: a query opens only the cells that can hold a nearer row.

Rows of the base belong to the nearest of about sqrt(n) pivots. With d the distance from a query to a pivot and r that of a row to the
same pivot, the row is at least |d - r| and at most d + r away. So the least r of the cells bound the k-th distance of a query
from above before any row is read, and the range of r bounds what a cell can hold from below; with Euclidean distances, so does the
plane between two pivots. Cells lie together in blocks. A query meets the block of its nearest pivot first, which lowers the bound, then the
other blocks with cells that are left. Inside a cell rows are in order of r, and only those within the bound are compared.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window as W, functions as F

from cohortlens.functions.seeded import seeded_tag
from cohortlens.operators.pairs import QUERY_TILE, Best, Estimates, distances
from cohortlens.session import written

CELLS = 1 << 12  # at most; the pivots are sent to all tasks
BASE_BLOCK = 65_536  # rows of some cells in one task
QUERY_BLOCK = 512  # queries are not cut smaller than this for the sake of more tasks
TILE = 64
SLACK = 1e-9  # of a bound, for rounding

# the functions below travel with the task: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _assign(pivots: np.ndarray, metric: str):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch["v"])
            cell, r = np.zeros(len(v), np.int32), np.zeros(len(v))
            for a in range(0, len(v), TILE):
                d = distances(v[a : a + TILE], pivots, metric)
                cell[a : a + TILE], r[a : a + TILE] = d.argmin(axis=1), d.min(axis=1)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("id", "v", "y")), pa.array(cell), pa.array(r)], names=["id", "v", "y", "cell", "r"])

    return go


def _least(k: int):
    """Of each cell the number of rows, the range of r and the ``k`` least r, as far as a task has them."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for batch in batches:
            cell, r = batch["cell"].to_numpy(), batch["r"].to_numpy()
            for c in np.unique(cell):
                own = r[cell == c]
                n, top, low = seen.get(int(c), (0, 0.0, np.zeros(0)))
                seen[int(c)] = (n + len(own), max(top, own.max()), np.sort(np.concatenate([low, own]))[:k])
        cells = list(seen)
        columns = [pa.array(cells, pa.int32()), pa.array([seen[c][0] for c in cells], pa.int64()), pa.array([seen[c][1] for c in cells], pa.float64())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([list(seen[c][2]) for c in cells], pa.list_(pa.float64()))], names=["cell", "n", "most", "least"])

    return go


class Cells:
    """Pivots with the range of r and the least r of their cells, and the blocks that the cells belong to."""

    def __init__(self, pivots: np.ndarray, most: np.ndarray, least: np.ndarray, first: np.ndarray, last: np.ndarray, metric: str) -> None:
        self.pivots, self.most, self.least, self.first, self.last, self.metric = pivots, most, least, first, last, metric
        self.apart = distances(pivots, pivots, metric)

    def lower(self, d: np.ndarray) -> np.ndarray:
        """What a row of each cell is away at least from queries ``d`` away from the pivots."""
        low = np.maximum(np.maximum(d - self.most, self.least[:, 0] - d), 0)
        if self.metric == "euclidean":
            own = d.argmin(axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = (d * d - (d[np.arange(len(d)), own] ** 2)[:, None]) / (2 * self.apart[own])
            low = np.maximum(low, np.where(np.isfinite(plane), plane, 0))
        low[:, ~np.isfinite(self.least[:, 0])] = np.inf
        return low

    def limits(self, d: np.ndarray, k: int) -> np.ndarray:
        """A bound on the k-th distance."""
        upper = (d[:, :, None] + self.least[None, :, :]).reshape(len(d), -1)
        return np.partition(upper, k - 1, axis=1)[:, k - 1] if upper.shape[1] >= k else np.full(len(d), np.inf)


def _first(cells: Cells, k: int):
    """For each query a bound on the k-th distance, its nearest cell and the block in which that begins."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch["v"])
            near, bound = np.zeros(len(v), np.int32), np.zeros(len(v))
            for a in range(0, len(v), TILE):
                d = distances(v[a : a + TILE], cells.pivots, cells.metric)
                near[a : a + TILE], bound[a : a + TILE] = d.argmin(axis=1), cells.limits(d, k)
            columns = [batch["id"], batch["v"], pa.array(near), pa.array(bound), pa.array(cells.first[near].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "v", "near", "bound", "block"])

    return go


def _others(cells: Cells, blocks: int):
    """Each query once for every further block with a cell that can hold a nearer row."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, bound, done = _matrix(batch["v"]), batch["bound"].to_numpy(), batch["block"].to_numpy()
            for a in range(0, len(v), TILE):
                low = cells.lower(distances(v[a : a + TILE], cells.pivots, cells.metric))
                row, cell = np.nonzero((low <= bound[a : a + TILE, None] * (1 + SLACK) + SLACK) & np.isfinite(low))
                wanted = np.zeros((len(low), blocks + 1), np.int32)
                np.add.at(wanted, (row, cells.first[cell]), 1)
                np.add.at(wanted, (row, cells.last[cell] + 1), -1)
                row, block = np.nonzero(np.cumsum(wanted, axis=1)[:, :blocks] > 0)
                other = block != done[a + row]
                row, block = pa.array(a + row[other]), pa.array(block[other].astype(np.int32))
                columns = [*(batch[c].take(row) for c in ("id", "v", "near", "bound")), block]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "v", "near", "bound", "block"])

    return go


def _search(cells: Cells, k: int, skip_same_id: bool, blank: list[str]):
    """The ``k`` best rows of a block for each query of a part, among those within its bound; only cells that can hold them are read."""

    def go(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({c: [] for c in blank})]
        if len(left) and len(right):
            right = right.sort_values(["b_cell", "b_r", "b_id"], kind="stable")
            left = left.sort_values(["q_near", "q_id"], kind="stable")
            b, r, ids, y = (np.stack(right["b_v"].to_numpy()).astype(float), right["b_r"].to_numpy(), right["b_id"].to_numpy(), right["b_y"].to_numpy(dtype=float))
            names, begin = np.unique(right["b_cell"].to_numpy(), return_index=True)
            end = np.append(begin[1:], len(b))
            q, mine = np.stack(left["q_v"].to_numpy()).astype(float), left["q_id"].to_numpy()
            bound = left["q_bound"].to_numpy() * (1 + SLACK) + SLACK
            estimates = Estimates(b, cells.metric)
            codes = ids if ids.dtype.kind in "iuf" else pd.Series(ids).rank(method="dense").to_numpy()
            for a in range(0, len(q), QUERY_TILE):
                part = slice(a, a + QUERY_TILE)
                own = None
                if skip_same_id:
                    own = mine[part] if codes is ids else pd.Series(codes, index=ids).reindex(mine[part]).to_numpy()
                best = Best(q[part], own, codes, estimates, k, bound[part])
                d = distances(q[part], cells.pivots, cells.metric)
                low, d = cells.lower(d)[:, names], d[:, names]
                took = np.zeros(len(d), np.int64)
                for c in np.argsort(low.min(axis=0), kind="stable"):
                    rows = np.flatnonzero(low[:, c] <= best.limit * (1 + SLACK) + SLACK)
                    if not len(rows):
                        continue
                    limit = best.limit[rows] * (1 + SLACK) + SLACK
                    own_r = r[begin[c] : end[c]]
                    lo = begin[c] + int(np.searchsorted(own_r, (d[rows, c] - limit).min(), side="left"))
                    hi = begin[c] + int(np.searchsorted(own_r, (d[rows, c] + limit).max(), side="right"))
                    if hi > lo:
                        best.add(lo, hi, rows)
                        took[rows] += hi - lo
                out.append(pd.DataFrame({"id": mine[part][best.row], "neighbor": ids[best.col], "y": y[best.col], "distance": best.distance, "took": 0}))
                out.append(pd.DataFrame({"id": mine[part], "neighbor": None, "y": np.nan, "distance": np.nan, "took": took}))
        return pd.concat([x for x in out if len(x)] or out, ignore_index=True)

    return go


def nearest(queries: DataFrame, base: DataFrame, k: int, metric: str = "euclidean", skip_same_id: bool = False, cells: int | None = None) -> DataFrame:
    """``id, rank, neighbor, y, distance, distances``: the exact k nearest rows of ``base`` for each query, ties to the lower neighbor id.

    ``queries`` has ``id, v`` and ``base`` has ``id, v, y``, ids unique, ``v`` an array of numbers of one length; ``metric`` is euclidean or
    manhattan. ``distances`` counts those that were worked out for the query, to pivots and to rows.
    """
    base = written(base.select("id", F.col("v").cast("array<double>").alias("v"), F.col("y").cast("double").alias("y")), "base")
    queries = queries.select("id", F.col("v").cast("array<double>").alias("v"))
    kinds = [df.schema["id"].dataType.simpleString() for df in (queries, base)]
    total = base.count()
    blank = ["id", "neighbor", "y", "distance", "took"]
    wanted = cells or min(CELLS, max(1, math.isqrt(total)))
    picked = base.orderBy(seeded_tag("pivots", "id"), "id").limit(wanted).select("v").collect()  # a bounded list
    if not picked:
        return queries.limit(0).select("id", F.lit(0).alias("rank"), F.lit(None).cast(kinds[1]).alias("neighbor"), F.lit(0.0).alias("y"), F.lit(0.0).alias("distance"), F.lit(0).cast("long").alias("distances"))
    pivots = np.array([r["v"] for r in picked], float).reshape(len(picked), -1)
    celled = written(base.mapInArrow(_assign(pivots, metric), f"id {kinds[1]}, v array<double>, y double, cell int, r double"), "celled")
    kk = k + 1 if skip_same_id else k
    facts = celled.select("cell", "r").mapInArrow(_least(kk), "cell int, n long, most double, least array<double>").groupBy("cell")
    facts = facts.agg(F.sum("n").alias("n"), F.max("most").alias("most"), F.slice(F.array_sort(F.flatten(F.collect_list("least"))), 1, kk).alias("least")).collect()
    most, least, sizes = np.full(len(pivots), -np.inf), np.full((len(pivots), kk), np.inf), {}
    for r in facts:  # one row a cell
        most[r["cell"]], sizes[r["cell"]] = r["most"], r["n"]
        least[r["cell"], : len(r["least"])] = r["least"]
    # cells one after the other in blocks of bounded size; a large cell has several
    upto, first, last = 0, np.zeros(len(pivots), np.int64), np.zeros(len(pivots), np.int64)
    for c in sorted(sizes):
        if upto % BASE_BLOCK + sizes[c] > BASE_BLOCK:
            upto += -upto % BASE_BLOCK
        first[c], last[c] = upto // BASE_BLOCK, (upto + sizes[c] - 1) // BASE_BLOCK
        upto += sizes[c]
    n_blocks = -(-upto // BASE_BLOCK)
    table = Cells(pivots, most, least, first, last, metric)
    spark = base.sparkSession
    tasks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = spark.createDataFrame([(c, int(first[c]), int(last[c] - first[c]) + 1) for c in sorted(sizes)], "cell int, first int, pieces int")
    stored = celled.join(F.broadcast(ranges), "cell").select(  # one row a cell
        (F.col("first") + F.pmod(F.xxhash64("id"), F.col("pieces"))).cast("int").alias("block"), *[F.col(c).alias(f"b_{c}") for c in ("id", "v", "y", "cell", "r")]
    )
    shape = f"id {kinds[0]}, v array<double>, near int, bound double, block int"

    def opened(rows: DataFrame) -> DataFrame:
        """Search of ``id, v, near, bound, block`` in their blocks; a vector moves once for each block."""
        counts = rows.groupBy("block").agg(F.count("*").alias("n"))
        # each part takes a copy of the block, so there are no more than the tasks need
        enough = F.least(F.lit(-(-tasks // n_blocks)), F.ceil(F.col("n") / QUERY_BLOCK))
        parts = counts.select("block", F.greatest(F.lit(1), F.ceil(F.col("n") / BASE_BLOCK), enough).cast("int").alias("parts"))
        parts = F.broadcast(spark.createDataFrame(parts.collect(), "block int, parts int"))  # one row a block
        left = rows.join(parts, "block").select("block", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), *[F.col(c).alias(f"q_{c}") for c in ("id", "v", "near", "bound")])
        right = stored.join(parts, "block").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))
        schema = f"id {kinds[0]}, neighbor {kinds[1]}, y double, distance double, took long"
        return written(found.applyInPandas(_search(table, k, skip_same_id, blank), schema), "found")

    asked = written(queries.mapInArrow(_first(table, kk), shape), "asked")
    one = opened(asked)
    # the k-th row of the first block lowers the bound
    kth = one.where("neighbor IS NOT NULL").groupBy("id").agg(F.count("*").alias("_n"), F.max("distance").alias("_kth"))
    kth = kth.where(F.col("_n") >= k).select("id", "_kth")
    two = one.limit(0)
    if n_blocks > 1:
        rest = asked.join(kth, "id", "left").withColumn("bound", F.least("bound", F.coalesce("_kth", "bound"))).drop("_kth")
        two = opened(written(rest.mapInArrow(_others(table, n_blocks), shape), "further"))
    every = one.unionByName(two)
    took = every.where("neighbor IS NULL").groupBy("id").agg((F.sum("took") + len(pivots)).alias("distances"))
    w = W.partitionBy("id").orderBy("distance", "neighbor")
    best = every.where("neighbor IS NOT NULL").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return best.join(took, "id").select("id", "rank", "neighbor", "y", "distance", "distances")
