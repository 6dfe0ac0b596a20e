"""Tables a job writes on its way, and small helpers that several operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortlens.session import shared_folder


_noted: list[list[str]] = []  # paths of open scopes


@contextmanager
def noting(paths: list[str]) -> Iterator[None]:
    """Add the paths of the tables that are written inside to ``paths``."""
    _noted.append(paths)
    try:
        yield
    finally:
        _noted.remove(paths)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that no reader needs any more."""
    jvm = spark.sparkContext._jvm
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later reads survive a lost executor and see the same rows."""
    path = f"{shared_folder(df.sparkSession)}/{label}"
    for paths in _noted:
        paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apart(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt by ``key``, all rows of one together, for tasks that take a partition as it comes.

    Dealt by a hash of the key, as Spark leaves out a repartition by the very column that a join below has dealt by, and may then
    turn that join into one that deals nothing.
    """
    return df.repartition(F.xxhash64(key))


def numbered(docs: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``docs`` with a number for each row, fixed by writing it, and the name of that column, which clashes with no other."""
    name = "_row_number"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), label), name


def without(rows: DataFrame, number: str, dropped: DataFrame) -> DataFrame:
    """The rows whose number is not in ``dropped`` (one column). Texts move only if the numbers are too many to send around."""
    gone = dropped.toDF("_gone")
    return rows.join(gone, rows[number] == gone["_gone"], "left_anti").drop(number)


def whole_text(text: str = "text") -> Column:
    """The text of a row, empty where it is null."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def in_fold(key: str | Column, parts: int) -> Column:
    """Whether crc32 of the key as text leaves remainder 0; a null key counts as empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts == 0


def worker_state(name: str, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from one task to the next, made on first use."""
    home = sys.modules.setdefault("_cohortlens_worker", types.ModuleType("_cohortlens_worker"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


BLOCK = 1 << 16
BLOCKS = "block int, slot long, sums binary"
TOGETHER = 64  # rows that one step adds up, so many tasks need a few steps, and no step a large group


def in_blocks(total: np.ndarray) -> pa.RecordBatch:
    """A task's sums of fixed size as rows that ``added`` can add up."""
    from pyspark import TaskContext

    blocks = [total[a : a + BLOCK].tobytes() for a in range(0, len(total), BLOCK)]
    slots = [TaskContext.get().partitionId()] * len(blocks)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(blocks)), pa.int32()), pa.array(slots, pa.int64()), pa.array(blocks, pa.binary())], names=["block", "slot", "sums"]
    )


def added(parts: DataFrame, size: int, kind: str) -> np.ndarray:
    """Sums of ``kind`` over all tasks, ``TOGETHER`` rows at a time. A fixed number of rows is collected."""
    width = np.dtype(kind).itemsize

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(len(table["sums"][0].as_buffer()) // width, "f8" if kind[0] == "f" else "i8")
        for x in table["sums"]:
            total += np.frombuffer(x.as_buffer(), kind)
        return pa.table({"block": table["block"].slice(0, 1), "slot": table["slot"].slice(0, 1), "sums": pa.array([total.astype(kind).tobytes()], pa.binary())})

    # task numbers are below 2**24; the last step meets at most as many rows as the others
    for step in (TOGETHER, TOGETHER**2, TOGETHER**4):
        parts = parts.groupBy("block", F.floor(F.col("slot") / step).alias("_s")).applyInArrow(add, BLOCKS)
    out = np.zeros(size, "f8" if kind[0] == "f" else "i8")
    for r in parts.collect():
        out[r["block"] * BLOCK : r["block"] * BLOCK + len(r["sums"]) // width] += np.frombuffer(r["sums"], kind)
    return out
