"""Vector code compression: product codes whose nearest entries are found in a lexicographic trie over distinct parts.

Vectors become integers and are cut into parts. Equal parts are counted once, ordered lexicographically and dealt in ranges, so
a task holds neighbouring branches of the trie. It walks them depth first, some leaves of one subtree at a time: a node's
squared distances to all entries of the codebook are its parent's plus those of one more dimension, and are worked out
once for all leaves below it. A leaf takes the least distance and adds its part, as often as it occurs, to that entry.
Only sums of one fixed size per entry leave a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortlens.llm.store import stored

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
LEAVES = 128  # of one subtree that are walked together; their distances fit a core's own cache
LARGEST = 1 << 26  # of a component's integer, so that sums of squares are exact
SALTS = 16


def walk(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (ties: the lower one) and squared distance of each row of ``part``, whose rows are in lexicographic order."""
    n, width = part.shape
    entry, error = np.empty(n, np.int64), np.empty(n, np.int64)
    reach = (int(np.abs(part).max(initial=0)) + int(np.abs(book).max(initial=0))) ** 2 * max(width, 1)
    kind = np.int32 if reach < 1 << 31 else np.int64
    part, book = part.astype(kind), book.astype(kind)
    # a row opens a node at every depth from its first difference to the row before
    new = np.ones((n, width), bool)
    if n > 1:
        np.logical_or.accumulate(part[1:] != part[:-1], axis=1, out=new[1:])
    for at in range(0, n, LEAVES):
        rows, opens = part[at : at + LEAVES], new[at : at + LEAVES].copy()
        opens[0] = True
        sums, above = np.zeros((1, len(book)), kind), np.zeros(len(rows), np.int64)
        for d in range(width):
            first = np.flatnonzero(opens[:, d])
            step = rows[first, d][:, None] - book[None, :, d]
            step *= step
            # as many nodes as parents: each has one child, and the parents' sums are taken over
            sums = step + sums[above[first]] if len(first) > len(sums) else np.add(sums, step, out=sums)
            above = np.cumsum(opens[:, d]) - 1
        best = sums.argmin(axis=1)
        entry[at : at + LEAVES] = best[above]
        error[at : at + LEAVES] = sums[np.arange(len(best)), best][above]
    return entry, error


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _sums(books: list[np.ndarray]):
    """Weighted sums of the parts that each entry is nearest to, one row an entry that has any."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((len(b), b.shape[1]), np.int64) for b in books]
        count = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            place, weight = batch["part"].to_numpy(), batch["n"].to_numpy()
            for p in np.unique(place):
                own = pa.array(np.flatnonzero(place == p))
                values = _matrix(batch["values"].take(own), books[p].shape[1])
                times = weight[place == p]
                entry, _ = walk(values, books[p])
                np.add.at(total[p], entry, values * times[:, None])
                np.add.at(count[p], entry, times)
        for p, (sums, n) in enumerate(zip(total, count)):
            used = np.flatnonzero(n)
            if len(used):
                columns = [pa.array(np.full(len(used), p), pa.int32()), pa.array(used, pa.int32()), pa.array(n[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "sums"])

    return go


def _codes(books: list[np.ndarray]):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.cumsum([0] + [b.shape[1] for b in books])
        for batch in batches:
            rows = _matrix(batch["values"], int(edges[-1]))
            error, code = np.zeros(len(rows), np.int64), np.empty((len(rows), len(books)), np.uint8)
            for p, book in enumerate(books):
                part = np.ascontiguousarray(rows[:, edges[p] : edges[p + 1]])
                by = np.lexsort(part.T[::-1]) if part.shape[1] else np.arange(len(part))
                entry, least = walk(part[by], book)
                code[by, p] = entry
                error[by] += least
            codes = pa.array([c.tobytes().hex() for c in code], pa.string())
            own = [batch[c] for c in ("row", "id", "label")]
            yield pa.RecordBatch.from_arrays([*own, codes, pa.array(error)], names=["row", "id", "label", "code", "error"])

    return go


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, int]:
    """``row, id, label, values`` of the rows that are kept, written once, and the number of components."""
    v = F.col(vector_col).cast("array<double>")
    whole = F.size(v) > 0
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = F.transform(v, lambda x: F.greatest(F.least(F.floor(x * SCALE), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int"))
    base = vectors.where(v.isNotNull() & whole & finite).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(label_col).alias("label"), scaled.alias("values")
    )
    rows = stored(base, "integers")
    lengths = rows.groupBy(F.size("values").alias("width")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("width")).first()
    width = usual["width"] if usual else 0
    return rows.where(F.size("values") == width), width


def fit(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """One codebook for each part position, from all rows."""
    edges = [p * (width // parts) + min(p, width % parts) for p in range(parts + 1)]
    # the list of starting entries has a fixed size
    first = rows.orderBy(F.asc_nulls_last("id"), "values").limit(entries).select("values").collect()
    start = np.array([r["values"] for r in first], np.int64).reshape(len(first), width)
    books = [start[:, a:b].copy() for a, b in zip(edges, edges[1:])]
    cuts = [F.struct(F.lit(p).alias("part"), F.slice("values", a + 1, b - a).alias("values")) for p, (a, b) in enumerate(zip(edges, edges[1:]))]
    each = rows.select(F.explode(F.array(*cuts)).alias("x")).select("x.part", "x.values")
    distinct = stored(each.groupBy("part", "values").agg(F.count("*").alias("n")), "distinct_parts")
    # neighbouring branches of the trie lie in one task, in order; a part that many vectors share is one row by now
    leaves = stored(distinct.repartitionByRange(F.col("part"), F.col("values")).sortWithinPartitions("part", "values"), "leaves")
    for _ in range(rounds):
        found = leaves.mapInArrow(_sums(books), "part int, entry int, n long, sums array<long>")
        widest = max(b - a for a, b in zip(edges, edges[1:]))
        total = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(j))) for j in range(widest)]).alias("sums"))
        # one row an entry: at most parts * entries
        for r in total.collect():
            book = books[r["part"]]
            book[r["entry"]] = [x // r["n"] for x in r["sums"][: book.shape[1]]]
    return books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``id, label, code, error, label_error`` for each kept row, and the codebooks.

    A component x counts as floor(1024 * x); beyond ``LARGEST`` either way it counts as that bound, so that distances are exact.
    Rows go whose vector is null, empty or holds a null or non-finite component, and rows whose length is not the usual one (the most
    frequent; ties: the longer). A length that ``parts`` does not divide gives the first parts one component more. Codebooks start from
    the least ids (nulls last; equal ids by their vectors), fewer rows than ``entries`` give fewer entries. Distance ties go to the
    lower entry. Repeated rows count each time. ``label_error`` sums over equal labels, nulls together; it is null beyond the range of a long.
    Empty table: no rows, empty codebooks. Other columns are neither read nor in the way.
    """
    rows, width = integer_vectors(vectors, id_col, vector_col, label_col)
    books = fit(rows, width, parts, entries, rounds)
    names = ("row", "id", "label")
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names)
    full = stored(rows.select(*names, "values").mapInArrow(_codes(books), f"{kinds}, code string, error long"), "codes")
    # a label may hold any share of the rows: its sum meets them in several tasks
    sums = full.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("s"))
    sums = sums.select(F.col("label").alias("_l"), F.expr("try_cast(s AS BIGINT)").alias("label_error"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s"))
    salted = full.withColumn("_s0", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    out = salted.join(sums, F.col("label").eqNullSafe(F.col("_l")) & (F.col("_s0") == F.col("_s")))
    return out.select("id", "label", "code", "error", "label_error"), books
