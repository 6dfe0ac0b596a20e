"""Exact dedup: Grace hash deduplication over complete texts.

Records are dealt to buckets by a 64-bit hash of the text; a bucket that is too large is dealt anew by further bits, again
and again, until it fits an open-addressing table, which compares complete texts. The spill files are Spark's: a table
in the shared folder, and shuffles of it, so a lost executor costs a few tasks. Before anything moves, each task
replaces copies that it has already seen by a pointer to the first one, so a text with a third of all rows reaches its
bucket at most once for each task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.llm.store import numbered, stored, whole_text, without
from cohortlens.llm.text import slices

BUCKET_BYTES = 32 << 20  # of one table: contents and what it holds beside each
COMBINED_BYTES = 16 << 20  # of the table in which a task looks for copies before anything moves
ENTRY_BYTES = 400  # beside the content: number, hash, digest, slots and the objects that hold them
SLICE = 4 << 20  # bytes of texts that are out of their Arrow buffer at a time, or one text
LISTED = 1_000  # buckets that a level deals anew by name; with more, it deals all


class ContentTable:
    """Open addressing with linear probing; a hit means that the complete contents are equal."""

    def __init__(self) -> None:
        self.slots, self.hashes, self.contents, self.bytes = [-1] * 1024, [], [], 0

    def place(self, h: int, content: bytes | memoryview) -> tuple[int, bool]:
        """Number of the entry with this content, and whether it is new."""
        mask = len(self.slots) - 1
        at = h & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == h and len(self.contents[entry]) == len(content) and self.contents[entry] == bytes(content):
                return entry, False
            at = (at + 1) & mask
        self.slots[at] = entry = len(self.hashes)
        self.hashes.append(h)
        self.contents.append(bytes(content))
        self.bytes += len(content) + ENTRY_BYTES
        if 2 * len(self.hashes) > len(self.slots):
            self._grow()
        return entry, True

    def _grow(self) -> None:
        mask = 4 * len(self.slots) - 1
        self.slots = [-1] * (mask + 1)
        for entry, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def _combine(table_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of the texts that are equal within a task, only the first keeps its text; the others point to it.

    The table starts anew when it holds ``table_bytes``; copies on both sides of that meet in their bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, rows, digests = ContentTable(), [], []
        for batch in batches:
            for part in slices(batch["text"], SLICE):
                own = batch.slice(part.first, part.n)
                data, edges = memoryview(part.data), part.offsets.tolist()
                rep, digest, hashes, texts = [], [], [], []
                for row, a, b in zip(own["row_id"].to_pylist(), edges, edges[1:]):
                    if table.bytes > table_bytes:
                        table, rows, digests = ContentTable(), [], []
                    h = xxhash.xxh3_64_intdigest(data[a:b])
                    entry, new = table.place(h, data[a:b])
                    if new:
                        rows.append(row)
                        digests.append(hashlib.sha256(data[a:b]).hexdigest())
                    rep.append(rows[entry])
                    digest.append(digests[entry])
                    hashes.append(h - (1 << 64) if h >> 63 else h)
                    texts.append(table.contents[entry] if new else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        own["row_id"],
                        own["id"],
                        pa.array(rep, pa.int64()),
                        pa.array(digest, pa.string()),
                        pa.array(hashes, pa.int64()),
                        pa.array(part.offsets[1:] - part.offsets[:-1], pa.int64()),
                        pa.array(texts, pa.binary()),
                    ],
                    names=["row_id", "id", "rep", "sha256", "hash", "size", "content"],
                )
        del table
        pa.default_memory_pool().release_unused()

    return run


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come bucket after bucket; each bucket has a table of its own."""
    table, bucket, first = ContentTable(), None, []
    for batch in batches:
        for part in slices(batch["content"], SLICE):
            own, group = batch.slice(part.first, part.n), []
            data, edges = memoryview(part.data), part.offsets.tolist()
            columns = (own[c].to_pylist() for c in ("bucket", "rep", "hash"))
            for b, rep, h, start, end in zip(*columns, edges, edges[1:]):
                if b != bucket:
                    table, bucket, first = ContentTable(), b, []
                entry, new = table.place(h & 0xFFFFFFFFFFFFFFFF, data[start:end])
                if new:
                    first.append(rep)
                group.append(first[entry])
            yield pa.RecordBatch.from_arrays([own["rep"], pa.array(group, pa.int64())], names=["rep", "group"])
    del table
    pa.default_memory_pool().release_unused()


def _digit(level: int, fan: int) -> Column:
    """The bits of the hash that deal out at a level."""
    return F.pmod(F.xxhash64(F.col("hash"), F.lit(level)), F.lit(fan))


def _groups(records: DataFrame, bucket_bytes: int) -> DataFrame:
    """``rep`` and the ``group`` it belongs to, from ``rep, hash, size, content``."""
    done, todo, level = None, records, 0
    path = F.lit(0).cast("long")
    while True:
        held = F.sum(F.col("size") + ENTRY_BYTES)
        total = todo.agg(held).first()[0] or 0
        fan = max(1, math.ceil(2 * total / bucket_bytes))
        todo = todo.withColumn("bucket", F.xxhash64(path, _digit(level, fan)))
        sizes = todo.groupBy("bucket").agg(held.alias("size"), F.min("hash").alias("lo"), F.max("hash").alias("hi"))
        # one hash cannot be dealt out further: its copies, at most one for each task, meet in one table entry
        large = [r[0] for r in sizes.where((F.col("size") > bucket_bytes) & (F.col("lo") != F.col("hi"))).select("bucket").limit(LISTED + 1).collect()]
        fits = todo if not large else todo.where(~F.col("bucket").isin(large)) if len(large) <= LISTED else None
        if fits is not None:
            found = (
                fits.select("bucket", "rep", "hash", "content")
                .repartition("bucket")
                .sortWithinPartitions("bucket")
                .mapInArrow(_probe, "rep long, group long")
            )
            done = found if done is None else done.unionByName(found)
        if not large:
            return done
        if fits is not None:
            # spill files of the next level: only what lies in large buckets
            todo = stored(todo.where(F.col("bucket").isin(large)), f"spill_{level}")
        path, level = F.col("bucket"), level + 1


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
    normalised: Callable[[Column], Column] | None = None,
    row_col: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``row_id, id, keep_id, group_size, kept, sha256`` (of the text in UTF-8).

    Texts are equal when identical after ``normalised`` (none: no change). Of equal texts the row with the largest id stays;
    of rows that also share the id, one stays. A null text is empty, a null id the smallest. An empty table gives no rows.
    Other columns are neither read nor in the way, but for ``row_col``, a unique number for each row, if given. Long texts are taken whole:
    a task holds one table of bounded bytes and one slice of texts, or the longest text.
    """
    text = whole_text(text_col)
    base = docs.select(
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row_id"), F.col(id_col).alias("id"), (normalised(text) if normalised else text).alias("text")
    )
    id_type = base.schema["id"].dataType.simpleString()
    schema = f"row_id long, id {id_type}, rep long, sha256 string, hash long, size long, content binary"
    # row numbers are fixed by this write, and every later step reads them from it
    rows = stored(base.mapInArrow(_combine(min(bucket_bytes, COMBINED_BYTES)), schema), "records")
    records = rows.where(F.col("content").isNotNull()).select("rep", "hash", "size", "content")
    groups = stored(_groups(records, bucket_bytes), "groups")
    members = rows.select("row_id", "id", "rep", "sha256")
    last = F.max(F.struct("id", "row_id")).alias("last")
    reps = members.groupBy("rep").agg(F.count("*").alias("n"), last).join(groups, "rep")
    whole = reps.groupBy("group").agg(F.sum("n").alias("group_size"), F.max("last").alias("last"))
    verdicts = groups.join(whole, "group").select("rep", "group_size", F.col("last.id").alias("keep_id"), F.col("last.row_id").alias("keep_row"))
    return members.join(verdicts, "rep").select(
        "row_id", "id", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept"), "sha256"
    )


def kept(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows, number = numbered(docs, "numbered")
    return without(rows, number, exact_dedup(rows, row_col=number, **options).where(~F.col("kept")).select("row_id"))
